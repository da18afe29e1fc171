"""Writers of minimal files in many formats: the way back from a text to bytes, for exact round trips of the parsers."""

from __future__ import annotations

import gzip
import io
import json
import struct
import zipfile
import zlib
from html import escape

LINE_WORDS = 10


def _zipped(**files: str | bytes) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in files.items():
            z.writestr(zipfile.ZipInfo(name), data)
    return out.getvalue()


def pdf(lines: list[str]) -> bytes:
    show = "\n".join(f"({x.translate(str.maketrans({'(': r'\(', ')': r'\)', chr(92): r'\\'}))}) Tj 0 -14 Td" for x in lines)
    page = zlib.compress(f"BT /F1 12 Tf 40 800 Td\n{show}\nET".encode("cp1252", "replace"))
    objects = [b"<< /Type /Catalog /Pages 2 0 R >>", b"<< /Type /Pages /Kids [3 0 R] /Count 1 >>", b"<< /Type /Page /Parent 2 0 R /Contents 4 0 R >>", b"<< /Length %d /Filter /FlateDecode >>\nstream\n%s\nendstream" % (len(page), page)]
    return b"%PDF-1.4\n" + b"".join(b"%d 0 obj\n%s\nendobj\n" % (k, o) for k, o in enumerate(objects, 1)) + b"trailer << /Root 1 0 R >>\n%%EOF"


def docx(lines: list[str]) -> bytes:
    body = "".join(f"<w:p><w:r><w:t>{escape(x)}</w:t></w:r></w:p>" for x in lines)
    return _zipped(**{"word/document.xml": f'<w:document xmlns:w="w"><w:body>{body}</w:body></w:document>'})


def pptx(lines: list[str]) -> bytes:
    body = "".join(f"<a:p><a:r><a:t>{escape(x)}</a:t></a:r></a:p>" for x in lines)
    return _zipped(**{"ppt/slides/slide1.xml": f'<p:sld xmlns:p="p" xmlns:a="a"><p:txBody>{body}</p:txBody></p:sld>'})


def xlsx(lines: list[str]) -> bytes:
    cells = "".join(f'<row><c r="A{k}" t="inlineStr"><is><t>{escape(x)}</t></is></c></row>' for k, x in enumerate(["line", *lines], 1))
    return _zipped(**{"xl/workbook.xml": '<workbook><sheets><sheet name="one"/></sheets></workbook>', "xl/worksheets/sheet1.xml": f"<worksheet><sheetData>{cells}</sheetData></worksheet>"})


def odt(lines: list[str]) -> bytes:
    return _zipped(**{"content.xml": "<d><b>" + "".join(f"<p>{escape(x)}</p>" for x in lines) + "</b></d>"})


def vsdx(lines: list[str]) -> bytes:
    shapes = "".join(f"<Shape><Text>{escape(x)}</Text></Shape>" for x in lines)
    return _zipped(**{"visio/pages/pages.xml": '<Pages><Page Name="Plan"/></Pages>', "visio/pages/page1.xml": f"<PageContents><Shapes>{shapes}</Shapes></PageContents>"})


def epub(lines: list[str]) -> bytes:
    return _zipped(**{"a.xhtml": "<html><body>" + "".join(f"<p>{escape(x)}</p>" for x in lines) + "</body></html>"})


def archive(lines: list[str]) -> bytes:
    return _zipped(**{"a.txt": "\n".join(lines)})


def gz(lines: list[str]) -> bytes:
    return gzip.compress("\n".join(lines).encode(), mtime=0)


def html(lines: list[str]) -> bytes:
    return ("<html><script>no</script><body>" + "".join(f"<p>{escape(x)}</p>" for x in lines) + "</body></html>").encode()


def rtf(lines: list[str]) -> bytes:
    return ("{\\rtf1\\ansi " + "\\par ".join(lines) + "}").encode("ascii", "replace")


def eml(lines: list[str]) -> bytes:
    return ("Subject: Lines\nFrom: a@b.example\nContent-Type: text/plain; charset=utf-8\n\n" + "\n".join(lines) + "\n").encode()


def jsonl(lines: list[str]) -> bytes:
    return json.dumps(lines).encode()


def csv(lines: list[str]) -> bytes:
    return "\r\n".join(lines).encode()


def dxf(lines: list[str]) -> bytes:
    pairs = [("0", "SECTION"), ("2", "ENTITIES"), *(p for x in lines for p in (("0", "TEXT"), ("1", x))), ("0", "ENDSEC"), ("0", "EOF")]
    return "\n".join(f"{a}\n{b}" for a, b in pairs).encode()


def compound(streams: dict[str, bytes], cutoff: int = 4096) -> bytes:
    """A compound file of 512-byte sectors; streams are padded to the cutoff so that all of them lie in full sectors."""
    size, end = 512, 0xFFFFFFFE
    padded = {k: v.ljust(cutoff, b"\0") for k, v in streams.items()}
    fat: list[int] = []
    data = b""

    def put(raw: bytes) -> int:
        nonlocal data
        first, n = len(fat), -(-len(raw) // size)
        fat.extend([*range(first + 1, first + n), end])
        data += raw.ljust(n * size, b"\0")
        return first

    def entry(name: str, kind: int, right: int, child: int, start: int, length: int) -> bytes:
        raw = name.encode("utf-16-le") + b"\0\0"
        return raw.ljust(64, b"\0") + struct.pack("<HBBIII", len(raw), kind, 1, 0xFFFFFFFF, right, child) + b"\0" * 36 + struct.pack("<IQ", start, length)

    starts = {k: put(v) for k, v in padded.items()}
    names = list(padded)
    entries = entry("Root Entry", 5, 0xFFFFFFFF, 1 if names else 0xFFFFFFFF, end, 0)
    entries += b"".join(entry(k, 2, i + 2 if i + 1 < len(names) else 0xFFFFFFFF, 0xFFFFFFFF, starts[k], len(padded[k])) for i, k in enumerate(names))
    directory = put(entries.ljust(-(-len(entries) // size) * size, b"\0"))
    n_fat = 1
    while n_fat * (size // 4) < len(fat) + n_fat:
        n_fat += 1
    first_fat = len(fat)
    fat += [0xFFFFFFFD] * n_fat
    table = struct.pack(f"<{len(fat)}I", *fat).ljust(n_fat * size, b"\xff")
    if n_fat > 109:
        raise ValueError("sample files have at most 109 allocation sectors")
    head = bytes.fromhex("d0cf11e0a1b11ae1") + b"\0" * 16 + struct.pack("<HHHHH", 62, 3, 0xFFFE, 9, 6) + b"\0" * 6 + struct.pack("<IIIIIIIII", 0, n_fat, directory, 0, cutoff, end, 0, end, 0)
    return head + struct.pack("<109I", *(list(range(first_fat, first_fat + n_fat)) + [0xFFFFFFFF] * (109 - n_fat))) + data + table


def msg(lines: list[str]) -> bytes:
    wide = lambda t: t.encode("utf-16-le")
    return compound({"__substg1.0_0037001F": wide("Lines"), "__substg1.0_1000001F": wide("\r\n".join(lines))})


def doc(lines: list[str]) -> bytes:
    text = "\r".join(lines).encode("cp1252", "replace")
    start = 1024
    main = bytearray(start + len(text))
    struct.pack_into("<HH", main, 0, 0xA5EC, 193)
    plc = struct.pack("<II", 0, len(text)) + struct.pack("<HIH", 0, start * 2 | 0x40000000, 0)
    clx = b"\x02" + struct.pack("<I", len(plc)) + plc
    struct.pack_into("<II", main, 0x1A2, 0, len(clx))
    main[start:] = text
    return compound({"WordDocument": bytes(main), "0Table": clx})


def xls(lines: list[str]) -> bytes:
    record = lambda kind, raw: struct.pack("<HH", kind, len(raw)) + raw
    text = lambda t: struct.pack("<HB", len(t), 1) + t.encode("utf-16-le")
    bof = record(0x809, struct.pack("<HHHHII", 0x600, 5, 0, 0, 0, 0))
    sheet_name = struct.pack("<BB", 3, 0) + b"one"
    at = len(bof) + 4 + 6 + len(sheet_name) + 4
    book = bof + record(0x85, struct.pack("<IH", at, 0) + sheet_name) + record(0x0A, b"")
    rows = b"".join(record(0x204, struct.pack("<HHH", k, 0, 0) + text(x)) for k, x in enumerate(lines))
    return compound({"Workbook": book + bof + rows + record(0x0A, b"")})


#: writer of each extension
WRITERS = {".pdf": pdf, ".docx": docx, ".pptx": pptx, ".xlsx": xlsx, ".odt": odt, ".vsdx": vsdx, ".epub": epub, ".zip": archive, ".gz": gz, ".html": html, ".rtf": rtf, ".eml": eml, ".json": jsonl, ".csv": csv, ".dxf": dxf, ".msg": msg, ".doc": doc, ".xls": xls}


def write(ext: str, words: list[str]) -> bytes:
    """Bytes of a file of format ``ext`` with ``words``, ten a line."""
    return WRITERS[ext]([" ".join(words[i : i + LINE_WORDS]) for i in range(0, len(words), LINE_WORDS)])
