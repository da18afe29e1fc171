"""Parsers of binary and drawing formats with the standard library alone: pdf, doc, xls, msg, vsdx, dxf, stl, psd, captures, certificates.

Formats with better outside libraries run through a ladder of steps: a step is only tried while the text so far has fewer than
``ENOUGH`` characters, and its result is kept only if it is longer. ``add_step`` puts a further step (a library, a recogniser) before or behind ours.
"""

from __future__ import annotations

import base64
import re
import struct
import zlib
from collections import Counter
from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from .compound import MAGIC, Compound
from .parsers import _by_length, _flag, _local, _tree, _zip, decoded, image_card, printable_runs, register, strip_html

Step = Callable[[str, bytes], str]
ENOUGH = 20
#: steps by format family: (quality of its texts, step)
STEPS: dict[str, list[tuple[float, Step]]] = {"pdf": [], "doc": [], "xls": [], "image": []}
PACKETS, LAYERS, TOP = 10_000, 500, 10


def add_step(family: str, step: Step, quality: float, first: bool = False) -> None:
    """Add a step of a family's ladder, behind the present ones or ``first``. A step that raises counts as empty."""
    STEPS[family].insert(0 if first else len(STEPS[family]), (quality, step))


def ladder(family: str, name: str, content: bytes) -> tuple[str, float]:
    best, quality = "", 0.0
    for q, step in STEPS[family]:
        if len(best.strip()) >= ENOUGH:
            break
        try:
            text = step(name, content) or ""
        except Exception:  # noqa: BLE001, S112 - a broken file or absent library leaves it to the next step
            continue
        if len(text.strip()) > len(best.strip()):
            best, quality = text, q
    return best, quality


# --- pdf --------------------------------------------------------------------------------------------------------------------------

_STREAM = re.compile(rb"<<(?:[^<>]|<<[^<>]*>>|<[^<>]*>)*>>\s*stream\r?\n", re.S)
_TOKEN = re.compile(rb"\((?:[^()\\]|\\.|\((?:[^()\\]|\\.)*\))*\)|<[0-9A-Fa-f\s]*>|\[|\]|[-+.\d]+|[A-Za-z'\"*][\w*'\"]*|/[^\s/\[\]()<>]+", re.S)
_ESCAPE = re.compile(rb"\\([0-7]{1,3}|\r\n|.)", re.S)
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f", b"\n": b"", b"\r\n": b"", b"\r": b""}


def _pdf_streams(content: bytes) -> list[tuple[bytes, bytes]]:
    """(dictionary, data) of each stream; compressed ones are inflated, those with other filters left out."""
    out = []
    for m in _STREAM.finditer(content):
        end = content.find(b"endstream", m.end())
        raw, head = content[m.end() : end if end >= 0 else len(content)], m.group()
        if b"FlateDecode" in head:
            try:
                raw = zlib.decompressobj().decompress(raw)
            except zlib.error:
                continue
        elif b"/Filter" in head:
            continue
        out.append((head, raw))
    return out


def _pdf_map(stream: bytes) -> dict[int, str]:
    """Codes to characters of a ToUnicode table."""
    text = lambda h: bytes.fromhex(h.decode()).decode("utf-16-be", "replace")
    out: dict[int, str] = {}
    for block in re.findall(rb"beginbfchar(.*?)endbfchar", stream, re.S):
        out |= {int(a, 16): text(b) for a, b in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>", block)}
    for block in re.findall(rb"beginbfrange(.*?)endbfrange", stream, re.S):
        for a, b, c in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>", block):
            low, high, base = int(a, 16), int(b, 16), text(c)
            if base and high - low < 65_536:
                out |= {k: base[:-1] + chr(min(0x10FFFF, ord(base[-1]) + k - low)) for k in range(low, high + 1)}
    return out


def _pdf_string(token: bytes, codes: dict[int, str]) -> str:
    if token.startswith(b"("):
        def plain(m: re.Match) -> bytes:
            x = m.group(1)
            return bytes([int(x, 8) & 255]) if x[:1].isdigit() else _ESCAPES.get(x, x)

        raw = _ESCAPE.sub(plain, token[1:-1])
    else:
        digits = re.sub(rb"\s", b"", token[1:-1])
        raw = bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
        if codes and len(raw) % 2 == 0:
            return "".join(codes.get(int.from_bytes(raw[i : i + 2], "big"), "") for i in range(0, len(raw), 2))
    if raw[:2] == b"\xfe\xff":
        return raw[2:].decode("utf-16-be", "replace")
    return raw.decode("cp1252", "replace")


def pdf_page(stream: bytes, codes: dict[int, str]) -> str:
    """Text that a content stream shows; a move to another line is a line feed, a wide gap within a line a blank."""
    out: list[str] = []
    stack: list = []
    array: list | None = None
    shown = lambda xs: "".join(x if isinstance(x, str) else " " if x < -200 else "" for x in xs)
    for m in _TOKEN.finditer(stream):
        t = m.group()
        c = t[:1]
        if c in b"(<":
            (stack if array is None else array).append(_pdf_string(t, codes))
        elif c == b"[":
            array = []
        elif c == b"]":
            stack, array = [array or []], None
        elif c in b"+-.0123456789":
            try:
                (stack if array is None else array).append(float(t))
            except ValueError:
                pass
        elif c != b"/":
            if t == b"Tj" and stack:
                out.append(stack[-1] if isinstance(stack[-1], str) else "")
            elif t == b"TJ" and stack and isinstance(stack[-1], list):
                out.append(shown(stack[-1]))
            elif t in (b"'", b'"') and stack:
                out.append("\n" + (stack[-1] if isinstance(stack[-1], str) else ""))
            elif t in (b"T*", b"ET", b"Tm") or (t in (b"Td", b"TD") and len(stack) >= 2 and stack[-1] != 0):
                out.append("\n")
            elif t in (b"Td", b"TD"):
                out.append(" ")
            stack = []
    return re.sub(r"\s*\n\s*", "\n", "".join(out)).strip()


def pdf_text(name: str, content: bytes) -> str:
    streams = _pdf_streams(content)
    codes: dict[int, str] = {}
    for _, s in streams:
        if b"begincmap" in s:
            codes |= _pdf_map(s)
    pages = (pdf_page(s, codes) for head, s in streams if b"BT" in s and b"/Image" not in head and b"begincmap" not in s)
    return "\n\n".join(p for p in pages if p)


add_step("pdf", pdf_text, 0.9)


@register(".pdf", ".ai")
def pdf(name: str, content: bytes) -> tuple[str, float]:
    text, quality = ladder("pdf", name, content)
    return text, _by_length(text, quality, alpha=True)


# --- doc, xls, msg ----------------------------------------------------------------------------------------------------------------


def doc_text(name: str, content: bytes) -> str:
    """Text of a binary word file by its table of pieces."""
    f = Compound(content)
    main = f.read("WordDocument")
    table = f.read("1Table" if struct.unpack_from("<H", main, 10)[0] & 0x200 else "0Table")
    at, size = struct.unpack_from("<II", main, 0x1A2)
    clx = table[at : at + size]
    while clx[:1] == b"\x01":  # properties before the table of pieces
        clx = clx[3 + struct.unpack_from("<H", clx, 1)[0] :]
    length = struct.unpack_from("<I", clx, 1)[0]
    plc = clx[5 : 5 + length]
    n = (length - 4) // 12
    ends = struct.unpack_from(f"<{n + 1}I", plc)
    out = []
    for k in range(n):
        place = struct.unpack_from("<I", plc, 4 * (n + 1) + 8 * k + 2)[0]
        chars = ends[k + 1] - ends[k]
        if place & 0x40000000:
            start = (place & 0x3FFFFFFF) // 2
            out.append(main[start : start + chars].decode("cp1252", "replace"))
        else:
            out.append(main[place : place + 2 * chars].decode("utf-16-le", "replace"))
    return re.sub(r"[\x00-\x08\x0e-\x1f]", "", re.sub(r"[\r\x07\x0b\x0c]", "\n", "".join(out))).strip()


def _biff(stream: bytes):
    at = 0
    while at + 4 <= len(stream):
        kind, size = struct.unpack_from("<HH", stream, at)
        yield at, kind, stream[at + 4 : at + 4 + size]
        at += 4 + size


def _biff_string(raw: bytes, at: int, wide: int = 2) -> tuple[str, int]:
    n = int.from_bytes(raw[at : at + wide], "little")
    flags = raw[at + wide]
    at += wide + 1
    runs = far = 0
    if flags & 8:
        runs = struct.unpack_from("<H", raw, at)[0]
        at += 2
    if flags & 4:
        far = struct.unpack_from("<I", raw, at)[0]
        at += 4
    size = n * (2 if flags & 1 else 1)
    text = raw[at : at + size].decode("utf-16-le" if flags & 1 else "latin-1", "replace")
    return text, at + size + 4 * runs + far


def _packed(v: int) -> float:
    x = float(struct.unpack("<i", struct.pack("<I", v & 0xFFFFFFFC))[0] >> 2) if v & 2 else struct.unpack("<d", b"\0\0\0\0" + struct.pack("<I", v & 0xFFFFFFFC))[0]
    return x / 100 if v & 1 else x


def xls_text(name: str, content: bytes) -> str:
    """``[Sheet: name]`` and the non-blank cells of each row, by tabs."""
    f = Compound(content) if content[:8] == MAGIC else None
    stream = f.read("Workbook" if "Workbook" in f.streams else "Book") if f else content
    names: dict[int, str] = {}
    shared: list[str] = []
    sheets: dict[int, dict[int, dict[int, str]]] = {}
    table, now, here = b"", 0, -1
    number = lambda x: str(int(x)) if x == int(x) else repr(x)
    for at, kind, raw in _biff(stream):
        cell = struct.unpack_from("<HH", raw) if len(raw) >= 4 else (0, 0)
        put = lambda c, v: sheets.setdefault(here, {}).setdefault(cell[0], {}).__setitem__(c, v)  # noqa: E731, B023
        if kind == 0x809:
            here = at
        elif kind == 0x85:
            names[struct.unpack_from("<I", raw)[0]] = _biff_string(raw, 6, 1)[0]
        elif kind == 0xFC or (kind == 0x3C and now == 0xFC):
            # strings cut by a continuation repeat one flag byte there, which is kept simple: such a table is read up to the cut
            table += raw
            kind = 0xFC
        elif kind == 0xFD:
            if table and not shared:
                n, p = struct.unpack_from("<I", table, 4)[0], 8
                while len(shared) < n and p + 3 <= len(table):
                    s, p = _biff_string(table, p)
                    shared.append(s)
            k = struct.unpack_from("<I", raw, 6)[0]
            put(cell[1], shared[k] if k < len(shared) else "")
        elif kind == 0x204:
            put(cell[1], _biff_string(raw, 6)[0])
        elif kind == 0x203 or kind == 0x06 and raw[12:14] != b"\xff\xff":
            put(cell[1], number(struct.unpack_from("<d", raw, 6)[0]))
        elif kind == 0x27E:
            put(cell[1], number(_packed(struct.unpack_from("<I", raw, 6)[0])))
        elif kind == 0xBD:
            for k in range((len(raw) - 6) // 6):
                put(cell[1] + k, number(_packed(struct.unpack_from("<I", raw, 6 + 6 * k)[0])))
        now = kind
    out = []
    for at, rows in sorted(sheets.items()):
        lines = ("\t".join(v for _, v in sorted(r.items()) if v.strip()) for _, r in sorted(rows.items()))
        out.append("\n".join([f"[Sheet: {names.get(at, '')}]", *(x for x in lines if x)]))
    return "\n\n".join(out)


add_step("doc", doc_text, 0.5)
add_step("doc", lambda name, content: printable_runs(content), 0.3)
add_step("xls", xls_text, 0.85)
add_step("xls", lambda name, content: printable_runs(content), 0.3)


@register(".doc")
def doc(name: str, content: bytes) -> tuple[str, float]:
    text, quality = ladder("doc", name, content)
    return text, _flag(text, quality)


@register(".xls")
def xls(name: str, content: bytes) -> tuple[str, float]:
    text, quality = ladder("xls", name, content)
    return text, _flag(text, quality)


#: fixed values: properties of a message, as label and number
MESSAGE = [("From", "0C1A"), ("To", "0E04"), ("Subject", "0037")]


def _filetime(raw: int) -> str:
    return (datetime(1601, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=raw // 10)).strftime("%Y-%m-%d %H:%M:%S")


@register(".msg")
def msg(name: str, content: bytes) -> tuple[str, float]:
    f = Compound(content)

    def field(number: str) -> str:
        for kind, code in (("001F", "utf-16-le"), ("001E", "cp1252"), ("0102", "utf-8")):
            path = f"__substg1.0_{number}{kind}"
            if path in f.streams:
                return f.read(path).decode(code, "replace").strip("\0 \r\n")
        return ""

    head = [f"{label}: {v}" for label, number in MESSAGE if (v := field(number))]
    props = f.read("__properties_version1.0") if "__properties_version1.0" in f.streams else b""
    times = {struct.unpack_from("<I", props, at)[0]: struct.unpack_from("<Q", props, at + 8)[0] for at in range(32, len(props) - 15, 16)}
    sent = times.get(0x00390040) or times.get(0x0E060040)
    if sent:
        head.append(f"Date: {_filetime(sent)}")
    body = field("1000") or strip_html(field("1013"))
    text = "\n".join(head) + "\n\n" + body if head or body else ""
    return text.strip(), _flag(text, 0.85)


# --- drawings ---------------------------------------------------------------------------------------------------------------------


def _title(name: str) -> str:
    return name.replace("\\", "/").rsplit("/", 1)[-1]


@register(".vsdx")
def vsdx(name: str, content: bytes) -> tuple[str, float]:
    """Texts of the shapes, page by page."""
    with _zip(content) as z:
        names = set(z.namelist())
        titles = [p.get("Name") or p.get("NameU") or "" for p in _tree(z, "visio/pages/pages.xml").iter() if _local(p.tag) == "Page"] if "visio/pages/pages.xml" in names else []
        pages = sorted((n for n in names if re.fullmatch(r"visio/pages/page\d+\.xml", n)), key=lambda n: int(re.search(r"\d+", n.rsplit("/", 1)[1]).group()))
        out, shapes = [f"Visio: {_title(name)}"], 0
        for k, n in enumerate(pages):
            texts = ["".join(t.itertext()).strip() for t in _tree(z, n).iter() if _local(t.tag) == "Text"]
            texts = [t for t in texts if t]
            shapes += len(texts)
            out.append("\n".join([f"--- Page: {titles[k] if k < len(titles) else k + 1} ---", *texts]))
    return "\n".join(out), (0.0 if not pages else 0.3 if not shapes else 0.5 if shapes < 3 else 0.8)


@register(".dxf")
def dxf(name: str, content: bytes) -> tuple[str, float]:
    """Layers, texts of the drawing, then texts of its named blocks, from the pairs of group code and value."""
    lines = decoded(content).splitlines()
    section = kind = block = ""
    fields: list[tuple[str, str]] = []
    layers: list[str] = []
    texts: dict[str, list[str]] = {"ENTITIES": [], "BLOCKS": []}

    def close() -> None:
        get = lambda code: [v for c, v in fields if c == code]
        if kind == "LAYER" and section == "TABLES":
            layers.extend(get("2")[:1])
        elif kind in ("TEXT", "MTEXT", "ATTRIB", "DIMENSION") and section in texts and not (section == "BLOCKS" and block.startswith("*")):
            t = re.sub(r"\\[A-Za-z][^;\\]*;|[{}]", "", "".join(get("3") + get("1")).replace("\\P", "\n")).strip()
            if t and t != "<>":
                texts[section].append(t)

    for code, value in zip((x.strip() for x in lines[::2]), (x.rstrip("\r") for x in lines[1::2]), strict=False):
        if code == "0":
            close()
            kind, fields = value.strip(), []
        elif code == "2" and kind == "SECTION":
            section = value.strip()
        else:
            if code == "2" and kind == "BLOCK":
                block = value.strip()
            fields.append((code, value.strip() if code != "3" else value))
    close()
    if not section:
        return "", 0.0
    parts = [f"DXF: {_title(name)}", *(["Layers: " + ", ".join(layers)] if layers else []), *texts["ENTITIES"], *texts["BLOCKS"]]
    return "\n\n".join(parts), (0.3 if len(parts) < 2 else 0.5 if len(parts) < 5 else 0.8)


@register(".stl")
def stl(name: str, content: bytes) -> tuple[str, float]:
    """Size and volume of a triangle mesh."""
    import numpy as np

    n = struct.unpack_from("<I", content, 80)[0] if len(content) >= 84 else -1
    if n >= 0 and len(content) == 84 + 50 * n:
        rows = np.frombuffer(content, np.dtype([("normal", "<f4", 3), ("corners", "<f4", (3, 3)), ("attribute", "<u2")]), n, 84)
        corners = rows["corners"].astype(float)
    else:
        found = re.findall(r"vertex\s+(\S+)\s+(\S+)\s+(\S+)", decoded(content))
        corners = np.array(found, float).reshape(-1, 3)[: len(found) // 3 * 3].reshape(-1, 3, 3)
    if not len(corners):
        return "", 0.0
    low, high = corners.min((0, 1)), corners.max((0, 1))
    volume = abs(float(np.einsum("ij,ij->i", corners[:, 0], np.cross(corners[:, 1], corners[:, 2])).sum() / 6))
    out = [f"STL: {_title(name)}", f"Triangles: {len(corners)}", f"Vertices: {3 * len(corners)}", "Bounding box: " + " x ".join(f"{x:.3f}" for x in high - low)]
    out += [f"{axis}: {a:.3f} to {b:.3f}" for axis, a, b in zip("XYZ", low, high, strict=True)]
    if volume > 0:
        out.append(f"Volume: {volume:.3f}")
    return "\n".join(out), 0.7


#: fixed values: colour modes of layered images
_MODES = {0: "Bitmap", 1: "Grayscale", 2: "Indexed", 3: "RGB", 4: "CMYK", 7: "Multichannel", 8: "Duotone", 9: "Lab"}


@register(".psd")
def psd(name: str, content: bytes) -> tuple[str, float]:
    if content[:4] != b"8BPS":
        return "", 0.0
    height, width, depth, mode = struct.unpack_from(">IIHH", content, 14)
    out = [f"PSD: {_title(name)}", f"Size: {width} x {height}", f"Mode: {_MODES.get(mode, mode)}, {depth} bits"]
    at = 26
    for _ in range(2):  # colour data and resources
        at += 4 + struct.unpack_from(">I", content, at)[0]
    names: list[str] = []
    if len(content) >= at + 10 and struct.unpack_from(">I", content, at)[0] and struct.unpack_from(">I", content, at + 4)[0]:
        count = abs(struct.unpack_from(">h", content, at + 8)[0])
        at += 10
        for _ in range(min(count, LAYERS)):
            at += 16 + 2 + 6 * struct.unpack_from(">H", content, at + 16)[0] + 12
            extra = struct.unpack_from(">I", content, at)[0]
            p, end = at + 4, at + 4 + extra
            for _ in range(2):
                p += 4 + struct.unpack_from(">I", content, p)[0]
            label = content[p + 1 : p + 1 + content[p]].decode("latin-1")
            wide = content.find(b"8BIMluni", p, end)
            if wide >= 0:
                label = content[wide + 16 : wide + 16 + 2 * struct.unpack_from(">I", content, wide + 12)[0]].decode("utf-16-be", "replace").rstrip("\0")
            names.append(label)
            at = end
        out.append(f"Layers: {count}")
        out += [f"- {x}" for x in names]
    for m in re.finditer(rb"Txt TEXT", content):
        n = struct.unpack_from(">I", content, m.end())[0]
        t = content[m.end() + 4 : m.end() + 4 + 2 * n].decode("utf-16-be", "replace").replace("\r", "\n").strip("\0 \n")
        if t:
            out.append(f"Text: {t}")
    return "\n".join(out), 0.8 if names else 0.3


# --- captures and certificates ----------------------------------------------------------------------------------------------------

#: fixed values: numbers of protocols
_PROTOCOLS = {1: "ICMP", 2: "IGMP", 6: "TCP", 17: "UDP", 47: "GRE", 50: "ESP", 58: "ICMPv6", 89: "OSPF"}


def _packets(content: bytes):
    """(seconds, frame) of a capture in either published layout."""
    if content[:4] in (b"\xd4\xc3\xb2\xa1", b"\xa1\xb2\xc3\xd4", b"\x4d\x3c\xb2\xa1", b"\xa1\xb2\x3c\x4d"):
        order = "<" if content[:1] in b"\xd4\x4d" else ">"
        unit = 1e-9 if b"\x3c" in content[:4] else 1e-6
        at = 24
        while at + 16 <= len(content):
            s, f, n, _ = struct.unpack_from(order + "IIII", content, at)
            yield s + f * unit, content[at + 16 : at + 16 + n]
            at += 16 + n
    elif content[:4] == b"\x0a\x0d\x0d\x0a":
        order, at = ("<" if content[8:12] == b"\x4d\x3c\x2b\x1a" else ">"), 0
        while at + 12 <= len(content):
            kind, size = struct.unpack_from(order + "II", content, at)
            if size < 12:
                return
            if kind == 6:
                high, low, n = struct.unpack_from(order + "III", content, at + 12)
                yield ((high << 32) | low) / 1e6, content[at + 28 : at + 28 + n]
            at += size


def _ends(frame: bytes) -> tuple[str, str, str]:
    """Protocol, source and destination of an Ethernet frame."""
    kind = frame[12:14]
    if kind == b"\x08\x00" and len(frame) >= 34:
        return _PROTOCOLS.get(frame[23], f"IP-{frame[23]}"), ".".join(map(str, frame[26:30])), ".".join(map(str, frame[30:34]))
    if kind == b"\x86\xdd" and len(frame) >= 54:
        address = lambda a: ":".join(f"{x:x}" for x in struct.unpack(">8H", frame[a : a + 16]))
        return _PROTOCOLS.get(frame[20], f"IPv6-{frame[20]}"), address(22), address(38)
    return ("ARP" if kind == b"\x08\x06" else "other"), frame[6:12].hex(":"), frame[:6].hex(":")


@register(".pcap", ".pcapng")
def capture(name: str, content: bytes) -> tuple[str, float]:
    """Counts, time range and the most frequent protocols and ends of at most ``PACKETS`` packets."""
    times, counts = [], [Counter(), Counter(), Counter()]
    for t, frame in _packets(content):
        if len(times) == PACKETS:
            break
        times.append(t)
        for c, v in zip(counts, _ends(frame), strict=True):
            c[v] += 1
    if not times:
        return "", 0.0
    stamp = lambda t: datetime.fromtimestamp(t, timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    out = [f"Capture: {_title(name)}", f"Packets: {len(times)}", f"Time: {stamp(min(times))} to {stamp(max(times))}"]
    for label, c in zip(("Protocols", "Sources", "Destinations"), counts, strict=True):
        out.append(f"{label}: " + ", ".join(f"{k}={v}" for k, v in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:TOP]))
    return "\n".join(out), 0.4 if len(times) < 10 else 0.7


def _der(raw: bytes):
    """(tag, value) of each element of DER data."""
    at = 0
    while at + 2 <= len(raw):
        tag, n = raw[at], raw[at + 1]
        at += 2
        if n & 0x80:
            k = n & 0x7F
            n = int.from_bytes(raw[at : at + k], "big")
            at += k
        yield tag, raw[at : at + n]
        at += n


def _oid(raw: bytes) -> str:
    out, n = [str(min(raw[0] // 40, 2)), str(raw[0] - 40 * min(raw[0] // 40, 2))], 0
    for b in raw[1:]:
        n = (n << 7) | (b & 0x7F)
        if not b & 0x80:
            out.append(str(n))
            n = 0
    return ".".join(out)


#: fixed values: short names of the parts of a name
_NAMES = {"2.5.4.3": "CN", "2.5.4.6": "C", "2.5.4.7": "L", "2.5.4.8": "ST", "2.5.4.10": "O", "2.5.4.11": "OU"}


def _rdn(raw: bytes) -> str:
    out = []
    for _, part in _der(raw):
        for _, pair in _der(part):
            (_, oid), (tag, value) = list(_der(pair))[:2]
            out.append(f"{_NAMES.get(_oid(oid), _oid(oid))}={value.decode('utf-16-be' if tag == 0x1E else 'utf-8', 'replace')}")
    return ",".join(out)


def _when(tag: int, raw: bytes) -> str:
    t = raw.decode()
    t = ("19" if t[:2] >= "50" else "20") + t if tag == 0x17 else t
    return f"{t[:4]}-{t[4:6]}-{t[6:8]} {t[8:10]}:{t[10:12]}:{t[12:14]}"


@register(".cer", ".pem", ".crt")
def certificate(name: str, content: bytes) -> tuple[str, float]:
    m = re.search(rb"-----BEGIN CERTIFICATE-----(.*?)-----END", content, re.S)
    raw = base64.b64decode(m.group(1)) if m else content
    parts = list(_der(list(_der(raw))[0][1]))
    body = list(_der(parts[0][1]))
    version = 1
    if body[0][0] == 0xA0:
        version = int.from_bytes(list(_der(body[0][1]))[0][1], "big") + 1
        body = body[1:]
    (_, serial), (_, algorithm), (_, issuer), (_, dates), (_, subject) = body[:5]
    start, end = (_when(*x) for x in list(_der(dates))[:2])
    out = [f"Certificate: {_title(name)}", f"Subject: {_rdn(subject)}", f"Issuer: {_rdn(issuer)}", f"Serial: {int.from_bytes(serial, 'big')}", f"Valid: {start} to {end}", f"Signature: {_oid(list(_der(algorithm))[0][1])}", f"Version: {version}"]
    for tag, value in body[6:]:
        for _, extensions in _der(value) if tag == 0xA3 else ():
            for _, e in _der(extensions):
                fields = list(_der(e))
                if _oid(fields[0][1]) == "2.5.29.17":
                    dns = [v.decode("ascii", "replace") for t, v in _der(list(_der(fields[-1][1]))[0][1]) if t == 0x82]
                    if dns:
                        out.append("DNS names: " + ", ".join(dns))
    return "\n".join(out), 0.8 if len(out) > 3 else 0.4


# --- images -----------------------------------------------------------------------------------------------------------------------


@register(".jpg", ".jpeg", ".png", ".gif", ".webp", ".bmp", ".wmf", ".emf", ".tiff", ".tif")
def image(name: str, content: bytes) -> tuple[str, float]:
    """Recognised text if a recogniser was added as a step of ``image``, else the identity card."""
    text, quality = ladder("image", name, content)
    return (text, _by_length(text, quality, short=30, alpha=True)) if text.strip() else image_card(name, content)
