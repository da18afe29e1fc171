"""Parser registry: bytes of a file -> text and quality, run as one Arrow function over ``binaryFile`` rows.

A parser is a function ``(name, content) -> (text, quality)``; ``register`` adds or replaces one. Formats whose libraries are not part of
the standard library have slots that return an empty text with the reason ``library_missing`` until a parser is registered.
"""

from __future__ import annotations

import email
import email.policy
import gzip
import io
import json
import mailbox
import re
import tarfile
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from html import unescape
from pathlib import PurePosixPath
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame

from ..plans.shared import ship_package

Parser = Callable[[str, bytes], tuple[str, float]]
REGISTRY: dict[str, Parser] = {}
MAX_CHARS = 5_000_000
#: fixed values: formats that only get an identity card
PLACEHOLDERS = (".dwg", ".dwt", ".prt", ".sldprt", ".asm", ".sldasm", ".mpp", ".vsd", ".one", ".ost", ".eps")
#: fixed values: formats that need a library outside the standard one
SLOTS = (".evtx", ".accdb", ".mdb", ".7z")
CSV_LINES, MEMBERS, MEMBER_BYTES, MAILS, MAIL_CHARS, SHEET_ROWS = 100_000, 5_000, 500 << 20, 200, 5_000, 100_000


class Missing(Exception):
    """The format's library is not installed."""


def suffix(name: str) -> str:
    return PurePosixPath(name.replace("\\", "/")).suffix.lower()


def register(*exts: str) -> Callable[[Parser], Parser]:
    def add(f: Parser) -> Parser:
        REGISTRY.update(dict.fromkeys(exts, f))
        return f

    return add


def decoded(content: bytes) -> str:
    try:
        return content.decode("utf-8-sig")
    except UnicodeDecodeError:
        return content.decode("latin-1")


def _by_length(text: str, good: float, short: int = 50, alpha: bool = False) -> float:
    x = text.strip()
    if not x:
        return 0.0
    if len(x) < short:
        return 0.3
    return 0.4 if alpha and sum(map(str.isalpha, x)) / len(x) < 0.3 else good


def _flag(text: str, quality: float) -> float:
    return quality if text.strip() else 0.0


@register(".txt", ".md", ".rst", ".log", ".ini", ".cfg", ".conf", ".yaml", ".yml", ".properties", ".reg", ".sao", ".rsf", ".drawio", ".svg", ".dia")
def plain(name: str, content: bytes) -> tuple[str, float]:
    text = decoded(content)
    head = text[:2000]
    if not text.strip():
        return text, 0.0
    if sum(c.isprintable() or c in "\n\r\t" for c in head) < 0.8 * len(head):
        return text, 0.2
    return text, 0.5 if len(text.strip()) < 50 else 1.0


@register(".csv", ".tsv")
def separated(name: str, content: bytes) -> tuple[str, float]:
    text = "\n".join(decoded(content).splitlines()[:CSV_LINES])
    return text, _flag(text, 0.9)


@register(".json")
def json_text(name: str, content: bytes) -> tuple[str, float]:
    text = decoded(content)
    try:
        text = json.dumps(json.loads(text), indent=2, ensure_ascii=False)
    except ValueError:
        pass
    return text, _flag(text, 0.9)


@register(".xml")
def xml_text(name: str, content: bytes) -> tuple[str, float]:
    raw = decoded(content)
    if re.search(r"<!(?:DOCTYPE|ENTITY)", raw, re.I):
        parts = re.sub(r"<[^>]+>", "\n", raw).split("\n")
    else:
        try:
            parts = list(ElementTree.fromstring(raw.encode()).itertext())
        except ElementTree.ParseError:
            parts = re.sub(r"<[^>]+>", "\n", raw).split("\n")
    text = "\n".join(p.strip() for p in parts if p.strip())
    return text, _flag(text, 0.85)


def strip_html(raw: str) -> str:
    raw = re.sub(r"<(script|style|nav|footer|header)\b[^>]*>.*?</\1\s*>", " ", raw, flags=re.S | re.I)
    raw = re.sub(r"<(?:br|/p|/div|/tr|/li|/h\d|/td|/th|/title)\b[^>]*>", "\n", raw, flags=re.I)
    lines = (re.sub(r"[ \t\r\f\v]+", " ", x).strip() for x in unescape(re.sub(r"<[^>]+>", "", raw)).split("\n"))
    return "\n".join(x for x in lines if x)


@register(".html", ".htm")
def html(name: str, content: bytes) -> tuple[str, float]:
    text = strip_html(decoded(content))
    return text, _flag(text, 0.6)


@register(".rtf")
def rtf(name: str, content: bytes) -> tuple[str, float]:
    text = decoded(content)
    if text.startswith("{\\rtf"):
        text = re.sub(r"\\'([0-9a-fA-F]{2})", lambda m: bytes.fromhex(m[1]).decode("cp1252", "replace"), text)
        text = re.sub(r"\{\\(?:\*|fonttbl|colortbl|stylesheet|info)[^{}]*(?:\{[^{}]*\}[^{}]*)*\}", "", text)
        text = re.sub(r"\\(?:par|line|row)\b ?", "\n", text)
        text = re.sub(r"\\[a-zA-Z]+-?\d* ?|[{}]", "", text).strip()
    return text, _flag(text, 0.85)


def printable_runs(content: bytes, least: int = 8) -> str:
    runs = (m.group().decode("ascii").strip() for m in re.finditer(rb"[\t\n\r -~]{%d,}" % least, content))
    return "\n".join(r for r in runs if len(r) > least and sum(c.isalpha() or c.isspace() for c in r) * 2 > len(r))


@register(".ppt")
def old_slides(name: str, content: bytes) -> tuple[str, float]:
    """Text records of the binary stream (UTF-16 and single-byte), else printable runs."""
    out, at = [], 0
    while (at := min((p for p in (content.find(b"\xa0\x0f", at), content.find(b"\xa8\x0f", at)) if p >= 0), default=-1)) >= 2:
        kind, size = content[at], int.from_bytes(content[at + 2 : at + 6], "little")
        if 0 < size <= len(content) - at - 6 and size < 1 << 20:
            t = content[at + 6 : at + 6 + size].decode("utf-16-le" if kind == 0xA0 else "latin-1", "replace").strip()
            if len(t) > 1 and t.isprintable():
                out.append(t)
                at += 6 + size
                continue
        at += 2
    if out:
        return "\n".join(out), 0.7
    text = printable_runs(content[:2_000_000])
    return text, _flag(text, 0.3)


def _zip(content: bytes) -> zipfile.ZipFile:
    return zipfile.ZipFile(io.BytesIO(content))


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _tree(z: zipfile.ZipFile, name: str) -> ElementTree.Element:
    raw = z.read(name)
    if b"<!ENTITY" in raw:
        raise ValueError("entities are not allowed")
    return ElementTree.fromstring(raw)


@register(".docx")
def docx(name: str, content: bytes) -> tuple[str, float]:
    with _zip(content) as z:
        paragraphs = ("".join(t.text or "" if _local(t.tag) == "t" else "\t" for t in p.iter() if _local(t.tag) in ("t", "tab")) for p in _tree(z, "word/document.xml").iter() if _local(p.tag) == "p")
        text = "\n\n".join(p for p in paragraphs if p.strip())
    return text, _flag(text, 1.0)


@register(".pptx")
def pptx(name: str, content: bytes) -> tuple[str, float]:
    slides = []
    with _zip(content) as z:
        names = sorted((n for n in z.namelist() if re.fullmatch(r"ppt/slides/slide\d+\.xml", n)), key=lambda n: int(re.search(r"\d+", n.rsplit("/", 1)[1]).group()))
        for i, n in enumerate(names, 1):
            shapes = ("\n".join(x for p in s.iter() if _local(p.tag) == "p" if (x := "".join(t.text or "" for t in p.iter() if _local(t.tag) == "t")).strip()) for s in _tree(z, n).iter() if _local(s.tag) == "txBody")
            body = "\n".join(x for x in shapes if x)
            if body:
                slides.append(f"[SLIDE {i}]\n{body}")
    text = "\n\n".join(slides)
    return text, _flag(text, 0.9)


@register(".xlsx")
def xlsx(name: str, content: bytes) -> tuple[str, float]:
    out = []
    with _zip(content) as z:
        names = z.namelist()
        shared = ["".join(t.text or "" for t in s.iter() if _local(t.tag) == "t") for s in _tree(z, "xl/sharedStrings.xml")] if "xl/sharedStrings.xml" in names else []
        titles = [s.get("name", "") for s in _tree(z, "xl/workbook.xml").iter() if _local(s.tag) == "sheet"]
        sheets = sorted((n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.search(r"\d+", n.rsplit("/", 1)[1]).group()))
        for title, n in zip([*titles, *[""] * len(sheets)], sheets, strict=False):
            rows = []
            for row in (r for r in _tree(z, n).iter() if _local(r.tag) == "row"):
                cells: dict[int, str] = {}
                for k, c in enumerate(x for x in row if _local(x.tag) == "c"):
                    col = 0
                    for ch in re.match(r"[A-Z]*", c.get("r", "")).group():
                        col = col * 26 + ord(ch) - 64
                    v = "".join(t.text or "" for t in c.iter() if _local(t.tag) in ("v", "t"))
                    cells[col - 1 if col else k] = shared[int(v)] if c.get("t") == "s" and v.isdigit() and int(v) < len(shared) else v
                rows.append(cells)
                if len(rows) > SHEET_ROWS:
                    break
            if rows:
                head = rows[0]
                lines = [" | ".join(head[k] for k in sorted(head))]
                lines += [", ".join(f"{head.get(k, '')}: {r[k]}" for k in sorted(r) if r[k].strip()) for r in rows[1:]]
                out.append("\n".join([f"[SHEET] {title}", *(x for x in lines if x)]))
    text = "\n\n".join(out)
    return text, _flag(text, 0.9)


def _mail(m, most: int | None = None) -> str:
    head = [f"{h}: {m[h]}" for h in ("Subject", "From", "To", "Cc", "Date") if m[h]]
    body = m.get_body(("plain", "html")) if hasattr(m, "get_body") else None
    try:
        text = body.get_content() if body else ""
    except (LookupError, KeyError):
        text = ""
    if body is not None and body.get_content_type() == "text/html":
        text = strip_html(text)
    return "\n".join(head) + "\n\n" + text.strip()[:most]


@register(".eml")
def eml(name: str, content: bytes) -> tuple[str, float]:
    text = _mail(email.message_from_bytes(content, policy=email.policy.default)).strip()
    return text, _by_length(text, 0.85)


@register(".mbox")
def mbox(name: str, content: bytes) -> tuple[str, float]:
    with tempfile.NamedTemporaryFile(suffix=".mbox") as f:  # scratch of one task, gone when it ends
        f.write(content)
        f.flush()
        mails = []
        for i, m in enumerate(mailbox.mbox(f.name)):
            if i == MAILS:
                break
            mails.append(f"--- Message {i + 1} ---\n" + _mail(email.message_from_bytes(m.as_bytes(), policy=email.policy.default), MAIL_CHARS))
    text = "\n\n".join(mails)
    return text, _by_length(text, 0.8)


def archive_members(name: str, content: bytes, deferred: tuple[str, ...] = ()) -> Iterator[tuple[str, bytes]]:
    """Safe members of an archive: no paths upwards, no nested archives, within the limits, none with a deferred dot segment."""
    tokens = {t.lower().lstrip(".") for t in deferred}
    late = lambda n: bool(tokens & set(PurePosixPath(n).name.lower().split(".")[1:]))
    if late(name):
        return
    ok = lambda n, size: size <= MEMBER_BYTES and ".." not in PurePosixPath(n.replace("\\", "/")).parts and not n.startswith("/") and suffix(n) not in (".zip", ".tar", ".tgz", ".gz", ".7z", ".rar") and not late(n)
    e = suffix(name)
    if e == ".zip":
        with _zip(content) as z:
            for i in [x for x in z.infolist() if not x.is_dir()][:MEMBERS]:
                if ok(i.filename, i.file_size) and not i.flag_bits & 1:
                    yield i.filename, z.read(i)
    elif e in (".tar", ".tgz") or name.lower().endswith(".tar.gz"):
        with tarfile.open(fileobj=io.BytesIO(content)) as t:
            for n, m in enumerate(x for x in t if x.isfile()):
                if n >= MEMBERS:
                    return
                if ok(m.name, m.size):
                    yield m.name, t.extractfile(m).read()
    elif e == ".gz":
        with gzip.GzipFile(fileobj=io.BytesIO(content)) as g:
            data = g.read(MEMBER_BYTES + 1)
        if len(data) <= MEMBER_BYTES:
            yield PurePosixPath(name.replace("\\", "/")).stem, data


@register(".zip", ".tar", ".tgz", ".gz")
def archive(name: str, content: bytes) -> tuple[str, float]:
    parts = []
    for member, data in archive_members(name, content):
        text = parse(member, data)[0]
        if text.strip():
            parts.append(f"[ARCHIVE_MEMBER={member}]\n{text}")
    text = "\n\n".join(parts)
    return text, _flag(text, 0.7)


@register(".epub")
def epub(name: str, content: bytes) -> tuple[str, float]:
    with _zip(content) as z:
        names = z.namelist()
        order = []
        for opf in (n for n in names if n.lower().endswith(".opf")):
            root, base = _tree(z, opf), PurePosixPath(opf).parent
            ids = {i.get("id"): i.get("href") for i in root.iter() if _local(i.tag) == "item"}
            order = [str(base / ids[r.get("idref")]) for r in root.iter() if _local(r.tag) == "itemref" and r.get("idref") in ids]
            break
        order = [n for n in order if n in names] or sorted(n for n in names if suffix(n) in (".html", ".xhtml", ".htm"))
        chapters = (strip_html(decoded(z.read(n))) for n in order)
        text = "\n\n".join(c for c in chapters if c)
    return text, _by_length(text, 0.9, alpha=True)


@register(".odt", ".ods", ".odp")
def opendocument(name: str, content: bytes) -> tuple[str, float]:
    with _zip(content) as z:
        meta = []
        if "meta.xml" in z.namelist():
            meta = [f"{_local(e.tag)}: {e.text.strip()}" for e in _tree(z, "meta.xml").iter() if _local(e.tag) in ("title", "subject", "keyword", "description", "creator") and e.text and e.text.strip()]
        body = [t.strip() for t in _tree(z, "content.xml").itertext() if t.strip()]
    text = "\n\n".join(x for x in ("\n".join(meta), "\n".join(body)) if x)
    return text, _by_length(text, 0.9, alpha=True)


@register(".stp", ".step", ".ste")
def step(name: str, content: bytes) -> tuple[str, float]:
    raw = decoded(content)
    if "ISO-10303" not in raw and "FILE_" not in raw:
        return "", 0.0
    quoted = lambda rx: [x for x in re.findall(r"'([^']*)'", (re.search(rx + r"\s*\((.*?)\)\s*;", raw, re.S) or [""])[0]) if x]
    out = [f"{label}: {', '.join(v)}" for label, rx in (("Description", "FILE_DESCRIPTION"), ("Name", "FILE_NAME"), ("Schema", "FILE_SCHEMA")) if (v := quoted(rx))]
    out.append(f"Entities: {len(re.findall(r'^#\d+\s*=', raw, re.M))}")
    products = re.findall(r"=\s*PRODUCT\s*\(\s*'([^']*)'", raw)[:10]
    if products:
        out.append("Products: " + ", ".join(products))
    return "\n".join(out), 0.8 if len(out) > 1 else 0.3


@register(".igs", ".iges")
def iges(name: str, content: bytes) -> tuple[str, float]:
    lines = [x for x in decoded(content).splitlines() if len(x) > 72]
    of = lambda s: [x[:72] for x in lines if x[72] == s]
    out = [x.strip() for x in of("S") if x.strip()]
    out += [m for m in re.findall(r"\d+H([^,;]+)", "".join(of("G")))]
    if not lines:
        return "", 0.0
    out.append(f"Entities: {len(of('D')) // 2}")
    return "\n".join(out), 0.8 if len(out) > 1 else 0.3


def image_card(name: str, content: bytes) -> tuple[str, float]:
    return f"[IMAGE_METADATA]\nFile: {PurePosixPath(name.replace('\\', '/')).name}\nType: {suffix(name)}\nSize: {len(content)}", 0.1


@register(*PLACEHOLDERS)
def placeholder(name: str, content: bytes) -> tuple[str, float]:
    return f"File: {PurePosixPath(name.replace('\\', '/')).name}\nType: {suffix(name)}\nSize: {len(content)}\nNeeds: a parser for this format", 0.15


@register(*SLOTS)
def slot(name: str, content: bytes) -> tuple[str, float]:
    raise Missing(suffix(name))


#: another extractor, and when it is asked: "off", "prefer" (before the format's own parser) or "fallback" (where that gives nothing)
BRIDGE: dict = {"mode": "off", "parser": None}


def set_bridge(parser: Parser | None, mode: str = "fallback") -> None:
    if mode not in ("off", "prefer", "fallback"):
        raise ValueError("mode is one of off, prefer, fallback")
    BRIDGE.update(mode=mode if parser else "off", parser=parser)


def parse(name: str, content: bytes | None, max_chars: int = MAX_CHARS) -> tuple[str, float, str | None]:
    """(text, quality, reason of an empty text): unknown_format, library_missing, parse_error, empty or None."""
    if BRIDGE["mode"] == "prefer":
        other = _parse_with(BRIDGE["parser"], name, content, max_chars)
        if other[2] is None:
            return other
    own = _parse_with(REGISTRY.get(suffix(name or "")), name, content, max_chars)
    if own[2] is not None and BRIDGE["mode"] == "fallback":
        other = _parse_with(BRIDGE["parser"], name, content, max_chars)
        return other if other[2] is None else own
    return own


def _parse_with(f: Parser | None, name: str, content: bytes | None, max_chars: int) -> tuple[str, float, str | None]:
    if f is None:
        return "", 0.0, "unknown_format"
    try:
        text, quality = f(name, content or b"")
    except Missing:
        return "", 0.0, "library_missing"
    except Exception:  # whatever a broken file does to its parser, the row stays
        return "", 0.0, "parse_error"
    return (text[:max_chars], quality, None) if text.strip() else ("", 0.0, "empty")


def parse_files(files: DataFrame, path: str = "path", content: str = "content", setup: Callable[[], None] | None = None) -> DataFrame:
    """All columns of ``files`` but the content, with text, parse_quality, file_ext, file_size, empty_reason. Narrow, one row a file.

    ``setup`` runs once in each task before the first file, to register parsers, steps or a bridge there.
    """
    ship_package(files.sparkSession)
    keep = [c for c in files.columns if c not in (content,)]
    schema = files.select(*keep).schema.add("text", "string").add("parse_quality", "double").add("file_ext", "string").add("file_size", "long").add("empty_reason", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if setup is not None:
            setup()
        for b in batches:
            names, data = b.column(keep.index(path)).to_pylist(), b.column(len(keep)).to_pylist()
            rows = [parse(n or "", d) for n, d in zip(names, data, strict=True)]
            cols = [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.float64()), pa.array([suffix(n or "") for n in names], pa.string()), pa.array([len(d or b"") for d in data], pa.int64()), pa.array([r[2] for r in rows], pa.string())]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], *cols], [*keep, "text", "parse_quality", "file_ext", "file_size", "empty_reason"])

    return files.select(*keep, content).mapInArrow(run, schema)


def parse_paths(files: DataFrame, path: str = "path", setup: Callable[[], None] | None = None) -> DataFrame:
    """As :func:`parse_files`, but each task opens the files of its rows itself; a file that can't be read has the reason ``unreadable``."""
    from .files import open_file

    ship_package(files.sparkSession)
    keep = files.columns
    schema = files.select(*keep).schema.add("text", "string").add("parse_quality", "double").add("file_ext", "string").add("file_size", "long").add("empty_reason", "string")

    def one(name: str | None) -> tuple[str, float, str, int, str | None]:
        try:
            with open_file(name) as f:
                data = f.read()
        except (OSError, TypeError, ValueError):
            return "", 0.0, suffix(name or ""), 0, "unreadable"
        text, quality, reason = parse(name, data)
        return text, quality, suffix(name), len(data), reason

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if setup is not None:
            setup()
        at = keep.index(path)
        for b in batches:
            for i in range(0, b.num_rows, 64):  # texts leave the task a few files at a time
                part = b.slice(i, 64)
                rows = [one(n) for n in part.column(at).to_pylist()]
                cols = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.string(), pa.float64(), pa.string(), pa.int64(), pa.string()))]
                yield pa.RecordBatch.from_arrays([*part.columns, *cols], [*keep, "text", "parse_quality", "file_ext", "file_size", "empty_reason"])

    return files.mapInArrow(run, schema)


from . import formats  # noqa: E402, F401 - registers the parsers of binary formats
