"""Overlapping chunks with section headings and deterministic ids."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import paths as P
from ..plans.shared import ship_package

_NUMBERED = re.compile(r"\d+(\.\d+)*\s+")
LOOK_BACK = 2000


def _is_section(line: str, most: int) -> bool:
    if not line or len(line) > most:
        return False
    return (len(line) > 3 and line.isupper()) or _NUMBERED.match(line) is not None or (len(line) < 80 and line[-1] == ":")


def heading_before(text: str, at: int, most: int) -> str:
    """The nearest non-blank line before ``at`` if it is a heading, else an empty text."""
    region = text[max(0, at - LOOK_BACK) : at].rstrip()
    line = region[region.rfind("\n") + 1 :].strip()
    return line if _is_section(line, most) else ""


def cut_windows(text: str, size: int, overlap: int) -> Iterator[tuple[int, int]]:
    """(start, end) of the windows: cut in the second half after a blank line, a sentence or a line, else hard."""
    n, start = len(text), 0
    while True:
        end = min(start + size, n)
        if end < n:
            for mark in ("\n\n", ". ", "\n"):
                at = text.rfind(mark, start + size // 2, end)
                if at >= 0:
                    end = at + len(mark)
                    break
        yield start, end
        if end >= n:
            return
        start = max(end - overlap, start + 1)


def chunk(text: str | None, size: int = 1200, overlap: int = 200, most_heading: int = 160) -> list[str]:
    if not text or not text.strip():
        return []
    out = []
    for start, end in cut_windows(text, size, overlap):
        piece = text[start:end].strip()
        if piece:
            head = heading_before(text, start, most_heading)
            out.append(f"[SECTION] {head}\n{piece}" if head and not piece.startswith(head) else piece)
    return out


def chunk_rows(docs: DataFrame, size: int = 1200, overlap: int = 200, most_heading: int = 160, text: str = "text") -> DataFrame:
    """All columns of ``docs`` but the text, with chunk_index, chunk_text, chunk_start, chunk_end, one row a chunk; no shuffle.

    Null and blank texts give no rows.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be less than size")
    ship_package(docs.sparkSession)
    keep = [c for c in docs.columns if c != text]
    schema = docs.select(*keep).schema.add("chunk_index", "integer").add("chunk_text", "string").add("chunk_start", "integer").add("chunk_end", "integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, index, piece, first, last = [], [], [], [], []
            for r, t in enumerate(b.column(len(keep)).to_pylist()):
                for i, c in enumerate(chunk(t, size, overlap, most_heading)):
                    at = t.find(c[:100])
                    rows.append(r)
                    index.append(i)
                    piece.append(c)
                    first.append(at)
                    last.append(at + len(c) if at >= 0 else i * size)
            kept = b.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns[: len(keep)], pa.array(index, pa.int32()), pa.array(piece, pa.string()), pa.array(first, pa.int32()), pa.array(last, pa.int32())], [*keep, "chunk_index", "chunk_text", "chunk_start", "chunk_end"])

    return docs.select(*keep, text).mapInArrow(run, schema)


def chunk_id(path: Column, mtime_ns: Column, start: Column, end: Column, text: Column) -> Column:
    """SHA-256 over path, time stamp, position and the text's first 2,000 characters."""
    p = F.lower(P.norm_path(P.strip(path)))
    return F.sha2(F.concat_ws("|", p, mtime_ns.cast("string"), start.cast("string"), end.cast("string"), F.sha2(F.substring(F.coalesce(text, F.lit("")), 1, 2000), 256)), 256)
