"""Splitting oversized texts (problem 4): dynamic programming over boundary positions.

A text longer than its run's size becomes pieces of at most ``size`` characters; consecutive pieces share exactly ``overlap`` characters. The
sum of cut penalties and of squared deviations from equal pieces is least over all admissible cuts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.shared import ship_package, widen

#: penalties of a cut: between paragraphs, after a line, after a sentence, between words, within a word, between a heading and its text
PARAGRAPH, LINE, SENTENCE, BLANK, HARD, HEADING = 0.0, 0.6, 0.3, 1.5, 6.0, 4.0
BALANCE = 2.0
_ENDS = re.compile(r"[.!?][\"')\]]*\s+(?=[^\s])")
_SPACE = re.compile(r"\s+")
_NUMBERED = re.compile(r"\d+(\.\d+)*\.?\s+\S")


def is_heading(line: str, most: int) -> bool:
    x = line.strip()
    return 0 < len(x) <= most and x[-1] not in ".!?,;" and ((x.upper() == x and len(x) > 3 and any(c.isalpha() for c in x)) or bool(_NUMBERED.match(x)) or (x.endswith(":") and len(x) < 80))


def boundaries(text: str, most_heading: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions at which a piece may end (after the white space) and their penalties, in order, without the text's end."""
    cost: dict[int, float] = {}
    for m in _SPACE.finditer(text):
        feeds = m.group().count("\n")
        cost[m.end()] = PARAGRAPH if feeds > 1 else LINE if feeds else BLANK
    for m in _ENDS.finditer(text):
        cost[m.end()] = min(cost.get(m.end(), HARD), SENTENCE)
    at = 0
    for line in text.split("\n"):
        end = at + len(line) + 1
        if is_heading(line, most_heading):
            nxt = _SPACE.match(text, end - 1)
            for p in {end, nxt.end() if nxt else end}:
                if p in cost:
                    cost[p] = HEADING
            if at in cost:
                cost[at] = PARAGRAPH
        at = end
    places = sorted(p for p in cost if 0 < p < len(text))
    return np.array(places, np.int64), np.array([cost[p] for p in places], float)


def candidates(text: str, step: int, most_heading: int) -> tuple[np.ndarray, np.ndarray]:
    """All positions at which a piece may end, the text's end last, and their penalties.

    These are all boundaries, and hard cuts at an eighth of a step wherever a stretch without any boundary is longer than half a step.
    """
    place, penalty = boundaries(text, most_heading)
    edges = np.concatenate([[0], place, [len(text)]])
    wide = np.flatnonzero(np.diff(edges) > max(1, step // 2))
    if len(wide):
        pitch = max(1, step // 8)
        hard = np.concatenate([np.arange(edges[i] + pitch, edges[i + 1], pitch) for i in wide])
        place, penalty = np.append(place, hard), np.append(penalty, np.full(len(hard), HARD))
        order = np.argsort(place, kind="stable")
        place, penalty = place[order], penalty[order]
    return np.append(place, len(text)), np.append(penalty, 0.0)


def cut_all(texts: list[str], settings: list[tuple[int, int, int]], block: int = 64) -> list[list[tuple[int, int]]]:
    """(start, end) of each piece of each text, given its (size, overlap, heading limit); one piece if it fits, none if it is empty.

    ``size`` is taken as at least 1 and ``overlap`` as 0 <= overlap < size. Every way through the candidates is weighed: the texts of a block
    go through their candidates together, one dynamic programme each.
    """
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    todo = []
    for i, (text, (size, overlap, heading)) in enumerate(zip(texts, settings, strict=True)):
        size = max(1, size)
        overlap = min(max(0, overlap), size - 1)
        if len(text) > size:
            todo.append((i, size, overlap, *candidates(text, size - overlap, heading)))
        elif text:
            out[i] = [(0, len(text))]
    todo.sort(key=lambda x: len(x[3]))
    for at in range(0, len(todo), block):
        part = todo[at : at + block]
        for (i, _, overlap, ends, _), ways in zip(part, _cheapest(part), strict=True):
            out[i] = [(int(ends[p]) - overlap if p >= 0 else 0, int(ends[j])) for p, j in zip([-1, *ways], ways, strict=False)]
    return out


def _cheapest(part: list[tuple]) -> list[list[int]]:
    """Indices of the chosen ends of each text."""
    t, m = len(part), max(len(x[3]) for x in part)
    size, overlap = (np.array([x[k] for x in part], float) for k in (1, 2))
    step = size - overlap
    n = np.array([x[3][-1] for x in part], float)
    # the first piece may reach ``size``, any later one adds at most ``step`` new characters
    ideal = (n - overlap) / (1 + np.ceil((n - size) / step))
    width = max(int((np.arange(len(x[3])) - np.searchsorted(x[3], x[3] - (x[1] - x[2]), "left")).max()) for x in part)
    width = max(1, width)
    ends = np.full((t, width + m), -np.inf)
    own = np.full((t, m), np.inf)
    for r, x in enumerate(part):
        ends[r, width : width + len(x[3])] = x[3]
        own[r, : len(x[4])] = x[4]
    best = np.full((t, width + m), np.inf)
    from_ = np.full((t, m), -1, np.int64)
    rows = np.arange(t)
    scaled = ends / ideal[:, None]
    # an earlier cut must lie beyond the overlap, so that the next piece begins inside the text
    usable = ends > overlap[:, None]
    lowest = (ends - step[:, None])[:, width:]
    for j in range(m):
        e = ends[:, width + j]
        alone = np.where(e <= size, BALANCE * ((e - overlap) / ideal - 1) ** 2, np.inf)
        window = slice(j, j + width)
        off = (scaled[:, width + j] - 1)[:, None] - scaled[:, window]
        cost = best[:, window] + BALANCE * off * off
        cost[~usable[:, window] | (ends[:, window] < lowest[:, j : j + 1])] = np.inf
        k = cost.argmin(1)
        joined = cost[rows, k]
        after = joined < alone
        best[:, width + j] = np.where(after, joined, alone) + own[:, j]
        from_[:, j] = np.where(after, j + k - width, -1)
    out = []
    for r, x in enumerate(part):
        j, ways = len(x[3]) - 1, []
        if not np.isfinite(best[r, width + j]):  # cannot be: hard cuts leave no stretch that a step does not cross
            raise AssertionError("no admissible cut")
        while j >= 0:
            ways.append(j)
            j = int(from_[r, j])
        out.append(ways[::-1])
    return out


def cut(text: str, size: int, overlap: int, most_heading: int = 160) -> list[tuple[int, int]]:
    """The pieces of one text, as in :func:`cut_all`."""
    return cut_all([text], [(size, overlap, most_heading)])[0]


def split_texts(docs: DataFrame, runs: DataFrame, id_col: str = "file_id", text_col: str = "text", run_col: str = "run_id") -> DataFrame:
    """``(file_id, piece_no, pieces, start, end, text)`` of every text that has characters besides outer white space.

    A text without white space at both ends that fits its run's size is one piece. Rows with a null id or text, blank texts, and rows whose
    run is null, unknown or has no positive size give nothing. A null overlap counts as 0, a null heading limit as no headings. Repeated
    rows stay repeated. ``runs`` is a setting per run (a few rows): it is read whole and sent along, after a check of its size.
    """
    spark = docs.sparkSession
    ship_package(spark)
    settings = {r["run_id"]: (r["size"], r["overlap"] or 0, r["max_heading_len"] or 0) for r in runs.where("run_id is not null and size > 0").select("run_id", "size", "overlap", "max_heading_len").limit(100_001).toLocalIterator()}
    if len(settings) > 100_000:
        raise ValueError("more than 100,000 run settings")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            kept = [(i, t.strip(), settings[r]) for i, t, r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True) if r in settings]
            for (i, t, _), spans in zip(kept, cut_all([x[1] for x in kept], [x[2] for x in kept]), strict=True):
                rows += [(i, k, len(spans), a, z, t[a:z]) for k, (a, z) in enumerate(spans, 1)]
            cols = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["file_id", "piece_no", "pieces", "start", "end", "text"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("file_id"), F.col(text_col).alias("text"), F.col(run_col).alias("run")).where("file_id is not null and text is not null")
    return widen(rows).mapInArrow(run, "file_id bigint, piece_no int, pieces int, start bigint, end bigint, text string")
