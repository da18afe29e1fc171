"""Evaluation passages in the corpus (problem 9): the q-gram lemma in overlapping diagonal bands, banded alignment, exact check.

Texts are compared as lower-cased words with single blanks between them. A passage of ``min_words`` words of an item has at
least ``m`` characters; a copy with at most ``edits`` character edits keeps ``m - q + 1 - q * edits`` of its q-grams (the
q-gram lemma) on diagonals that differ by at most ``edits``. The lemma is used twice: over the whole corpus with the q-grams of
all items together, vectorised, and then in the few regions left, item by item and band by band.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.shared import ship_package
from .alignment import banded_distance
from .hashing import _BASE, _BASE_INV, LOWER, U, _powers, blocks, mix, plain

TABLE_BITS = 22
#: a block of items holds at most so many, and at most so many characters (about 48 MB of postings and streams); a longer item is a block by itself
BLOCK_ITEMS, BLOCK_CHARS = 20_000, 1_000_000


def word_stream(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased words of all texts as bytes with one blank after each word, and the offset of each text."""
    parts = [plain(t).encode() for t in texts]
    low = LOWER[np.frombuffer(b" ".join(parts) + b" ", np.uint8)]
    keep = low != 0
    keep[1:] |= low[:-1] != 0
    out = np.where(low == 0, np.uint8(32), low)[keep]
    begins = np.cumsum([0, *(len(p) + 1 for p in parts)])
    return out, np.append(0, np.cumsum(keep))[begins]


def qgram_hashes(stream: np.ndarray, q: int) -> np.ndarray:
    n = len(stream) - q + 1
    if n <= 0:
        return np.empty(0, U)
    sums = np.empty(len(stream) + 1, U)
    sums[0] = 0
    np.cumsum(stream.astype(U) * _powers("up", _BASE, len(stream))[: len(stream)], out=sums[1:])
    return (sums[q:] - sums[:-q]) * _powers("down", _BASE_INV, len(stream) + 1)[:n]


class ItemGrams:
    """q-grams of the items: a bit table for the first look, and sorted postings (hash, item, position)."""

    def __init__(self, items: list[tuple[int, str]], q: int, min_words: int, edits: int) -> None:
        self.q, self.edits, self.min_words = q, edits, min_words
        self.ids, self.streams, self.word_at, self.need = [], [], [], []
        hashes, item_no, position = [], [], []
        for item_id, text in items:
            stream, _ = word_stream([text])
            stream = stream[:-1]  # no blank after the last word
            starts = np.flatnonzero(np.append(True, stream[:-1] == 32)) if len(stream) else np.empty(0, np.int64)
            if len(starts) < min_words:
                continue
            ends = np.append(starts[1:] - 1, len(stream))
            shortest = int((ends[min_words - 1 :] - starts[: len(starts) - min_words + 1]).min())
            h = qgram_hashes(stream, q)
            hashes.append(h)
            item_no.append(np.full(len(h), len(self.ids)))
            position.append(np.arange(len(h)))
            self.ids.append(item_id)
            self.streams.append(stream)
            self.word_at.append((starts, ends))
            self.need.append(max(1, shortest - q + 1 - q * edits))
        cat = (lambda x: np.concatenate(x)) if hashes else (lambda _: np.empty(0, np.int64))
        h = cat(hashes).astype(U) if hashes else np.empty(0, U)
        order = np.argsort(h, kind="stable")
        self.hash, self.item, self.pos = h[order], cat(item_no)[order], cat(position)[order]
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[(mix(self.hash) >> U(64 - TABLE_BITS)).astype(np.int64)] = True
        self.least = min(self.need, default=0)
        self.span = self.least + q * edits

    def candidates(self, stream: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Rows (text, item, lowest diagonal, highest diagonal) whose shared q-grams meet the lemma within a band."""
        h = qgram_hashes(stream, self.q)
        if not len(h) or not len(self.hash):
            return np.empty((0, 4), np.int64)
        seen = self.table[(mix(h) >> U(64 - TABLE_BITS)).astype(np.int64)]
        count = np.append(0, np.cumsum(seen))
        n = len(h)
        window = min(self.span, n)
        dense = np.flatnonzero(count[window:] - count[: n - window + 1] >= min(self.least, window))
        if not len(dense):
            return np.empty((0, 4), np.int64)
        near = np.zeros(n + 1, np.int64)
        np.add.at(near, dense, 1)
        np.add.at(near, np.minimum(dense + window, n), -1)
        at = np.flatnonzero((np.cumsum(near[:n]) > 0) & seen)
        doc = np.searchsorted(offsets, at, "right") - 1
        at = at[at + self.q <= offsets[doc + 1]]
        lo, hi = np.searchsorted(self.hash, h[at], "left"), np.searchsorted(self.hash, h[at], "right")
        each = hi - lo
        if not each.sum():
            return np.empty((0, 4), np.int64)
        src = np.repeat(at, each)
        post = np.repeat(lo - np.append(0, np.cumsum(each))[:-1], each) + np.arange(each.sum())
        doc = np.searchsorted(offsets, src, "right") - 1
        item = self.item[post]
        diag = src - offsets[doc] - self.pos[post]
        width = 2 * (self.edits + 1)
        # one sort by (text, item, diagonal); bands of either phase are runs of it
        base = int(diag.min())
        span = int(diag.max()) - base + 1
        key = np.sort((doc * len(self.ids) + item) * span + (diag - base))
        pair, dg = key // span, key % span + base
        doc, item = pair // len(self.ids), pair % len(self.ids)
        need = np.array(self.need)
        out = []
        for shift in (0, width // 2):  # bands overlap by half, so that no region falls between two
            band = (dg + shift) // width
            starts = np.flatnonzero(np.append(True, (pair[1:] != pair[:-1]) | (band[1:] != band[:-1])))
            ends = np.append(starts[1:], len(key))
            ok = ends - starts >= need[item[starts]]
            starts, ends = starts[ok], ends[ok]
            out.append(np.stack([doc[starts], item[starts], dg[starts], dg[ends - 1]], 1))
        return np.unique(np.concatenate(out), axis=0)

    def verify(self, text: np.ndarray, item: int, low: int, high: int) -> tuple[int, int]:
        """(longest exact run of words, fewest edits of a passage of ``min_words`` words) on the band's diagonals."""
        x = self.streams[item]
        starts, ends = self.word_at[item]
        longest, fewest = 0, self.edits + 1
        left, right = [], []
        for d in range(low, high + 1):
            a, b = max(0, -d), min(len(x), len(text) - d)
            if b <= a:
                continue
            equal = np.zeros(len(x) + 1, np.int64)
            equal[a + 1 : b + 1] = x[a:b] == text[a + d : b + d]
            equal = np.cumsum(equal)
            whole = equal[ends] - equal[starts] == ends - starts
            # the text's word has to begin and end where the item's does
            before, after = starts + d - 1, ends + d
            whole &= (before < 0) | (text[np.clip(before, 0, len(text) - 1)] == 32)
            whole &= (after >= len(text)) | (text[np.clip(after, 0, len(text) - 1)] == 32)
            edge = np.flatnonzero(np.diff(np.concatenate([[0], whole.view(np.int8), [0]])))
            if len(edge):
                longest = max(longest, int((edge[1::2] - edge[::2]).max()))
            if longest < self.min_words:
                # of edits + 1 parts of a passage at least one is free of edits, hence equal on one of the diagonals
                ps, pe = starts[: len(starts) - self.min_words + 1], ends[self.min_words - 1 :]
                cut = [ps + (pe - ps) * k // (self.edits + 1) for k in range(self.edits + 2)]
                hope = (ps >= a) & (pe <= b) & np.any([equal[y] - equal[x_] == y - x_ for x_, y in zip(cut, cut[1:], strict=False)], axis=0)
                for w in np.flatnonzero(hope):
                    left.append(x[ps[w] : pe[w]])
                    right.append(text[ps[w] + d : pe[w] + d])
        if longest >= self.min_words:
            return longest, 0
        if left:
            fewest = int(banded_distance(left, right, self.edits + 1).min())
        return longest, fewest


def eval_leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text_col: str = "text", min_words: int = 15, edits: int = 1, q: int = 16) -> DataFrame:
    """``(doc_id, item_id, words, edits)``: documents that hold ``min_words`` consecutive words of an item, up to ``edits`` edits.

    ``words`` is the longest exact run of the item's words; ``edits`` is 0 where that run reaches ``min_words``. The items are
    the stated query set; they are taken in blocks of bounded number and size, each broadcast to all tasks, against all documents in one
    pass without a shuffle. Rows with null ids or texts, empty texts, and items below ``min_words`` words give nothing; repeated
    documents and items give one row each pair; other columns are ignored.
    """
    spark = docs.sparkSession
    ship_package(spark)
    texts = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null and length(text) > 0")
    held = items.select(F.col(item_id).cast("bigint").alias("item_id"), F.col(text_col).alias("text")).where("item_id is not null and text is not null").distinct().orderBy("item_id", "text")
    schema = "doc_id bigint, item_id bigint, words int, edits int"
    out, block = None, []

    def scan(rows: list[tuple[int, str]]) -> DataFrame:
        shared = spark.sparkContext.broadcast(ItemGrams(rows, q, min_words, edits))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            grams = shared.value
            for b in batches:
                ids, all_texts = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_pylist()
                for i, j in blocks(all_texts):
                    stream, off = word_stream(all_texts[i:j])
                    rows = {}
                    for doc, item, low, high in grams.candidates(stream, off).tolist():
                        words, least = grams.verify(stream[off[doc] : off[doc + 1]], item, low, high)
                        if least <= edits:
                            key = (int(ids[i + doc]), grams.ids[item])
                            old = rows.get(key, (0, edits + 1))
                            rows[key] = (max(old[0], words), min(old[1], least))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k[0] for k in rows], pa.int64()), pa.array([k[1] for k in rows], pa.int64()), pa.array([v[0] for v in rows.values()], pa.int32()), pa.array([v[1] for v in rows.values()], pa.int32())],
                        ["doc_id", "item_id", "words", "edits"],
                    )

        return texts.mapInArrow(run, schema)

    size = 0
    for r in held.toLocalIterator():
        if block and (len(block) == BLOCK_ITEMS or size + len(r["text"]) > BLOCK_CHARS):
            out = scan(block) if out is None else out.unionByName(scan(block))
            block, size = [], 0
        block.append((r["item_id"], r["text"]))
        size += len(r["text"])
    if block or out is None:
        out = scan(block) if out is None else out.unionByName(scan(block))
    return out.groupBy("doc_id", "item_id").agg(F.max("words").alias("words"), F.min("edits").alias("edits"))
