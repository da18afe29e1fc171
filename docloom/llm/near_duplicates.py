"""Near-duplicate records with small edits (problem 2): Order MinHash candidates, banded alignment, exact check.

1. Texts with the same word sequence form one class; only the class's smallest id goes on.
2. Order MinHash: the smallest ``2`` occurrence-labelled word 5-grams, kept in text order, once per hash function
   over the whole text and once per content-defined segment of it. The segments make a text that is contained in a longer one,
   or whose paragraphs were moved, share keys with it.
3. All keys are range-sorted; a row meets the two rows before it and the smallest id of its run, so that a hot
   key costs time in proportion to its rows and is split over tasks by the sort. MinHash values drop chance meetings.
4. Banded alignment verifies a pair: an edit of a word spoils at most five 5-grams, so few edits prove the similarity. Where the edits
   are too many to prove it, the exact containment of the 5-grams decides.
5. Components of the links are groups. An exact prefix join then compares all texts of different groups that can share ``threshold`` of
   the smaller one's 5-grams, and its links, verified in the same way, complete the groups: none is left to chance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.components import connected_components
from ..plans.shared import attach_group, discard, materialize, ship_package, widen
from .alignment import banded_distance
from .hashing import U, blocks, mix, shingles, spread_values, word_blocks, word_values
from .prefixes import K, token_bits, token_counts, token_rows, wanted_rows
from .sketches import Packed, get_bits, merged_table, set_bits

SIGS = 8
GLOBAL_KEYS = 6
SEGMENT_MASK = 15
LEAST_SEGMENT = 6
MARKS = 1024
TOP = U(0xFFFFFFFFFFFFFFFF)
ODD = [int(x) | 1 for x in mix(np.arange(1, SIGS + 1, dtype=U) * U(0x9E3779B97F4A7C15))]


def occurrence(s: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """How many times the same shingle stood earlier in the same text."""
    if not len(s):
        return np.empty(0, np.int64)
    key = s + mix(doc.astype(U) + U(1))
    order = np.argsort(key, kind="stable")
    k = key[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    first = np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))
    out = np.empty(len(k), np.int64)
    out[order] = np.arange(len(k)) - first
    return out


def _two_minima(v: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two smallest values of each run, in the order in which they stand in the text."""
    one = np.minimum.reduceat(v, starts)
    run = np.repeat(np.arange(len(starts)), lengths)
    at_one = v == one[run]
    rest = np.where(at_one, TOP, v)
    two = np.minimum.reduceat(rest, starts)
    pos_one = np.full(len(starts), -1)
    where = np.flatnonzero(at_one)[::-1]
    pos_one[run[where]] = where
    pos_two = np.full(len(starts), -1)
    where = np.flatnonzero((rest == two[run]) & (rest != TOP))[::-1]
    pos_two[run[where]] = where
    swap = (pos_two >= 0) & (pos_two < pos_one)
    return np.where(swap, two, one), np.where(swap, one, two)


def sketch(texts: list) -> dict:
    """Word values, number of 5-grams, Order MinHash keys, MinHash bytes and word-sequence class of each text (arrays by text)."""
    h, values, off = word_values(texts)
    m = len(texts)
    s, doc, _ = shingles(spread_values(values), off, K)
    occ = occurrence(s, doc)
    n = np.bincount(doc[occ == 0], minlength=m)
    ends = np.cumsum(np.bincount(doc, minlength=m))
    lengths = np.diff(ends, prepend=0)
    full = np.flatnonzero(lengths)
    starts, lens = (ends - lengths)[full], lengths[full]
    g = mix(s + occ.astype(U) * U(0xA0761D6478BD642F))
    sig = np.zeros((m, SIGS), np.uint8)
    key_doc, keys = [], []
    if len(full):
        for i, odd in enumerate(ODD):
            v = g * U(odd)
            if i < GLOBAL_KEYS:
                a, b = _two_minima(v, starts, lens)
                keys.append(mix(a * U(3) + b + U(i)))
                key_doc.append(full)
                least = np.minimum(a, b)
            else:
                least = np.minimum.reduceat(v, starts)
            sig[full, i] = (mix(least) >> U(56)).astype(np.uint8)
        cut = np.zeros(len(s), bool)
        cut[starts] = True
        cut[1:] |= (s[:-1] & U(SEGMENT_MASK)) == 0
        seg = np.flatnonzero(cut)
        seg_len = np.diff(np.append(seg, len(s)))
        a, b = _two_minima(mix(g ^ U(0x5851F42D4C957F2D)), seg, seg_len)
        long = seg_len >= LEAST_SEGMENT
        keys.append(mix(a * U(5) + b)[long])
        key_doc.append(doc[seg[long]])
    cls = [c.view(np.int64) for c in sequence_class(h, off)]
    key_doc = np.concatenate(key_doc) if key_doc else np.empty(0, np.int64)
    keys = np.concatenate(keys) if keys else np.empty(0, U)
    order = np.argsort(key_doc, kind="stable")
    return {"n": n, "sig": np.ascontiguousarray(sig).view(np.int64)[:, 0], "cls": cls, "key_off": np.searchsorted(key_doc[order], np.arange(m + 1)), "keys": keys[order].view(np.int64), "values": values, "off": off}


def sequence_class(h: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit hashes of each text's word sequence (0 without a word)."""
    at = (np.arange(len(h)) - np.repeat(off[:-1], np.diff(off))).astype(U)
    some = np.flatnonzero(np.diff(off))
    out = []
    for salt in (1, 2):
        c = np.zeros(len(off) - 1, U)
        if len(some):
            c[some] = np.add.reduceat(mix(h + mix(at * U(0x9E3779B97F4A7C15) + U(salt))), off[:-1][some])
        out.append(c)
    return out


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b.column(1).to_pylist()
        for i, j in blocks(texts):
            x = sketch(texts[i:j])
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).slice(i, j - i),
                    pa.array(x["n"], pa.int32()),
                    pa.array(x["cls"][0]),
                    pa.array(x["cls"][1]),
                    pa.array(x["sig"]),
                    pa.ListArray.from_arrays(pa.array(x["key_off"], pa.int32()), pa.array(x["keys"])),
                    pa.array([x["values"][p:q].tobytes() for p, q in zip(x["off"][:-1], x["off"][1:], strict=True)], pa.binary()),
                ],
                ["id", "n", "cls_a", "cls_b", "sig", "keys", "words"],
            )


def _neighbours(threshold: float):
    """Rows (key, id, n, sig) sorted by key: pairs with the two rows before and with the smallest id of the run so far, if MinHash
    values agree about as often as the threshold demands at their sizes (an estimate: what it drops is left to the exact join)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = None
        for b in batches:
            cols = [b.column(c).to_numpy(zero_copy_only=False) for c in range(4)]
            if tail is not None:
                cols = [np.concatenate(x) for x in zip(tail, cols, strict=True)]
            key, idv, n, sig = cols
            if not len(key):
                continue
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            starts = np.flatnonzero(new)
            runs = np.cumsum(new) - 1
            # the leader of a run is its row with the smallest id
            low = np.minimum.reduceat(idv, starts)
            lead = np.zeros(len(starts), np.int64)
            where = np.flatnonzero(idv == low[runs])[::-1]
            lead[runs[where]] = where
            left, right = [lead[runs]], [np.arange(len(key))]
            for d in (1, 2):
                left.append(np.arange(len(key) - d))
                right.append(np.arange(d, len(key)))
            i, j = np.concatenate(left), np.concatenate(right)
            ok = (runs[i] == runs[j]) & (idv[i] != idv[j])
            i, j = i[ok], j[ok]
            same = ((sig[i, None] ^ sig[j, None]).view(np.uint8).reshape(-1, SIGS) == 0).sum(1)
            least, most = np.minimum(n[i], n[j]).astype(float), np.maximum(n[i], n[j])
            jaccard = threshold * least / np.maximum(least + most - threshold * least, 1)
            ok = same >= np.floor(SIGS * jaccard * 0.6)
            i, j = i[ok], j[ok]
            lo, hi = np.minimum(idv[i], idv[j]), np.maximum(idv[i], idv[j])
            if len(lo):
                order = np.lexsort((hi, lo))
                lo, hi = lo[order], hi[order]
                keep = np.ones(len(lo), bool)
                keep[1:] = (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(lo[keep]), pa.array(hi[keep])], ["a", "b"])
            # carried into the next batch: the open run's leader and its last two rows
            last = np.unique(np.append(np.arange(max(starts[-1], len(key) - 2), len(key)), lead[-1]))
            tail = [c[last] for c in cols]

    return run


def _chosen(b: pa.RecordBatch, table: np.ndarray) -> pa.RecordBatch:
    """The rows (id, words) whose id is in the Bloom bits."""
    return b.take(pa.array(np.flatnonzero(get_bits(table, _place(b.column(0).to_numpy(zero_copy_only=False), len(table) * 8)))))


def _marks(bits):
    """Number of 5-grams and their marks of the rows (id, words) whose id is in the Bloom bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            some = _chosen(b, bits.value)
            for i, j, h, off in word_blocks(some.column(1)):
                s, doc, _ = shingles(h, off, K)
                marks = np.zeros((j - i, MARKS), bool)
                marks[doc, (s % U(MARKS)).astype(np.int64)] = True
                raw, grams = np.packbits(marks, axis=1), np.bincount(doc, minlength=j - i)
                yield pa.RecordBatch.from_arrays([some.column(0).slice(i, j - i), pa.array(grams, pa.int32()), pa.array([r.tobytes() for r in raw], pa.binary())], ["id", "grams", "marks"])

    return run


def _words_of(bits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _chosen(b, bits.value)

    return run


def _possible(threshold: float):
    """Drop only pairs that can't reach the threshold: each mark that the other text lacks is at least one 5-gram that it lacks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            na, nb = (b.column(c).to_numpy(zero_copy_only=False) for c in (2, 3))
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(-1, MARKS // 8) for c in (4, 5))
            lacks = lambda p, q, n: np.bitwise_count(p & ~q).sum(1) <= (1 - threshold) * n + 1e-9
            t = b.filter(pa.array(lacks(x, y, na) | lacks(y, x, nb)))
            yield pa.RecordBatch.from_arrays([t.column(0), t.column(1)], ["a", "b"])

    return run


def _place(ids: np.ndarray, size: int) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(U)) % U(size)).astype(np.int64)


def containment(left: list[np.ndarray], right: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Exact shared distinct word 5-grams over the smaller number of them, pair by pair (0 where a text has none), and that number."""
    m = len(left)
    counts, sets = [], []
    for side in (left, right):
        off = np.cumsum([0, *map(len, side)])
        s, doc, _ = shingles(spread_values(np.concatenate(side)) if off[-1] else np.empty(0, U), off, K)
        key = np.unique(mix(s ^ mix(doc.astype(U) + U(7))))
        counts.append(np.bincount(doc[occurrence(s, doc) == 0], minlength=m))
        sets.append((key, s, doc))
    (_, s1, d1), (key2, _, _) = sets
    first = occurrence(s1, d1) == 0
    k1 = mix(s1[first] ^ mix(d1[first].astype(U) + U(7)))
    at = np.searchsorted(key2, k1)
    at[at == len(key2)] = 0
    hit = key2[at] == k1 if len(key2) else np.zeros(len(k1), bool)
    shared = np.bincount(d1[first][hit], minlength=m)
    least = np.minimum(*counts)
    return np.where(least > 0, shared / np.maximum(least, 1), 0.0), least


def _verify(threshold: float, band: int):
    """Pairs (a, b, wa, wb) that are similar: few edits in the banded alignment prove it, else the exact containment decides.

    An edit spoils at most ``K`` of the smaller text's 5-grams, so with ``d`` edits at least ``1 - K * d / n`` of its ``n`` are shared.
    The similarity given is the exact containment in either case.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                x, y = ([np.frombuffer(w, np.uint32) for w in part.column(c).to_pylist()] for c in (2, 3))
                d = banded_distance(x, y, band)
                similar, grams = containment(x, y)
                proven = (d <= band) & (grams > 0) & (1 - K * d / np.maximum(grams, 1) >= threshold)
                keep = np.flatnonzero(proven | (similar >= threshold))
                if len(keep):
                    longest = np.array([max(len(x[i]), len(y[i]), 1) for i in keep])
                    edit = np.where(d[keep] > band, np.nan, 1 - d[keep] / longest)
                    rows = part.take(pa.array(keep))
                    yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(similar[keep]), pa.array(edit, from_pandas=True)], ["a", "b", "similarity", "edit_similarity"])

    return run


def bloom_of(ids: DataFrame, bits: int) -> np.ndarray:
    """Bloom bits (one hash) of an id column; the size is fixed, whatever the data."""

    def fold(table: np.ndarray, b: pa.RecordBatch) -> None:
        set_bits(table, _place(b.column(0).to_numpy(zero_copy_only=False), bits))

    return merged_table(ids, bits // 8, "uint8", fold, "or")[0]


def verified(pairs: DataFrame, words: DataFrame, threshold: float, band: int, bloom_bits: int) -> DataFrame:
    """Links (a, b, similarity, edit_similarity) among candidate ``pairs`` (a, b) of texts ``words`` (id, words), one row an id.

    Marks of fixed size drop impossible pairs first, so that only words of texts in likely pairs are moved.
    """
    words = words.select("id", "words")
    ids = lambda p: p.select(F.explode(F.array("a", "b")).alias("id"))
    marked = materialize(words.mapInArrow(_marks(Packed(pairs, bloom_of(ids(pairs), bloom_bits))), "id bigint, grams int, marks binary"))
    marks = lambda c: marked.select(F.col("id").alias(c), F.col("grams").alias(f"n{c}"), F.col("marks").alias(f"m{c}"))
    likely = materialize(pairs.join(marks("a"), "a").join(marks("b"), "b").select("a", "b", "na", "nb", "ma", "mb").mapInArrow(_possible(threshold), "a bigint, b bigint"))
    discard(marked)
    chosen = words.mapInArrow(_words_of(Packed(pairs, bloom_of(ids(likely), bloom_bits))), "id bigint, words binary")
    left = chosen.select(F.col("id").alias("a"), F.col("words").alias("wa"))
    right = chosen.select(F.col("id").alias("b"), F.col("words").alias("wb"))
    links = likely.join(left, "a").join(right, "b").select("a", "b", "wa", "wb").mapInArrow(_verify(threshold, band), "a bigint, b bigint, similarity double, edit_similarity double")
    out = materialize(links)
    discard(likely)
    return out


def _across_groups(words: DataFrame, groups: DataFrame, number: int, threshold: float) -> DataFrame:
    """Pairs (a, b) of texts ``words`` (id, words) in different ``groups`` (id, grp) of which the smaller one's prefix shares a token with the other.

    What meets under a token are groups before rows, so that a token of a large group costs nothing within the group.
    """
    counts = Packed(words, token_counts(words, number))
    of = lambda rows, i, n, g: rows.join(groups, "id").select("token", F.col("id").alias(i), F.col("n").alias(n), F.col("grp").alias(g))
    prefix = materialize(words.mapInArrow(token_rows(counts, threshold, True), "token bigint, id bigint, pos int, n int").select("token", "id", "n"))
    wanted = Packed(words, token_bits(prefix, prefix.count()))
    small = materialize(of(prefix, "a", "na", "ga"))
    discard(prefix)
    large = materialize(of(words.mapInArrow(wanted_rows(wanted), "token bigint, id bigint, n int"), "b", "nb", "gb"))
    meet = small.select("token", "ga").distinct().join(large.select("token", "gb").distinct(), "token").where("ga <> gb")
    pairs = meet.join(small, ["token", "ga"]).join(large, ["token", "gb"]).where("na <= nb")
    out = materialize(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    for t in (small, large):
        discard(t)
    return out


def near_duplicate_groups(
    docs: DataFrame,
    id_col: str = "file_id",
    text_col: str = "normalized_text",
    threshold: float = 0.9,
    min_chars: int = 200,
    band: int = 24,
    bloom_bits: int = 1 << 23,
) -> DataFrame:
    """``(id, first, links, similarity, edit_similarity)`` of every text that belongs to a near-duplicate group.

    ``first`` is the smallest id of the group, ``links`` the number of verified links of the text's word-sequence
    class, the similarities are the best among them (1.0 inside a class; edit similarity null outside the band).
    Rows with a null id or text, with fewer than ``min_chars`` characters or with fewer than five words belong to no
    group. Repeated rows of one id count once. Other columns of ``docs`` are ignored. Empty input gives an empty result.
    """
    spark = docs.sparkSession
    ship_package(spark)
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).where((F.length("text") >= min_chars) & F.col("id").isNotNull())
    sk = materialize(widen(texts).mapInArrow(_sketch_batches, "id bigint, n int, cls_a bigint, cls_b bigint, sig bigint, keys array<bigint>, words binary").where("n > 0"))
    number = sk.count()
    members = materialize(attach_group(sk.select("id", "cls_a", "cls_b"), ["cls_a", "cls_b"], {"rep": F.min("id")}, number).select("id", "rep").distinct())
    reps = members.where("id = rep").select("id")
    keyed = sk.select("id", "n", "sig", "keys").join(reps, "id").select("id", "n", "sig", F.explode("keys").alias("key"))
    order = (F.col("key"), F.col("sig"), F.xxhash64("id", "key"))
    pairs = materialize(keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "id", "n", "sig").mapInArrow(_neighbours(threshold), "a bigint, b bigint").distinct())
    words = sk.select("id", "words")
    first = verified(pairs, words.dropDuplicates(["id"]) if members.count() < number else words, threshold, band, bloom_bits)
    comps = connected_components(first, "a", "b").select(F.col("node").alias("id"), F.col("component").alias("c"))
    groups = materialize(reps.join(comps, "id", "left").select("id", F.coalesce("c", "id").alias("grp")))
    rest = _across_groups(words, groups, number, threshold).join(pairs, ["a", "b"], "left_anti")
    links = first.unionByName(verified(rest, words.dropDuplicates(["id"]) if members.count() < number else words, threshold, band, bloom_bits))
    comps = connected_components(links, "a", "b").select(F.col("node").alias("rep"), F.col("component").alias("root"))
    ends = links.select(F.col("a").alias("rep"), "similarity", "edit_similarity").unionByName(links.select(F.col("b").alias("rep"), "similarity", "edit_similarity"))
    best = ends.groupBy("rep").agg(F.count(F.lit(1)).alias("links"), F.max("similarity").alias("best"), F.max("edit_similarity").alias("best_edit"))
    rows = members.join(comps, "rep", "left").join(best, "rep", "left").withColumn("first", F.coalesce("root", "rep"))
    copies = members.groupBy("rep").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    rows = rows.join(copies, "rep", "left").where("root is not null or copies > 1")
    whole = F.col("copies").isNotNull()
    return rows.select("id", "first", F.coalesce("links", F.lit(0)).alias("links"), F.when(whole, F.lit(1.0)).otherwise(F.col("best")).alias("similarity"), F.when(whole, F.lit(1.0)).otherwise(F.col("best_edit")).alias("edit_similarity"))
