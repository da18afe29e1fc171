"""Filling fixed-capacity containers (problem 8): optimal length buckets and token-budget batches.

Token counts are made once, by a public tokenizer. For each capacity, dynamic programming over the global histogram of piece
lengths chooses the bucket boundaries that minimise padding. A batch forms inside one bucket: as many of its pieces as the bucket's bound
says fit the token budget. What the batch leaves free is topped up with the largest pieces of smaller buckets that fit. Batches form
inside hash parts of bounded size, so no task ever holds an unbounded group; only items beyond the capacity are split.
"""

from __future__ import annotations

import base64
import os
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.shared import materialize, ship_package
from .hashing import blocks

#: The files' folder is a parameter; this is where the public tokenizers' package keeps them.
TOKENIZER = os.environ.get("DOCLOOM_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: fixed value: the published split pattern of this byte-level vocabulary
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PART_ROWS = 100_000
_ENCODERS: dict = {}


def encoder(path: str):
    if path not in _ENCODERS:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        _ENCODERS[path] = tiktoken.Encoding("docloom", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[path]


def token_counts(docs: DataFrame, doc_id: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """``(doc_id, tokens)`` of every row with an id; null and empty texts have 0 tokens."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for b in batches:
            texts = b.column(1).to_pylist()
            for i, j in blocks(texts):
                n = [len(enc.encode_ordinary(t)) if t else 0 for t in texts[i:j]]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(n, pa.int64())], ["doc_id", "tokens"])

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null")
    return rows.mapInArrow(run, "doc_id bigint, tokens bigint")


def length_buckets(lengths: np.ndarray, counts: np.ndarray, most: int = 16) -> list[int]:
    """Upper bounds of at most ``most`` buckets over the histogram such that the sum of (bound - length) is least.

    Dynamic programming with the divide-and-conquer optimisation (the padding cost meets the quadrangle inequality).
    """
    m = len(lengths)
    if not m:
        return []
    n, total = np.append(0, np.cumsum(counts)), np.append(0, np.cumsum(counts * lengths))
    cost = lambda i, j: lengths[j - 1] * (n[j] - n[i]) - (total[j] - total[i])
    best = np.array([cost(0, j) if j else 0 for j in range(m + 1)], float)
    cuts = []
    for _ in range(min(most, m) - 1):
        nxt, cut = np.full(m + 1, np.inf), np.zeros(m + 1, int)
        stack = [(1, m, 0, m - 1)]
        while stack:
            lo, hi, a, z = stack.pop()
            if lo > hi:
                continue
            mid = (lo + hi) // 2
            i = np.arange(a, min(mid, z + 1))
            if not len(i):
                i = np.array([mid - 1])
            c = best[i] + cost(i, mid)
            k = int(np.argmin(c))
            nxt[mid], cut[mid] = c[k], i[k]
            stack += [(lo, mid - 1, a, i[k]), (mid + 1, hi, i[k], z)]
        cuts.append(cut)
        best = nxt
    bounds, j = [], m
    for cut in reversed(cuts):
        bounds.append(int(lengths[j - 1]))
        j = cut[j]
        if not j:
            break
    if j:
        bounds.append(int(lengths[j - 1]))
    return sorted(set(bounds))


def fill(lengths: np.ndarray, bounds: list[int], capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Container number of each piece, and the bucket whose batch the container holds.

    Buckets are emptied from the longest pieces to the shortest. A batch takes ``capacity // bound`` pieces of its bucket, the longest first, which
    fit whatever their lengths; then the largest piece that still fits comes next, of smaller buckets before its own, until none fits.
    """
    container, batch = np.full(len(lengths), -1, np.int64), np.full(len(lengths), -1, np.int64)
    bucket = np.searchsorted(bounds, lengths)
    free: dict[int, list[int]] = {}
    for i in np.argsort(lengths, kind="stable")[::-1]:
        free.setdefault(int(lengths[i]), []).append(int(i))
    left, number = sorted(free), 0

    def take(at: int, home: int) -> int:
        n = left[at]
        i = free[n].pop()
        container[i], batch[i] = number, home
        if not free[n]:
            del left[at]
        return n

    for home in np.unique(bucket)[::-1]:
        bound = int(bounds[home])
        floor = int(bounds[home - 1]) if home else -1
        each = max(1, capacity // bound) if bound else len(lengths)
        while left and left[-1] > floor:
            room = capacity
            for _ in range(each):
                if not left or left[-1] <= floor:
                    break
                room -= take(len(left) - 1, home)
            while (at := bisect_right(left, min(room, floor)) - 1) >= 0 or (at := bisect_right(left, room) - 1) >= 0:
                room -= take(at, home)
            number += 1
    return container, batch


def _packer(sid: int, cap: int, bounds: list[int]):
    def pack(t: pa.Table) -> pa.Table:
        t = t.sort_by([("doc_id", "ascending"), ("piece", "ascending")])
        n = t["tokens"].to_numpy()
        part, m = t["part"][0].as_py(), t.num_rows
        container, batch = fill(n, bounds, cap)
        return pa.table(
            {"spec_id": pa.array([sid] * m, pa.int32()), "capacity_tokens": pa.array([cap] * m, pa.int32()), "container_id": pa.array([f"{sid}-{part}-{c}" for c in container], pa.string()), "batch_bucket": pa.array(batch, pa.int32()), "bucket": pa.array(np.searchsorted(bounds, n), pa.int32()), "bound": pa.array(np.array(bounds, np.int64)[np.searchsorted(bounds, n)]),
             "doc_id": t["doc_id"], "piece": t["piece"].cast(pa.int32()), "pieces": t["pieces"].cast(pa.int32()), "first_token": t["first_token"], "tokens": t["tokens"]}
        )

    return pack


def fill_containers(docs: DataFrame, spec: DataFrame, buckets: int = 16, tokenizer: str = TOKENIZER, part_rows: int = PART_ROWS) -> DataFrame:
    """``(spec_id, capacity_tokens, container_id, batch_bucket, bucket, bound, doc_id, piece, pieces, first_token, tokens)``.

    ``bucket`` and its ``bound`` are those of the piece, ``batch_bucket`` is the bucket whose batch the container holds; a piece of another bucket
    tops the batch up. Padding of a batch against its bounds is the sum of ``bound - tokens``.
    Every document with an id is assigned for every spec with a positive capacity; one beyond the capacity is split into full pieces and a
    rest, any other stays whole. Null and empty texts are one piece of 0 tokens. Repeated documents are placed once each time they
    occur; null specs are ignored. The specs are few by definition (one row a capacity) and handled one after the other.
    """
    spark = docs.sparkSession
    counted = materialize(token_counts(docs, tokenizer=tokenizer).withColumn("copy", F.lit(0)))
    rows = counted.count()
    parts = max(1, -(-rows // part_rows))
    out = None
    schema = "spec_id int, capacity_tokens int, container_id string, batch_bucket int, bucket int, bound bigint, doc_id bigint, piece int, pieces int, first_token bigint, tokens bigint"
    for r in spec.where("capacity_tokens > 0").select("spec_id", "capacity_tokens").distinct().orderBy("spec_id", "capacity_tokens").toLocalIterator():
        sid, cap = r["spec_id"], r["capacity_tokens"]
        cut = counted.withColumn("pieces", F.greatest(F.lit(1), F.ceil(F.col("tokens") / cap)).cast("int"))
        pieces = cut.select("doc_id", "tokens", "pieces", F.posexplode(F.sequence(F.lit(1), F.col("pieces"))).alias("piece", "_"))
        pieces = pieces.select("doc_id", "pieces", "piece", (F.col("piece") * F.lit(cap).cast("bigint")).alias("first_token"), F.least(F.lit(cap).cast("bigint"), F.col("tokens") - F.col("piece") * F.lit(cap)).alias("tokens"))
        # at most capacity + 1 rows, whatever the corpus
        hist = sorted((h["tokens"], h["n"]) for h in pieces.groupBy("tokens").agg(F.count(F.lit(1)).alias("n")).collect())
        bounds = length_buckets(np.array([h[0] for h in hist], np.int64), np.array([h[1] for h in hist], np.int64), buckets)

        part = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)).cast("int")
        placed = pieces.withColumn("part", part).groupBy("part").applyInArrow(_packer(sid, cap, bounds), schema)
        out = placed if out is None else out.unionByName(placed)
    return out if out is not None else spark.createDataFrame([], schema)


def container_report(placed: DataFrame) -> DataFrame:
    """One row a capacity: pieces, containers, tokens, mean ``fill`` and ``padding`` (tokens missing to the buckets' bounds over the tokens)."""
    one = placed.groupBy("spec_id", "capacity_tokens", "container_id").agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("t"), F.sum(F.col("bound") - F.col("tokens")).alias("p"))
    return one.groupBy("spec_id", "capacity_tokens").agg(F.sum("n").alias("pieces"), F.count(F.lit(1)).alias("containers"), F.sum("t").alias("tokens"), (F.avg("t") / F.max("capacity_tokens")).alias("fill"), (F.sum("p") / F.sum("t")).alias("padding"))


__all__ = ["container_report", "fill", "fill_containers", "length_buckets", "token_counts"]
