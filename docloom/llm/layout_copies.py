"""Copies hidden by formatting (problem 6): merged Bloom filters of once- and repeatedly-seen canonical hashes.

A text's canonical form is its words in order, lower-cased; a record of named fields also has the sorted list of its
``field value`` pairs. The rows are written in parts by a hash of their words that doesn't depend on the order, so all that can belong together
lies in one part; a part holds as many rows as filters of fixed size serve, however many rows there are in all. One pass over a part sets,
per task, the bits of the canonical hashes seen and of those seen again; the tasks' filters are merged on the executors (a bit seen by two
tasks becomes a repeat). Only rows of which both bits are repeats are shuffled for exact grouping by 128-bit hashes; all others
are singletons without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.components import connected_components
from ..plans.shared import attach_group, materialize, ship_package
from .hashing import U, blocks, mix, word_hashes
from .sketches import get_bits, merged_table, set_bits, spread

WORD = regex.compile(r"[\p{L}\p{N}]+")
SPLIT = regex.compile(r"[;|\n]+")
SIGN = re.compile(r"[:=]")
ASCII_WORD = re.compile(r"[a-z0-9]+")
LONGEST_NAME = 60
ROWS = "id bigint, words binary, record binary"
#: hash functions of the filters: the two halves of a canonical hash
HASHES = 2


def record_key(text: str) -> str | None:
    """Canonical text of a record of at least two named fields, with one value each, or None."""
    parts = [p for p in SPLIT.split(text) if p.strip()]
    if len(parts) < 2:
        return None
    out = []
    for p in parts:
        m = SIGN.search(p)
        if not m or m.start() > LONGEST_NAME + len(p) - len(p.lstrip()):
            return None
        name, value = (" ".join(WORD.findall(x.lower())) for x in (p[: m.start()], p[m.end() :]))
        if not name or len(name.split()) > 4:
            return None
        out.append(f"{name}\x01{value}")
    names = [p.split("\x01")[0] for p in out]
    return "\x02".join(sorted(out)) if len(set(names)) == len(names) else None


def _digest(kind: bytes, text: str) -> bytes:
    return blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16, person=kind).digest()


def _canonical(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            words, records = [], []
            for t in texts:
                lower = t.lower()
                w = " ".join((WORD if not lower.isascii() else ASCII_WORD).findall(lower))
                key = record_key(t) if w else None
                words.append(_digest(b"words", w) if w else None)
                records.append(_digest(b"record", key) if key else None)
            part = np.concatenate([_part(texts[i:j], parts) for i, j in blocks(texts)]) if texts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words, pa.binary()), pa.array(records, pa.binary()), pa.array(part, pa.int32())], ["id", "words", "record", "part"])

    return run


def _part(texts: list, parts: int) -> np.ndarray:
    """Part of each text by the sum of its words' hashes, which layout and the order of fields leave as it is."""
    if parts == 1:
        return np.zeros(len(texts), np.int64)
    h, off = word_hashes(texts)
    total = np.append(U(0), np.cumsum(mix(h)))
    return (mix(total[off[1:]] - total[off[:-1]]) % U(parts)).astype(np.int64)


def _bits(column: pa.Array, size: int) -> np.ndarray:
    """The places of each canonical hash in the filters, a column for each hash function."""
    return (np.frombuffer(b"".join(column.to_pylist()), U).reshape(-1, HASHES) % U(size)).astype(np.int64)


def _possible_repeats(keyed: DataFrame, size: int) -> DataFrame:
    """``keyed`` with ``maybe``: whether all bits of the row's words or of its record have been seen more than once."""

    def fold(table: np.ndarray, b: pa.RecordBatch) -> None:
        once, more = table[: size // 8], table[size // 8 :]
        # a record is looked up by its fields as well as by its words
        for c in (1, 2):
            col = b.column(c).drop_null() if b.column(c).null_count else b.column(c)
            for k in range(HASHES if len(col) else 0):
                at = np.sort(_bits(col, size)[:, k])
                set_bits(more, at[1:][at[1:] == at[:-1]])
                at = at[np.append(True, at[1:] != at[:-1])]
                set_bits(more, at[get_bits(once, at)])
                set_bits(once, at)

    filters = spread(keyed, merged_table(keyed, size // 8, "uint8", fold, "twice", 2)[1])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated = lambda col: get_bits(filters.value, _bits(col, size)).all(1)
        for b in batches:
            maybe = repeated(b.column(1)) if b.num_rows else np.zeros(0, bool)
            some = np.flatnonzero(np.array([x is not None for x in b.column(2).to_pylist()], bool))
            if len(some):
                maybe[some] |= repeated(b.column(2).take(pa.array(some)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(maybe)], ["id", "words", "record", "maybe"])

    return keyed.mapInArrow(mark, ROWS + ", maybe boolean")


def layout_copies(docs: DataFrame, id_col: str = "file_id", text_col: str = "normalized_text", bits_per_row: int = 16, most_bits: int = 1 << 28) -> DataFrame:
    """``(first, id, copies)`` of every row with a text: the smallest id of its group and the group's number of rows.

    The filters take ``bits_per_row`` bits a row, rounded up to a power of two, at most ``most_bits`` (32 MB), the proven bound of what
    is broadcast; more rows are more parts, handled one after the other. Rows with a null id or text, or a text
    without letters and digits, are left out. Repeated rows of one id count once. A record and a plain text with the same words in
    the same order belong together. Empty input gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).where("id is not null and text is not null")
    total = docs.count()
    parts = max(1, -(-total * bits_per_row // most_bits))
    size = 1 << max(13, (max(1, -(-total // parts)) * bits_per_row - 1).bit_length())
    keyed = materialize(rows.mapInArrow(_canonical(parts), ROWS + ", part int").where("words is not null"), "part" if parts > 1 else None)
    out = None
    for p in range(parts):
        one = _copies_of_part((keyed.where(F.col("part") == p) if parts > 1 else keyed).select("id", "words", "record"), size, total)
        out = one if out is None else out.unionByName(one)
    return out


def _copies_of_part(keyed: DataFrame, size: int, total: int) -> DataFrame:
    marked = materialize(_possible_repeats(keyed, size))
    alone = marked.where("not maybe").select(F.col("id").alias("first"), "id", F.lit(1).cast("bigint").alias("copies")).distinct()
    several = marked.where("maybe").dropDuplicates(["id"])
    # records and plain texts with the same words are tied over the word hash; the record hash leads where there is one
    ties = several.where("record is not null").select("words", "record").distinct()
    plain = several.where("record is null").select("words").distinct()
    ends = materialize(ties.select(F.col("words").alias("src"), F.col("record").alias("dst")))
    shared = ends.groupBy("src").agg(F.count(F.lit(1)).alias("n"), F.min("dst").alias("dst"))
    crossing = ends.join(shared.where("n > 1").select("src"), "src").select("src", "dst")
    roots = connected_components(crossing).select(F.col("node").alias("key"), "component")
    lead = shared.select(F.col("src").alias("words"), F.col("dst").alias("lead"))
    led = plain.join(lead, "words")
    keys = several.join(led, "words", "left").select("id", F.coalesce("record", "lead", "words").alias("key")).join(roots, "key", "left").select("id", F.coalesce("component", "key").alias("key"))
    keys = materialize(keys)
    grouped = attach_group(keys, ["key"], {"first": F.min("id"), "copies": F.count(F.lit(1))}, total)
    return alone.unionByName(grouped.select("first", "id", "copies"))
