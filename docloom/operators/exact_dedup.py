"""Exact deduplication and incremental classification against a state table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import paths as P
from ..plans.shared import materialize

TOLERANCE_S = 2.0


def same_stamp(m1: Column, s1: Column, m2: Column, s2: Column, tolerance: float = TOLERANCE_S) -> Column:
    """Equal sizes and mtimes within the tolerance."""
    return (s1 == s2) & (F.abs(m1 - m2) < tolerance)


def latest_state(state: DataFrame, key: str = "file_id", at: str = "recorded_at") -> DataFrame:
    """The latest row of each key; among equal times the greatest (status, path, hash, mtime, size)."""
    rest = [c for c in state.columns if c not in (key, at)]
    order = ["status", *(c for c in rest if c != "status")] if "status" in rest else rest
    return state.groupBy(key).agg(F.max(F.struct(F.col(at), *order)).alias("_s")).select(key, "_s.*").select(*state.columns)


def first_by_hash(files: DataFrame, hash_col: str = "hash", order: str = "ordinal") -> DataFrame:
    """``files`` with ``first``: whether the row is the first of its content. Rows without a hash are all first.

    The minimum is pre-aggregated, so a content that a third of the rows share needs no window in one task.
    """
    first = files.where(F.col(hash_col).isNotNull()).groupBy(hash_col).agg(F.min(order).alias("_first"))
    return files.join(first, hash_col, "left").withColumn("first", F.col(hash_col).isNull() | (F.col(order) == F.col("_first"))).drop("_first")


def suffix_copies(files: DataFrame) -> DataFrame:
    """Files ``Name_N.ext`` whose content equals ``Name.ext`` in the same folder: ``path, original``."""
    maybe = files.where(F.col("hash").isNotNull() & F.rlike("path", F.lit(r"_\d+\.[^./\\]*$|_\d+$")))
    named = maybe.select("path", "hash", P.suffix_copy_of(F.col("path")).alias("original")).where("original is not null")
    there = files.select(P.norm_path(F.col("path")).alias("original"), F.col("hash").alias("_hash")).distinct()
    return named.join(there, "original").where(F.lower("hash") == F.lower("_hash")).select("path", "original").distinct()


def classify(files: DataFrame, state: DataFrame, against_state: bool = False) -> DataFrame:
    """``ordinal, path, hash, decision`` with decision unchanged, duplicate or work.

    ``files`` (ordinal, path, hash, mtime, size) are compared with ``state`` (path, hash, mtime, size, status) in this order: equal stamp and
    indexed -> unchanged, equal stamp and duplicate -> duplicate, indexed with equal hash -> unchanged, suffix copy -> duplicate,
    content seen in an earlier remaining row -> duplicate, else work. Only with ``against_state`` is content that is already indexed
    elsewhere a duplicate too.
    """
    s = state.select(P.norm_path(F.col("path")).alias("_p"), F.col("hash").alias("_h"), F.col("mtime").alias("_m"), F.col("size").alias("_z"), F.col("status").alias("_s"))
    f = files.withColumn("_p", P.norm_path(F.col("path")))
    j = f.join(s, "_p", "left")
    stamp = F.coalesce(same_stamp(F.col("mtime"), F.col("size"), F.col("_m"), F.col("_z")), F.lit(False))
    j = j.withColumn("hash", F.coalesce(F.when(stamp, F.col("_h")), F.col("hash")))
    early = F.when(stamp & (F.col("_s") == "indexed"), "unchanged").when(stamp & (F.col("_s") == "duplicate"), "duplicate").when((F.col("_s") == "indexed") & (F.lower("_h") == F.lower("hash")), "unchanged")
    j = materialize(j.select("ordinal", "path", "_p", "hash", early.alias("early")))
    copies = suffix_copies(j.select(F.col("_p").alias("path"), "hash")).select(F.col("path").alias("_p"), F.lit(True).alias("copy"))
    j = j.join(copies, "_p", "left").withColumn("early", F.coalesce("early", F.when(F.col("copy"), "duplicate")))
    rest = first_by_hash(j.where("early is null"))
    if against_state:
        known = state.where("status = 'indexed' and hash is not null").select(F.col("hash"), F.lit(True).alias("_known")).distinct()
        rest = rest.join(known, "hash", "left").withColumn("first", F.col("first") & F.col("_known").isNull())
    rest = rest.select("ordinal", "path", "hash", F.when(F.col("first"), "work").otherwise("duplicate").alias("decision"))
    return j.where("early is not null").select("ordinal", "path", "hash", F.col("early").alias("decision")).unionByName(rest)


def upsert_state(state: DataFrame, changes: DataFrame, key: str = "path") -> DataFrame:
    """Snapshot with the rows of ``changes`` in place of those with the same key."""
    return state.join(changes.select(key), key, "left_anti").unionByName(changes.select(*state.columns))


def canonical_snapshot(files: DataFrame, state: DataFrame) -> DataFrame:
    """Scanned files that the state doesn't hold as duplicates."""
    dup = state.where("status = 'duplicate'").select(P.norm_path(F.col("path")).alias("_p")).distinct()
    return files.withColumn("_p", P.norm_path(F.col("path"))).join(dup, "_p", "left_anti").drop("_p")
