"""Nightly delta: classification against a state or a mirror, deletions, canaries, gates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import paths as P
from .exact_dedup import same_stamp


def delta_scan(files: DataFrame, state: DataFrame) -> DataFrame:
    """``files`` (path, mtime, size) with ``delta_kind``: unchanged (mirrored), resumed, new or changed."""
    s = state.select(P.norm_path(F.col("path")).alias("_p"), F.col("mtime").alias("_m"), F.col("size").alias("_z"), F.col("status").alias("_s"))
    j = files.withColumn("_p", P.norm_path(F.col("path"))).join(s, "_p", "left")
    stamp = F.coalesce(same_stamp(F.col("mtime"), F.col("size"), F.col("_m"), F.col("_z")), F.lit(False))
    kind = F.when(F.col("_s").isNull(), "new").when(stamp & (F.col("_s") == "mirrored"), "unchanged").when(stamp, "resumed").otherwise("changed")
    return j.select(*files.columns, kind.alias("delta_kind"))


def deleted(files: DataFrame, state: DataFrame, root: str, complete: bool = True) -> DataFrame:
    """Tracked paths below ``root`` that the scan didn't meet; unknown (null paths, no rows) unless the scan was complete."""
    tracked = state.select(P.norm_path(F.col("path")).alias("path")).where(F.startswith("path", F.lit(root.replace("\\", "/").rstrip("/") + "/"))).distinct()
    out = tracked.join(files.select(P.norm_path(F.col("path")).alias("path")), "path", "left_anti")
    return out if complete else out.where(F.lit(False))


def mirror_delta(source: DataFrame, mirror: DataFrame) -> DataFrame:
    """``rel, kind, reason`` by comparing (rel, size, hash): new, changed by size, changed by hash, same."""
    m = mirror.select("rel", F.col("size").alias("_z"), F.lower("hash").alias("_h"))
    j = source.join(m, "rel", "left")
    kind = F.when(F.col("_z").isNull(), "new").when(F.col("size") != F.col("_z"), "changed").when(F.lower("hash") != F.col("_h"), "changed").otherwise("same")
    reason = F.when(F.col("_z").isNotNull() & (F.col("size") != F.col("_z")), "size").when(kind == "changed", "hash")
    return j.select("rel", kind.alias("kind"), reason.alias("reason"))


def delta_summary(scanned: DataFrame) -> DataFrame:
    k = F.col("delta_kind")
    n = lambda x: F.count_if(k == x)
    return scanned.agg(F.count(F.lit(1)).alias("total_files"), n("new").alias("new_files"), n("changed").alias("changed_files"), n("resumed").alias("resumed_files"), n("unchanged").alias("unchanged_files"), F.count_if(k != "unchanged").alias("delta_files"))


def canary_gate(scanned: DataFrame, globs: list[str], required: bool = True) -> DataFrame:
    hit = P.matches_globs(F.col("path"), globs)
    return scanned.agg(F.count_if(hit & (F.col("delta_kind") != "unchanged")).alias("canaries")).withColumn("gate", F.when(F.lit(not required) | (F.col("canaries") > 0), "PASS").otherwise("FAIL"))


def ingest_status(delta_files, canary_ok, transfer_failed, pipeline_failed):
    """Status of a nightly run, the weightiest condition first."""
    return F.when(delta_files == 0, "no_delta").when(~canary_ok, "failed_no_canary").when(transfer_failed > 0, "transfer_partial").when(pipeline_failed, "pipeline_failed").otherwise("success")


def resume_plan(current: DataFrame, done: DataFrame) -> DataFrame:
    """Current files (path, hash) still to do: those whose (path, hash) a checkpoint doesn't hold."""
    key = lambda df: df.withColumn("_p", P.norm_path(F.col("path"))).withColumn("_h", F.lower("hash"))
    return key(current).join(key(done).select("_p", "_h").distinct(), ["_p", "_h"], "left_anti").drop("_p", "_h")
