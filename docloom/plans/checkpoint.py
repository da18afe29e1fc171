"""Resumable progress of a run: finished documents and their chunks, bound to one configuration signature."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import paths as P

DONE = "path string, hash string"


class Checkpoint:
    """Parquet appends below ``root/signature``; another signature is another folder, so a changed configuration starts anew.

    Spark's commit protocol makes an append visible whole or not at all. A chunk whose document row is missing (a run broke between the
    two appends), or the reverse, is ignored on resume: both sides are semi-joined.
    """

    def __init__(self, spark: SparkSession, root: str, signature: str) -> None:
        self.spark, self.path = spark, f"{root.rstrip('/')}/{signature}"

    def _exists(self, name: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}/_SUCCESS")
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def append(self, docs: DataFrame, chunks: DataFrame) -> None:
        """Record finished ``docs`` (path, hash) and their ``chunks`` (source_path, ...); chunks first."""
        chunks.write.mode("append").parquet(f"{self.path}/chunks")
        docs.select("path", "hash").write.mode("append").parquet(f"{self.path}/docs")

    def done(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/docs") if self._exists("docs") else self.spark.createDataFrame([], DONE)

    def resume(self, current: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """Rows of ``current`` (path, hash, ...) still to do, and the chunks to replay (None if there are none)."""
        key = lambda df: df.select(P.norm_path(F.col("path")).alias("_p"), F.lower("hash").alias("_h")).distinct()
        if not (self._exists("docs") and self._exists("chunks")):
            return current, None
        chunks = self.spark.read.parquet(f"{self.path}/chunks")
        with_chunks = chunks.select(P.norm_path(F.col("source_path")).alias("_p")).distinct()
        good = key(self.done()).join(key(current), ["_p", "_h"], "left_semi").join(with_chunks, "_p", "left_semi")
        rows = current.withColumn("_p", P.norm_path(F.col("path"))).withColumn("_h", F.lower("hash"))
        todo = rows.join(good, ["_p", "_h"], "left_anti").drop("_p", "_h")
        replay = chunks.withColumn("_p", P.norm_path(F.col("source_path"))).join(good.select("_p").distinct(), "_p", "left_semi").drop("_p")
        return todo, replay

    def clear(self) -> None:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)
