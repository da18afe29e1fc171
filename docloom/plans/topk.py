"""Bounded top-k per group without collecting a group, and global ordinals without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import materialize


def first_k(rows: DataFrame, keys: list[str], order: str, k: int, salts: int = 32) -> DataFrame:
    """The ``k`` smallest distinct values of ``order`` per group; groups are cut into salted parts first, so a hot group is spread."""
    d = rows.select(*keys, order).distinct().withColumn("_salt", F.pmod(F.xxhash64(order), F.lit(salts)))
    part = d.withColumn("_r", F.row_number().over(W.partitionBy(*keys, "_salt").orderBy(order))).where(F.col("_r") <= k)
    return part.withColumn("_r", F.row_number().over(W.partitionBy(*keys).orderBy(order))).where(F.col("_r") <= k).drop("_r", "_salt")


def with_ordinal(rows: DataFrame, *order: str, name: str = "ordinal") -> DataFrame:
    """Global row number by ``order``: a range-partitioned sort, counts per partition, and offsets added to local numbers.

    Only one number per partition reaches the driver.
    """
    marked = materialize(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id()))
    sizes = sorted((r["_pid"], r["n"], r["low"]) for r in marked.groupBy("_pid").agg(F.count(F.lit(1)).alias("n"), F.min("_mid").alias("low")).collect())
    offsets, total = [], 0
    for pid, n, low in sizes:
        offsets.append((pid, total - low))
        total += n
    table = rows.sparkSession.createDataFrame(offsets, "_pid int, _off bigint")
    return marked.join(F.broadcast(table), "_pid").withColumn(name, F.col("_mid") + F.col("_off") + 1).drop("_pid", "_mid", "_off")
