"""Lineage cuts, package shipping and group attachment that survive lost executors and hot keys."""

from __future__ import annotations

import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"
HOT_SHARE = 1000
#: paths of the tables of this application that are not discarded yet
_MADE: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``; a folder of our own only where it is unset."""
    have = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if not have:
        if not is_local(spark):
            raise RuntimeError(f"{CHECKPOINT_CONF} names no folder that all executors share")
        have = "file://" + tempfile.mkdtemp(prefix="docloom-shared-")
        spark.conf.set(CHECKPOINT_CONF, have)
    return have.rstrip("/")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that workers can import it."""
    sc = spark.sparkContext
    if getattr(sc, "_docloom_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="docloom-zip-")) / "docloom.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, str(Path(root.name) / p.relative_to(root)))
    sc.addPyFile(str(target))
    sc._docloom_shipped = True


def materialize(df: DataFrame, by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder, in folders by column ``by`` if given, and read it back: cuts the lineage, survives the loss of executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/docloom-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(by) if by else writer).parquet(path)
    _MADE.add(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._docloom_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a table of :func:`materialize` that nothing reads any more."""
    path = getattr(df, "_docloom_path", None)
    if path is not None:
        _delete(df.sparkSession, path)


def discard_all(spark: SparkSession) -> int:
    """Delete every table that this application has materialized, once its results are written elsewhere; returns their number."""
    paths = sorted(_MADE)
    for path in paths:
        _delete(spark, path)
    return len(paths)


def _delete(spark: SparkSession, path: str) -> None:
    _MADE.discard(path)
    if path.startswith(("file:", "/")):
        shutil.rmtree(path.removeprefix("file://").removeprefix("file:"), ignore_errors=True)
        return
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def attach_group(rows: DataFrame, keys: list[str], aggs: dict[str, Column], n_rows: int) -> DataFrame:
    """Add group aggregates to every row without moving a hot group to one task.

    Groups with more than ``n_rows / HOT_SHARE`` rows number fewer than ``HOT_SHARE``, so their totals are
    broadcast (proven bound); all other rows join the totals by shuffle. Rows with a null key keep null
    aggregates. The totals themselves are pre-aggregated on the map side.
    """
    totals = materialize(rows.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *(c.alias(k) for k, c in aggs.items())))
    hot = totals.where(F.col("_n") > max(1, n_rows // HOT_SHARE))
    marked = rows.join(F.broadcast(hot.select(*keys, F.lit(True).alias("_hot"), *(F.col(a).alias(f"_h_{a}") for a in aggs))), keys, "left")
    hot_rows = marked.where("_hot").select(*rows.columns, *(F.col(f"_h_{a}").alias(a) for a in aggs))
    cold = marked.where("_hot is null").select(*rows.columns)
    return hot_rows.unionByName(cold.join(totals.drop("_n"), keys, "left").select(*rows.columns, *aggs))


def widen(df: DataFrame) -> DataFrame:
    """``df`` in at least as many partitions as there are cores, for costly narrow stages over inputs of few splits.

    Inputs with enough splits, the rule at scale, are left as they are, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local"
