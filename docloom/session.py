"""Session settings for batch work on a cluster."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def session(name: str = "docloom", master: str | None = None, **more: str) -> SparkSession:
    b = SparkSession.builder.appName(name).config(map=SETTINGS | more)
    return (b.master(master) if master else b).getOrCreate()
