"""File scans, input lists, JSONL and vector sources."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import paths as P
from ..plans.shared import ship_package
from ..plans.topk import with_ordinal


def empty_files(spark: SparkSession, root: str) -> DataFrame:
    """``path, size, mtime`` of files without bytes, which file sources leave out; the listing streams through the driver and only these are kept."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    it = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
    rows = []
    while it.hasNext():
        f = it.next()
        if f.getLen() == 0:
            rows.append((f.getPath().toString(), 0, f.getModificationTime() / 1000))
    return spark.createDataFrame(rows, "path string, size bigint, mtime double")


def scan(spark: SparkSession, root: str, exts: list[str] | None = None, content: bool = False, max_files: int | None = None, with_empty: bool = True) -> DataFrame:
    """``ordinal, path, size, mtime[, content]`` of a folder tree in path order. Without ``content`` no file is opened.

    ``max_files`` keeps the first files in path order (the feature of a capped scan).
    """
    d = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    cols = [F.col("path"), F.col("length").alias("size"), (F.unix_micros("modificationTime") / 1e6).alias("mtime")]
    d = d.select(*cols, *(["content"] if content else []))
    if with_empty:
        none = empty_files(spark, root)
        d = d.unionByName(none.withColumn("content", F.lit(b"")) if content else none)
    if exts:
        d = d.where(P.ext(F.col("path")).isin(*exts))
    if max_files is not None:
        d = d.orderBy("path").limit(max_files)
    if content:
        # numbers are made from the narrow listing, so that the bytes are never sorted or written
        return d.join(with_ordinal(d.select("path"), "path"), "path").select("ordinal", *d.columns)
    return with_ordinal(d, "path")


def with_hash(files: DataFrame) -> DataFrame:
    return files.withColumn("hash", F.sha2("content", 256))


def open_file(path: str):
    """Binary stream of a file by its path or URI: local files, and whatever file systems pyarrow knows."""
    if "://" not in path and not path.startswith("file:"):
        return open(path, "rb")
    from urllib.parse import unquote, urlparse

    if path.startswith("file:"):
        return open(unquote(urlparse(path).path), "rb")
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_stream(inner)


def spread_files(files: DataFrame, bytes_a_task: int = 64 << 20, least: int | None = None) -> DataFrame:
    """``files`` (path, size, ...) over as many tasks as their bytes ask for; only the narrow rows move."""
    spark = files.sparkSession
    total = files.agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).first()
    tasks = max(least or spark.sparkContext.defaultParallelism, (total["b"] or 0) // bytes_a_task + 1)
    return files.repartition(int(min(tasks, max(1, total["n"]))), F.xxhash64("path"))


def read_facts(files: DataFrame, head: int = 4096) -> DataFrame:
    """All columns of ``files`` with ``hash`` (SHA-256 of the bytes) and ``header`` (their first ``head``).

    The bytes are streamed within the task that needs them and never become a column. A file that can't be read has null in both.
    """
    ship_package(files.sparkSession)
    keep = files.columns
    at = keep.index("path")

    def one(path: str | None) -> tuple[str | None, bytes | None]:
        try:
            digest = hashlib.sha256()
            with open_file(path) as f:
                first = f.read(head)
                part = first
                while part:
                    digest.update(part)
                    part = f.read(1 << 20)
            return digest.hexdigest(), first
        except (OSError, TypeError, ValueError):
            return None, None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [one(x) for x in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())], [*keep, "hash", "header"])

    return spread_files(files).mapInArrow(run, T.StructType([*files.schema.fields, T.StructField("hash", T.StringType()), T.StructField("header", T.BinaryType())]))


def input_list(spark: SparkSession, path: str, listing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Listed files that exist, in order and once without letter case, and counts of the missing by extension."""
    lines = spark.read.text(path).select(F.trim("value").alias("value")).where((F.col("value") != "") & ~F.startswith("value", F.lit("#")))
    wanted = lines.select(P.norm_path(F.col("value")).alias("path"), F.monotonically_increasing_id().alias("_i")).groupBy(F.lower("path").alias("_key")).agg(F.min_by("path", "_i").alias("path"), F.min("_i").alias("_i"))
    have = listing.select(F.lower(P.norm_path(F.regexp_replace("path", r"^file:/+", "/"))).alias("_key"), F.lit(True).alias("_have")).distinct()
    j = wanted.join(have, "_key", "left")
    missing = j.where("_have is null").groupBy(P.ext_or(F.col("path"), "<none>").alias("ext")).agg(F.count(F.lit(1)).alias("missing"))
    return j.where("_have").orderBy("_i").select("path"), missing


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str, keep_corrupt: bool = False) -> DataFrame:
    """JSON lines; blank lines vanish, corrupt ones are dropped, or kept in ``_corrupt`` for counting."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    full = T.StructType([*kind.fields, T.StructField("_corrupt", T.StringType())])
    rows = lines.select(F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("r")).select("r.*")
    return rows if keep_corrupt else rows.where("_corrupt is null").drop("_corrupt")


def count_lines(spark: SparkSession, path: str) -> int:
    """Lines of text files, an unterminated last line included."""
    return spark.read.text(path).count()


def newest_export(root: str, pointer: str = "latest") -> Path | None:
    """Folder that ``latest`` points to (link or redirect file), else the newest ``export_*`` by name."""
    base = Path(root)
    p = base / pointer
    if p.is_dir():
        return p.resolve()
    if p.is_file() and (base / p.read_text("utf-8").strip()).is_dir():
        return (base / p.read_text("utf-8").strip()).resolve()
    return max((d for d in base.glob("export_*") if d.is_dir()), key=lambda d: d.name, default=None)


def register_npy(spark: SparkSession) -> None:
    """Register the ``npy`` data source: rows of two-dimensional arrays, in ranges that executors map into memory."""
    from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

    class Range(InputPartition):
        def __init__(self, path: str, start: int, end: int) -> None:
            self.path, self.start, self.end = path, start, end

    class Reader(DataSourceReader):
        def __init__(self, options: dict) -> None:
            self.path, self.rows = options["path"], int(options.get("rowsperpartition", 100_000))

        def partitions(self):
            n = np.load(self.path, mmap_mode="r").shape[0]
            return [Range(self.path, a, min(n, a + self.rows)) for a in range(0, n, self.rows)] or [Range(self.path, 0, 0)]

        def read(self, partition):
            m = np.load(partition.path, mmap_mode="r")
            for i in range(partition.start, partition.end):
                yield i, m[i].astype(np.float32).tolist()

    class Npy(DataSource):
        @classmethod
        def name(cls) -> str:
            return "npy"

        def schema(self) -> str:
            return "row bigint, vector array<float>"

        def reader(self, schema):
            return Reader(self.options)

    spark.dataSource.register(Npy)
