"""Analytics over exported chunks and failure logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import paths as P
from ..plans.topk import first_k

#: fixed values: document families by what their paths hold
FAMILIES = {
    "travel_admin": ("itinerary", "travel approval", "receipts", "packing list"),
    "inventory_manifest": ("inventory", "manifest"),
    "image_photo": ("photo", "image", "picture"),
    "logs": ("desktop_log", "desktop log", "/logs/"),
    "archive_derived": ("/archive/", "specialfiles"),
    "drawing_diagram": ("drawing", "diagram"),
    "calibration_cert": ("calibration", "certificate", "cert of", "certification"),
}
#: fixed values: folders of interest
SPECIAL_DIRS = ("packing list", "site inventory", "pictures", "photos", "itinerary", "archive", "receipts", "drawings", "images")


def families(path: Column) -> Column:
    p = F.lower(P.norm_path(path))
    hit = lambda words: F.array_max(F.array(*(F.contains(p, F.lit(w)) for w in words)))
    return F.array_compact(F.array(*(F.when(hit(words), name) for name, words in FAMILIES.items())))


def family_counts(chunks: DataFrame, examples: int = 5) -> DataFrame:
    """Distinct documents, chunks and the first example paths per family."""
    rows = chunks.select("source_path", "chunks", F.explode(families(F.col("source_path"))).alias("family"))
    ex = first_k(rows, ["family"], "source_path", examples).groupBy("family").agg(F.array_join(F.array_sort(F.collect_list("source_path")), "|").alias("examples"))
    return rows.groupBy("family").agg(F.count_distinct("source_path").alias("documents"), F.sum("chunks").alias("chunks")).join(ex, "family")


def special_dirs(paths: DataFrame) -> DataFrame:
    d = paths.select(F.explode(F.transform(P.parts(F.col("source_path")), lambda x: F.lower(x))).alias("directory"))
    return d.where(F.col("directory").isin(*SPECIAL_DIRS)).groupBy("directory").agg(F.count(F.lit(1)).alias("hits"))


def reused_basenames(paths: DataFrame, top: int = 25, shown: int = 5) -> DataFrame:
    """Basenames at more than one path, most frequent first (ties by name)."""
    d = paths.select(F.lower(P.basename(F.col("source_path"))).alias("name"), "source_path").where("name <> ''").distinct()
    n = d.groupBy("name").agg(F.count(F.lit(1)).alias("paths")).where("paths > 1").orderBy(F.desc("paths"), "name").limit(top)
    ex = first_k(d.join(F.broadcast(n.select("name")), "name"), ["name"], "source_path", shown).groupBy("name").agg(F.array_join(F.array_sort(F.collect_list("source_path")), "|").alias("examples"))
    return n.join(ex, "name")


def chunk_stats(chunks: DataFrame, top: int = 15) -> DataFrame:
    """Per extension: chunks, documents, characters, mean length and chunks a document."""
    g = chunks.groupBy("ext").agg(F.count(F.lit(1)).alias("chunks"), F.count_distinct("doc").alias("documents"), F.sum("text_length").alias("characters"))
    return g.select("ext", "chunks", "documents", "characters", F.round(F.col("characters") / F.col("chunks"), 1).alias("mean_length"), F.round(F.col("chunks") / F.col("documents"), 1).alias("chunks_per_doc")).orderBy(F.desc("chunks"), "ext").limit(top)


def failure_lines(log: DataFrame) -> DataFrame:
    """Failure-log lines ``[ext] cause: name`` as ``ext, cause, name``; header lines and others are dropped."""
    rx = r"^\[\.?([^\]]+)\]\s*([^:]+):\s*(.*)$"
    e = lambda g: F.regexp_extract("value", rx, g)
    return log.select(F.lower(e(1)).alias("ext"), e(2).alias("cause"), e(3).alias("name")).where("ext <> ''")


def failure_headers(log: DataFrame) -> DataFrame:
    """``### .ext (N files)`` headers as ``ext, files``."""
    rx = r"^###\s+\.?(\S+)\s+\((\d+) files?\)"
    return log.select(F.lower(F.regexp_extract("value", rx, 1)).alias("ext"), F.regexp_extract("value", rx, 2).alias("n")).where("ext <> ''").select("ext", F.col("n").cast("bigint").alias("files"))


def failure_causes(logs: DataFrame, value: str = "value") -> DataFrame:
    """``ext, files, cause`` of the sections of whole failure logs: a header ``### .ext (N files)`` and the ``Likely cause:`` line below it, if any."""
    sections = logs.select(F.explode(F.split(F.regexp_replace(value, r"\r\n?", "\n"), r"\n(?=### )")).alias("s"))
    e = lambda rx: F.regexp_extract("s", rx, 1)
    head = sections.select(F.lower(e(r"^###\s+\.?(\S+)\s+\(\d+ files?\)")).alias("ext"), e(r"^###\s+\S+\s+\((\d+) files?\)").alias("n"), e(r"(?m)^Likely cause:[ \t]*(.*)$").alias("cause"))
    return head.where("ext <> ''").select("ext", F.col("n").cast("bigint").alias("files"), F.nullif(F.trim("cause"), F.lit("")).alias("cause"))
