"""One surviving record per duplicate group (problem 5): ranked survivor and iterative truth discovery field by field.

Files are tied by path: a file's own path and its canonical path are nodes, so chains and stars of any size are components of a
graph whose edges are the distinct (path, canonical path) pairs. The field values of the surviving record come from truth
discovery: source reliabilities and weighted votes for (group, field, value) are estimated in turn until the
reliabilities settle. Which file survives is a fixed preference (quality, format, size, id), because weighted votes cannot
state it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.components import connected_components
from ..plans.shared import discard, materialize

FIELDS = ("ext", "stem_key", "parse_quality", "raw_chars", "normalized_chars", "normalized_hash")
#: fixed values: order of formats
EXT_ORDER = ("docx", "doc", "pdf")


def path_key(col: str) -> Column:
    """Paths are the same if they differ only in kind or doubling of slashes, letter case or outer blanks."""
    p = F.regexp_replace(F.lower(F.regexp_replace(F.col(col), r"^\s+|\s+$", "")), r"[\\/]+", "/")
    return F.when(F.length(p) > 0, p)


def clean_ext(col: str) -> Column:
    return F.lower(F.regexp_replace(F.col(col), r"^[\s.]+|[\s.]+$", ""))


def valid_quality(col: str) -> Column:
    q = F.col(col).cast("double")
    return F.when(~F.isnan(q) & q.between(0.0, 1.0), q)


def latest_decisions(dedup: DataFrame) -> DataFrame:
    """The latest row of each file by decided_at; among equal times the greatest (canonical_path, status, quality, chars) wins.

    Rows without a file id are ignored; a null time ranks before every other.
    """
    d = dedup.where("file_id is not null").select(
        "file_id", "path", "canonical_path", "status", "decided_at", valid_quality("parse_quality").alias("parse_quality"), clean_ext("ext").alias("ext"),
        F.when(F.col("raw_chars") >= 0, F.col("raw_chars").cast("bigint")).alias("raw_chars"), F.when(F.col("normalized_chars") >= 0, F.col("normalized_chars").cast("bigint")).alias("normalized_chars"),
        "normalized_hash", "stem_key",
    )
    order = F.struct("decided_at", "canonical_path", "status", "parse_quality", "raw_chars", "path", "ext", "normalized_hash", "stem_key", "normalized_chars")
    return d.groupBy("file_id").agg(F.max(order).alias("s")).select("file_id", "s.*")


def tie_by_path(latest: DataFrame) -> DataFrame:
    """``latest`` with ``root``: the component of the paths a file is tied by; files tied to nothing get none and are left out."""
    node = lambda c: F.unhex(F.md5(F.col(c).cast("binary")))
    rows = materialize(latest.withColumn("_p", path_key("path")).withColumn("_c", path_key("canonical_path")).withColumn("_pn", node("_p")).withColumn("_cn", node("_c")).drop("_p", "_c"))
    meant = rows.where("_cn is not null").select(F.col("_cn").alias("_pn"), F.lit(True).alias("_meant")).distinct()
    rows = rows.join(meant, "_pn", "left").withColumn("_a", F.coalesce("_cn", F.when(F.col("_meant"), F.col("_pn"))))
    edges = rows.where("_cn is not null and _meant and _pn <> _cn").select(F.col("_pn").alias("src"), F.col("_cn").alias("dst")).distinct()
    comps = connected_components(edges).select(F.col("node").alias("_a"), F.col("component").alias("_root"))
    return rows.where("_a is not null").join(comps, "_a", "left").withColumn("root", F.coalesce("_root", "_a")).drop("_pn", "_cn", "_a", "_root", "_meant")


def claims_of(members: DataFrame) -> DataFrame:
    """(group_id, field, value, source, newest, votes): what each source says about each field, pre-aggregated."""
    source = F.concat_ws("/", F.slice(F.split(F.regexp_replace(F.lower(F.col("path")), r"[\\/]+", "/"), "/"), 1, 3))
    value = lambda f: F.col(f).cast("string")
    kinds = F.array(*(F.struct(F.lit(f).alias("field"), value(f).alias("value")) for f in FIELDS))
    c = members.select("group_id", "decided_at", F.coalesce(source, F.lit("")).alias("source"), F.explode(kinds).alias("c")).select("group_id", "decided_at", "source", "c.*").where("value is not null and value <> ''")
    return c.groupBy("group_id", "field", "value", "source").agg(F.count(F.lit(1)).alias("votes"), F.max("decided_at").alias("newest"))


def discover_truth(claims: DataFrame, rounds: int = 10, settled: float = 1e-3) -> tuple[DataFrame, DataFrame]:
    """Best value per (group_id, field), and the sources with their reliability.

    A value's support is the sum of its sources' weights log(r / (1 - r)) times their votes; a source's reliability ``r`` is the mean
    share of support of what it claims (smoothed towards 0.8 by two claims). Ties go to the newest claim, then to the greatest value.
    """
    claims = materialize(claims)
    # the rounds carry 64-bit keys only; a collision would blur a mean over all claims, never a chosen value
    keyed = materialize(claims.select(F.xxhash64("group_id", "field").alias("g"), F.xxhash64("value").alias("v"), "source", "votes").groupBy("g", "v", F.xxhash64("source").alias("s")).agg(F.sum("votes").alias("votes")))
    sources = materialize(keyed.groupBy("s").agg(F.sum("votes").alias("n")).withColumn("r", F.lit(0.8).cast("double")))
    trust = F.greatest(F.log(F.col("r") / (1 - F.col("r"))), F.lit(0.05))
    for _ in range(rounds):
        support = keyed.join(sources.select("s", trust.alias("w")), "s").groupBy("g", "v").agg(F.sum(F.col("w") * F.col("votes")).alias("u"))
        whole = support.groupBy("g").agg(F.sum("u").alias("whole"))
        share = support.join(whole, "g").select("g", "v", (F.col("u") / F.col("whole")).alias("share"))
        rated = keyed.join(share, ["g", "v"]).groupBy("s").agg(F.sum(F.col("share") * F.col("votes")).alias("good"))
        nxt = materialize(sources.join(rated, "s").select("s", "n", F.least(F.lit(0.99), F.greatest(F.lit(0.51), (F.col("good") + 1.6) / (F.col("n") + 2))).alias("r"), F.col("r").alias("old")))
        moved = nxt.agg(F.max(F.abs(F.col("r") - F.col("old")))).first()[0]
        discard(sources)
        sources = nxt
        if moved is None or moved < settled:
            break
    names = claims.select("source", F.xxhash64("source").alias("s")).distinct()
    sources = sources.join(names, "s").select("source", "n", "r")
    weight = sources.select("source", F.greatest(F.log(F.col("r") / (1 - F.col("r"))), F.lit(0.05)).alias("w"))
    support = claims.join(weight, "source").groupBy("group_id", "field", "value").agg(F.sum(F.col("w") * F.col("votes")).alias("s"), F.max("newest").alias("newest"))
    best = support.groupBy("group_id", "field").agg(F.max(F.struct(F.round("s", 9).alias("s"), "newest", "value")).alias("b"), F.sum("s").alias("whole"))
    return best.select("group_id", "field", F.col("b.value").alias("value"), F.least(F.lit(1.0), F.col("b.s") / F.col("whole")).alias("support")), sources.select("source", "n", "r")


def group_survivors(dedup: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups ``(group_id, survivor_id, members)`` of at least two files, and their members with all cleaned fields."""
    tied = materialize(tie_by_path(latest_decisions(dedup)))
    rank = F.when(F.col("ext") == EXT_ORDER[0], 3).when(F.col("ext") == EXT_ORDER[1], 2).when(F.col("ext") == EXT_ORDER[2], 1).otherwise(0)
    best = F.max(F.struct(F.coalesce("parse_quality", F.lit(-1.0)).alias("q"), rank.alias("e"), F.coalesce("raw_chars", F.lit(-1)).alias("c"), (-F.col("file_id")).alias("i")))
    groups = tied.groupBy("root").agg(F.min("file_id").alias("group_id"), best.alias("best"), F.count(F.lit(1)).alias("members")).where("members > 1")
    groups = materialize(groups.select("root", "group_id", (-F.col("best.i")).alias("survivor_id"), "members"))
    return groups.drop("root"), tied.join(groups.select("root", "group_id"), "root").drop("root")


def surviving_files(dedup: DataFrame) -> DataFrame:
    """``(group_id, survivor_id, members)`` of every group of at least two files, by the fixed ranking; no truth discovery is run for it."""
    return group_survivors(dedup)[0]


def surviving_records(dedup: DataFrame) -> DataFrame:
    """One record per group of at least two files: ``group_id, survivor_id, members`` and the best supported value of each field.

    ``<field>_support`` is the chosen value's share of the weighted votes. Values outside their domain (quality outside 0..1 or NaN, negative
    counts, blank strings) and nulls cast no vote; a field that nobody states is null. Files that no canonical path ties to another
    are in no group. Empty input gives an empty result; other columns are ignored.
    """
    groups, members = group_survivors(dedup)
    best, _ = discover_truth(claims_of(members))
    pick = lambda f, c: F.max(F.when(F.col("field") == f, F.col(c)))
    wide = best.groupBy("group_id").agg(*(pick(f, "value").alias(f) for f in FIELDS), *(pick(f, "support").alias(f"{f}_support") for f in FIELDS))
    typed = {"parse_quality": "double", "raw_chars": "bigint", "normalized_chars": "bigint"}
    return groups.join(wide, "group_id", "left").select("group_id", "survivor_id", "members", *(F.col(f).cast(typed.get(f, "string")).alias(f) for f in FIELDS), *(f"{f}_support" for f in FIELDS))
