"""Coverage, audit, inspection, integrity and gates of an export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import paths as P
from ..functions import text as T


def field_coverage(rows: DataFrame, fields: list[str]) -> DataFrame:
    """``field, present_rows, coverage_pct`` of each field in order; a field that is no column is never present. One pass."""
    kinds = dict(rows.dtypes)
    present = [F.count_if(T.has_value(F.col(f), kinds[f])) if f in kinds else F.lit(0) for f in fields]
    one = rows.agg(F.count(F.lit(1)).alias("_n"), *(p.alias(f"_f{i}") for i, p in enumerate(present)))
    pairs = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"_f{i}").cast("bigint").alias("present_rows")) for i, f in enumerate(fields)))
    x = one.select("_n", F.explode(pairs).alias("p")).select("_n", "p.*")
    return x.select("field", "present_rows", F.when(F.col("_n") > 0, F.round(F.col("present_rows") * 100.0 / F.col("_n"), 2)).otherwise(0.0).alias("coverage_pct"))


def contract_gaps(coverage: DataFrame) -> DataFrame:
    """Fields of the contract that no row has."""
    return coverage.where("present_rows = 0").select(F.concat(F.lit("missing:"), "field").alias("gap"))


def quality_summary(rows: DataFrame, c: str = "parse_quality") -> DataFrame:
    q = F.col(c)
    return rows.agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.avg(q), 3).alias("quality_avg"), F.min(q).alias("quality_min"), F.max(q).alias("quality_max"),
        F.count_if(q >= 0.9).alias("q_high"), F.count_if((q >= 0.7) & (q < 0.9)).alias("q_good"), F.count_if((q >= 0.5) & (q < 0.7)).alias("q_fair"), F.count_if(q < 0.5).alias("q_low"), F.count_if(q.isNull()).alias("q_missing"),
    )


def duplicate_texts(rows: DataFrame, c: str = "text") -> DataFrame:
    """Unique and repeated texts, by SHA-256."""
    g = rows.groupBy(F.sha2(F.coalesce(F.col(c), F.lit("")), 256).alias("h")).agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.count(F.lit(1)).alias("unique_texts"), F.sum(F.col("n") - 1).alias("duplicate_rows"), F.max("n").alias("most_copies"))


def inspect(rows: DataFrame, globs: list[str], markers: list[str], suspicious: float = 0.6, path: str = "source_path", text: str = "text", length: str = "text_length") -> DataFrame:
    """Counters of an export and its gate: any forbidden path fails."""
    t, p = F.coalesce(F.col(text), F.lit("")), F.col(path)
    marked = F.lit(False)
    for m in markers:
        marked = marked | F.contains(F.lower(t), F.lit(m.lower()))
    bad = P.matches_globs(p, globs)
    out = rows.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(p.isNull() | (p == "")).alias("missing_path"), F.count_if(P.strip(t) == "").alias("empty_text"), F.count_if(F.length(t) != F.col(length)).alias("length_mismatch"),
        F.count_if(bad).alias("glob_hits"), F.count_if(marked).alias("marker_hits"), F.count_if(T.numeric_dump(t)).alias("numeric_dumps"), F.count_if((bad | marked | T.numeric_dump(t)) & (F.col("parse_quality") >= suspicious)).alias("suspicious"),
    )
    return out.withColumn("gate", F.when(F.col("glob_hits") > 0, "FAIL").otherwise("PASS"))


def integrity(chunks: DataFrame, vectors: DataFrame, entities: DataFrame, manifest: DataFrame, skip_total: int | None = None, skip_counts: int | None = None, key: str = "chunk_id") -> DataFrame:
    """Counts against the manifest (chunk_count, entity_count), alignment by key, and ``issues`` / ``warnings``; one row."""
    c = chunks.agg(F.count(F.lit(1)).alias("chunks"), F.count_distinct(key).alias("distinct_ids"))
    v = vectors.agg(F.count(F.lit(1)).alias("vectors"), F.count_distinct("dim").alias("dims"))
    e = entities.agg(F.count(F.lit(1)).alias("entities"))
    lost = chunks.select(key).join(vectors.select(key), key, "left_anti").agg(F.count(F.lit(1)).alias("without_vector"))
    orphan = entities.select(key).join(chunks.select(key), key, "left_anti").agg(F.count(F.lit(1)).alias("orphan_entities"))
    m = manifest.agg(F.first("chunk_count").alias("m_chunks"), F.first("entity_count").alias("m_entities"))
    # the other parts are scalar subqueries of one row each
    one = c
    for part in (v, e, lost, orphan, m):
        one = one.withColumns({k: part.select(k).scalar() for k in part.columns})
    issue = lambda bad, name: F.when(bad, name)
    issues = [issue(F.col("chunks") != F.col("m_chunks"), "chunk_count_mismatch"), issue(F.col("entities") != F.col("m_entities"), "entity_count_mismatch"), issue(F.col("vectors") != F.col("chunks"), "vector_count_mismatch"), issue(F.col("distinct_ids") != F.col("chunks"), "duplicate_chunk_ids"), issue(F.col("without_vector") > 0, "chunks_without_vector"), issue(F.col("dims") > 1, "mixed_vector_dims")]
    if skip_total is not None:
        issues.append(issue(F.lit(skip_total) != F.lit(skip_counts or 0), "skip_total_mismatch"))
    return one.withColumn("issues", F.array_join(F.array_compact(F.array(*issues)), ",")).withColumn("warnings", F.when(F.col("orphan_entities") > 0, "orphan_entities").otherwise("")).withColumn("gate", F.when(F.col("issues") != "", "FAIL").otherwise("PASS"))


def run_sanity(stats: DataFrame) -> DataFrame:
    """Failures of runs (chunks_created, files_parsed, files_found, errors) and their exit codes."""
    f = F.array_compact(F.array(F.when(F.col("chunks_created") == 0, "zero_chunks"), F.when(F.col("files_parsed") == 0, "zero_parsed"), F.when(F.col("errors") > 0.5 * F.greatest("files_found", F.lit(1)), "high_error_rate")))
    code = F.when(F.col("files_parsed") == 0, 1).when(F.col("errors") > 0, 2).otherwise(0)
    return stats.select("*", F.array_join(f, ",").alias("failures"), code.alias("exit_code"))


def last_runs(history: DataFrame, at: Column, n: int = 10) -> DataFrame:
    return history.orderBy(at.desc()).limit(n)


def alias_union(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """Union in which rows of ``second`` take the place of those of ``first`` with the same key."""
    return first.join(second.select(key), key, "left_anti").unionByName(second)


def share(part: Column, whole: Column, places: int = 2) -> Column:
    return F.when(whole > 0, F.round(part * 100.0 / whole, places)).otherwise(0.0)
