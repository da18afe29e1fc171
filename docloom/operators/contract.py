"""The metadata contract of an export: its fields, their coverage, the keys in use, and the gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import audit

#: fixed values: fields of chunks that every export has
CHUNK_FIELDS = ["chunk_id", "text", "enriched_text", "source_path", "chunk_index", "text_length", "parse_quality"]
#: fixed values: metadata fields of chunks
METADATA_FIELDS = [
    "source_ext", "source_doc_hash", "authority_tier", "authority_signals", "business_domain", "archive_class", "archive_depth", "is_archive_derived", "is_visual_heavy", "visual_family",
    "table_heavy", "is_ocr", "doc_date", "site_token", "program_token", "identifier_tokens", "log_clin", "log_vendor", "log_purchase_req", "log_purchase_order",
    "log_part_number", "log_model_number", "log_oem", "log_nomenclature", "log_qty", "log_serial_number", "log_acquisition_contract_code", "log_acquisition_cost", "log_acquisition_date", "log_revision",
    "log_remarks", "cyber_report_family", "cyber_scan_date", "cyber_system_scope", "cyber_site_scope", "cyber_finding_id", "cyber_severity", "cyber_status", "cyber_waiver_flag",
]
#: fixed values: fields of entities
ENTITY_FIELDS = ["chunk_id", "text", "label", "score", "start", "end", "source_path"]
#: fixed values: older names that the skip manifest also carries
SKIP_ALIASES = ["count", "skipped_files", "deferred_formats"]


def coverage(chunks: DataFrame, entities: DataFrame) -> DataFrame:
    """``artifact, field, present_rows, coverage_pct`` of all fields of the contract, chunks before entities."""
    part = lambda rows, name, fields: audit.field_coverage(rows, fields).select(F.lit(name).alias("artifact"), "field", "present_rows", "coverage_pct")
    return part(chunks, "chunks", CHUNK_FIELDS + METADATA_FIELDS).unionByName(part(entities, "entities", ENTITY_FIELDS))


def key_union(lines: DataFrame, value: str = "value") -> DataFrame:
    """``key, rows``: every key that occurs in JSON ``lines``, and in how many rows. Pre-aggregated; lines that are no objects have no keys."""
    return lines.select(F.explode(F.json_object_keys(F.col(value))).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("rows"))


def gaps(table: DataFrame, skip_keys: list[str]) -> DataFrame:
    """``gap``: what an export lacks, by name: source extension, document hash, authority metadata, aliases, entity paths."""
    present = lambda artifact, field: F.max(F.when((F.col("artifact") == artifact) & (F.col("field") == field), F.col("present_rows")))
    one = table.agg(
        present("chunks", "source_ext").alias("ext"), present("chunks", "source_doc_hash").alias("hash"), present("chunks", "authority_tier").alias("tier"),
        present("entities", "source_path").alias("path"), present("entities", "chunk_id").alias("entities"),
    )
    lacks = lambda test, name: F.when(test, F.lit(name))
    found = F.array_compact(
        F.array(
            lacks(F.col("ext") == 0, "source_ext"), lacks(F.col("hash") == 0, "source_doc_hash"), lacks(F.col("tier") == 0, "authority_metadata"),
            lacks(F.lit(not set(SKIP_ALIASES) <= set(skip_keys)), "skip_aliases"), lacks((F.col("entities") > 0) & (F.col("path") == 0), "entity_source_path"),
        )
    )
    return one.select(F.explode(found).alias("gap"))


def corpus_audit(chunks: DataFrame, entities: DataFrame, quality: str = "parse_quality", length: str = "text_length", enriched: str = "enriched_text") -> DataFrame:
    """One row: scores of entities, sizes of chunks and enrichment coverage, beside the quality of ``audit.quality_summary``."""
    s, n = F.col("score"), F.col(length)
    e = entities.agg(F.count(F.lit(1)).alias("entities"), F.round(F.avg(s), 3).alias("score_avg"), F.round(F.min(s), 3).alias("score_min"), F.round(F.max(s), 3).alias("score_max"))
    c = chunks.agg(F.round(F.avg(n)).cast("bigint").alias("size_avg"), F.min(n).alias("size_min"), F.max(n).alias("size_max"), F.count_if(F.col(enriched).isNotNull()).alias("enriched"))
    one = audit.quality_summary(chunks, quality)
    for part in (c, e):
        one = one.withColumns({k: part.select(k).scalar() for k in part.columns})
    return one.withColumn("enrichment_coverage", F.concat_ws("/", F.col("enriched").cast("string"), F.col("rows").cast("string")))


def label_counts(entities: DataFrame) -> DataFrame:
    return entities.groupBy(F.coalesce("label", F.lit("UNKNOWN")).alias("label")).agg(F.count(F.lit(1)).alias("entities"))


def full_integrity(counts: DataFrame, manifest: DataFrame, skipped: DataFrame, present: list[str], required: list[str]) -> DataFrame:
    """Counts of an export against its manifest and skip manifest: ``issues``, ``warnings`` and ``gate``; one row.

    ``counts`` holds chunks, vectors, dim, dtype, entities; ``manifest`` chunk_count, vector_dim, entity_count, vector_dtype, chunks_created,
    vectors_created, entities_extracted; ``skipped`` total_skipped and counted (the sum of the counts by reason). Null stands for a
    value that is missing. A missing artifact is an issue by itself.
    """
    m, k = manifest.columns, skipped.columns
    one = counts.withColumns({c: manifest.select(c).scalar() for c in m} | {c: skipped.select(c).scalar() for c in k})
    col = F.col
    issue = lambda test, name: F.when(test, F.lit(name))
    differs = lambda a, b: col(a).isNotNull() & (col(a) != col(b))
    issues: list[Column] = [F.lit(f"missing_artifact:{x}") for x in required if x not in present]
    issues += [
        issue(col("chunk_count").isNull(), "manifest_without_chunk_count"), issue(differs("chunk_count", "chunks"), "chunk_count_mismatch"), issue(col("vectors") != col("chunks"), "vector_rows_mismatch"),
        issue(col("vector_dim").isNull(), "manifest_without_vector_dim"), issue(differs("vector_dim", "dim"), "vector_dim_mismatch"), issue(differs("entity_count", "entities"), "entity_count_mismatch"),
        issue(col("total_skipped").isNotNull() & differs("counted", "total_skipped"), "skip_total_mismatch"),
    ]
    warnings = [
        issue(col("entity_count").isNull(), "manifest_without_entity_count"), issue(differs("vector_dtype", "dtype"), "vector_dtype_mismatch"), issue(col("total_skipped").isNull(), "skip_manifest_without_total"),
        issue(col("counted").isNull(), "skip_manifest_without_counts"), issue(differs("chunks_created", "chunks"), "stats_chunks_mismatch"), issue(differs("vectors_created", "vectors"), "stats_vectors_mismatch"),
        issue(differs("entities_extracted", "entities"), "stats_entities_mismatch"),
    ]
    joined = lambda xs: F.array_join(F.array_compact(F.array(*xs)), ",")
    return one.withColumn("issues", joined(issues)).withColumn("warnings", joined(warnings)).withColumn("gate", F.when(F.col("issues") == "", "PASS").otherwise("FAIL"))
