"""Queries of formats, export contracts, audits and reports; the SQL states its literals itself, independent of the operators' constants."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import functions as F

from .functions import display
from .functions import paths as P
from .functions import text as T
from .operators import artifacts, contract, exact_dedup, family_dedup, metadata, skip
from .plans.shared import shared_dir, ship_package
from .queries import LATEST_STATE, _t, q_base, q_ext, q_norm, q_strip, query
from .sources import files as src

# --- formats: every document is written in one of 18 formats and parsed again -----------------------------------------------------

FORMATS = [".pdf", ".docx", ".pptx", ".xlsx", ".odt", ".vsdx", ".epub", ".zip", ".gz", ".html", ".rtf", ".eml", ".json", ".csv", ".dxf", ".msg", ".doc", ".xls"]
_NL = "chr(10)"


@query(
    f"""WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[A-Za-z0-9]+') AS w, doc_id % 18 AS k FROM documents),
    l AS (SELECT doc_id, k, len(w) AS n, list_transform(range(0, (len(w) + 9) // 10), lambda i: array_to_string(w[i * 10 + 1:i * 10 + 10], ' ')) AS l FROM w),
    b AS (SELECT *, array_to_string(l, {_NL}) AS b, array_to_string(l, {_NL} || {_NL}) AS p FROM l),
    x AS (SELECT doc_id, ['.pdf', '.docx', '.pptx', '.xlsx', '.odt', '.vsdx', '.epub', '.zip', '.gz', '.html', '.rtf', '.eml', '.json', '.csv', '.dxf', '.msg', '.doc', '.xls'][k + 1] AS ext, CASE WHEN n = 0 THEN '' ELSE CASE k
      WHEN 1 THEN p WHEN 2 THEN '[SLIDE 1]' || {_NL} || b WHEN 3 THEN '[SHEET] one' || {_NL} || 'line' || {_NL} || array_to_string(list_transform(l, lambda x: 'line: ' || x), {_NL})
      WHEN 5 THEN 'Visio: x.vsdx' || {_NL} || '--- Page: Plan ---' || {_NL} || b WHEN 7 THEN '[ARCHIVE_MEMBER=a.txt]' || {_NL} || b WHEN 8 THEN '[ARCHIVE_MEMBER=x.txt]' || {_NL} || b
      WHEN 11 THEN 'Subject: Lines' || {_NL} || 'From: a@b.example' || {_NL} || {_NL} || b WHEN 12 THEN '[' || {_NL} || array_to_string(list_transform(l, lambda x: '  "' || x || '"'), ',' || {_NL}) || {_NL} || ']'
      WHEN 14 THEN 'DXF: x.dxf' || {_NL} || {_NL} || p WHEN 15 THEN 'Subject: Lines' || {_NL} || {_NL} || array_to_string(l, chr(13) || {_NL}) WHEN 17 THEN '[Sheet: one]' || {_NL} || b ELSE b END END AS x FROM b)
    SELECT doc_id, ext, length(x) AS chars, sha256(x) AS text_hash FROM x"""
)
def parsed_formats(spark, sf):
    """Round trip of each document's words through the bytes of a format: written, parsed, compared with the text that the format prescribes."""
    from .sources.parsers import parse_files
    from .sources.samples import write

    ship_package(spark)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, ext = b.column(1).to_pylist(), b.column(2).to_pylist()
            data = [write(e, w) if w else b"" for w, e in zip(words, ext, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(["x.txt.gz" if e == ".gz" else f"x{e}" for e in ext]), b.column(2), pa.array(data, pa.binary())], ["doc_id", "path", "ext", "content"])

    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("[A-Za-z0-9]+"), F.lit(0))
    ext = F.element_at(F.array(*map(F.lit, FORMATS)), (F.col("doc_id") % 18 + 1).cast("int"))
    files = _t(spark, sf, "documents").select("doc_id", words.alias("w"), ext.alias("ext")).mapInArrow(encode, "doc_id bigint, path string, ext string, content binary")
    return parse_files(files).select("doc_id", "ext", F.length("text").alias("chars"), F.sha2("text", 256).alias("text_hash"))


@query("SELECT doc_id, sha256(coalesce(text, '')) AS sha256, octet_length(encode(coalesce(text, '')))::BIGINT AS size FROM documents")
def hashed_bytes(spark, sf):
    """SHA-256 over the bytes of every document's text."""
    b = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return src.with_hash(_t(spark, sf, "documents").select("doc_id", b.alias("content"))).select("doc_id", F.col("hash").alias("sha256"), F.octet_length("content").cast("bigint").alias("size"))


# --- scans, lists and skips through the operators ---------------------------------------------------------------------------------


@query(rf"SELECT DISTINCT first_value({q_norm('trim(path)')}) OVER (PARTITION BY lower({q_norm('trim(path)')}) ORDER BY {q_norm('trim(path)')}) AS path FROM delta_path WHERE trim(path) <> '' AND NOT starts_with(trim(path), '#') AND lower({q_norm('trim(path)')}) IN (SELECT lower({q_norm('path')}) FROM file_state)")
def listed_files(spark, sf):
    """The delta's paths as an input list file, read against the state's listing: listed files that exist, each once."""
    path = f"{shared_dir(spark)}/docloom-list-{uuid.uuid4().hex}"
    lines = _t(spark, sf, "delta_path").select(F.trim("path").alias("value")).where("value is not null").orderBy("value")
    lines.unionByName(spark.createDataFrame([("# list",), ("",)], "value string")).write.text(path)
    have, _ = src.input_list(spark, path, _t(spark, sf, "file_state").select("path"))
    first = _t(spark, sf, "delta_path").groupBy(F.lower(P.norm_path(F.trim("path"))).alias("k")).agg(F.min(P.norm_path(F.trim("path"))).alias("path"))
    # which spelling stands for a path depends on the list's order in the file; the least one is shown
    return have.select(F.lower("path").alias("k")).join(first, "k").select("path")


_N = q_base("path")
_E = q_ext("path")
_ENC = rf"regexp_matches(lower({_N}), '(^|[^a-z0-9]){{}}($|[^a-z0-9])')"
_FULL = f"""CASE WHEN size = 0 THEN 'zero-byte file' WHEN starts_with({_N}, '~$') THEN 'temp file prefix ''~$''' WHEN {_E} = '.tmp' THEN 'temp file extension ''.tmp''' WHEN size > 3145728 THEN 'over size limit (3 MB)'
 WHEN ends_with(lower({_N}), '_djvu.xml') THEN 'OCR sidecar artifact (_djvu.xml)' WHEN ends_with(lower({_N}), '_hocr.html') THEN 'OCR sidecar artifact (_hocr.html)' WHEN ends_with(lower({_N}), '_meta.xml') THEN 'OCR sidecar artifact (_meta.xml)' WHEN ends_with(lower({_N}), '_ocr.pdf') THEN 'OCR sidecar artifact (_ocr.pdf)'
 WHEN {_E} IN ('.jpg', '.jpeg', '.png', '.tif', '.tiff') THEN 'image asset skipped (OCR mode skip)' WHEN {_E} = '.pdf' AND file_id % 11 = 0 OR {_E} IN ('.docx', '.xlsx', '.pptx') AND file_id % 11 = 1 THEN 'encrypted file (magic bytes)'
 WHEN {_ENC.format('encrypted')} THEN 'encrypted file (filename cue: ''encrypted'')' WHEN {_ENC.format('password-protected')} THEN 'encrypted file (filename cue: ''password-protected'')' WHEN {_ENC.format('drm-protected')} THEN 'encrypted file (filename cue: ''drm-protected'')'
 WHEN {_E} = '.dwf' THEN 'Design Web Format' WHEN {_E} = '.sao' THEN 'Deferred by config for this run' END"""


def _policy() -> skip.SkipPolicy:
    """The policy of the query: the lists that the SQL states."""
    return skip.SkipPolicy(
        deferred={".dwf": "Design Web Format", ".sao": "Deferred by config for this run"}, over_size_mb=3, ocr_mode="skip", temp_prefixes=("~$",), temp_extensions=(".tmp",),
        sidecars=("_djvu.xml", "_hocr.html", "_meta.xml", "_ocr.pdf"), images=(".jpg", ".jpeg", ".png", ".tif", ".tiff"), cues=("encrypted", "password-protected", "drm-protected"),
    )


@query(
    f"""WITH {LATEST_STATE}, s AS (SELECT file_id, path, size, mtime, {_FULL} AS reason, CASE WHEN {_E} IN ('.dwf', '.sao') THEN 'deferred' ELSE 'skipped' END AS status FROM latest),
    h AS (SELECT {q_norm('path')} AS p, mtime, size, max(hash) AS sha256 FROM file_state GROUP BY 1, 2, 3)
    SELECT s.path, s.size, s.reason, s.status, h.sha256, count(*) AS rows FROM s LEFT JOIN h ON {q_norm('s.path')} = h.p AND s.mtime = h.mtime AND s.size = h.size WHERE reason IS NOT NULL GROUP BY 1, 2, 3, 4, 5"""
)
def skipped_by_headers(spark, sf):
    """Skip records of the state's files with the bytes of their beginnings, in a run without recognition; stored hashes reused on equal stamps."""
    pdf, ole = F.lit(b"%PDF-1.7 trailer << /Encrypt 5 0 R >>"), F.lit(bytes.fromhex("d0cf11e0a1b11ae1") + b"\0" * 8)
    header = F.when(F.col("file_id") % 11 == 0, pdf).when(F.col("file_id") % 11 == 1, ole).otherwise(F.lit(b"plain bytes"))
    # other formats with these beginnings are no cases: a pdf mark in a pdf, a compound file under a zipped format's name
    e = P.ext(F.col("path"))
    header = F.when(((F.col("file_id") % 11 == 0) & (e == ".pdf")) | ((F.col("file_id") % 11 == 1) & e.isin(".docx", ".xlsx", ".pptx")), header).otherwise(F.lit(b"plain bytes"))
    f = exact_dedup.latest_state(_t(spark, sf, "file_state")).select("path", "size", "mtime", header.alias("header"))
    s = _t(spark, sf, "file_state").groupBy(P.norm_path(F.col("path")).alias("path"), "mtime", "size").agg(F.max("hash").alias("hash"))
    return skip.skip_records(f, _policy(), s).groupBy("path", "size", "reason", "status", "sha256").agg(F.count(F.lit(1)).alias("rows"))


# --- contract, audit and gates ----------------------------------------------------------------------------------------------------

_TX = "coalesce(text, '')"
_LOW = f"lower({q_norm('source_path')})"


def _q_group(rx: str) -> str:
    return f"nullif({q_strip(f'regexp_extract({_TX}, {chr(39)}{rx}{chr(39)}, 1)')}, '')"


_CY = rf"regexp_matches(lower({_TX}), '\b(acas|nessus|stig|rmf|poa&?m|iavm|cci|waiver|finding)\b')"
_FAM = " ".join(rf"WHEN regexp_matches(lower({_TX}), '\b{rx}\b') THEN '{n}'" for n, rx in [("acas", "acas"), ("nessus", "nessus"), ("stig", "stig"), ("rmf", "rmf"), ("poam", "poa&?m"), ("iavm", "iavm"), ("cci", "cci"), ("waiver", "waiver")])
_MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
_DAY = rf"regexp_extract({_TX}, '\b(\d{{1,2}} ({_MONTHS}) \d{{4}})\b', 1)"
_DATE = rf"coalesce(nullif(regexp_extract({_TX}, '\b(\d{{4}}-\d{{2}}-\d{{2}})\b', 1), ''), strftime(try_strptime(nullif({_DAY}, ''), '%-d %B %Y'), '%Y-%m-%d'))"


@query(
    rf"""SELECT doc_id, sha256({_TX}) AS source_doc_hash, array_to_string(list_filter([CASE WHEN regexp_matches({_LOW}, 'restricted') THEN 'restricted_path' END, CASE WHEN regexp_matches({_LOW}, '/deliverables?/') THEN 'deliverables_path' END, CASE WHEN regexp_matches({_TX}, '(?i)\bcdrl\b') THEN 'cdrl' END,
      CASE WHEN regexp_matches({_TX}, '(?i)\bdd\s*250\b') THEN 'dd250' END, CASE WHEN regexp_matches({_TX}, '(?i)\bdeliverables?\b') THEN 'deliverable' END, CASE WHEN regexp_matches({_TX}, '(?i)\bdata\s+accession\s+list\b') THEN 'accession_list' END], lambda x: x IS NOT NULL), ',') AS authority_signals,
    {_DATE} AS doc_date, nullif(regexp_extract({_LOW}, '/intake/([a-z0-9]+)', 1), '') AS site_token, nullif(regexp_extract({_LOW}, '/intake/[a-z0-9]+_([a-z0-9]+)', 1), '') AS program_token,
    array_to_string(list_sort(list_distinct(regexp_extract_all({_TX}, '\b[A-Z]{{2}}-\d{{2,6}}\b'))), ',') AS identifier_tokens,
    {_q_group(r'(?i)\b(?:vendor|supplier)\s*[:=]\s*([^\n;|]+)')} AS log_vendor, {_q_group(r'(?i)\b(?:nomenclature|description|item)\s*[:=]\s*([^\n;|]+)')} AS log_nomenclature, {_q_group(r'(?i)\b(?:qty|quantity)\s*[:=]\s*(\d+)')} AS log_qty,
    {_q_group(r'(?i)\brev(?:ision)?(?:\.\s*|\s*[:=]\s*|\s+)([A-Z0-9]{1,3})(?:[\s,.;:)]|$)')} AS log_revision, {_q_group(r'(?i)\bsite\s*[:=]\s*([^\n;|]+)')} AS cyber_site_scope, {_q_group(r'\b(V-\d{4,6}|CVE-\d{4}-\d{4,}|CCI-\d{4,6})\b')} AS cyber_finding_id,
    CASE WHEN {_CY} THEN CASE {_FAM} ELSE 'other' END END AS cyber_report_family,
    CASE WHEN {_CY} THEN CASE WHEN regexp_matches({_TX}, '(?i)\b(exception|accepted\s+risk)\b') THEN 'exception' WHEN regexp_matches({_TX}, '(?i)\bmitigated\b') THEN 'mitigated' WHEN regexp_matches({_TX}, '(?i)\bclosed\b') THEN 'closed' WHEN regexp_matches({_TX}, '(?i)\bopen\b') THEN 'open' ELSE 'unknown' END END AS cyber_status,
    regexp_matches(lower({_TX}), '\bwaiver\b') AS cyber_waiver_flag FROM documents"""
)
def contract_metadata(spark, sf):
    """Fields of the export contract that are derived from path and text, beside those of metadata_columns."""
    d = _t(spark, sf, "documents")
    c = metadata.contract_columns(F.col("source_path"), F.col("text"), F.col("parse_quality"), F.sha2(F.coalesce("text", F.lit("")), 256))
    c |= {k: F.array_join(c[k], ",") for k in ("authority_signals", "identifier_tokens")}
    names = ["source_doc_hash", "authority_signals", "doc_date", "site_token", "program_token", "identifier_tokens", "log_vendor", "log_nomenclature", "log_qty", "log_revision", "cyber_site_scope", "cyber_finding_id", "cyber_report_family", "cyber_status", "cyber_waiver_flag"]
    return d.select("doc_id", *(c[n].alias(n) for n in names))


_ALL_CHUNK = "chunk_id text enriched_text source_path chunk_index text_length parse_quality source_ext source_doc_hash authority_tier authority_signals business_domain archive_class archive_depth is_archive_derived is_visual_heavy visual_family table_heavy is_ocr doc_date site_token program_token identifier_tokens log_clin log_vendor log_purchase_req log_purchase_order log_part_number log_model_number log_oem log_nomenclature log_qty log_serial_number log_acquisition_contract_code log_acquisition_cost log_acquisition_date log_revision log_remarks cyber_report_family cyber_scan_date cyber_system_scope cyber_site_scope cyber_finding_id cyber_severity cyber_status cyber_waiver_flag".split()  # noqa: SIM905
_HAVE = {"chunk_id": "count(*)", "text": "count(*) FILTER (WHERE text <> '')", "source_path": "count(*) FILTER (WHERE source_path <> '')", "text_length": "count(n_chars)", "parse_quality": "count(parse_quality)", "source_ext": "count(*) FILTER (WHERE file_ext <> '')"}
_COVER = " UNION ALL ".join(f"SELECT 'chunks' AS artifact, '{f}' AS field, {_HAVE.get(f, '0')} AS present_rows, count(*) AS n FROM documents" for f in _ALL_CHUNK)
_COVER += " UNION ALL " + " UNION ALL ".join(f"SELECT 'entities', '{f}', {'count(*)' if f in ('chunk_id', 'label') else '0'}, count(*) FROM reading_label" for f in "chunk_id text label score start end source_path".split())  # noqa: SIM905


def _export_rows(spark, sf):
    chunks = _t(spark, sf, "documents").select(F.col("doc_id").alias("chunk_id"), "text", "source_path", F.col("n_chars").alias("text_length"), "parse_quality", F.col("file_ext").alias("source_ext"))
    return chunks, _t(spark, sf, "reading_label").select(F.col("doc_id").alias("chunk_id"), F.col("grade").cast("string").alias("label"))


@query(f"SELECT artifact, field, present_rows, CASE WHEN n > 0 THEN round(present_rows * 100.0 / n, 2) ELSE 0.0 END::DOUBLE AS coverage_pct FROM ({_COVER})")
def contract_coverage(spark, sf):
    """All 53 fields of the contract over the documents as chunks and the graded rows as entities."""
    return contract.coverage(*_export_rows(spark, sf))


@query("SELECT unnest(['source_doc_hash', 'authority_metadata', 'skip_aliases', 'entity_source_path']) AS gap")
def export_gaps(spark, sf):
    return contract.gaps(contract.coverage(*_export_rows(spark, sf)), ["total_skipped", "counts_by_reason", "count"])


@query("SELECT k AS key, count(*) AS rows FROM (SELECT unnest(json_keys(props)) AS k FROM events) GROUP BY 1")
def json_key_union(spark, sf):
    return contract.key_union(_t(spark, sf, "events"), "props")


@query(
    """SELECT count(*) AS rows, round(avg(parse_quality), 3) AS quality_avg, round(avg(n_chars))::BIGINT AS size_avg, min(n_chars) AS size_min, max(n_chars) AS size_max, count(lang) AS enriched, count(lang) || '/' || count(*) AS enrichment_coverage,
    (SELECT count(*) FROM reading_label) AS entities, (SELECT round(avg(grade / 5.0::DOUBLE), 3) FROM reading_label) AS score_avg, (SELECT round(min(grade / 5.0::DOUBLE), 3) FROM reading_label) AS score_min, (SELECT round(max(grade / 5.0::DOUBLE), 3) FROM reading_label) AS score_max FROM documents"""
)
def corpus_audit(spark, sf):
    """Audit of sizes, enrichment and entity scores: documents as chunks (lang standing for the enriched text), graded rows as entities."""
    e = _t(spark, sf, "reading_label").select((F.col("grade") / F.lit(5.0)).alias("score"))
    out = contract.corpus_audit(_t(spark, sf, "documents"), e, length="n_chars", enriched="lang")
    return out.select("rows", "quality_avg", "size_avg", "size_min", "size_max", "enriched", "enrichment_coverage", "entities", "score_avg", "score_min", "score_max")


@query("SELECT coalesce(task, 'UNKNOWN') AS label, count(*) AS entities FROM eval_item GROUP BY 1")
def entity_labels(spark, sf):
    return contract.label_counts(_t(spark, sf, "eval_item").select(F.col("task").alias("label")))


@query(
    """WITH c AS (SELECT (SELECT count(*) FROM documents) AS chunks, (SELECT count(*) FROM embeddings) AS vectors, (SELECT max(len(embedding)) FROM embeddings) AS dim, (SELECT count(*) FROM reading_label) AS entities, (SELECT count(*) FROM eval_item) AS counted)
    SELECT chunks, vectors, dim, entities, array_to_string(list_filter(['missing_artifact:run_report.txt', CASE WHEN chunks + 1 <> chunks THEN 'chunk_count_mismatch' END, CASE WHEN vectors <> chunks THEN 'vector_rows_mismatch' END, CASE WHEN dim <> 768 THEN 'vector_dim_mismatch' END, CASE WHEN counted <> counted - 1 THEN 'skip_total_mismatch' END], lambda x: x IS NOT NULL), ',') AS issues,
    array_to_string(list_filter(['manifest_without_entity_count', 'vector_dtype_mismatch', CASE WHEN vectors <> chunks THEN 'stats_vectors_mismatch' END], lambda x: x IS NOT NULL), ',') AS warnings, 'FAIL' AS gate FROM c"""
)
def integrity_gate(spark, sf):
    """Integrity of an export whose manifest is wrong in known ways: one chunk too many, no entity count, other vectors, one skip too few, no report."""
    one = lambda name, agg: _t(spark, sf, name).agg(agg.alias("x")).first()["x"]
    n = F.count(F.lit(1))
    chunks, vectors, entities, skips = (one(t, n) for t in ("documents", "embeddings", "reading_label", "eval_item"))
    counts = spark.createDataFrame([(chunks, vectors, one("embeddings", F.max(F.size("embedding"))), "float32", entities)], "chunks bigint, vectors bigint, dim int, dtype string, entities bigint")
    manifest = spark.createDataFrame([(chunks + 1, 768, None, "float16", chunks, chunks, None)], "chunk_count bigint, vector_dim int, entity_count bigint, vector_dtype string, chunks_created bigint, vectors_created bigint, entities_extracted bigint")
    skipped = spark.createDataFrame([(skips - 1, skips)], "total_skipped bigint, counted bigint")
    required = ["manifest.json", "skip_manifest.json", "run_report.txt", "chunks.jsonl", "vectors.npy", "entities.jsonl"]
    out = contract.full_integrity(counts, manifest, skipped, [x for x in required if x != "run_report.txt"], required)
    return out.select("chunks", "vectors", "dim", "entities", "issues", "warnings", "gate")


# --- review order, display and rules ----------------------------------------------------------------------------------------------


@query(
    """WITH f AS (SELECT canonical_path, count(*) AS members, count(*) FILTER (WHERE status = 'duplicate') AS duplicates, min(similarity) FILTER (WHERE status = 'duplicate') AS min_similarity FROM document_dedup WHERE canonical_path IS NOT NULL GROUP BY 1 HAVING count(*) FILTER (WHERE status = 'duplicate') > 0),
    a AS (SELECT 'largest' AS mode, row_number() OVER (ORDER BY members DESC, lower(canonical_path), canonical_path) AS place, canonical_path FROM f UNION ALL SELECT 'similarity', row_number() OVER (ORDER BY min_similarity ASC NULLS LAST, lower(canonical_path), canonical_path), canonical_path FROM f
      UNION ALL SELECT 'path', row_number() OVER (ORDER BY canonical_path, lower(canonical_path)), canonical_path FROM f)
    SELECT mode, canonical_path FROM a WHERE place <= 25"""
)
def review_orders(spark, sf):
    """First 25 review families in each sort mode."""
    families = family_dedup.review_families(_t(spark, sf, "document_dedup"))
    out = None
    for mode in ("largest", "similarity", "path"):
        one = family_dedup.sorted_families(families, mode).select(F.lit(mode).alias("mode"), "canonical_path")
        out = one if out is None else out.unionByName(one)
    return out


@query(
    """SELECT file_id, CASE WHEN size >= 1073741824 THEN printf('%.1f GB', size / 1073741824.0::DOUBLE) WHEN size >= 1048576 THEN printf('%.1f MB', size / 1048576.0::DOUBLE) WHEN size >= 1024 THEN printf('%.1f KB', size / 1024.0::DOUBLE) ELSE size || ' B' END AS shown,
    CASE WHEN size >= 3600 THEN printf('%d:%02d:%02d', size // 3600, size % 3600 // 60, size % 60) ELSE printf('%d:%02d', size // 60, size % 60) END AS as_time FROM delta_path WHERE size IS NOT NULL"""
)
def display_texts(spark, sf):
    """Sizes for readers, and the same numbers taken as seconds."""
    d = _t(spark, sf, "delta_path").where("size is not null")
    return d.select("file_id", display.bytes_text(F.col("size")).alias("shown"), display.elapsed_text(F.col("size").cast("double")).alias("as_time"))


@query(r"SELECT doc_id, sha256(replace(regexp_replace(regexp_replace(coalesce(text, ''), '(?i)\bpump(s?)\b', 'motor\1', 'g'), '(?i)wo-(\d+)', 'order \1', 'g'), '(part', '[part')) AS text_hash FROM documents")
def rewritten_texts(spark, sf):
    """Ordered rewrite rules; the last one is no expression and is taken literally."""
    rules = [(r"\bpump(s?)\b", "motor$1"), (r"wo-(\d+)", "order $1"), ("(part", "[part")]
    return _t(spark, sf, "documents").select("doc_id", F.sha2(T.rewrite(F.coalesce("text", F.lit("")), rules), 256).alias("text_hash"))


_MIX = """WITH c AS (SELECT doc_id AS id, coalesce(source, '') AS q, length(coalesce(text, '')) % 101 / 10.0::DOUBLE AS prior, CASE WHEN doc_id % 7 = 0 THEN 'customer_deliverable' ELSE 'operational_working' END AS tier, doc_id % 3 = 0 AS archive, doc_id % 5 = 0 AS visual FROM documents),
 r AS (SELECT *, CASE tier WHEN 'customer_deliverable' THEN 2 ELSE 1 END AS t FROM c),
 m AS (SELECT *, t = max(t) OVER (PARTITION BY q) AS top FROM r),
 k AS (SELECT *, row_number() OVER (PARTITION BY q, archive ORDER BY prior DESC, id) AS a, row_number() OVER (PARTITION BY q, visual ORDER BY prior DESC, id) AS v, row_number() OVER (PARTITION BY q, top ORDER BY prior DESC, id) AS n FROM m),
 f AS (SELECT *, top AND n <= 16 AS first FROM k WHERE (NOT archive OR a <= 8) AND (NOT visual OR v <= 6))
 SELECT q, id, place FROM (SELECT q, id, row_number() OVER (PARTITION BY q ORDER BY first DESC, prior DESC, id)::INT AS place FROM f) WHERE place <= 40"""


@query(_MIX)
def rerank_pool(spark, sf):
    """Pool of 40 candidates a source under the mix caps: archive 20 %, visual 15 %, 40 % for the best tier."""
    d = _t(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), F.coalesce("source", F.lit("")).alias("q"), (F.length(F.coalesce("text", F.lit(""))) % 101 / F.lit(10.0)).alias("prior"),
        F.when(F.col("doc_id") % 7 == 0, "customer_deliverable").otherwise("operational_working").alias("authority_tier"), (F.col("doc_id") % 3 == 0).alias("is_archive_derived"), (F.col("doc_id") % 5 == 0).alias("is_visual_heavy"),
    )
    return metadata.mixed_pool(d, ["q"], 40).select("q", "id", "place")


@query("SELECT doc_id FROM documents WHERE regexp_matches(lower(replace(coalesce(source_path, ''), '\\', '/')), '^.*report.*$') OR regexp_matches(lower(regexp_extract(replace(coalesce(source_path, ''), '\\', '/'), '[^/]*$')), '^.*\\.xls.?$')")
def relative_globs(spark, sf):
    """Shell patterns on the relative path or the basename."""
    return _t(spark, sf, "documents").where(P.matches_globs(F.coalesce("source_path", F.lit("")), ["*report*", "*.xls?"]) | F.rlike(F.lower(P.basename(F.coalesce("source_path", F.lit("")))), F.lit(r"\.xls$"))).select("doc_id")


@query(f"SELECT lower(ltrim({q_ext('source_path')}, '.')) AS ext, n_chars AS files, CASE WHEN trim(coalesce(source, '')) <> '' AND doc_id % 5 <> 0 THEN trim(source) END AS cause, count(*) AS sections FROM documents WHERE {q_ext('source_path')} <> '' GROUP BY 1, 2, 3")
def failure_causes(spark, sf):
    """Sections of failure logs with their causes; each document gives one log of one section, those divisible by five without a cause."""
    d = _t(spark, sf, "documents").where(P.ext(F.col("source_path")) != "")
    cause = F.when(F.col("doc_id") % 5 != 0, F.concat(F.lit("Likely cause: "), F.coalesce("source", F.lit("")), F.lit("\n"))).otherwise("")
    log = F.concat(F.lit("# Failures\n\n### "), P.ext(F.col("source_path")), F.lit(" ("), F.col("n_chars").cast("string"), F.lit(" files)\r\n"), cause, F.lit("[ext] Empty parse: a name\n"))
    return artifacts.failure_causes(d.select(log.alias("value"))).groupBy("ext", "files", "cause").agg(F.count(F.lit(1)).alias("sections"))
