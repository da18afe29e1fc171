"""Derived metadata of chunks, entities by pattern, and retrieval priors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import paths as P
from ..functions import text as T

#: patterns of the entity pass: label, expression
ENTITY_PATTERNS = [
    ("PART_NUMBER", r"\b(?:PN|QX|TM|LT)-\d{2,6}\b"),
    ("WORK_ORDER", r"\bWO-\d{2,6}\b"),
    ("SERIAL_NUMBER", r"\bSN-\d{2,6}\b"),
    ("DATE", r"\b\d{1,2} (?:January|February|March|April|May|June|July|August|September|October|November|December) \d{4}\b"),
    ("MEASURE", r"\b\d+(?:\.\d+)? (?:psi|mm|kg|volts|ohms|hours|degrees|newton meters)\b"),
    ("EMAIL", r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"),
]
#: fixed values: cues of domains, in order of precedence
DOMAINS = [("logistics", r"packing|supply|inventory|manifest|receipt|purchase|shipment"), ("cybersecurity", r"cyber|scan|vulnerab|firewall"), ("site_visit", r"site visit|site_visit|travel|itinerary"), ("engineering", r"drawing|calibration|test report|test_report|power"), ("program", r"program|contract|quality"), ("sysadmin", r"log|radio|network")]
IMAGE_EXT = (".jpg", ".jpeg", ".png", ".gif", ".bmp", ".tif", ".tiff", ".webp")
DRAWING_EXT = (".dwg", ".dxf", ".dwf", ".vsdx", ".drawio")


def metadata_columns(path: Column, text: Column, quality: Column) -> dict[str, Column]:
    p, t = F.lower(P.norm_path(path)), F.coalesce(text, F.lit(""))
    e = P.ext(path)
    domain = F.lit("unknown")
    for name, rx in reversed(DOMAINS):
        domain = F.when(F.rlike(p, F.lit(rx)), name).otherwise(domain)
    archive = F.rlike(p, F.lit(r"/archive/|\.zip|_archive/"))
    deliverable = F.rlike(p, F.lit(r"deliverable|final|signed|contract"))
    return {
        "source_ext": e,
        "business_domain": domain,
        "is_archive_derived": archive,
        "archive_class": F.when(archive & F.rlike(p, F.lit(r"\.zip")), "archive_bundle_member").when(archive, "archive_original").otherwise("primary"),
        "archive_depth": F.size(F.split(p, r"archive")) - 1,
        "authority_tier": F.when(F.rlike(p, F.lit(r"restricted")), "dm_restricted").when(deliverable, "customer_deliverable").when(archive, "archive_copy").when(domain != "unknown", "operational_working").otherwise("unknown"),
        "visual_family": F.when(e.isin(*DRAWING_EXT), "cad").when(F.rlike(p, F.lit("scan")) & e.isin(*IMAGE_EXT), "scan").when(e.isin(*IMAGE_EXT), "photo").when(F.rlike(p, F.lit("drawing|diagram")), "drawing").otherwise("none"),
        "is_visual_heavy": e.isin(*IMAGE_EXT, *DRAWING_EXT),
        "table_heavy": (F.length(F.regexp_replace(t, r"[^|\t]", "")) >= 10) | F.contains(t, F.lit("[SHEET]")),
        "is_ocr": quality < 0.6,
        "identifier_count": F.size(F.array_distinct(F.regexp_extract_all(t, F.lit(r"\b[A-Z]{2}-\d{2,6}\b"), F.lit(0)))),
        "log_part_number": F.nullif(F.regexp_extract(t, r"\b(PN-\d{2,6})\b", 1), F.lit("")),
        "log_serial_number": F.nullif(F.regexp_extract(t, r"\b(SN-\d{2,6})\b", 1), F.lit("")),
        "log_purchase_req": F.nullif(F.regexp_extract(t, r"(?i)purchase request ([A-Z]{2}-\d{2,6})", 1), F.lit("")),
        "cyber_severity": F.nullif(F.lower(F.regexp_extract(t, r"(?i)\b(low|medium|high|critical) severity", 1)), F.lit("")),
    }


#: fixed values: what names a field of the logistics block in a text, by field; the value follows
LABELLED = {
    "log_clin": r"(?i)\bCLIN\b\s*[:#-]?\s*([A-Z0-9-]{2,})",
    "log_purchase_order": r"(?i)\b(?:PO|Purchase\s*Order)\s*#?\s*[:#-]?\s*([A-Z0-9-]*\d[A-Z0-9-]*)",
    "log_model_number": r"(?i)\bModel\s*(?:Number|No\.?|#)?\s*[:#-]?\s*([A-Z0-9._-]*\d[A-Z0-9._-]*)",
    "log_vendor": r"(?i)\b(?:vendor|supplier)\s*[:=]\s*([^\n;|]+)",
    "log_oem": r"(?i)\b(?:oem|manufacturer)\s*[:=]\s*([^\n;|]+)",
    "log_nomenclature": r"(?i)\b(?:nomenclature|description|item)\s*[:=]\s*([^\n;|]+)",
    "log_qty": r"(?i)\b(?:qty|quantity)\s*[:=]\s*(\d+)",
    "log_acquisition_contract_code": r"(?i)\bcontract\s*(?:code|no\.?|number)?\s*[:=]\s*([^\n;|]+)",
    "log_acquisition_cost": r"(?i)\b(?:cost|price)\s*[:=]\s*\$?\s*(\d[\d,]*(?:\.\d+)?)",
    "log_acquisition_date": r"(?i)\b(?:acquired|received|acquisition date)\s*[:=]\s*([^\n;|]+)",
    "log_revision": r"(?i)\brev(?:ision)?(?:\.\s*|\s*[:=]\s*|\s+)([A-Z0-9]{1,3})(?:[\s,.;:)]|$)",
    "log_remarks": r"(?i)\b(?:remarks?|notes?)\s*[:=]\s*([^\n;|]+)",
    "cyber_system_scope": r"(?i)\bsystem\s*[:=]\s*([^\n;|]+)",
    "cyber_site_scope": r"(?i)\bsite\s*[:=]\s*([^\n;|]+)",
    "cyber_finding_id": r"\b(V-\d{4,6}|CVE-\d{4}-\d{4,}|CCI-\d{4,6})\b",
}
#: fixed values: kinds of security reports and states of findings, in order of precedence
CYBER_FAMILIES = ["acas", "nessus", "stig", "rmf", "poam", "iavm", "cci", "waiver"]
CYBER_STATES = [("exception", r"(?i)\b(?:exception|accepted\s+risk)\b"), ("mitigated", r"(?i)\bmitigated\b"), ("closed", r"(?i)\bclosed\b"), ("open", r"(?i)\bopen\b")]
#: fixed values: signals of authority in path or text
SIGNALS = [("restricted_path", "path", r"restricted"), ("deliverables_path", "path", r"/deliverables?/"), ("cdrl", "text", r"(?i)\bcdrl\b"), ("dd250", "text", r"(?i)\bdd\s*250\b"), ("deliverable", "text", r"(?i)\bdeliverables?\b"), ("accession_list", "text", r"(?i)\bdata\s+accession\s+list\b")]
IDENTIFIER = r"\b[A-Z]{2}-\d{2,6}\b"
DAY = r"\b(\d{1,2} (?:January|February|March|April|May|June|July|August|September|October|November|December) \d{4})\b"


def contract_columns(path: Column, text: Column, quality: Column, doc_hash: Column) -> dict[str, Column]:
    """All metadata fields of the export contract; a field that nothing states is null, a list without entries empty."""
    p, t = F.lower(P.norm_path(path)), F.coalesce(text, F.lit(""))
    found = lambda rx: F.nullif(P.strip(F.regexp_extract(t, rx, 1)), F.lit(""))
    out = metadata_columns(path, text, quality)
    cyber = F.rlike(F.lower(t), F.lit(r"\b(?:acas|nessus|stig|rmf|poa&?m|iavm|cci|waiver|finding)\b"))
    family = F.lit("other")
    for name in reversed(CYBER_FAMILIES):
        family = F.when(F.rlike(F.lower(t), F.lit(r"\bpoa&?m\b" if name == "poam" else rf"\b{name}\b")), name).otherwise(family)
    state = F.lit("unknown")
    for name, rx in reversed(CYBER_STATES):
        state = F.when(F.rlike(t, F.lit(rx)), name).otherwise(state)
    signals = F.array_compact(F.array(*(F.when(F.rlike(p if where == "path" else t, F.lit(rx)), F.lit(name)) for name, where, rx in SIGNALS)))
    day = F.to_date(F.nullif(F.regexp_extract(t, DAY, 1), F.lit("")), "d MMMM yyyy")
    stated = F.coalesce(F.nullif(F.regexp_extract(t, r"\b(\d{4}-\d{2}-\d{2})\b", 1), F.lit("")), F.date_format(day, "yyyy-MM-dd"))
    return out | {
        "source_doc_hash": doc_hash,
        "authority_signals": signals,
        "doc_date": stated,
        "site_token": F.nullif(F.regexp_extract(p, r"/intake/([a-z0-9]+)", 1), F.lit("")),
        "program_token": F.nullif(F.regexp_extract(p, r"/intake/[a-z0-9]+_([a-z0-9]+)", 1), F.lit("")),
        "identifier_tokens": F.array_sort(F.array_distinct(F.regexp_extract_all(t, F.lit(IDENTIFIER), F.lit(0)))),
        **{name: found(rx) for name, rx in LABELLED.items()},
        "cyber_report_family": F.when(cyber, family),
        "cyber_scan_date": F.when(cyber, stated),
        "cyber_status": F.when(cyber, state),
        "cyber_waiver_flag": F.rlike(F.lower(t), F.lit(r"\bwaiver\b")),
    }


def mixed_pool(ranked: DataFrame, keys: list[str], size: int, archive_share: float = 0.2, visual_share: float = 0.15, authority_share: float = 0.4) -> DataFrame:
    """The rerank pool of each query: ``ranked`` (keys, prior, authority_tier, is_archive_derived, is_visual_heavy, id) cut to ``size`` under mix caps.

    Places for the best authority tier at hand are reserved, archive and visual candidates only fill their share; the rest follows by prior, ties
    by id. Each limit is a rank within its class, so a query's candidates are ranked three times and never collected.
    """
    tiers = F.when(F.col("authority_tier") == "dm_restricted", 3).when(F.col("authority_tier") == "customer_deliverable", 2).when(F.col("authority_tier") == "operational_working", 1).otherwise(0)
    order = (F.desc("prior"), F.asc("id"))
    by = lambda *more: W.partitionBy(*keys, *more).orderBy(*order)
    rows = ranked.withColumn("_tier", tiers)
    rows = rows.withColumn("_top", F.col("_tier") == F.max("_tier").over(W.partitionBy(*keys)))
    rows = rows.withColumns({"_a": F.row_number().over(by("is_archive_derived")), "_v": F.row_number().over(by("is_visual_heavy")), "_t": F.row_number().over(by("_top"))})
    fits = (~F.col("is_archive_derived") | (F.col("_a") <= int(archive_share * size))) & (~F.col("is_visual_heavy") | (F.col("_v") <= int(visual_share * size)))
    kept = rows.where(fits).withColumn("_first", F.col("_top") & (F.col("_t") <= -int(-authority_share * size // 1)))
    final = W.partitionBy(*keys).orderBy(F.desc("_first"), *order)
    return kept.withColumn("place", F.row_number().over(final)).where(F.col("place") <= size).drop("_tier", "_top", "_a", "_v", "_t", "_first")


def with_metadata(chunks: DataFrame, path: str = "source_path", text: str = "text", quality: str = "parse_quality") -> DataFrame:
    return chunks.withColumns(metadata_columns(F.col(path), F.col(text), F.col(quality)))


def pattern_entities(chunks: DataFrame, key: str = "chunk_id", text: str = "text", least: int = 20) -> DataFrame:
    """``key, label, entity`` with the number of mentions; texts below ``least`` characters are left out. Narrow up to the count."""
    def of(label: str, rx: str) -> Column:
        return F.transform(F.regexp_extract_all(F.col(text), F.lit(rx), F.lit(0)), lambda x: F.struct(F.lit(label).alias("label"), x.alias("entity")))

    found = F.flatten(F.array(*(of(label, rx) for label, rx in ENTITY_PATTERNS)))
    rows = chunks.where(F.length(text) >= least).select(key, F.explode(found).alias("e")).select(key, "e.*")
    return rows.groupBy(key, "label", "entity").agg(F.count(F.lit(1)).alias("mentions"))


def retrieval_prior(m: dict[str, Column], quality: Column, intent_penalty: float = 0.70) -> Column:
    """Additive prior of a chunk from its metadata; identifiers count 0.35 each up to 1.20."""
    tier, domain = m["authority_tier"], m["business_domain"]
    plus = lambda test, x: F.when(test, F.lit(x)).otherwise(F.lit(0.0))
    return F.round(
        plus(tier == "dm_restricted", 1.25) + plus(tier == "customer_deliverable", 0.75) + plus(tier == "operational_working", 0.25)
        + plus(m["table_heavy"] & (domain == "logistics"), 0.80) + plus(domain == "logistics", 0.55) + plus(domain == "cybersecurity", 0.75)
        + plus(m["is_visual_heavy"], -0.65) + plus(quality < 0.45, -0.40) + plus(m["is_archive_derived"], -intent_penalty)
        + F.least(F.lit(1.2), m["identifier_count"] * F.lit(0.35)), 4,
    )


__all__ = ["ENTITY_PATTERNS", "T", "metadata_columns", "pattern_entities", "retrieval_prior", "with_metadata"]
