"""Registered queries of the core operators, each with its DuckDB counterpart over the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import paths as P
from .functions import text as T
from .functions import vectors as V
from .operators import artifacts, audit, chunking, delta, exact_dedup, family_dedup, metadata, profile, skip
from .plans.topk import first_k, with_ordinal

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# --- SQL counterparts of the column functions -------------------------------------------------------------------------------------

WHITE = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


# The lists that the SQL states itself, so that a wrong list of an operator shows as a difference.
Q_IMAGES = "('.jpg', '.jpeg', '.png', '.gif', '.bmp', '.webp', '.tif', '.tiff', '.svg', '.wmf', '.emf')"
Q_ARCHIVES = "('.zip', '.7z', '.rar', '.tar', '.tgz', '.gz', '.bz2', '.xz')"
Q_DRAWINGS = "('.drawio', '.dia', '.dxf', '.dwg', '.vsdx', '.svg', '.stp', '.step', '.ste', '.igs', '.iges', '.stl')"
Q_STOP_TOKENS = "('and', 'for', 'the', 'with', 'from', 'that', 'this', 'into', 'scan', 'copy', 'draft', 'final', 'file', 'page', 'img')"
Q_BOILERPLATE = ("previous", "next", "navigation", "table of contents", "show source")
Q_PAGE_LINE = r"^(page \d+ of \d+|page \d+|\d+/\d+|\d+|printed on .+|generated on .+|created on .+)$"
Q_FAMILIES = {
    "travel_admin": ("itinerary", "travel approval", "receipts", "packing list"), "inventory_manifest": ("inventory", "manifest"), "image_photo": ("photo", "image", "picture"), "logs": ("desktop_log", "desktop log", "/logs/"),
    "archive_derived": ("/archive/", "specialfiles"), "drawing_diagram": ("drawing", "diagram"), "calibration_cert": ("calibration", "certificate", "cert of", "certification"),
}
Q_SPECIAL_DIRS = "('packing list', 'site inventory', 'pictures', 'photos', 'itinerary', 'archive', 'receipts', 'drawings', 'images')"
Q_DOMAINS = [("logistics", "packing|supply|inventory|manifest|receipt|purchase|shipment"), ("cybersecurity", "cyber|scan|vulnerab|firewall"), ("site_visit", "site visit|site_visit|travel|itinerary"), ("engineering", "drawing|calibration|test report|test_report|power"), ("program", "program|contract|quality"), ("sysadmin", "log|radio|network")]
Q_PICTURES = "('.jpg', '.jpeg', '.png', '.gif', '.bmp', '.tif', '.tiff', '.webp')"
Q_PLANS = "('.dwg', '.dxf', '.dwf', '.vsdx', '.drawio')"
Q_VISUAL = "('.jpg', '.jpeg', '.png', '.gif', '.bmp', '.tif', '.tiff', '.webp', '.dwg', '.dxf', '.dwf', '.vsdx', '.drawio')"
Q_ENTITIES = [
    ("PART_NUMBER", r"\b(PN|QX|TM|LT)-\d{2,6}\b"), ("WORK_ORDER", r"\bWO-\d{2,6}\b"), ("SERIAL_NUMBER", r"\bSN-\d{2,6}\b"), ("DATE", r"\b\d{1,2} (January|February|March|April|May|June|July|August|September|October|November|December) \d{4}\b"),
    ("MEASURE", r"\b\d+(\.\d+)? (psi|mm|kg|volts|ohms|hours|degrees|newton meters)\b"), ("EMAIL", r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"),
]


def q_strip(c: str) -> str:
    return f"regexp_replace({c}, '^{WHITE}+|{WHITE}+$', '', 'g')"


def q_norm(c: str) -> str:
    return rf"replace({c}, '\', '/')"


def q_base(c: str) -> str:
    return f"regexp_extract({q_norm(c)}, '[^/]*$')"


def q_ext(c: str) -> str:
    return rf"lower(regexp_extract({q_base(c)}, '[^.].*(\.[^.]+)$', 1))"


def q_stem(c: str) -> str:
    return f"(CASE WHEN {q_ext(c)} = '' THEN {q_base(c)} ELSE substring({q_base(c)}, 1, length({q_base(c)}) - length({q_ext(c)})) END)"


def q_parent(c: str) -> str:
    return f"regexp_extract({q_norm(c)}, '^(.*)/[^/]*$', 1)"


def q_list(xs) -> str:
    return "(" + ", ".join("'" + x.replace("'", "''") + "'" for x in xs) + ")"


LATEST_STATE = """latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY recorded_at DESC, status DESC, path DESC, hash DESC NULLS LAST, mtime DESC NULLS LAST, size DESC) AS rn FROM file_state) WHERE rn = 1)"""
DELTA_ONE = """d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY found_at DESC, hash DESC NULLS LAST) AS rn FROM delta_path) WHERE rn = 1)"""
EXT_LABEL = f"CASE WHEN {q_ext('path')} = '' THEN '[no_ext]' ELSE {q_ext('path')} END"
REL = f"(CASE WHEN starts_with({q_norm('path')}, rtrim({q_norm('source_root')}, '/') || '/') THEN substring({q_norm('path')}, length(rtrim({q_norm('source_root')}, '/')) + 2) ELSE {q_norm('path')} END)"
TREE = f"{LATEST_STATE}, t AS (SELECT path, size, {REL} AS rel, {q_base('path')} AS name, {EXT_LABEL} AS ext, CASE WHEN instr({REL}, '/') > 0 THEN split_part({REL}, '/', 1) ELSE '(root)' END AS top_level FROM latest)"
SIG = "list_filter([" + ", ".join(
    f"CASE WHEN {c} THEN '{n}' END"
    for c, n in [
        ("ends_with(lower(name), '_djvu.txt')", "ocr_sidecar_djvu_txt"), ("ends_with(lower(name), '_djvu.xml')", "ocr_sidecar_djvu_xml"), ("ends_with(lower(name), '_hocr.html')", "ocr_sidecar_hocr_html"),
        (f"contains(lower(name), 'spectrogram') AND ext IN {Q_IMAGES}", "spectrogram_image"), ("contains(lower(name), 'encrypted') AND ext = '.pdf'", "encrypted_pdf_name"),
        (f"contains(lower(name), 'scan') AND ext IN {Q_IMAGES}", "scan_named_image"), ("contains(rel, '.thumbs/')", "thumbnail_cache_asset"),
        (f"ext IN {Q_ARCHIVES}", "archive_container"), (f"ext IN {Q_DRAWINGS}", "drawing_or_diagram_asset"), (f"ext IN {Q_IMAGES}", "image_asset"),
    ]
) + "], lambda x: x IS NOT NULL)"


def _tree(spark: SparkSession, sf: str) -> DataFrame:
    return profile.tree(exact_dedup.latest_state(_t(spark, sf, "file_state")).select("path", "size", "source_root"), F.col("source_root"))


def _delta_one(spark: SparkSession, sf: str) -> DataFrame:
    d = _t(spark, sf, "delta_path")
    return d.groupBy("file_id").agg(F.max(F.struct("found_at", "hash", "path", "mtime", "size", "source_root", "batch_no")).alias("s")).select("file_id", "s.*")


# --- sources, scans, splits -------------------------------------------------------------------------------------------------------


@query(f"WITH {LATEST_STATE} SELECT row_number() OVER (ORDER BY {q_norm('path')}, file_id) AS ordinal, file_id, {q_norm('path')} AS path, {EXT_LABEL} AS ext, size FROM latest")
def scan_files(spark, sf):
    """Ordered file scan with a global ordinal."""
    f = exact_dedup.latest_state(_t(spark, sf, "file_state")).select("file_id", P.norm_path(F.col("path")).alias("path"), P.ext_or(F.col("path"), "[no_ext]").alias("ext"), "size")
    return with_ordinal(f, "path", "file_id").select("ordinal", "file_id", "path", "ext", "size")


SUPPORTED = (".txt", ".md", ".csv", ".tsv", ".htm", ".html", ".pdf", ".doc", ".docx", ".xlsx", ".xls", ".ppt", ".pptx", ".eml", ".msg", ".zip", ".jpg", ".tif", ".png", ".xml", ".json", ".rtf", ".log")
DEFERRED = (".dwf", ".dwg", ".sao", ".rsf", ".stp", ".igs", ".stl", ".dxf", ".svg", ".psd")
SPLIT = f"CASE WHEN {q_ext('path')} IN {q_list(DEFERRED)} THEN 'deferred' WHEN {q_ext('path')} IN {q_list(SUPPORTED)} THEN 'supported' ELSE 'unsupported' END"


@query(f"WITH {LATEST_STATE} SELECT {SPLIT} AS class, {EXT_LABEL} AS ext, count(*) AS files FROM latest GROUP BY 1, 2")
def candidate_split(spark, sf):
    """Deferred, supported and unsupported candidates by extension."""
    e = P.ext(F.col("path"))
    c = F.when(e.isin(*DEFERRED), "deferred").when(e.isin(*SUPPORTED), "supported").otherwise("unsupported")
    return exact_dedup.latest_state(_t(spark, sf, "file_state")).groupBy(c.alias("class"), P.ext_or(F.col("path"), "[no_ext]").alias("ext")).agg(F.count(F.lit(1)).alias("files"))


@query(f"SELECT DISTINCT lower({q_norm('path')}) AS path FROM delta_path WHERE trim(path) <> '' AND NOT starts_with(trim(path), '#')")
def input_list(spark, sf):
    """Input list: blanks and comments dropped, paths once without letter case."""
    d = _t(spark, sf, "delta_path")
    return d.where((F.trim("path") != "") & ~F.startswith(F.trim("path"), F.lit("#"))).select(F.lower(P.norm_path(F.col("path"))).alias("path")).distinct()


@query(f"WITH {TREE} SELECT ext, count(*) AS files, sum(size)::BIGINT AS bytes FROM t GROUP BY ext")
def ext_histogram(spark, sf):
    return profile.ext_histogram(_tree(spark, sf))


@query(f"WITH {TREE} SELECT top_level, ext, count(*) AS files, sum(size)::BIGINT AS bytes FROM t GROUP BY ROLLUP (top_level, ext)")
def folder_ext_rollup(spark, sf):
    return profile.folder_rollup(_tree(spark, sf))


_SH = lambda xs: f"round(sum(CASE WHEN ext IN {xs} THEN n ELSE 0 END) / sum(n), 3)"


@query(
    f"""WITH {TREE}, e AS (SELECT top_level, ext, count(*) AS n, count(*) FILTER (WHERE ends_with(lower(name), '_djvu.txt') OR ends_with(lower(name), '_djvu.xml') OR ends_with(lower(name), '_hocr.html')) AS side FROM t GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY top_level ORDER BY n DESC, ext) AS k FROM e)
    SELECT top_level, sum(n)::BIGINT AS files, string_agg(CASE WHEN k <= 5 THEN ext || '=' || n END, ',' ORDER BY k) AS dominant, {_SH(Q_IMAGES)} AS image_ratio, {_SH(Q_DRAWINGS)} AS drawing_ratio, {_SH(Q_ARCHIVES)} AS archive_ratio, sum(side)::BIGINT AS ocr_sidecars FROM r GROUP BY 1"""
)
def folder_profile(spark, sf):
    return profile.folder_profile(_tree(spark, sf))


@query(f"WITH {TREE}, s AS (SELECT rel, unnest({SIG}) AS signal FROM t), r AS (SELECT signal, rel, row_number() OVER (PARTITION BY signal ORDER BY rel) AS k FROM (SELECT DISTINCT * FROM s)) SELECT c.signal, c.files, r.examples FROM (SELECT signal, count(*) AS files FROM s GROUP BY 1) c JOIN (SELECT signal, string_agg(rel, '|' ORDER BY rel) AS examples FROM r WHERE k <= 5 GROUP BY 1) r USING (signal)")
def signal_counts(spark, sf):
    return profile.signal_counts(_tree(spark, sf))


@query(f"WITH {TREE} SELECT token, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower({q_stem('path')}), '[a-z]{{3,}}')) AS token FROM t) WHERE token NOT IN {Q_STOP_TOKENS} GROUP BY 1")
def filename_tokens(spark, sf):
    return profile.name_tokens(_tree(spark, sf))


@query(
    f"""WITH {TREE}, p AS (SELECT DISTINCT list_filter(string_split({q_parent('path')}, '/'), lambda x: x <> '') AS p FROM t), d AS (SELECT p[i] AS name, array_to_string(p[1:i], '/') AS "full" FROM (SELECT p, unnest(range(1, len(p) + 1)) AS i FROM p))
    SELECT name, count(DISTINCT "full") AS places FROM d GROUP BY 1 HAVING count(DISTINCT "full") > 1"""
)
def repeated_dirs(spark, sf):
    return profile.repeated_dirs(_tree(spark, sf))


@query(
    f"""WITH {TREE}, x AS (SELECT size, ext, string_split({q_norm('path')}, '/') AS p FROM t), l AS (SELECT size, ext, p, unnest(range(1, len(p))) AS k FROM x WHERE len(p) > 1),
    h AS (SELECT array_to_string(p[1:k], '/') AS folder, sha256(array_to_string(p[k + 1:], '/') || '|' || ext || '|' || size) AS s FROM l),
    f AS (SELECT folder, count(*) AS descendants, sum(('0x' || substring(s, 1, 8))::BIGINT)::BIGINT AS a, sum(('0x' || substring(s, 9, 8))::BIGINT)::BIGINT AS b FROM h GROUP BY 1 HAVING count(*) >= 1)
    SELECT descendants || '-' || a || '-' || b AS signature, count(*) AS folders, descendants, min(folder) AS sample FROM f GROUP BY descendants, a, b HAVING count(*) > 1"""
)
def folder_signatures(spark, sf):
    return profile.folder_signatures(_tree(spark, sf), 1)


@query(
    f"""WITH {TREE}, z AS (SELECT rel, size, ext, string_split({q_norm('path')}, '/') AS p FROM t), y AS (SELECT size, ext, p, unnest(range(1, len(p))) AS k FROM z WHERE len(p) > 1),
    g AS (SELECT array_to_string(p[1:k], '/') AS folder, string_agg(array_to_string(p[k + 1:], '/') || '|' || ext || '|' || size, chr(10) ORDER BY array_to_string(p[k + 1:], '/'), ext, size) AS lines FROM y GROUP BY 1 HAVING count(*) >= 3),
    a AS (SELECT (SELECT count(*) FROM (SELECT lines FROM g GROUP BY 1 HAVING count(*) > 1)) AS twins, count(*) AS n, count(*) FILTER (WHERE len(list_filter(s, lambda x: starts_with(x, 'ocr_sidecar'))) > 0) AS side, count(*) FILTER (WHERE list_contains(s, 'encrypted_pdf_name')) AS enc, count(*) FILTER (WHERE list_contains(s, 'image_asset')) AS img FROM (SELECT {SIG} AS s FROM t)),
    r AS (SELECT unnest(list_filter([CASE WHEN side > 0 THEN 'skip_ocr_sidecars' END, CASE WHEN enc > 0 THEN 'review_encrypted_pdfs' END, CASE WHEN twins > 0 THEN 'audit_duplicate_folders' END, CASE WHEN img > 0.2 * n THEN 'separate_image_assets' END], lambda x: x IS NOT NULL)) AS recommendation FROM a)
    SELECT recommendation FROM r UNION ALL SELECT 'no_action' WHERE NOT EXISTS (SELECT 1 FROM r)"""
)
def profile_recommendations(spark, sf):
    return profile.recommendations(_tree(spark, sf))


# --- skip rules -------------------------------------------------------------------------------------------------------------------

POLICY = skip.SkipPolicy(deferred={".dwf": "Design Web Format", ".sao": "Deferred by config for this run", ".rsf": "Deferred by config for this run", ".dwg": "Deferred by config for this run"}, over_size_mb=3)


def _q_reason(p: skip.SkipPolicy) -> str:
    n, e = q_base("path"), q_ext("path")
    lit = lambda s: "'" + s.replace("'", "''") + "'"
    w = ["WHEN size = 0 THEN 'zero-byte file'"]
    w += [f"WHEN starts_with({n}, {lit(x)}) THEN {lit(f"temp file prefix '{x}'")}" for x in p.temp_prefixes]
    w += [f"WHEN {e} = {lit(x)} THEN {lit(f"temp file extension '{x}'")}" for x in p.temp_extensions]
    w.append(f"WHEN size > {p.over_size_mb * 1048576} THEN 'over size limit ({p.over_size_mb} MB)'")
    w += [f"WHEN ends_with(lower({n}), {lit(x)}) THEN {lit(f'OCR sidecar artifact ({x})')}" for x in p.sidecars]
    w += [f"WHEN regexp_matches(lower({n}), {lit(rf'(?:^|[^a-z0-9]){x}(?:$|[^a-z0-9])')}) THEN {lit(f"encrypted file (filename cue: '{x}')")}" for x in p.cues]
    w += [f"WHEN {e} = {lit(x)} THEN {lit(r)}" for x, r in p.deferred.items()]
    return "CASE " + " ".join(w) + " END"


SKIPPED = f"{LATEST_STATE}, s AS (SELECT file_id, path, size, {_q_reason(POLICY)} AS reason, CASE WHEN {q_ext('path')} IN {q_list(POLICY.deferred)} THEN 'deferred' ELSE 'skipped' END AS status FROM latest)"


def _skipped(spark, sf):
    f = exact_dedup.latest_state(_t(spark, sf, "file_state")).select("file_id", "path", "size", "mtime")
    f = f.withColumn("reason", skip.skip_reason(F.col("path"), F.col("size"), POLICY)).where("reason is not null")
    return f.withColumn("status", F.when(P.ext(F.col("path")).isin(*POLICY.deferred), "deferred").otherwise("skipped"))


@query(f"WITH {SKIPPED} SELECT file_id, path, size, reason, status FROM s WHERE reason IS NOT NULL")
def skip_reasons(spark, sf):
    return _skipped(spark, sf).select("file_id", "path", "size", "reason", "status")


@query(f"WITH {SKIPPED}, n AS (SELECT reason, count(*) AS n FROM s WHERE reason IS NOT NULL GROUP BY 1) SELECT string_agg(n || ' ' || reason, ', ' ORDER BY n DESC, reason) AS summary FROM n")
def skip_summary(spark, sf):
    return skip.reason_summary(_skipped(spark, sf))


@query(f"WITH {SKIPPED} SELECT {q_ext('path')} AS ext, status, count(*) AS files FROM s WHERE reason IS NOT NULL GROUP BY 1, 2")
def skip_extensions(spark, sf):
    return _skipped(spark, sf).groupBy(P.ext(F.col("path")).alias("ext"), "status").agg(F.count(F.lit(1)).alias("files"))


@query(
    f"""WITH {SKIPPED} SELECT s.file_id, s.reason, s.status, h.sha256 FROM s LEFT JOIN (SELECT p, max(sha256) AS sha256, mtime, size FROM (SELECT {q_norm('path')} AS p, hash AS sha256, mtime, size FROM file_state) GROUP BY p, mtime, size) h
    ON {q_norm('s.path')} = h.p AND s.size = h.size AND (SELECT l.mtime FROM latest l WHERE l.file_id = s.file_id) = h.mtime WHERE s.reason IS NOT NULL"""
)
def skip_records(spark, sf):
    """Stored hash of skipped files, reused only on exactly equal stamps."""
    st = _t(spark, sf, "file_state").groupBy(P.norm_path(F.col("path")).alias("_p"), F.col("mtime").alias("_m"), F.col("size").alias("_z")).agg(F.max("hash").alias("sha256"))
    j = _skipped(spark, sf).withColumn("_p", P.norm_path(F.col("path")))
    return j.join(st, (j["_p"] == st["_p"]) & (j["mtime"] == st["_m"]) & (j["size"] == st["_z"]), "left").select("file_id", "reason", "status", "sha256")


@query(f"WITH {LATEST_STATE} SELECT CASE WHEN {q_ext('path')} IN {q_list(DEFERRED)} THEN 'deferred' WHEN {q_ext('path')} IN {q_list(SUPPORTED)} THEN 'parseable' ELSE 'unsupported' END AS class, status, count(*) AS files FROM latest WHERE status IN ('skipped', 'unsupported', 'deferred') GROUP BY 1, 2")
def backfill_classes(spark, sf):
    f = exact_dedup.latest_state(_t(spark, sf, "file_state")).where(F.col("status").isin("skipped", "unsupported", "deferred"))
    return f.groupBy(skip.backfill_class(F.col("path"), list(SUPPORTED), list(DEFERRED)).alias("class"), "status").agg(F.count(F.lit(1)).alias("files"))


@query(f"WITH {LATEST_STATE} SELECT file_id, len(list_filter(string_split(lower({q_base('path')}), '.')[2:], lambda x: x IN ('sao', 'rsf'))) > 0 AS deferred FROM latest WHERE {q_ext('path')} IN ('.zip', '.tar', '.gz', '.tgz', '.sao', '.rsf')")
def archive_defer(spark, sf):
    """Archives whose name holds a deferred dot segment."""
    f = exact_dedup.latest_state(_t(spark, sf, "file_state")).where(P.ext(F.col("path")).isin(".zip", ".tar", ".gz", ".tgz", ".sao", ".rsf"))
    seg = F.split(F.lower(P.basename(F.col("path"))), r"\.")
    return f.select("file_id", F.exists(F.slice(seg, 2, F.size(seg)), lambda x: x.isin("sao", "rsf")).alias("deferred"))


# --- exact dedup and delta --------------------------------------------------------------------------------------------------------

HASHED = "l AS (SELECT file_id AS ordinal, path, lower(hash) AS hash FROM latest WHERE hash IS NOT NULL)"


@query(f"WITH {LATEST_STATE}, {HASHED} SELECT ordinal, hash, ordinal = min(ordinal) OVER (PARTITION BY hash) AS first FROM l")
def exact_dedup_first(spark, sf):
    f = exact_dedup.latest_state(_t(spark, sf, "file_state")).where("hash is not null").select(F.col("file_id").alias("ordinal"), F.lower("hash").alias("hash"))
    return exact_dedup.first_by_hash(f).select("ordinal", "hash", "first")


_Q_SUF = f"regexp_extract({q_stem('path')}, '^(.+?)_(\\d+)$', 1)"


@query(
    f"""WITH {LATEST_STATE}, n AS (SELECT {q_norm('path')} AS path, hash, {q_parent('path')} || '/' || {_Q_SUF} || substring({q_base('path')}, length({q_stem('path')}) + 1) AS original FROM latest WHERE {_Q_SUF} <> '' AND hash IS NOT NULL)
    SELECT DISTINCT n.path, n.original FROM n JOIN latest o ON {q_norm('o.path')} = n.original AND lower(o.hash) = lower(n.hash)"""
)
def suffix_duplicates(spark, sf):
    f = exact_dedup.latest_state(_t(spark, sf, "file_state")).select(P.norm_path(F.col("path")).alias("path"), "hash")
    return exact_dedup.suffix_copies(f)


STATE_BY_PATH = f"st AS (SELECT p, hash, mtime, size, status FROM (SELECT {q_norm('path')} AS p, *, row_number() OVER (PARTITION BY {q_norm('path')} ORDER BY recorded_at DESC, status DESC, file_id DESC) AS rn FROM file_state) WHERE rn = 1)"


def _state_by_path(spark, sf):
    s = _t(spark, sf, "file_state").withColumn("path", P.norm_path(F.col("path")))
    return s.groupBy("path").agg(F.max(F.struct("recorded_at", "status", "file_id", "hash", "mtime", "size")).alias("s")).select("path", "s.hash", "s.mtime", "s.size", "s.status")


_STAMP = "coalesce(f.size = st.size AND abs(f.mtime - st.mtime) < 2.0, false)"
_Q_SUFP = _Q_SUF


@query(
    f"""WITH {DELTA_ONE}, {STATE_BY_PATH}, f AS (SELECT file_id AS ordinal, path, {q_norm('path')} AS p, hash, mtime, size FROM d),
    j AS (SELECT f.ordinal, f.path, f.p, lower(CASE WHEN {_STAMP} AND st.hash IS NOT NULL THEN st.hash ELSE f.hash END) AS hash,
      CASE WHEN {_STAMP} AND st.status = 'indexed' THEN 'unchanged' WHEN {_STAMP} AND st.status = 'duplicate' THEN 'duplicate' WHEN st.status = 'indexed' AND lower(st.hash) = lower(CASE WHEN {_STAMP} AND st.hash IS NOT NULL THEN st.hash ELSE f.hash END) THEN 'unchanged' END AS early
      FROM f LEFT JOIN st ON f.p = st.p),
    c AS (SELECT DISTINCT n.p FROM (SELECT p, hash, {q_parent('p')} || '/' || {_Q_SUF.replace("path", "p")} || substring({q_base('p')}, length({q_stem('p')}) + 1) AS original FROM j WHERE {_Q_SUF.replace("path", "p")} <> '' AND hash IS NOT NULL) n JOIN j o ON o.p = n.original AND o.hash = n.hash),
    e AS (SELECT j.ordinal, j.path, j.hash, coalesce(early, CASE WHEN c.p IS NOT NULL THEN 'duplicate' END) AS early FROM j LEFT JOIN c ON j.p = c.p)
    SELECT ordinal, path, coalesce(early, CASE WHEN hash IS NULL OR ordinal = min(ordinal) OVER (PARTITION BY hash, early IS NULL) THEN 'work' ELSE 'duplicate' END) AS decision FROM e"""
)
def state_classify(spark, sf):
    """Incremental decision of each delta file against the state."""
    f = _delta_one(spark, sf).select(F.col("file_id").alias("ordinal"), "path", F.lower("hash").alias("hash"), "mtime", "size")
    s = _state_by_path(spark, sf).withColumn("hash", F.lower("hash"))
    return exact_dedup.classify(f, s).select("ordinal", "path", "decision")


_KIND = f"CASE WHEN st.p IS NULL THEN 'new' WHEN {_STAMP} AND st.status = 'mirrored' THEN 'unchanged' WHEN {_STAMP} THEN 'resumed' ELSE 'changed' END"
SCANNED = f"{DELTA_ONE}, {STATE_BY_PATH}, k AS (SELECT f.file_id, f.path, f.size, {_KIND} AS delta_kind FROM d f LEFT JOIN st ON {q_norm('f.path')} = st.p)"


def _scanned(spark, sf):
    return delta.delta_scan(_delta_one(spark, sf).select("file_id", "path", "mtime", "size"), _state_by_path(spark, sf))


@query(f"WITH {SCANNED} SELECT file_id, path, delta_kind FROM k")
def delta_classify(spark, sf):
    return _scanned(spark, sf).select("file_id", "path", "delta_kind")


@query(f"WITH {SCANNED} SELECT count(*) AS total_files, count(*) FILTER (WHERE delta_kind = 'new') AS new_files, count(*) FILTER (WHERE delta_kind = 'changed') AS changed_files, count(*) FILTER (WHERE delta_kind = 'resumed') AS resumed_files, count(*) FILTER (WHERE delta_kind = 'unchanged') AS unchanged_files, count(*) FILTER (WHERE delta_kind <> 'unchanged') AS delta_files FROM k")
def delta_summary(spark, sf):
    return delta.delta_summary(_scanned(spark, sf))


@query(f"SELECT DISTINCT {q_norm('path')} AS path FROM file_state WHERE starts_with({q_norm('path')}, 'X:/intake/iris_field/') AND {q_norm('path')} NOT IN (SELECT {q_norm('path')} FROM delta_path)")
def delta_deleted(spark, sf):
    return delta.deleted(_t(spark, sf, "delta_path"), _t(spark, sf, "file_state"), "X:/intake/iris_field")


CANARIES = ["*scan*.jpg", "*.zip", "x:/intake/iris_*/*"]
_CAN = f"(regexp_matches(lower({q_base('path')}), '(?s)^.*scan.*\\.jpg$') OR regexp_matches(lower({q_base('path')}), '(?s)^.*\\.zip$') OR regexp_matches(lower({q_norm('path')}), '(?s)^x:/intake/iris_.*/.*$') OR regexp_matches(lower({q_norm('path')}), '(?s)^.*scan.*\\.jpg$'))"


@query(f"WITH {SCANNED} SELECT file_id, path FROM k WHERE {_CAN}")
def canary_matches(spark, sf):
    return _scanned(spark, sf).where(P.matches_globs(F.col("path"), CANARIES)).select("file_id", "path")


@query(f"WITH {SCANNED} SELECT count(*) FILTER (WHERE {_CAN} AND delta_kind <> 'unchanged') AS canaries, CASE WHEN count(*) FILTER (WHERE {_CAN} AND delta_kind <> 'unchanged') > 0 THEN 'PASS' ELSE 'FAIL' END AS gate FROM k")
def canary_gate(spark, sf):
    return delta.canary_gate(_scanned(spark, sf), CANARIES)


_RELD = REL.replace("source_root", "source_root")


@query(
    f"""WITH {DELTA_ONE}, s AS (SELECT {REL} AS rel, max(size) AS size, max(lower(hash)) AS hash FROM d GROUP BY 1), m AS (SELECT {REL} AS rel, max(size) AS size, max(lower(hash)) AS hash FROM file_state GROUP BY 1)
    SELECT s.rel, CASE WHEN m.size IS NULL THEN 'new' WHEN s.size <> m.size THEN 'changed' WHEN s.hash <> m.hash THEN 'changed' ELSE 'same' END AS kind, CASE WHEN m.size IS NULL THEN NULL WHEN s.size <> m.size THEN 'size' WHEN s.hash <> m.hash THEN 'hash' END AS reason FROM s LEFT JOIN m USING (rel)"""
)
def mirror_delta(spark, sf):
    one = lambda df: df.groupBy(P.relative_to(F.col("path"), F.col("source_root")).alias("rel")).agg(F.max("size").alias("size"), F.max(F.lower("hash")).alias("hash"))
    return delta.mirror_delta(one(_delta_one(spark, sf)), one(_t(spark, sf, "file_state")))


@query(f"WITH {DELTA_ONE} SELECT file_id, path FROM d WHERE NOT EXISTS (SELECT 1 FROM file_state s WHERE {q_norm('s.path')} = {q_norm('d.path')} AND lower(s.hash) = lower(d.hash))")
def resume_plan(spark, sf):
    return delta.resume_plan(_delta_one(spark, sf).select("file_id", "path", "hash"), _t(spark, sf, "file_state").select("path", "hash")).select("file_id", "path")


@query(f"WITH {DELTA_ONE}, {STATE_BY_PATH}, n AS (SELECT {q_norm('path')} AS path, max(hash) AS hash, max(size) AS size FROM d GROUP BY 1) SELECT p AS path, hash, size, status FROM st WHERE p NOT IN (SELECT path FROM n) UNION ALL SELECT path, hash, size, 'hashed' FROM n")
def state_upsert(spark, sf):
    new = _delta_one(spark, sf).groupBy(P.norm_path(F.col("path")).alias("path")).agg(F.max("hash").alias("hash"), F.max("size").alias("size")).withColumn("status", F.lit("hashed"))
    return exact_dedup.upsert_state(_state_by_path(spark, sf).select("path", "hash", "size", "status"), new)


@query(f"WITH {DELTA_ONE} SELECT file_id, path FROM d WHERE {q_norm('path')} NOT IN (SELECT {q_norm('path')} FROM file_state WHERE status = 'duplicate')")
def canonical_snapshot(spark, sf):
    return exact_dedup.canonical_snapshot(_delta_one(spark, sf).select("file_id", "path"), _t(spark, sf, "file_state"))


# --- text functions ---------------------------------------------------------------------------------------------------------------

_PRINT = r"[\p{Cc}\p{Cf}\p{Co}\p{Zl}\p{Zp}\x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}]"


def q_print_share(c: str) -> str:
    bad = rf"(length({c}) - length(regexp_replace({c}, '{_PRINT}', '', 'g')) - (length({c}) - length(regexp_replace({c}, '[\n\r\t]', '', 'g'))))"
    return f"((length({c}) - {bad})::DOUBLE / nullif(length({c}), 0))"


def q_alpha_share(c: str) -> str:
    return rf"(length(regexp_replace({c}, '[^\p{{L}}]', '', 'g'))::DOUBLE / nullif(length({c}), 0))"


_HITS = " + ".join(f"contains(lower(sample), '{m}')::INT" for m in Q_BOILERPLATE)


@query(
    f"""WITH s AS (SELECT file_id, coalesce(text, '') AS raw, {q_strip("coalesce(text, '')")} AS "full" FROM parsed_document), x AS (SELECT *, substring("full", 1, 2000) AS sample FROM s)
    SELECT file_id, CASE WHEN "full" = '' THEN 0.0::DOUBLE WHEN length("full") < 50 THEN 0.3 WHEN {q_print_share('sample')} < 0.7 THEN 0.1 WHEN {q_alpha_share('sample')} < 0.2 THEN 0.3 WHEN {_HITS} >= 3 THEN 0.4 WHEN {q_alpha_share('sample')} > 0.5 AND {q_print_share('sample')} > 0.95 THEN 1.0 ELSE 0.8 END::DOUBLE AS quality,
    CASE WHEN "full" = '' THEN 0.0::DOUBLE WHEN {q_print_share('substring(raw, 1, 2000)')} < 0.8 THEN 0.2 WHEN length("full") < 50 THEN 0.5 ELSE 1.0 END::DOUBLE AS text_quality,
    CASE WHEN "full" = '' THEN 0.0::DOUBLE WHEN length("full") < 50 THEN 0.3 WHEN {q_alpha_share('"full"')} < 0.3 THEN 0.4 ELSE 0.9 END::DOUBLE AS ocr_quality FROM x"""
)
def quality_score(spark, sf):
    """The three text quality scorers."""
    c = F.col("text")
    return _t(spark, sf, "parsed_document").select("file_id", T.parse_quality(c).alias("quality"), T.text_file_quality(c).alias("text_quality"), T.ocr_quality(c).alias("ocr_quality"))


_BUCKET = "CASE WHEN parse_quality IS NULL THEN 'missing' WHEN parse_quality >= 0.95 THEN '0.95-1.00' WHEN parse_quality >= 0.85 THEN '0.85-0.94' WHEN parse_quality >= 0.70 THEN '0.70-0.84' ELSE '<0.70' END"


@query(f"SELECT {_BUCKET} AS bucket, count(*) AS documents FROM documents GROUP BY 1")
def quality_buckets(spark, sf):
    return _t(spark, sf, "documents").groupBy(T.quality_bucket(F.col("parse_quality")).alias("bucket")).agg(F.count(F.lit(1)).alias("documents"))


_SOLID = "regexp_replace(text, '\\s', '', 'g')"


@query(rf"SELECT file_id, coalesce(length({_SOLID}) >= 80 AND length(regexp_replace({_SOLID}, '[^\p{{Nd}}]', '', 'g')) >= 0.55 * length({_SOLID}) AND length(regexp_replace({_SOLID}, '[^\p{{L}}]', '', 'g')) <= 0.2 * length({_SOLID}), false) AS numeric_dump FROM parsed_document")
def numeric_dump(spark, sf):
    return _t(spark, sf, "parsed_document").select("file_id", T.numeric_dump(F.col("text")).alias("numeric_dump"))


_FLAT = q_strip("regexp_replace(coalesce(text, ''), '[\\t\\n\\x0B\\f\\r ]+', ' ', 'g')")


@query(f"SELECT doc_id, CASE WHEN length({_FLAT}) <= 180 THEN {_FLAT} ELSE {q_strip(f'substring({_FLAT}, 1, 177)')} || '...' END AS preview FROM documents")
def previews(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", T.preview(F.col("text")).alias("preview"))


_NT = r"regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g'), '([\p{L}\p{N}_])-\n([\p{L}\p{N}_])', '\1\2', 'g'), '[ \t]+', ' ', 'g')"
_NL = f"list_filter(list_transform(string_split({_NT}, chr(10)), lambda x: lower({q_strip('x')})), lambda x: x <> '' AND NOT regexp_matches(x, '{Q_PAGE_LINE}'))"


@query(
    f"""WITH l AS (SELECT file_id, {_NL} AS l FROM parsed_document), u AS (SELECT file_id, l, unnest(range(1, len(l) + 1)) AS i FROM l), w AS (SELECT file_id, l[i] AS x, i FROM u),
    c AS (SELECT *, count(*) OVER (PARTITION BY file_id, x) AS n FROM w), k AS (SELECT file_id, string_agg(x, chr(10) ORDER BY i) FILTER (WHERE NOT (n >= 3 AND length(x) <= 120)) AS kept, string_agg(x, chr(10) ORDER BY i) AS whole FROM c GROUP BY 1)
    SELECT p.file_id, sha256(coalesce(k.kept, k.whole, '')) AS normalized_hash, length(coalesce(k.kept, k.whole, '')) AS normalized_chars FROM parsed_document p LEFT JOIN k USING (file_id)"""
)
def normalized_text_hash(spark, sf):
    n = T.normalized_text(F.col("text"))
    return _t(spark, sf, "parsed_document").select("file_id", n.alias("n")).select("file_id", F.sha2("n", 256).alias("normalized_hash"), F.length("n").alias("normalized_chars"))


_SK1 = f"replace(lower({q_stem('path')}), '&', ' and ')"
_SK2 = rf"regexp_replace({_SK1}, '(?:[_\-\s]|\()\d{{1,3}}\)?$', '')"
_SK3 = rf"regexp_replace({_SK2}, '(?:[\s_\-]copy|[\s_\-]final|[\s_\-]signed|[\s_\-]scan(?:ned)?|[\s_\-]ocr)+$', '')"
_SK4 = f"array_to_string(regexp_extract_all({_SK3}, '[a-z0-9]+'), ' ')"
STEM_KEY = f"CASE WHEN {_SK4} = '' THEN lower({q_stem('path')}) ELSE {_SK4} END"


@query(f"SELECT file_id, {STEM_KEY} AS stem_key FROM fingerprinted_document")
def stem_keys(spark, sf):
    return _t(spark, sf, "fingerprinted_document").select("file_id", T.stem_key(P.stem(F.col("path"))).alias("stem_key"))


_TAGS = r"regexp_replace(regexp_replace(h, '(?is)<script[^>]*>.*?</script>', '', 'g'), '(?is)<style[^>]*>.*?</style>', '', 'g')"
_HTML = "'<html><head><style>p {color: red}</style><SCRIPT>var a = 1;</SCRIPT></head><body><h1>' || coalesce(source, '') || '</h1><p class=\"x\">' || coalesce(text, '') || '</p></body></html>'"


@query(f"SELECT doc_id, {q_strip(rf"regexp_replace(regexp_replace({_TAGS}, '<[^>]+>', ' ', 'g'), '[\t\n\x0B\f\r ]+', ' ', 'g')")} AS html_text FROM (SELECT doc_id, {_HTML} AS h FROM documents)")
def html_text(spark, sf):
    h = F.concat(F.lit("<html><head><style>p {color: red}</style><SCRIPT>var a = 1;</SCRIPT></head><body><h1>"), F.coalesce("source", F.lit("")), F.lit('</h1><p class="x">'), F.coalesce("text", F.lit("")), F.lit("</p></body></html>"))
    return _t(spark, sf, "documents").select("doc_id", T.html_text(h).alias("html_text"))


_EV = "'<Event><System><Provider Name=''' || event_type || '''/><EventID>' || event_id || '</EventID><TimeCreated SystemTime=''' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '''/></System><EventData><Data>' || user_id || '</Data><Data>' || event_type || '</Data></EventData></Event>'"


@query(f"SELECT event_id, '[' || regexp_extract(x, '<TimeCreated[^>]*?SystemTime=[''\"]([^''\"]+)[''\"]', 1) || '] EventID=' || regexp_extract(x, '<EventID[^>]*?>([^<]+)<', 1) || ' Provider=' || regexp_extract(x, '<Provider\\s+Name=[''\"]([^''\"]+)[''\"]', 1) || ' | ' || array_to_string(regexp_extract_all(x, '<Data[^>]*>([^<]+)</Data>', 1)[1:5], ' ') AS line FROM (SELECT event_id, {_EV} AS x FROM events)")
def event_log_lines(spark, sf):
    e = _t(spark, sf, "events")
    x = F.concat(F.lit("<Event><System><Provider Name='"), "event_type", F.lit("'/><EventID>"), F.col("event_id").cast("string"), F.lit("</EventID><TimeCreated SystemTime='"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("'/></System><EventData><Data>"), F.col("user_id").cast("string"), F.lit("</Data><Data>"), "event_type", F.lit("</Data></EventData></Event>"))
    return e.select("event_id", T.event_line(x).alias("line"))


_WIN = """CASE WHEN n <= 56000 THEN doc WHEN pos < 0 THEN substring(doc, 1, 20000) ELSE
  (CASE WHEN s > 0 THEN '... ' ELSE '' END) || substring(doc, s + 1, e - s) || (CASE WHEN e < n THEN ' ...' ELSE '' END) END"""


@query(
    f"""WITH b AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN repeat('- ', 20000) || text || repeat(' +', 20000) WHEN 1 THEN text ELSE text || repeat(' +', 40000) END AS doc, substring(text, 1, 1200) AS piece FROM documents WHERE text <> ''), x AS (SELECT *, length(doc) AS n, length(piece) AS m, instr(doc, substring(piece, 1, 200)) - 1 AS pos FROM b),
    y AS (SELECT *, greatest(0, pos - 10000) AS s0, least(n, pos + m + 10000) AS e0 FROM x), z AS (SELECT *, CASE WHEN s0 = 0 THEN least(n, 20000) ELSE e0 END AS e, CASE WHEN s0 <> 0 AND e0 = n THEN greatest(0, n - 20000) ELSE s0 END AS s FROM y),
    c AS (SELECT doc_id, {_WIN} AS context FROM z) SELECT doc_id, length(context) AS chars, sha256(context) AS context_hash FROM c"""
)
def context_windows(spark, sf):
    """Windows of 20,000 characters around the beginning of each text, set into longer documents or left alone."""
    t = F.col("text")
    pad = lambda x: F.repeat(F.lit(x), F.lit(20_000))
    doc = F.when(F.col("doc_id") % 3 == 0, F.concat(pad("- "), t, pad(" +"))).when(F.col("doc_id") % 3 == 1, t).otherwise(F.concat(t, pad(" +"), pad(" +")))
    d = _t(spark, sf, "documents").where("text <> ''").select("doc_id", T.context_window(doc, F.substring(t, 1, 1200)).alias("context"))
    return d.select("doc_id", F.length("context").alias("chars"), F.sha2("context", 256).alias("context_hash"))


@query("SELECT doc_id, CASE WHEN length(source) > 10 THEN source || chr(10) || chr(10) || text END AS enriched_text, greatest(1, length(coalesce(text, '')) // 4)::INT AS tokens FROM documents")
def enriched_text(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", T.enriched(F.col("source"), F.col("text")).alias("enriched_text"), T.token_estimate(F.col("text")).alias("tokens"))


RULES = [(r"\b[a-z]{2}-\d+\b", "<code>"), (r"\d+(?:\.\d+)? psi", "<pressure>"), ("harbor", "harbour")]
_RW = "coalesce(text, '')"
for _p, _to in RULES:
    _RW = f"regexp_replace({_RW}, '(?i){_p}', '{_to}', 'g')"


@query(f"SELECT doc_id, {_RW} AS text FROM documents")
def text_rewrite(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", T.rewrite(F.coalesce("text", F.lit("")), RULES).alias("text"))


@query("SELECT doc_id, contains(lower(coalesce(text, '')), '[sheet]') AS sheet, contains(lower(coalesce(text, '')), 'eventid=') AS event, replace(replace(coalesce(source, ''), '|', '\\|'), chr(10), ' ') AS cell FROM documents")
def text_markers(spark, sf):
    low = F.lower(F.coalesce("text", F.lit("")))
    return _t(spark, sf, "documents").select("doc_id", F.contains(low, F.lit("[sheet]")).alias("sheet"), F.contains(low, F.lit("eventid=")).alias("event"), T.markdown_cell(F.col("source")).alias("cell"))


GLOBS = ["*.csv", "*invoice*", "x:/intake/mail_*/*"]


@query(
    f"""SELECT doc_id, array_to_string(list_filter([CASE WHEN regexp_matches(lower({q_norm('source_path')}), '(?s)^.*\\.csv$') THEN '*.csv' END, CASE WHEN regexp_matches(lower({q_norm('source_path')}), '(?s)^.*invoice.*$') THEN '*invoice*' END, CASE WHEN regexp_matches(lower({q_norm('source_path')}), '(?s)^x:/intake/mail_.*/.*$') THEN 'x:/intake/mail_*/*' END], lambda x: x IS NOT NULL), ',') AS hits FROM documents"""
)
def glob_hits(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", F.array_join(P.glob_hits(F.col("source_path"), GLOBS), ",").alias("hits"))


@query(f"SELECT doc_id, 'File: ' || {q_base('source_path')} || chr(10) || 'Type: ' || {q_ext('source_path')} || chr(10) || 'Size: ' || n_chars AS card, 0.15::DOUBLE AS parse_quality FROM documents WHERE {q_ext('source_path')} IN ('.ppt', '.doc', '.pdf')")
def placeholder_cards(spark, sf):
    """Identity cards of formats without a parser."""
    p = F.col("source_path")
    d = _t(spark, sf, "documents").where(P.ext(p).isin(".ppt", ".doc", ".pdf"))
    return d.select("doc_id", F.concat_ws("\n", F.concat(F.lit("File: "), P.basename(p)), F.concat(F.lit("Type: "), P.ext(p)), F.concat(F.lit("Size: "), F.col("n_chars").cast("string"))).alias("card"), F.lit(0.15).alias("parse_quality"))


@query("WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events) SELECT user_id, string_agg(event_type || ':' || event_id, chr(10) ORDER BY ts, event_id) FILTER (WHERE k <= 200) AS body, count(*) AS messages FROM r GROUP BY 1")
def mbox_assembly(spark, sf):
    """The first 200 messages of each box in order, as the mail parser reads them, and the number of all; a box is one user's events."""
    e = _t(spark, sf, "events").select("user_id", F.struct("ts", "event_id", "event_type").alias("m"))
    body = first_k(e, ["user_id"], "m", 200).groupBy("user_id").agg(F.array_sort(F.collect_list("m")).alias("m"))
    total = e.groupBy("user_id").agg(F.count(F.lit(1)).alias("messages"))
    return total.join(body, "user_id").select("user_id", F.array_join(F.transform("m", lambda x: F.concat(x["event_type"], F.lit(":"), x["event_id"].cast("string"))), "\n").alias("body"), "messages")


# --- chunking ---------------------------------------------------------------------------------------------------------------------


def _q_rfind(window: str, mark: str) -> str:
    """0-based last place of ``mark`` in ``window``, or -1."""
    m = {"\n\n": "chr(10) || chr(10)", ". ": "'. '", "\n": "chr(10)"}[mark]
    r = {"\n\n": "chr(10) || chr(10)", ". ": "' .'", "\n": "chr(10)"}[mark]
    return f"(CASE WHEN contains({window}, {m}) THEN length({window}) - instr(reverse({window}), {r}) - {len(mark)} + 1 ELSE -1 END)"


def _q_end(st: str) -> str:
    w = f"substring(text, {st} + 600 + 1, 600)"
    return f"(CASE WHEN {st} + 1200 >= n THEN n WHEN {_q_rfind(w, chr(10) * 2)} >= 0 THEN {st} + 600 + {_q_rfind(w, chr(10) * 2)} + 2 WHEN {_q_rfind(w, '. ')} >= 0 THEN {st} + 600 + {_q_rfind(w, '. ')} + 2 WHEN {_q_rfind(w, chr(10))} >= 0 THEN {st} + 600 + {_q_rfind(w, chr(10))} + 1 ELSE {st} + 1200 END)"


_HEADLINE = f"list_filter(list_transform(string_split(substring(text, greatest(0, st - 2000) + 1, st - greatest(0, st - 2000)), chr(10)), lambda x: {q_strip('x')}), lambda x: x <> '')[-1]"
CHUNKS = f"""RECURSIVE c AS (SELECT doc_id, text, length(text) AS n, 0 AS st, {_q_end('0')} AS en FROM (SELECT *, length(text) AS n FROM documents WHERE {q_strip("coalesce(text, '')")} <> '')
  UNION ALL SELECT doc_id, text, n, s2, {_q_end('s2')} FROM (SELECT *, greatest(en - 200, st + 1) AS s2 FROM c WHERE en < n)),
  p AS (SELECT doc_id, text, st, {q_strip('substring(text, st + 1, en - st)')} AS piece, coalesce({_HEADLINE}, '') AS line FROM c),
  h AS (SELECT *, CASE WHEN line <> '' AND length(line) <= 160 AND ((length(line) > 3 AND regexp_matches(line, '\\p{{Lu}}') AND NOT regexp_matches(line, '[\\p{{Ll}}\\p{{Lt}}]')) OR regexp_matches(line, '^\\d+(\\.\\d+)*\\s+') OR (ends_with(line, ':') AND length(line) < 80)) THEN line ELSE '' END AS head FROM p WHERE piece <> ''),
  k AS (SELECT doc_id, text, (row_number() OVER (PARTITION BY doc_id ORDER BY st) - 1)::INT AS chunk_index, CASE WHEN head <> '' AND NOT starts_with(piece, head) THEN '[SECTION] ' || head || chr(10) || piece ELSE piece END AS chunk_text FROM h),
  z AS (SELECT *, (instr(text, substring(chunk_text, 1, 100)) - 1)::INT AS chunk_start FROM k),
  chunks AS (SELECT doc_id, chunk_index, chunk_text, chunk_start, (CASE WHEN chunk_start >= 0 THEN chunk_start + length(chunk_text) ELSE chunk_index * 1200 END)::INT AS chunk_end FROM z)"""


def _chunks(spark, sf, *cols):
    return chunking.chunk_rows(_t(spark, sf, "documents").select("doc_id", *cols, "text"))


@query(f"WITH {CHUNKS} SELECT doc_id, chunk_index, chunk_text, chunk_start, chunk_end FROM chunks")
def chunk_rows(spark, sf):
    return _chunks(spark, sf)


_CID = f"sha256(concat_ws('|', lower({q_norm(q_strip('d.source_path'))}), '0', chunk_start, chunk_end, sha256(substring(chunk_text, 1, 2000))))"


@query(f"WITH {CHUNKS} SELECT doc_id, chunk_index, {_CID} AS chunk_id FROM chunks JOIN documents d USING (doc_id)")
def chunk_ids(spark, sf):
    c = _chunks(spark, sf, "source_path")
    return c.select("doc_id", "chunk_index", chunking.chunk_id(F.col("source_path"), F.lit(0), F.col("chunk_start"), F.col("chunk_end"), F.col("chunk_text")).alias("chunk_id"))


@query(f"WITH {CHUNKS}, e AS (SELECT CASE WHEN {q_ext('source_path')} = '' THEN '(no ext)' ELSE {q_ext('source_path')} END AS ext, doc_id, length(chunk_text) AS len FROM chunks JOIN documents USING (doc_id)) SELECT ext, count(*) AS chunks, count(DISTINCT doc_id) AS documents, sum(len)::BIGINT AS characters, round(sum(len) / count(*), 1) AS mean_length, round(count(*) / count(DISTINCT doc_id), 1) AS chunks_per_doc FROM e GROUP BY 1 ORDER BY chunks DESC, ext LIMIT 15")
def chunk_stats_by_ext(spark, sf):
    c = _chunks(spark, sf, "source_path")
    return artifacts.chunk_stats(c.select(P.ext_or(F.col("source_path"), "(no ext)").alias("ext"), F.col("doc_id").alias("doc"), F.length("chunk_text").alias("text_length")))


@query(f"WITH {CHUNKS}, g AS (SELECT chunk_text, count(*) AS n FROM chunks GROUP BY 1) SELECT count(*) AS unique_texts, sum(n - 1)::BIGINT AS duplicate_rows, max(n) AS most_copies FROM g")
def chunk_duplicates(spark, sf):
    return audit.duplicate_texts(_chunks(spark, sf), "chunk_text")


# --- families ---------------------------------------------------------------------------------------------------------------------

_RANK = "CASE WHEN parse_quality IS NULL OR isnan(parse_quality) THEN -1 ELSE parse_quality END DESC, CASE ext WHEN '.docx' THEN 3 WHEN '.doc' THEN 2 WHEN '.pdf' THEN 1 ELSE 0 END DESC, coalesce(normalized_chars, 0) DESC, lower(path) DESC"


@query(f"SELECT stem_key, path AS canonical_path, members FROM (SELECT *, row_number() OVER (PARTITION BY stem_key ORDER BY {_RANK}) AS rn, count(*) OVER (PARTITION BY stem_key) AS members FROM fingerprinted_document WHERE stem_key IS NOT NULL) WHERE rn = 1")
def family_canonical_rank(spark, sf):
    return family_dedup.canonical_of_family(_t(spark, sf, "fingerprinted_document"))


_TOK = "regexp_extract_all(lower(normalized_text), '[a-z0-9]+')"


@query(
    f"""WITH d AS (SELECT stem_key, normalized_text, min(file_id) AS file_id FROM fingerprinted_document WHERE normalized_chars >= 200 AND normalized_text IS NOT NULL GROUP BY 1, 2), t AS (SELECT stem_key, file_id, {_TOK} AS t FROM d),
    u AS (SELECT stem_key, file_id, list_distinct(CASE WHEN len(t) <= 5 THEN [array_to_string(t, ' ')] ELSE list_transform(range(1, len(t) - 3), lambda i: array_to_string(t[i:i + 4], ' ')) END) AS s FROM t)
    SELECT a.file_id AS a, b.file_id AS b, round(len(list_intersect(a.s, b.s)) / least(len(a.s), len(b.s)), 4) AS similarity FROM u a JOIN u b ON a.stem_key = b.stem_key AND a.file_id < b.file_id WHERE round(len(list_intersect(a.s, b.s)) / least(len(a.s), len(b.s)), 4) >= 0.9"""
)
def shingle_pairs(spark, sf):
    """Pairs of different texts of one family by 5-word containment."""
    return family_dedup.pair_scores(_t(spark, sf, "fingerprinted_document"))


@query()
def family_decisions(spark, sf):
    """Greedy leader decisions; tested against brute force."""
    return family_dedup.family_decisions(_t(spark, sf, "fingerprinted_document"))


DEC = "x AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY decided_at DESC, canonical_path DESC, status DESC, similarity DESC, ext DESC NULLS LAST, dedup_reason DESC) AS rn FROM document_dedup) WHERE rn = 1)"


def _decisions(spark, sf):
    d = _t(spark, sf, "document_dedup")
    return d.groupBy("file_id").agg(F.max(F.struct("decided_at", "canonical_path", "status", "similarity", "ext", "dedup_reason", "parse_quality")).alias("s")).select("file_id", "s.*")


_E = "lower(coalesce(ext, ''))"


@query(
    f"""WITH {DEC}, g AS (SELECT canonical_path, count(*) AS members, count(*) FILTER (WHERE status = 'duplicate') AS duplicates, max(similarity) FILTER (WHERE status = 'duplicate') AS max_similarity, min(similarity) FILTER (WHERE status = 'duplicate') AS min_similarity,
    bool_or({_E} = '.docx') AS dx, bool_or({_E} = '.doc') AS dc, bool_or({_E} = '.pdf') AS pd, bool_or(status = 'duplicate' AND dedup_reason = 'near_duplicate_same_stem' AND similarity < 0.95) AS nr, regexp_extract(lower(canonical_path), '[^./\\\\][^/\\\\]*(\\.[^./\\\\]+)$', 1) AS own FROM x WHERE canonical_path IS NOT NULL GROUP BY canonical_path HAVING count(*) FILTER (WHERE status = 'duplicate') > 0),
    f AS (SELECT *, list_filter([CASE WHEN dx AND own <> '.docx' THEN 'prefer_docx_if_parse_quality_is_close' END, CASE WHEN dc AND own = '.pdf' THEN 'prefer_editable_source_over_pdf' END, CASE WHEN pd AND (dx OR dc) THEN 'mixed_format_family' END, CASE WHEN nr THEN 'review_near_duplicate_threshold' END], lambda x: x IS NOT NULL) AS fl FROM g)
    SELECT canonical_path, members, duplicates, max_similarity, min_similarity, CASE WHEN len(fl) > 0 THEN 'review_canonical_choice' ELSE 'keep_canonical_choice' END AS recommendation, CASE WHEN len(fl) > 0 THEN array_to_string(fl, ',') ELSE 'low_risk_family' END AS flags FROM f"""
)
def review_families(spark, sf):
    return family_dedup.review_families(_decisions(spark, sf))


@query(f"WITH {DEC} SELECT dedup_reason, count(*) AS files, round(100.0 * count(*) / (SELECT count(*) FROM x), 2) AS share FROM x GROUP BY 1")
def dedup_reason_counts(spark, sf):
    x = _decisions(spark, sf)
    n = x.agg(F.count(F.lit(1)).alias("n"))
    return x.groupBy("dedup_reason").agg(F.count(F.lit(1)).alias("files")).select("dedup_reason", "files", F.round(F.col("files") * 100.0 / n.scalar(), 2).alias("share"))


# --- export analytics -------------------------------------------------------------------------------------------------------------

_FAM = "list_filter([" + ", ".join("CASE WHEN " + " OR ".join(f"contains(p, '{w}')" for w in ws) + f" THEN '{n}' END" for n, ws in Q_FAMILIES.items()) + "], lambda x: x IS NOT NULL)"


@query(
    f"""WITH f AS (SELECT source_path, unnest({_FAM}) AS family FROM (SELECT source_path, lower({q_norm('source_path')}) AS p FROM documents WHERE source_path IS NOT NULL)), r AS (SELECT family, source_path, row_number() OVER (PARTITION BY family ORDER BY source_path) AS k FROM (SELECT DISTINCT * FROM f))
    SELECT a.family, a.documents, a.chunks, b.examples FROM (SELECT family, count(DISTINCT source_path) AS documents, count(*) AS chunks FROM f GROUP BY 1) a JOIN (SELECT family, string_agg(source_path, '|' ORDER BY source_path) AS examples FROM r WHERE k <= 5 GROUP BY 1) b USING (family)"""
)
def family_paths(spark, sf):
    return artifacts.family_counts(_t(spark, sf, "documents").where("source_path is not null").select("source_path", F.lit(1).cast("bigint").alias("chunks")))


@query(f"SELECT directory, count(*) AS hits FROM (SELECT unnest(list_transform(string_split({q_parent('source_path')}, '/'), lambda x: lower(x))) AS directory FROM parsed_document) WHERE directory IN {Q_SPECIAL_DIRS} GROUP BY 1")
def special_dirs(spark, sf):
    return artifacts.special_dirs(_t(spark, sf, "parsed_document"))


@query(f"SELECT file_id, {q_ext('source_path')} IN {Q_IMAGES} AS image, {q_ext('source_path')} IN {Q_ARCHIVES} AS archive, {q_ext('source_path')} IN {Q_DRAWINGS} AS drawing FROM parsed_document")
def path_flags(spark, sf):
    e = P.ext(F.col("source_path"))
    return _t(spark, sf, "parsed_document").select("file_id", e.isin(*profile.IMAGES).alias("image"), e.isin(*profile.ARCHIVES).alias("archive"), e.isin(*profile.DRAWINGS).alias("drawing"))


@query(
    f"""WITH d AS (SELECT DISTINCT lower({q_base('source_path')}) AS name, source_path FROM documents WHERE {q_base('source_path')} <> ''), n AS (SELECT name, count(*) AS paths FROM d GROUP BY 1 HAVING count(*) > 1 ORDER BY paths DESC, name LIMIT 25),
    r AS (SELECT d.name, source_path, row_number() OVER (PARTITION BY d.name ORDER BY source_path) AS k FROM d JOIN n USING (name)) SELECT n.name, n.paths, string_agg(source_path, '|' ORDER BY source_path) AS examples FROM n JOIN r USING (name) WHERE k <= 5 GROUP BY 1, 2"""
)
def reused_basenames(spark, sf):
    return artifacts.reused_basenames(_t(spark, sf, "documents").select("source_path"))


COVER = ["doc_id", "text", "lang", "source", "n_chars", "source_path", "file_ext", "parse_quality", "ingested_at", "authority_tier", "business_domain"]
_COV = " UNION ALL ".join(f"SELECT '{f}' AS field, count(*) FILTER (WHERE {f} IS NOT NULL" + (f" AND {f} <> ''" if f in ("text", "lang", "source", "source_path", "file_ext") else "") + ") AS present_rows, count(*) AS n FROM documents" if f not in ("authority_tier", "business_domain") else f"SELECT '{f}', 0, count(*) FROM documents" for f in COVER)


@query(f"SELECT field, present_rows, CASE WHEN n > 0 THEN round(present_rows * 100.0 / n, 2) ELSE 0.0 END::DOUBLE AS coverage_pct FROM ({_COV})")
def field_coverage(spark, sf):
    return audit.field_coverage(_t(spark, sf, "documents"), COVER)


@query(f"SELECT 'missing:' || field AS gap FROM ({_COV}) WHERE present_rows = 0")
def contract_gaps(spark, sf):
    return audit.contract_gaps(audit.field_coverage(_t(spark, sf, "documents"), COVER))


@query("SELECT count(*) AS rows, round(avg(parse_quality), 3) AS quality_avg, min(parse_quality) AS quality_min, max(parse_quality) AS quality_max, count(*) FILTER (WHERE parse_quality >= 0.9) AS q_high, count(*) FILTER (WHERE parse_quality >= 0.7 AND parse_quality < 0.9) AS q_good, count(*) FILTER (WHERE parse_quality >= 0.5 AND parse_quality < 0.7) AS q_fair, count(*) FILTER (WHERE parse_quality < 0.5) AS q_low, count(*) FILTER (WHERE parse_quality IS NULL) AS q_missing FROM documents")
def audit_summary(spark, sf):
    return audit.quality_summary(_t(spark, sf, "documents"))


_TX = "coalesce(text, '')"
_SO = f"regexp_replace({_TX}, '\\s', '', 'g')"
_ND = rf"(length({_SO}) >= 80 AND length(regexp_replace({_SO}, '[^\p{{Nd}}]', '', 'g')) >= 0.55 * length({_SO}) AND length(regexp_replace({_SO}, '[^\p{{L}}]', '', 'g')) <= 0.2 * length({_SO}))"
_GL = f"coalesce(regexp_matches(lower({q_norm('source_path')}), '(?s)^.*\\.sao\\.zip$') OR regexp_matches(lower({q_norm('source_path')}), '(?s)^.*order.*$'), false)"
_MK = f"(contains(lower({_TX}), '[content_types].xml') OR contains(lower({_TX}), '_rels/.rels'))"


@query(
    f"""SELECT count(*) AS total, count(*) FILTER (WHERE source_path IS NULL OR source_path = '') AS missing_path, count(*) FILTER (WHERE {q_strip(_TX)} = '') AS empty_text, count(*) FILTER (WHERE length({_TX}) <> n_chars) AS length_mismatch, count(*) FILTER (WHERE {_GL}) AS glob_hits, count(*) FILTER (WHERE {_MK}) AS marker_hits,
    count(*) FILTER (WHERE {_ND}) AS numeric_dumps, count(*) FILTER (WHERE ({_GL} OR {_MK} OR {_ND}) AND parse_quality >= 0.6) AS suspicious, CASE WHEN count(*) FILTER (WHERE {_GL}) > 0 THEN 'FAIL' ELSE 'PASS' END AS gate FROM documents"""
)
def inspect_counters(spark, sf):
    return audit.inspect(_t(spark, sf, "documents"), ["*.sao.zip", "*order*"], ["[content_types].xml", "_rels/.rels"], length="n_chars")


@query(
    """WITH c AS (SELECT doc_id AS k FROM documents), v AS (SELECT vec_id AS k, len(embedding) AS dim FROM embeddings), e AS (SELECT doc_id AS k FROM reading_label)
    SELECT (SELECT count(*) FROM c) AS chunks, (SELECT count(DISTINCT k) FROM c) AS distinct_ids, (SELECT count(*) FROM v) AS vectors, (SELECT count(DISTINCT dim) FROM v) AS dims, (SELECT count(*) FROM e) AS entities, (SELECT count(*) FROM c WHERE k NOT IN (SELECT k FROM v)) AS without_vector, (SELECT count(*) FROM e WHERE k NOT IN (SELECT k FROM c)) AS orphan_entities"""
)
def integrity_report(spark, sf):
    """Alignment of chunks, vectors and entities by key."""
    c = _t(spark, sf, "documents").select(F.col("doc_id").alias("chunk_id"))
    v = _t(spark, sf, "embeddings").select(F.col("vec_id").alias("chunk_id"), F.size("embedding").alias("dim"))
    e = _t(spark, sf, "reading_label").select(F.col("doc_id").alias("chunk_id"))
    m = spark.createDataFrame([(0, 0)], "chunk_count bigint, entity_count bigint")
    return audit.integrity(c, v, e, m).select("chunks", "distinct_ids", "vectors", "dims", "entities", "without_vector", "orphan_entities")


@query("SELECT d.doc_id, v.vec_id IS NOT NULL AS has_vector FROM documents d LEFT JOIN embeddings v ON d.doc_id = v.vec_id")
def vector_alignment(spark, sf):
    v = _t(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), F.lit(True).alias("has_vector"))
    return _t(spark, sf, "documents").select("doc_id").join(v, "doc_id", "left").select("doc_id", F.coalesce("has_vector", F.lit(False)).alias("has_vector"))


@query(
    "WITH q AS (SELECT vec_id AS query_id, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id % 100 = 0), s AS (SELECT query_id, v.vec_id, round(list_cosine_similarity(q.e, v.embedding::DOUBLE[]), 6) AS score FROM q, embeddings v WHERE v.vec_id <> query_id) SELECT query_id, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM s) WHERE k <= 5"
)
def vector_cosine_topk(spark, sf):
    """Five nearest vectors by cosine of every query (ids divisible by 100), against all rows, in blocks of queries."""
    from .operators.search import cosine_topk

    v = _t(spark, sf, "embeddings").select("vec_id", "embedding")
    return cosine_topk(v.where("vec_id % 100 = 0"), v, 5).select("query_id", "vec_id", "score")


_ENT = " UNION ALL ".join(rf"SELECT doc_id, '{label}' AS label, unnest(regexp_extract_all(text, '{rx}')) AS entity FROM documents WHERE length(text) >= 20" for label, rx in Q_ENTITIES)


@query(f"SELECT doc_id, label, entity, count(*) AS mentions FROM ({_ENT}) GROUP BY 1, 2, 3")
def entity_regex(spark, sf):
    return metadata.pattern_entities(_t(spark, sf, "documents"), "doc_id")


_P = f"lower({q_norm('source_path')})"
_DOM = "CASE " + " ".join(f"WHEN regexp_matches({_P}, '{rx}') THEN '{n}'" for n, rx in Q_DOMAINS) + " ELSE 'unknown' END"
_ARC = f"regexp_matches({_P}, '/archive/|\\.zip|_archive/')"
META = f"""m AS (SELECT doc_id, {q_ext('source_path')} AS source_ext, {_DOM} AS business_domain, {_ARC} AS is_archive_derived, CASE WHEN {_ARC} AND regexp_matches({_P}, '\\.zip') THEN 'archive_bundle_member' WHEN {_ARC} THEN 'archive_original' ELSE 'primary' END AS archive_class, (len(string_split({_P}, 'archive')) - 1)::INT AS archive_depth,
 CASE WHEN regexp_matches({_P}, 'restricted') THEN 'dm_restricted' WHEN regexp_matches({_P}, 'deliverable|final|signed|contract') THEN 'customer_deliverable' WHEN {_ARC} THEN 'archive_copy' WHEN {_DOM} <> 'unknown' THEN 'operational_working' ELSE 'unknown' END AS authority_tier,
 CASE WHEN {q_ext('source_path')} IN {Q_PLANS} THEN 'cad' WHEN contains({_P}, 'scan') AND {q_ext('source_path')} IN {Q_PICTURES} THEN 'scan' WHEN {q_ext('source_path')} IN {Q_PICTURES} THEN 'photo' WHEN regexp_matches({_P}, 'drawing|diagram') THEN 'drawing' ELSE 'none' END AS visual_family,
 {q_ext('source_path')} IN {Q_VISUAL} AS is_visual_heavy, (length(regexp_replace({_TX}, '[^|\\t]', '', 'g')) >= 10 OR contains({_TX}, '[SHEET]')) AS table_heavy, len(list_distinct(regexp_extract_all({_TX}, '\\b[A-Z]{{2}}-\\d{{2,6}}\\b')))::INT AS identifier_count, parse_quality,
 nullif(regexp_extract({_TX}, '\\b(PN-\\d{{2,6}})\\b', 1), '') AS log_part_number, nullif(lower(regexp_extract({_TX}, '(?i)\\b(low|medium|high|critical) severity', 1)), '') AS cyber_severity FROM documents)"""
META_OUT = ["source_ext", "business_domain", "is_archive_derived", "archive_class", "archive_depth", "authority_tier", "visual_family", "is_visual_heavy", "table_heavy", "identifier_count", "log_part_number", "cyber_severity"]


@query(f"WITH {META} SELECT doc_id, {', '.join(META_OUT)} FROM m")
def metadata_columns(spark, sf):
    return metadata.with_metadata(_t(spark, sf, "documents")).select("doc_id", *META_OUT)


@query(
    f"""WITH {META} SELECT doc_id, round(CASE authority_tier WHEN 'dm_restricted' THEN 1.25 WHEN 'customer_deliverable' THEN 0.75 WHEN 'operational_working' THEN 0.25 ELSE 0 END::DOUBLE + CASE WHEN table_heavy AND business_domain = 'logistics' THEN 0.8 ELSE 0 END::DOUBLE + CASE WHEN business_domain = 'logistics' THEN 0.55 ELSE 0 END::DOUBLE + CASE WHEN business_domain = 'cybersecurity' THEN 0.75 ELSE 0 END::DOUBLE
    - CASE WHEN is_visual_heavy THEN 0.65 ELSE 0 END::DOUBLE - CASE WHEN parse_quality < 0.45 THEN 0.4 ELSE 0 END::DOUBLE - CASE WHEN is_archive_derived THEN 0.7 ELSE 0 END::DOUBLE + least(1.2::DOUBLE, identifier_count * 0.35::DOUBLE), 4) AS prior FROM m"""
)
def rerank_prior(spark, sf):
    d = _t(spark, sf, "documents")
    m = metadata.metadata_columns(F.col("source_path"), F.col("text"), F.col("parse_quality"))
    return d.select("doc_id", metadata.retrieval_prior(m, F.col("parse_quality")).alias("prior"))


@query(f"WITH r AS (SELECT run_id, count(*) AS files_found, count(*) FILTER (WHERE {q_strip(_TX)} <> '') AS files_parsed, count(*) FILTER (WHERE {q_strip(_TX)} = '') AS errors, sum(ceil(length({_TX}) / 1000.0))::BIGINT AS chunks_created FROM parsed_document GROUP BY 1) SELECT *, array_to_string(list_filter([CASE WHEN chunks_created = 0 THEN 'zero_chunks' END, CASE WHEN files_parsed = 0 THEN 'zero_parsed' END, CASE WHEN errors > 0.5 * greatest(files_found, 1) THEN 'high_error_rate' END], lambda x: x IS NOT NULL), ',') AS failures, CASE WHEN files_parsed = 0 THEN 1 WHEN errors > 0 THEN 2 ELSE 0 END AS exit_code FROM r")
def run_sanity(spark, sf):
    t = F.coalesce("text", F.lit(""))
    r = _t(spark, sf, "parsed_document").groupBy("run_id").agg(F.count(F.lit(1)).alias("files_found"), F.count_if(P.strip(t) != "").alias("files_parsed"), F.count_if(P.strip(t) == "").alias("errors"), F.sum(F.ceil(F.length(t) / 1000.0)).cast("bigint").alias("chunks_created"))
    return audit.run_sanity(r)


@query("SELECT run_id, max(parsed_at) AS last FROM parsed_document GROUP BY 1 ORDER BY last DESC LIMIT 10")
def last_runs(spark, sf):
    h = _t(spark, sf, "parsed_document").groupBy("run_id").agg(F.max("parsed_at").alias("last"))
    return audit.last_runs(h, F.col("last"))


@query(f"SELECT coalesce(lower(file_ext), '') AS ext, count(*) AS files, count(*) FILTER (WHERE {q_strip(_TX)} <> '') AS parsed, sum(length({_TX}))::BIGINT AS characters FROM parsed_document GROUP BY 1")
def format_coverage(spark, sf):
    t = F.coalesce("text", F.lit(""))
    return _t(spark, sf, "parsed_document").groupBy(F.lower(F.coalesce("file_ext", F.lit(""))).alias("ext")).agg(F.count(F.lit(1)).alias("files"), F.count_if(P.strip(t) != "").alias("parsed"), F.sum(F.length(t)).alias("characters"))


@query(f"SELECT DISTINCT {q_norm('source_path')} AS source_path FROM documents WHERE source_path IS NOT NULL")
def exported_paths(spark, sf):
    return _t(spark, sf, "documents").where("source_path is not null").select(P.norm_path(F.col("source_path")).alias("source_path")).distinct()


@query("SELECT file_id, normalized_hash FROM fingerprinted_document WHERE file_id NOT IN (SELECT file_id FROM delta_path) UNION ALL SELECT file_id, max(hash) FROM delta_path GROUP BY 1")
def override_union(spark, sf):
    """Union in which the later source wins by key."""
    new = _t(spark, sf, "delta_path").groupBy("file_id").agg(F.max("hash").alias("normalized_hash"))
    return audit.alias_union(_t(spark, sf, "fingerprinted_document").select("file_id", "normalized_hash"), new, "file_id")


@query(f"WITH f AS (SELECT *, {_STAMP} AS same FROM delta_path f LEFT JOIN (SELECT {q_norm('path')} AS p, mtime AS mtime, size AS size FROM file_state) st ON {q_norm('f.path')} = st.p WHERE st.p IS NOT NULL) SELECT file_id, count(*) AS compared, count(*) FILTER (WHERE same) AS same FROM f GROUP BY 1".replace("SELECT *, coalesce", "SELECT f.file_id, coalesce"))
def stamp_matches(spark, sf):
    """Pairs of a delta row and a state row of the same path, and those with equal stamps."""
    s = _t(spark, sf, "file_state").select(P.norm_path(F.col("path")).alias("p"), F.col("mtime").alias("m"), F.col("size").alias("z"))
    j = _t(spark, sf, "delta_path").withColumn("p", P.norm_path(F.col("path"))).join(s, "p")
    same = F.coalesce(exact_dedup.same_stamp(F.col("mtime"), F.col("size"), F.col("m"), F.col("z")), F.lit(False))
    return j.groupBy("file_id").agg(F.count(F.lit(1)).alias("compared"), F.count_if(same).alias("same"))


@query("SELECT status, count(*) AS files, sum(size)::BIGINT AS bytes FROM file_state GROUP BY 1")
def transfer_counts(spark, sf):
    return _t(spark, sf, "file_state").groupBy("status").agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"))


LOG = "'[' || coalesce(file_ext, '') || '] Empty parse: ' || " + q_base("source_path")


@query(f"WITH l AS (SELECT {LOG} AS value FROM parsed_document WHERE {q_strip(_TX)} = '' OR parse_quality < 0.5) SELECT lower(regexp_extract(value, '^\\[\\.?([^\\]]+)\\]\\s*([^:]+):\\s*(.*)$', 1)) AS ext, regexp_extract(value, '^\\[\\.?([^\\]]+)\\]\\s*([^:]+):\\s*(.*)$', 2) AS cause, count(*) AS failures FROM l WHERE regexp_extract(value, '^\\[\\.?([^\\]]+)\\]\\s*([^:]+):\\s*(.*)$', 1) <> '' GROUP BY 1, 2")
def failure_log(spark, sf):
    """Failure lines by extension and cause."""
    d = _t(spark, sf, "parsed_document").where((P.strip(F.coalesce("text", F.lit(""))) == "") | (F.col("parse_quality") < 0.5))
    log = d.select(F.concat(F.lit("["), F.coalesce("file_ext", F.lit("")), F.lit("] Empty parse: "), P.basename(F.col("source_path"))).alias("value"))
    return artifacts.failure_lines(log).groupBy("ext", "cause").agg(F.count(F.lit(1)).alias("failures"))


KEYS = ["user_id", "value", "chunk_id"]


@query("SELECT event_id, array_to_string(list_filter(['user_id', 'value', 'chunk_id'], lambda k: NOT list_contains(json_keys(j), k)), ',') AS missing FROM (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN json_object('user_id', user_id, 'value', value) ELSE json_object('user_id', user_id) END AS j FROM events)")
def missing_keys(spark, sf):
    """Required keys that a JSON row lacks."""
    e = _t(spark, sf, "events")
    j = F.when(F.col("event_id") % 2 == 0, F.to_json(F.struct("user_id", "value"))).otherwise(F.to_json(F.struct("user_id")))
    return e.select("event_id", F.array_join(F.array_except(F.array(*map(F.lit, KEYS)), F.json_object_keys(j)), ",").alias("missing"))


@query(f"SELECT file_id, CASE WHEN starts_with({q_norm('path')}, 'X:/intake/') THEN '/mirror/' || substring({q_norm('path')}, 11) ELSE {q_norm('path')} END AS path FROM delta_path")
def path_relocation(spark, sf):
    return _t(spark, sf, "delta_path").select("file_id", P.relocate(F.col("path"), "X:\\intake", "/mirror").alias("path"))


@query("WITH r AS (SELECT batch_no, count(*) AS delta_files, count(*) FILTER (WHERE delta_kind IS NULL) AS failed FROM delta_path GROUP BY 1) SELECT batch_no, CASE WHEN delta_files = 0 THEN 'no_delta' WHEN delta_files < 5 THEN 'failed_no_canary' WHEN failed > 0 THEN 'transfer_partial' WHEN batch_no % 7 = 0 THEN 'pipeline_failed' ELSE 'success' END AS status FROM r")
def ingest_status(spark, sf):
    r = _t(spark, sf, "delta_path").groupBy("batch_no").agg(F.count(F.lit(1)).alias("delta_files"), F.count_if(F.col("delta_kind").isNull()).alias("failed"))
    return r.select("batch_no", delta.ingest_status(F.col("delta_files"), F.col("delta_files") >= 5, F.col("failed"), F.col("batch_no") % 7 == 0).alias("status"))


@query("SELECT kind, name, n FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY n DESC, name) AS k FROM (SELECT 'protocol' AS kind, event_type AS name, count(*) AS n FROM events GROUP BY 2 UNION ALL SELECT 'source', user_id::VARCHAR, count(*) FROM events GROUP BY 2)) WHERE k <= 10")
def capture_summary(spark, sf):
    """Top ten protocols and sources of a capture."""
    from pyspark.sql import Window as W

    e = _t(spark, sf, "events")
    x = F.explode(F.array(F.struct(F.lit("protocol").alias("kind"), F.col("event_type").alias("name")), F.struct(F.lit("source").alias("kind"), F.col("user_id").cast("string").alias("name"))))
    n = e.select(x.alias("x")).select("x.*").groupBy("kind", "name").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("k", F.row_number().over(W.partitionBy("kind").orderBy(F.desc("n"), "name"))).where("k <= 10").drop("k")


@query(f"WITH {DEC}, d AS (SELECT file_id, canonical_path FROM x WHERE status = 'duplicate') SELECT d.file_id, p.file_id AS canonical_id, p.parse_quality FROM d JOIN fingerprinted_document p ON {q_norm('d.canonical_path')} = {q_norm('p.path')}")
def duplicates_with_canonical(spark, sf):
    """Duplicates joined with the row of the file they point to."""
    d = _decisions(spark, sf).where("status = 'duplicate'").select("file_id", P.norm_path(F.col("canonical_path")).alias("p"))
    f = _t(spark, sf, "fingerprinted_document").select(P.norm_path(F.col("path")).alias("p"), F.col("file_id").alias("canonical_id"), "parse_quality")
    return d.join(f, "p").select("file_id", "canonical_id", "parse_quality")


_RUN = "list_filter(list_transform(regexp_extract_all(text, '[\\t\\n\\r -~]{8,}'), lambda x: " + q_strip("x") + "), lambda x: length(x) > 8 AND length(regexp_replace(x, '[^A-Za-z\\s]', '', 'g')) * 2 > length(x))"


@query(f"SELECT file_id, array_to_string({_RUN}, chr(10)) AS text FROM parsed_document WHERE text IS NOT NULL")
def byte_runs(spark, sf):
    """Printable runs of the texts' bytes."""
    d = _t(spark, sf, "parsed_document").where("text is not null")
    return d.select("file_id", T.byte_runs(F.encode("text", "UTF-8")).alias("text"))


_XML = "'<r><s>' || coalesce(source, '') || '</s>' || chr(10) || '<i> ' || n_chars || '</i></r>'"


@query(f"SELECT doc_id, array_to_string(list_filter(list_transform(string_split(regexp_replace({_XML}, '<[^>]+>', chr(10), 'g'), chr(10)), lambda x: {q_strip('x')}), lambda x: x <> ''), chr(10)) AS xml_text FROM documents")
def xml_text(spark, sf):
    x = F.concat(F.lit("<r><s>"), F.coalesce("source", F.lit("")), F.lit("</s>\n<i> "), F.col("n_chars").cast("string"), F.lit("</i></r>"))
    return _t(spark, sf, "documents").select("doc_id", T.xml_text(x).alias("xml_text"))


_LU = "list_distinct(list_filter(string_split(normalized_text, chr(10)), lambda x: x <> ''))"


@query(f"WITH f AS (SELECT file_id, normalized_hash, {_LU} AS u FROM fingerprinted_document WHERE normalized_hash <> '' AND normalized_text <> ''), m AS (SELECT normalized_hash, min(file_id) AS first FROM f GROUP BY 1 HAVING count(*) > 1) SELECT a.file_id AS first, b.file_id, round(len(list_intersect(a.u, b.u)) / least(len(a.u), len(b.u)), 4) AS line_similarity FROM m JOIN f a ON a.file_id = m.first JOIN f b ON b.normalized_hash = m.normalized_hash AND b.file_id > m.first")
def copies_with_first(spark, sf):
    """Line containment of each copy with the first document of its normalized hash; one row a copy, not a pair."""
    f = _t(spark, sf, "fingerprinted_document").where("normalized_hash <> '' and normalized_text <> ''").select("file_id", "normalized_hash", T.line_units(F.col("normalized_text")).alias("u"))
    first = f.groupBy("normalized_hash").agg(F.min(F.struct("file_id", "u")).alias("f"), F.count(F.lit(1)).alias("n")).where("n > 1").select("normalized_hash", F.col("f.file_id").alias("first"), F.col("f.u").alias("fu"))
    return f.join(first, "normalized_hash").where("file_id > first").select("first", "file_id", F.round(T.containment(F.col("fu"), F.col("u")), 4).alias("line_similarity"))


@query(
    """WITH RECURSIVE o AS (SELECT doc_id, (doc_id % 4)::INT AS part, greatest(1, length(coalesce(text, '')) // 4) AS t, row_number() OVER (PARTITION BY doc_id % 4 ORDER BY doc_id) AS k FROM documents),
    r AS (SELECT doc_id, part, k, 0 AS batch, 49152 - t AS room, 1 AS rows FROM o WHERE k = 1 UNION ALL
      SELECT o.doc_id, o.part, o.k, CASE WHEN x THEN batch + 1 ELSE batch END, CASE WHEN x THEN 49152 ELSE room END - t, CASE WHEN x THEN 1 ELSE rows + 1 END FROM (SELECT r.*, r.rows >= 256 OR (r.rows >= 8 AND r.room < n.t) AS x FROM r JOIN o n ON n.part = r.part AND n.k = r.k + 1) r JOIN o ON o.part = r.part AND o.k = r.k + 1)
    SELECT doc_id, part, batch FROM r"""
)
def token_batches(spark, sf):
    """Token-budget batches in order of doc_id, inside four parts."""
    from .operators.batches import assign_batches

    return assign_batches(_t(spark, sf, "documents").select("doc_id", "text"), part=F.col("doc_id") % 4)


@query(
    """WITH l AS (SELECT doc_id, list_transform(range(97, 123), lambda k: length(coalesce(text, '')) - length(replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), chr(k::INT), ''))) AS v FROM documents)
    SELECT doc_id, round(CASE WHEN list_sum(v) > 0 THEN v[5] / sqrt(list_sum(list_transform(v, lambda x: x * x))::DOUBLE) ELSE 0 END, 3) AS e, round(CASE WHEN list_sum(v) > 0 THEN v[20] / sqrt(list_sum(list_transform(v, lambda x: x * x))::DOUBLE) ELSE 0 END, 3) AS t FROM l"""
)
def letter_vectors(spark, sf):
    """Two components of each document's unit vector of letter counts, by the embedding operator."""
    from .operators import models

    v = models.embed(_t(spark, sf, "documents").select("doc_id", F.translate("text", "\u212a\u0130", "..").alias("text")), models.LetterEmbedder, "doc_id")
    return v.select("doc_id", F.round(F.get("vector", F.lit(4)).cast("double"), 3).alias("e"), F.round(F.get("vector", F.lit(19)).cast("double"), 3).alias("t"))


@query()
def embedded_chunks(spark, sf):
    """Chunk vectors from the deterministic stand-in model."""
    from .operators import models

    c = _chunks(spark, sf, "source_path").withColumn("chunk_id", chunking.chunk_id(F.col("source_path"), F.lit(0), F.col("chunk_start"), F.col("chunk_end"), F.col("chunk_text")))
    return models.embed(c.select("chunk_id", F.col("chunk_text").alias("text")), models.HashEmbedder)


@query(
    f"""WITH {CHUNKS}, said AS (SELECT doc_id || '-' || chunk_index AS chunk_id, chunk_text, substring(split_part(CASE WHEN length(d.text) <= 56000 OR instr(d.text, substring(chunk_text, 1, 200)) <= 10001 THEN d.text ELSE '... ' || substring(d.text, instr(d.text, substring(chunk_text, 1, 200)) - 10000) END, '. ', 1), 1, 150) AS p FROM chunks JOIN documents d USING (doc_id))
    SELECT chunk_id, CASE WHEN length(p) > 10 THEN p || chr(10) || chr(10) || chunk_text END AS enriched_text FROM said"""
)
def enriched_chunks(spark, sf):
    """Chunks enriched by the deterministic stand-in model: the context's first sentence."""
    from .operators import models

    c = _chunks(spark, sf).withColumn("chunk_id", F.concat_ws("-", "doc_id", "chunk_index"))
    return models.enrich(c.select("chunk_id", "doc_id", F.col("chunk_text").alias("text")), _t(spark, sf, "documents"))


from . import queries_exports  # noqa: E402, F401 - registers its queries

__all__ = ["Column", "V", "first_k", "oracle_sql", "queries"]
