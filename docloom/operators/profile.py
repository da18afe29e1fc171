"""Profile of a source tree: extensions, folders, signals, names, recursive folder signatures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import paths as P

#: fixed values: kinds of files by extension
IMAGES = (".jpg", ".jpeg", ".png", ".gif", ".bmp", ".webp", ".tif", ".tiff", ".svg", ".wmf", ".emf")
ARCHIVES = (".zip", ".7z", ".rar", ".tar", ".tgz", ".gz", ".bz2", ".xz")
DRAWINGS = (".drawio", ".dia", ".dxf", ".dwg", ".vsdx", ".svg", ".stp", ".step", ".ste", ".igs", ".iges", ".stl")
#: fixed values: words that say nothing in a file name
STOP_TOKENS = ("and", "for", "the", "with", "from", "that", "this", "into", "scan", "copy", "draft", "final", "file", "page", "img")
SIDECAR_SIGNALS = ("ocr_sidecar_djvu_txt", "ocr_sidecar_djvu_xml", "ocr_sidecar_hocr_html")


def tree(files: DataFrame, root: Column | None = None) -> DataFrame:
    """``files`` (path, size) with rel, name, ext (``[no_ext]`` for none), top_level."""
    p = P.norm_path(F.col("path"))
    rel = P.relative_to(F.col("path"), root) if root is not None else p
    return files.withColumn("rel", rel).withColumn("name", P.basename(F.col("path"))).withColumn("ext", P.ext_or(F.col("path"), "[no_ext]")).withColumn("top_level", P.top_level(F.col("rel")))


def signals(name: Column, ext: Column, rel: Column) -> Column:
    n = F.lower(name)
    image = ext.isin(*IMAGES)
    tests = [
        (F.endswith(n, F.lit("_djvu.txt")), "ocr_sidecar_djvu_txt"),
        (F.endswith(n, F.lit("_djvu.xml")), "ocr_sidecar_djvu_xml"),
        (F.endswith(n, F.lit("_hocr.html")), "ocr_sidecar_hocr_html"),
        (F.contains(n, F.lit("spectrogram")) & image, "spectrogram_image"),
        (F.contains(n, F.lit("encrypted")) & (ext == ".pdf"), "encrypted_pdf_name"),
        (F.contains(n, F.lit("scan")) & image, "scan_named_image"),
        (F.contains(rel, F.lit(".thumbs/")), "thumbnail_cache_asset"),
        (ext.isin(*ARCHIVES), "archive_container"),
        (ext.isin(*DRAWINGS), "drawing_or_diagram_asset"),
        (image, "image_asset"),
    ]
    return F.array_compact(F.array(*(F.when(t, s) for t, s in tests)))


def ext_histogram(t: DataFrame) -> DataFrame:
    return t.groupBy("ext").agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"))


def folder_rollup(t: DataFrame) -> DataFrame:
    """Folder x extension counts with subtotals (null stands for all)."""
    return t.rollup("top_level", "ext").agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"))


def folder_profile(t: DataFrame, top: int = 5) -> DataFrame:
    """Per top-level folder: files, dominant extensions (ties by name), shares of images, drawings and archives, side products."""
    by_ext = t.groupBy("top_level", "ext").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.exists(signals(F.col("name"), F.col("ext"), F.col("rel")), lambda s: s.isin(*SIDECAR_SIGNALS))).alias("side"))
    ranked = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "ext"))), 1, top)
    share = lambda kinds: F.round(F.sum(F.when(F.col("ext").isin(*kinds), F.col("n")).otherwise(0)) / F.sum("n"), 3)
    g = by_ext.groupBy("top_level").agg(F.sum("n").alias("files"), ranked.alias("r"), share(IMAGES).alias("image_ratio"), share(DRAWINGS).alias("drawing_ratio"), share(ARCHIVES).alias("archive_ratio"), F.sum("side").alias("ocr_sidecars"))
    return g.select("top_level", "files", F.array_join(F.transform("r", lambda x: F.concat(x["ext"], F.lit("="), (-x["m"]).cast("string"))), ",").alias("dominant"), "image_ratio", "drawing_ratio", "archive_ratio", "ocr_sidecars")


def signal_counts(t: DataFrame, examples: int = 5) -> DataFrame:
    """Files per signal and the first ``examples`` paths; only bounded lists are ever collected."""
    rows = t.select("rel", F.explode(signals(F.col("name"), F.col("ext"), F.col("rel"))).alias("signal"))
    from ..plans.topk import first_k

    first = first_k(rows, ["signal"], "rel", examples).groupBy("signal").agg(F.array_join(F.array_sort(F.collect_list("rel")), "|").alias("examples"))
    return rows.groupBy("signal").agg(F.count(F.lit(1)).alias("files")).join(first, "signal")


def name_tokens(t: DataFrame) -> DataFrame:
    tokens = F.regexp_extract_all(F.lower(P.stem(F.col("path"))), F.lit(r"[a-z]{3,}"), F.lit(0))
    return t.select(F.explode(tokens).alias("token")).where(~F.col("token").isin(*STOP_TOKENS)).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def repeated_dirs(t: DataFrame) -> DataFrame:
    """Directory names that occur at more than one place."""
    p = P.parts(F.col("path"))
    at = F.transform(F.sequence(F.lit(1), F.size(p)), lambda i: F.struct(F.element_at(p, i).alias("name"), F.array_join(F.slice(p, 1, i), "/").alias("full")))
    dirs = t.where(F.size(p) > 0).select(F.explode(at).alias("d")).select("d.*").distinct()
    return dirs.groupBy("name").agg(F.count(F.lit(1)).alias("places")).where("places > 1")


def folder_signatures(t: DataFrame, least_files: int = 3) -> DataFrame:
    """Groups of folders with the same recursive content: ``signature, folders, descendants, sample``.

    Each ancestor folder gets a commutative fingerprint of its descendants (name below the folder, extension, size): count, and the sums of
    the two halves of the SHA-256's first 16 bytes. So the fingerprint is pre-aggregated, and no folder's list of files is ever collected.
    """
    p = F.split(P.norm_path(F.col("path")), "/")
    levels = F.sequence(F.lit(1), F.size(p) - 1)
    rows = t.where(F.size(p) > 1).select("size", "ext", p.alias("p"), F.explode(levels).alias("k"))
    inner = F.concat_ws("|", F.array_join(F.slice("p", F.col("k") + 1, F.size("p")), "/"), "ext", F.col("size").cast("string"))
    half = lambda a: F.conv(F.substring(F.sha2(inner, 256), a, 8), 16, 10).cast("decimal(20,0)")
    folders = rows.groupBy(F.array_join(F.slice("p", 1, F.col("k")), "/").alias("folder")).agg(F.count(F.lit(1)).alias("descendants"), F.sum(half(1)).alias("a"), F.sum(half(9)).alias("b")).where(F.col("descendants") >= least_files)
    g = folders.groupBy("descendants", "a", "b").agg(F.count(F.lit(1)).alias("folders"), F.min("folder").alias("sample")).where("folders > 1")
    return g.select(F.concat_ws("-", F.col("descendants").cast("string"), F.col("a").cast("string"), F.col("b").cast("string")).alias("signature"), "folders", "descendants", "sample")


def recommendations(t: DataFrame, least_files: int = 3) -> DataFrame:
    """Advice lines from the profile's totals and from folders of the same content (with at least ``least_files`` files)."""
    s = signals(F.col("name"), F.col("ext"), F.col("rel"))
    a = t.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.exists(s, lambda x: x.isin(*SIDECAR_SIGNALS))).alias("side"), F.count_if(F.array_contains(s, "encrypted_pdf_name")).alias("enc"), F.count_if(F.array_contains(s, "image_asset")).alias("img"))
    a = a.withColumn("twins", folder_signatures(t, least_files).agg(F.count(F.lit(1)).alias("n")).scalar())
    lines = F.array_compact(F.array(F.when(F.col("side") > 0, "skip_ocr_sidecars"), F.when(F.col("enc") > 0, "review_encrypted_pdfs"), F.when(F.col("twins") > 0, "audit_duplicate_folders"), F.when(F.col("img") > 0.2 * F.col("n"), "separate_image_assets")))
    return a.select(F.explode(F.when(F.size(lines) > 0, lines).otherwise(F.array(F.lit("no_action")))).alias("recommendation"))
