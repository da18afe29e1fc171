"""Skip and defer rules: one first-hit-wins chain of Columns."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import paths as P
from ..functions.text import let

#: fixed values: OCR side products by suffix
OCR_SIDECARS = ("_djvu.xml", "_djvu.txt", "_hocr.html", "_marc.xml", "_meta.xml", "_scandata.xml", "_page_numbers.json", ".info.json", "_dc.xml", "_reviews.xml", "_toc.xml", "_mods.xml", "_extramarc.xml", "_asr.json", ".autogenerated.txt", "_ocr.pdf", "_ocr.txt")
#: fixed values: image assets
IMAGE_ASSETS = (".jpg", ".jpeg", ".png", ".gif", ".bmp", ".tif", ".tiff", ".webp", ".svg", ".wmf", ".emf", ".psd")
#: fixed values: cues of protected files in their names
ENCRYPTED_CUES = ("encrypted", "password-protected", "password_protected", "drm-protected", "drm_protected")
#: fixed values: signatures in hexadecimal
OLE_HEADER, PDF_HEADER = "D0CF11E0A1B11AE1", "25504446"
PDF_ENCRYPT, OLE_STREAMS = "2F456E6372797074", ("45006E006300720079007000740069006F006E0049006E0066006F00", "45006E0063007200790070007400650064005000610063006B00610067006500")
OOXML = (".docx", ".xlsx", ".pptx")


@dataclass(frozen=True)
class SkipPolicy:
    temp_prefixes: tuple[str, ...] = ("~$", "~")
    temp_extensions: tuple[str, ...] = (".tmp", ".partial", ".bak", ".swp")
    over_size_mb: int = 500
    zero_byte: bool = True
    encrypted: bool = True
    sidecars: tuple[str, ...] = OCR_SIDECARS
    images: tuple[str, ...] = IMAGE_ASSETS
    cues: tuple[str, ...] = ENCRYPTED_CUES
    ocr_mode: str = "auto"
    deferred: dict[str, str] = field(default_factory=lambda: {".dwf": "Design Web Format"})


def normalize_extensions(values: list[str]) -> list[str]:
    """Trimmed, lower-cased, with a dot, each once, in order."""
    out: dict[str, None] = {}
    for v in values:
        x = (v or "").strip().lower()
        if x:
            out["." + x.lstrip(".")] = None
    return list(out)


def encrypted_bytes(header: Column, ext: Column) -> Column:
    """Encryption marks in the first 4,096 bytes."""
    h = F.hex(F.substring(header, 1, 4096))
    ole = F.startswith(h, F.lit(OLE_HEADER))
    streams = F.contains(h, F.lit(OLE_STREAMS[0])) | F.contains(h, F.lit(OLE_STREAMS[1]))
    return F.coalesce((F.startswith(h, F.lit(PDF_HEADER)) & F.contains(h, F.lit(PDF_ENCRYPT))) | (ole & streams) | (ole & ext.isin(*OOXML)), F.lit(False))


def skip_reason(path: Column, size: Column, policy: SkipPolicy, header: Column | None = None) -> Column:
    """Reason of the first rule that hits, or null. Name and extension are computed once for all rules."""
    facts = F.struct(P.basename(path).alias("name"), F.lower(P.basename(path)).alias("low"), P.ext(path).alias("ext"), size.alias("size"), (F.lit(None).cast("binary") if header is None else header).alias("header"))
    return let(facts, lambda f: F.coalesce(*_rules(f["name"], f["low"], f["ext"], f["size"], None if header is None else f["header"], policy), F.lit(None).cast("string")))


def _rules(name: Column, low: Column, e: Column, size: Column, header: Column | None, policy: SkipPolicy) -> list[Column]:
    rules = []
    if policy.zero_byte:
        rules.append(F.when(size == 0, "zero-byte file"))
    rules += [F.when(F.startswith(name, F.lit(p)), F.lit(f"temp file prefix '{p}'")) for p in policy.temp_prefixes]
    rules += [F.when(e == x, F.lit(f"temp file extension '{x}'")) for x in policy.temp_extensions]
    rules.append(F.when(size > policy.over_size_mb * 1048576, F.lit(f"over size limit ({policy.over_size_mb} MB)")))
    rules += [F.when(F.endswith(low, F.lit(s)), F.lit(f"OCR sidecar artifact ({s})")) for s in policy.sidecars]
    if policy.ocr_mode == "skip":
        rules.append(F.when(e.isin(*policy.images), "image asset skipped (OCR mode skip)"))
    if policy.encrypted:
        if header is not None:
            rules.append(F.when(encrypted_bytes(header, e), "encrypted file (magic bytes)"))
        rules += [F.when(F.rlike(low, F.lit(rf"(?:^|[^a-z0-9]){t}(?:$|[^a-z0-9])")), F.lit(f"encrypted file (filename cue: '{t}')")) for t in policy.cues]
    return rules + [F.when(e == x, F.lit(r)) for x, r in policy.deferred.items()]


def skip_records(files: DataFrame, policy: SkipPolicy, state: DataFrame | None = None) -> DataFrame:
    """``path, size, reason, status, sha256`` of the skipped ``files`` (path, size, mtime[, header]).

    The stored hash is reused only on exactly equal mtime and size. Status is deferred iff the extension is deferred, whatever the reason.
    """
    header = F.col("header") if "header" in files.columns else None
    out = files.withColumn("reason", skip_reason(F.col("path"), F.col("size"), policy, header)).where("reason is not null")
    status = F.when(P.ext(F.col("path")).isin(*policy.deferred), "deferred").otherwise("skipped")
    if state is None:
        return out.select("path", "size", "reason", status.alias("status"), F.lit(None).cast("string").alias("sha256"))
    s = state.select(F.col("path").alias("_path"), F.col("mtime").alias("_mtime"), F.col("size").alias("_size"), F.col("hash").alias("_hash"))
    same = (P.norm_path(F.col("path")) == F.col("_path")) & (F.col("mtime") == F.col("_mtime")) & (F.col("size") == F.col("_size"))
    return out.join(s, same, "left").select("path", "size", "reason", status.alias("status"), F.col("_hash").alias("sha256"))


def reason_summary(skipped: DataFrame) -> DataFrame:
    """Reasons by count, most frequent first (ties by reason), as one text."""
    n = skipped.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    rows = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "reason")))
    return n.agg(F.array_join(F.transform(rows, lambda r: F.concat((-r["m"]).cast("string"), F.lit(" "), r["reason"])), ", ").alias("summary"))


def backfill_class(path: Column, parseable: list[str], deferred: list[str]) -> Column:
    e = P.ext(path)
    return F.when(e.isin(*deferred), "deferred").when(e.isin(*parseable), "parseable").otherwise("unsupported")
