"""Registered queries of the training-data problems; each reads whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .containers import container_report, fill_containers
from .eval_leaks import eval_leaks
from .incremental import match_batches
from .layout_copies import layout_copies
from .near_duplicates import near_duplicate_groups
from .oracles import SQL
from .reading_level import held_out_agreement, reading_bands, reading_levels
from .scan_repair import repair_scans
from .splitting import split_texts
from .survivors import surviving_files, surviving_records
from .text_types import not_prose, text_types


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def p2_groups(spark: SparkSession, sf: str) -> DataFrame:
    g = near_duplicate_groups(_t(spark, sf, "fingerprinted_document"))
    return g.select(F.col("first").alias("first_file_id"), F.col("id").alias("file_id"), "links", "similarity", "edit_similarity")


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return p2_groups(spark, sf).where("first_file_id <> file_id").select("first_file_id", "file_id")


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return match_batches(_t(spark, sf, "file_state"), _t(spark, sf, "delta_path"), _t(spark, sf, "fingerprinted_document"))


def p1_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The same files as p1_found, accepted in two batches against the stored index: up to the middle batch number, then the rest."""
    delta = _t(spark, sf, "delta_path")
    ends = delta.agg(F.min("batch_no").alias("lo"), F.max("batch_no").alias("hi")).first()
    cuts = () if ends["lo"] is None or ends["lo"] == ends["hi"] else ((ends["lo"] + ends["hi"]) // 2,)
    return match_batches(_t(spark, sf, "file_state"), delta, _t(spark, sf, "fingerprinted_document"), cuts=cuts)


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    c = layout_copies(_t(spark, sf, "fingerprinted_document"))
    return c.where("first <> id").select(F.col("first").alias("first_file_id"), F.col("id").alias("file_id"))


def p6_records(spark: SparkSession, sf: str) -> DataFrame:
    """One record per group with its number of copies."""
    return layout_copies(_t(spark, sf, "fingerprinted_document")).where("first = id").select(F.col("id").alias("file_id"), "copies")


def p9_leaks(spark: SparkSession, sf: str) -> DataFrame:
    return eval_leaks(_t(spark, sf, "documents"), _t(spark, sf, "eval_item"))


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return p9_leaks(spark, sf).where("words >= 15").select("doc_id", "item_id")


def p5_records(spark: SparkSession, sf: str) -> DataFrame:
    return surviving_records(_t(spark, sf, "document_dedup"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return surviving_files(_t(spark, sf, "document_dedup")).select("group_id", "survivor_id")


def p8_containers(spark: SparkSession, sf: str) -> DataFrame:
    return fill_containers(_t(spark, sf, "documents"), _t(spark, sf, "container_spec"))


def p8_report(spark: SparkSession, sf: str) -> DataFrame:
    """Fill of the containers of each capacity, and padding against the buckets' bounds."""
    return container_report(p8_containers(spark, sf))


def p8_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Whether each document is placed whole unless it exceeds the capacity, without a gap, in containers that hold no more than the capacity."""
    placed = p8_containers(spark, sf)
    over = placed.groupBy("spec_id", "container_id").agg((F.sum("tokens") > F.max("capacity_tokens")).alias("over")).where("over").select("spec_id", "container_id", "over")
    rows = placed.join(over, ["spec_id", "container_id"], "left")
    one = rows.groupBy("spec_id", "capacity_tokens", "doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("pieces").alias("pieces"), F.sum("tokens").alias("tokens"), F.max(F.col("first_token") + F.col("tokens")).alias("last"), F.max(F.coalesce("over", F.lit(False))).alias("over")
    )
    whole = (F.col("n") == F.col("pieces")) & (F.col("tokens") == F.col("last")) & (F.col("pieces") == F.greatest(F.lit(1), F.ceil(F.col("tokens") / F.col("capacity_tokens"))))
    return one.select("spec_id", "capacity_tokens", "doc_id", whole.alias("whole"), (~F.col("over")).alias("fits"))


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that no container of the smallest capacity holds whole."""
    placed = p8_containers(spark, sf)
    return placed.where((F.col("pieces") > 1) & (F.col("capacity_tokens") == 2048)).select("doc_id").distinct()


def p10_levels(spark: SparkSession, sf: str) -> DataFrame:
    return reading_levels(_t(spark, sf, "documents"), _t(spark, sf, "reading_label"))


def p10_agreement(spark: SparkSession, sf: str) -> DataFrame:
    """Level against grades held out of the fit."""
    return held_out_agreement(_t(spark, sf, "documents"), _t(spark, sf, "reading_label"))


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    return reading_bands(_t(spark, sf, "documents"), _t(spark, sf, "reading_label"))


def p3_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Repaired texts and their damaged lines."""
    return repair_scans(_t(spark, sf, "parsed_document"))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return p3_texts(spark, sf).select("file_id", F.explode("defects").alias("d")).select("file_id", "d.line_no", "d.defect").distinct()


def p4_pieces(spark: SparkSession, sf: str) -> DataFrame:
    return split_texts(_t(spark, sf, "parsed_document"), _t(spark, sf, "run_config"))


def p4_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Per text: its characters, and whether the pieces cover it from end to end within the run's size and with exactly its overlap."""
    d, runs = _t(spark, sf, "parsed_document"), _t(spark, sf, "run_config")
    pieces = split_texts(d, runs).select("file_id", "piece_no", "pieces", "start", "end", F.length("text").alias("n"))
    size = d.select("file_id", "run_id").join(F.broadcast(runs.select("run_id", "size", "overlap")), "run_id")
    nxt = pieces.select("file_id", (F.col("piece_no") - 1).alias("piece_no"), F.col("start").alias("next"))
    j = pieces.join(nxt, ["file_id", "piece_no"], "left").join(size, "file_id")
    joined = F.when(F.col("piece_no") == F.col("pieces"), F.col("next").isNull()).otherwise(F.col("next") == F.col("end") - F.col("overlap"))
    return j.groupBy("file_id").agg(
        F.max("end").alias("chars"), (F.min("start") == 0).alias("from_start"), F.every((F.col("n") <= F.col("size")) & (F.col("n") == F.col("end") - F.col("start"))).alias("within_size"), F.every(F.coalesce(joined, F.lit(False))).alias("exact_overlap")
    )


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return p4_pieces(spark, sf).where("pieces > 1").select("file_id").distinct()


def p7_types(spark: SparkSession, sf: str) -> DataFrame:
    return text_types(_t(spark, sf, "parsed_document"))


def p7_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """The statistics that SQL can state."""
    r = lambda c: F.round(c, 6).alias(c)
    return text_types(_t(spark, sf, "parsed_document")).where("kind is not null").select("file_id", F.col("words").cast("bigint").alias("words"), F.col("chars").cast("bigint").alias("chars"), r("mean_word_length"), r("symbol_ratio"), r("punctuated_lines"), r("digit_ratio"))


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return not_prose(_t(spark, sf, "parsed_document"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"p1_batches": p1_batches, "p4_checks": p4_checks, "p7_statistics": p7_statistics, "p8_checks": p8_checks, "p8_report": p8_report, "p10_agreement": p10_agreement, "p3_found": p3_found, "p3_texts": p3_texts, "p4_found": p4_found, "p4_pieces": p4_pieces, "p7_found": p7_found, "p7_types": p7_types, "p10_found": p10_found, "p10_levels": p10_levels, "p5_found": p5_found, "p5_records": p5_records, "p8_found": p8_found, "p8_containers": p8_containers, "p9_found": p9_found, "p9_leaks": p9_leaks, "p1_found": p1_found, "p6_found": p6_found, "p6_records": p6_records, "p2_found": p2_found, "p2_groups": p2_groups}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
