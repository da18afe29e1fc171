"""The batch pipeline as one plan: list, classify, skip, parse, chunk, enrich, embed, extract, describe, export.

What moves between tasks are rows about files: bytes are hashed and parsed in the tasks that open them, and only for files that need it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..functions import paths as P
from ..operators import chunking, contract, exact_dedup, metadata, models, skip
from ..sources import files as src
from ..sources import sinks
from ..sources.parsers import parse_paths
from .checkpoint import Checkpoint
from .shared import materialize

STATE = "path string, hash string, mtime double, size bigint, status string"
CHUNK = ["chunk_id", "text", "enriched_text", "source_path", "chunk_index", "text_length", "parse_quality"]


@dataclass
class Plugins:
    """What a run may bring: models (callables that make them in each task), parsers, progress, metadata and a stop request."""

    embedder: Callable[[], models.Embedder] | None = None
    enricher: models.Enricher | None = None
    extractor: Callable[[list[str]], list[list[dict]]] | None = None
    parsers: Callable[[], None] | None = None
    checkpoint: Checkpoint | None = None
    metadata: bool = False
    should_stop: Callable[[], bool] = lambda: False


@dataclass
class Stages:
    decisions: DataFrame
    skipped: DataFrame
    parsed: DataFrame
    chunks: DataFrame
    vectors: DataFrame
    entities: DataFrame
    stopped: bool = False


def _facts(files: DataFrame, state: DataFrame) -> DataFrame:
    """``files`` with hash and header; files whose stamp says they are indexed or duplicates are not opened."""
    s = state.select(P.norm_path(F.col("path")).alias("_p"), F.col("mtime").alias("_m"), F.col("size").alias("_z"), F.col("status").alias("_s"))
    j = files.withColumn("_p", P.norm_path(F.col("path"))).join(s, "_p", "left")
    done = F.coalesce(exact_dedup.same_stamp(F.col("mtime"), F.col("size"), F.col("_m"), F.col("_z")) & F.col("_s").isin("indexed", "duplicate"), F.lit(False))
    j = materialize(j.select(*files.columns, done.alias("_done")))
    opened = src.read_facts(j.where("not _done").select(*files.columns))
    return materialize(opened.unionByName(j.where("_done").select(*files.columns), allowMissingColumns=True))


def build(spark: SparkSession, config: Config, files: DataFrame, state: DataFrame | None = None, plugins: Plugins | None = None) -> Stages:
    """Stages over ``files`` (ordinal, path, size, mtime); a column of contents, if there is one, is not used."""
    plugins = plugins or Plugins()
    state = state if state is not None else spark.createDataFrame([], STATE)
    facts = _facts(files.select("ordinal", "path", "size", "mtime"), state)
    decisions = materialize(exact_dedup.classify(facts.select("ordinal", "path", "hash", "mtime", "size"), state))
    work = facts.join(decisions.where("decision = 'work'").select("ordinal"), "ordinal")
    policy = skip.SkipPolicy(ocr_mode=config.parse.ocr_mode, deferred=config.deferred)
    skipped = materialize(skip.skip_records(work.drop("hash"), policy))
    reason = skip.skip_reason(F.col("path"), F.col("size"), policy, F.col("header"))
    todo, replay = work.where(reason.isNull()).drop("header"), None
    if plugins.checkpoint is not None:
        todo, replay = plugins.checkpoint.resume(todo)
    stopped = plugins.should_stop()
    parsed = materialize(parse_paths(src.spread_files(todo.limit(0) if stopped else todo), setup=plugins.parsers))
    c = chunking.chunk_rows(parsed.select("ordinal", F.col("path").alias("source_path"), "mtime", "hash", "parse_quality", "text"), config.chunk.size, config.chunk.overlap, config.chunk.max_heading_len)
    cid = chunking.chunk_id(F.col("source_path"), (F.col("mtime") * 1_000_000_000).cast("bigint"), F.col("chunk_start"), F.col("chunk_end"), F.col("chunk_text"))
    chunks = c.select(cid.alias("chunk_id"), F.col("chunk_text").alias("text"), "source_path", "chunk_index", F.length("chunk_text").alias("text_length"), "parse_quality", F.col("hash").alias("source_doc_hash"))
    if plugins.enricher is not None:
        chunks = materialize(chunks)
        said = models.enrich(chunks, parsed.select(F.col("path").alias("source_path"), "text"), plugins.enricher, "source_path")
        chunks = chunks.join(said, "chunk_id", "left")
    else:
        chunks = chunks.withColumn("enriched_text", F.lit(None).cast("string"))
    if plugins.metadata:
        more = metadata.contract_columns(F.col("source_path"), F.col("text"), F.col("parse_quality"), F.col("source_doc_hash"))
        chunks = chunks.withColumns(more).select(*CHUNK, *contract.METADATA_FIELDS)
    else:
        chunks = chunks.select(*CHUNK)
    chunks = materialize(chunks)
    if plugins.checkpoint is not None:
        # what was finished before is copied, since the checkpoint goes at the end of the run
        old = None if replay is None else materialize(replay.select(*chunks.columns))
        plugins.checkpoint.append(parsed.select("path", "hash"), chunks)
        chunks = chunks if old is None else chunks.unionByName(old)
    maker = plugins.embedder or (lambda dim=config.embed.dim: models.HashEmbedder(dim))
    said = chunks.select("chunk_id", F.coalesce("enriched_text", "text").alias("text"))
    vectors = models.embed(said, maker, prefix=config.embed.prefix, budget=config.embed.token_budget)
    if plugins.extractor is not None:
        entities = models.extract(chunks, plugins.extractor).join(chunks.select("chunk_id", "source_path"), "chunk_id")
    else:
        entities = metadata.pattern_entities(chunks)
    return Stages(decisions, skipped, parsed, chunks, vectors, entities, stopped)


def run_stats(stages: Stages) -> dict:
    """Counts of a run: files by decision, parsed and empty files, formats, chunks; one small aggregate each."""
    by = {r["decision"]: r["n"] for r in stages.decisions.groupBy("decision").agg(F.count(F.lit(1)).alias("n")).collect()}
    p = stages.parsed.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("empty_reason").isNull()).alias("ok")).first()
    formats = {r["file_ext"] or "[no_ext]": r["n"] for r in stages.parsed.groupBy("file_ext").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {"files_found": sum(by.values()), **{f"files_{k}": v for k, v in by.items()}, "files_parsed": p["ok"], "files_empty": p["n"] - p["ok"], "chunks_created": stages.chunks.count(), "formats": formats}


def run(spark: SparkSession, config: Config, state: DataFrame | None = None, plugins: Plugins | None = None) -> tuple[Stages, object]:
    """List, build and export; returns the stages and the package's folder. A run that was stopped exports what it has; its checkpoint stays."""
    stages = build(spark, config, src.scan(spark, config.source, max_files=config.delta.max_files), state, plugins)
    stats = run_stats(stages)
    dim = config.embed.dim
    if plugins is not None and plugins.embedder is not None:
        first = stages.vectors.select(F.size("vector").alias("d")).first()
        dim = first["d"] if first is not None else dim
    folder = sinks.export_package(config.output, stages.chunks, stages.vectors, stages.entities, stages.skipped, dim, stats=stats, deferred=config.deferred)
    if plugins is not None and plugins.checkpoint is not None and not stages.stopped:
        plugins.checkpoint.clear()
    return stages, folder


def dedup_only(spark: SparkSession, source: str, state: DataFrame, copy_to: str | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Exact deduplication without parsing: the canonical snapshot of the folder (unchanged indexed files included), and its verified copy."""
    files = src.scan(spark, source)
    decisions = materialize(exact_dedup.classify(_facts(files, state).select("ordinal", "path", "hash", "mtime", "size"), state))
    status = F.when(F.col("decision") == "duplicate", "duplicate").otherwise("canonical")
    rows = decisions.select("path", "hash", "decision", status.alias("status"))
    return rows, sinks.portable_copy(rows, "file:" + source if rows.where(F.startswith("path", F.lit("file:"))).head(1) else source, copy_to) if copy_to else None
