"""The nightly lane as a stream: new files of a folder, once, with a checkpoint, deduplicated against a state table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

FILE = "path string, modificationTime timestamp, length bigint, content binary"


def nightly(spark: SparkSession, root: str, checkpoint: str, handle: Callable[[DataFrame, int], None], max_files: int | None = None) -> StreamingQuery:
    """Run ``handle(files, batch)`` over the files that no earlier pass has seen, then stop.

    The stream's checkpoint is the resume point: a pass that breaks is repeated from its last complete batch. ``max_files`` bounds a
    batch, not the pass. Content is deduplicated by ``handle`` through the state table, whose size is that of the corpus,
    rather than by streaming state that grows without bound.
    """
    s = spark.readStream.format("binaryFile").schema(FILE).option("recursiveFileLookup", "true")
    if max_files:
        s = s.option("maxFilesPerTrigger", max_files)
    files = s.load(root).select("path", F.col("length").alias("size"), (F.unix_micros("modificationTime") / 1e6).alias("mtime"), "content")
    return files.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(handle).start()


def windowed_counts(events: DataFrame, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events per window and type with a watermark; an extra for event logs that arrive as a stream."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", window), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), "event_type", "n")


EXIT_CODES = {"success": 0, "no_delta": 0, "transfer_partial": 2, "pipeline_failed": 1, "failed_no_canary": 3, "stopped": 0}


def run_night(
    files: DataFrame,
    state: DataFrame,
    transfer: Callable[[DataFrame], DataFrame],
    pipeline: Callable[[DataFrame], bool],
    canary_globs: list[str] | None = None,
    require_canary: bool = False,
    should_stop: Callable[[], bool] = lambda: False,
) -> dict:
    """Scan, canary gate, transfer, pipeline; returns the report with status and exit code.

    ``transfer`` copies the delta and returns ``rel, status, bytes``; ``pipeline`` gets the rows that arrived and returns whether it
    succeeded. ``should_stop`` (a sentinel file, say) is asked between the stages.
    """
    from ..operators import delta
    from ..plans.shared import materialize

    scanned = materialize(delta.delta_scan(files, state))
    report = delta.delta_summary(scanned).first().asDict()
    gate = delta.canary_gate(scanned, canary_globs or [], require_canary).first()
    report |= {"canaries": gate["canaries"], "gate": gate["gate"]}

    def end(status: str) -> dict:
        return report | {"status": status, "exit_code": EXIT_CODES[status]}

    if report["delta_files"] == 0:
        return end("no_delta")
    if gate["gate"] == "FAIL":
        return end("failed_no_canary")
    if should_stop():
        return end("stopped")
    moved = materialize(transfer(scanned.where("delta_kind <> 'unchanged'")))
    by = {r["status"]: (r["n"], r["bytes"]) for r in moved.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")).collect()}
    report |= {"copied": by.get("copied", (0, 0))[0], "skipped": by.get("skipped", (0, 0))[0], "failed": by.get("failed", (0, 0))[0], "bytes": sum(b for _, b in by.values())}
    if report["failed"]:
        return end("transfer_partial")
    if should_stop():
        return end("stopped")
    return end("success" if pipeline(moved.where("status <> 'failed'")) else "pipeline_failed")
