import json

from docloom.operators.delta import ingest_status
from docloom.plans.checkpoint import Checkpoint
from docloom.sources import sinks
from docloom.streaming.nightly import run_night
from pyspark.sql import functions as F

FILES = "path string, mtime double, size bigint"
STATE = "path string, hash string, mtime double, size bigint, status string"


def test_checkpoint(spark, tmp_path):
    now = spark.createDataFrame([("/a", "h1"), ("/b", "h2"), ("/c", "h3")], "path string, hash string")
    c = Checkpoint(spark, f"file://{tmp_path}/cp", "sig")
    todo, replay = c.resume(now)
    assert todo.count() == 3 and replay is None
    c.append(spark.createDataFrame([("\\a", "H1"), ("/b", "old"), ("/lost", "h")], "path string, hash string"), spark.createDataFrame([("/a", 0), ("/b", 0), ("/orphan", 0)], "source_path string, chunk_index int"))
    todo, replay = c.resume(now)
    assert {r["path"] for r in todo.collect()} == {"/b", "/c"} and [r["source_path"] for r in replay.collect()] == ["/a"]
    assert Checkpoint(spark, f"file://{tmp_path}/cp", "other").resume(now)[0].count() == 3
    c.clear()
    assert c.done().count() == 0


def test_night(spark):
    files = spark.createDataFrame([("/s/a.txt", 1.0, 5), ("/s/canary.txt", 1.0, 5)], FILES)
    none, all_seen = spark.createDataFrame([], STATE), spark.createDataFrame([("/s/a.txt", "h", 1.0, 5, "mirrored"), ("/s/canary.txt", "h", 1.0, 5, "mirrored")], STATE)
    moved = lambda status: lambda df: df.select(F.col("path").alias("rel"), F.lit(status).alias("status"), F.lit(5).cast("bigint").alias("bytes"))
    go = lambda state=none, status="copied", ok=True, **k: run_night(files, state, moved(status), lambda df: ok, **k)
    assert (go()["status"], go()["bytes"]) == ("success", 10)
    assert go(all_seen)["status"] == "no_delta"
    assert go(canary_globs=["none*"], require_canary=True)["exit_code"] == 3 and go(canary_globs=["canary*"], require_canary=True)["status"] == "success"
    assert go(status="failed")["status"] == "transfer_partial" and go(ok=False)["status"] == "pipeline_failed" and go(should_stop=lambda: True)["status"] == "stopped"


def test_status_order(spark):
    d = spark.createDataFrame([(0, False, 1, True), (1, False, 1, True), (1, True, 1, True), (1, True, 0, True), (1, True, 0, False)], "n int, c boolean, t int, p boolean")
    got = [r[0] for r in d.select(ingest_status(F.col("n"), F.col("c"), F.col("t"), F.col("p"))).collect()]
    assert got == ["no_delta", "failed_no_canary", "transfer_partial", "pipeline_failed", "success"]


def test_dedup_index_and_reports(spark, tmp_path):
    d = spark.createDataFrame([(1, "/B", "canonical", "/B", "kept_best_in_family", 1.0), (2, "/a", "canonical", "/a", "singleton_skipped", 1.0), (3, "/c", "duplicate", "/B", "exact_normalized_text", 1.0)], "file_id bigint, path string, status string, canonical_path string, dedup_reason string, similarity double")
    r = sinks.write_dedup_index(d, str(tmp_path / "dedup"))
    assert r["duplicates"] == 1 and r["reduction_pct"] == 33.33
    assert json.loads((tmp_path / "dedup/dedup_report.json").read_text())["reasons"]["singleton_skipped"] == 1
    assert [x["value"] for x in spark.read.text(str(tmp_path / "dedup/canonical_files")).collect()] == ["/a", "/B"]
    sinks.write_report(d, str(tmp_path / "review"), "Families")
    assert (tmp_path / "review/report.md").read_text().count("\n") == 7 and spark.read.option("header", True).csv(str(tmp_path / "review/rows.csv")).count() == 3
    sinks.write_path_list(d, str(tmp_path / "list"))
    assert spark.read.text(str(tmp_path / "list")).count() == 3
    h = tmp_path / "history.jsonl"
    for i in range(12):
        sinks.append_history(h, {"n": i})
    assert [json.loads(x)["n"] for x in h.read_text().splitlines()] == list(range(2, 12))
