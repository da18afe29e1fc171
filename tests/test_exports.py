import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom import config
from docloom.functions import display
from docloom.functions import text as T
from docloom.operators import contract, family_dedup, metadata, models
from docloom.plans.precheck import precheck, verdict
from docloom.plans.stop import StopRequest
from docloom.sources import sinks


def test_sizes_and_times(spark):
    d = spark.createDataFrame([(17, 0.0), (3072, 59.9), (1610612736, 61.0), (None, 3725.0), (5 << 20, -3.0), (0, None)], "n bigint, s double")
    rows = d.select(display.bytes_text(F.col("n")).alias("n"), display.elapsed_text(F.col("s")).alias("s")).collect()
    assert [r["n"] for r in rows] == ["17 B", "3.0 KB", "1.5 GB", None, "5.0 MB", "0 B"]
    assert [r["s"] for r in rows] == ["0:00", "0:59", "1:01", "1:02:05", "0:00", None]


def test_rewrite_takes_a_broken_pattern_literally(spark):
    d = spark.createDataFrame([("Cost (USD: 5",), (None,)], "t string")
    assert [r[0] for r in d.select(T.rewrite(F.col("t"), [("(usd", "[$"), (r"\d", "n")])).collect()] == ["Cost [$: n", None]


def test_contract_case_of_the_export(spark):
    chunks = spark.createDataFrame([("c1", "t", "/a.txt"), ("c2", "", "/b.txt")], "chunk_id string, text string, source_path string")
    entities = spark.createDataFrame([("c1", "x", "P", 0.9, 0, 1)], "chunk_id string, text string, label string, score double, start int, end int")
    table = contract.coverage(chunks, entities)
    have = {(r["artifact"], r["field"]): (r["present_rows"], r["coverage_pct"]) for r in table.collect()}
    assert len(have) == 53 and have["chunks", "source_path"] == (2, 100.0) and have["chunks", "text"] == (1, 50.0) and have["chunks", "source_ext"] == (0, 0.0)
    assert [r["gap"] for r in contract.gaps(table, ["total_skipped"]).collect()] == ["source_ext", "source_doc_hash", "authority_metadata", "skip_aliases", "entity_source_path"]
    none = contract.coverage(chunks.limit(0), entities.limit(0))
    assert none.where("coverage_pct <> 0").count() == 0 and "entity_source_path" not in {r["gap"] for r in contract.gaps(none, contract.SKIP_ALIASES).collect()}


def test_metadata_fields_cover_the_contract(spark):
    t = "Vendor: Acme Ltd; qty: 12\nCLIN: 0003AB PO 4500-77 Model No. X-200 rev. B, acquired: 3 May 2021\nremarks: none | cost: $1,250.50\nNessus finding CVE-2024-12345 high severity, open. CDRL"
    d = spark.createDataFrame([("X:\\intake\\iris_field\\Deliverables\\a.pdf", t, 0.5), (None, None, None)], "p string, t string, q double")
    cols = metadata.contract_columns(F.col("p"), F.col("t"), F.col("q"), F.sha2("t", 256))
    assert set(contract.METADATA_FIELDS) <= set(cols)
    r, empty = d.select(*(v.alias(k) for k, v in cols.items())).collect()
    assert (r["log_vendor"], r["log_qty"], r["log_clin"], r["log_purchase_order"], r["log_model_number"], r["log_revision"], r["log_acquisition_cost"]) == ("Acme Ltd", "12", "0003AB", "4500-77", "X-200", "B", "1,250.50")
    assert (r["log_acquisition_date"], r["doc_date"], r["cyber_report_family"], r["cyber_status"], r["cyber_finding_id"], r["cyber_scan_date"]) == ("3 May 2021", "2021-05-03", "nessus", "open", "CVE-2024-12345", "2021-05-03")
    assert (r["site_token"], r["program_token"], r["authority_signals"], r["cyber_waiver_flag"]) == ("iris", "field", ["deliverables_path", "cdrl"], False)
    assert empty["identifier_tokens"] == [] and empty["log_vendor"] is None and empty["cyber_status"] is None


def test_mix_caps_of_the_pool(spark):
    rows = [("q", i, float(100 - i), "customer_deliverable" if i > 90 else "unknown", i % 2 == 0, i % 4 == 1) for i in range(100)]
    d = spark.createDataFrame(rows, "q string, id int, prior double, authority_tier string, is_archive_derived boolean, is_visual_heavy boolean")
    out = metadata.mixed_pool(d, ["q"], 20).orderBy("place").collect()
    assert [r["place"] for r in out] == list(range(1, 21))
    assert sum(r["is_archive_derived"] for r in out) <= 4 and sum(r["is_visual_heavy"] for r in out) <= 3
    assert [r["authority_tier"] for r in out[:2]] == ["customer_deliverable"] * 2
    assert metadata.mixed_pool(d.limit(0), ["q"], 20).count() == 0


def test_sort_modes_of_the_review(spark):
    d = spark.createDataFrame([("/b", 5, 0.9), ("/A", 5, None), ("/c", 2, 0.5)], "canonical_path string, members int, min_similarity double")
    first = lambda mode, n=25: [r["canonical_path"] for r in family_dedup.sorted_families(d, mode, n).collect()]
    assert (first("largest"), first("similarity"), first("path"), first("path", 0)) == (["/A", "/b", "/c"], ["/c", "/b", "/A"], ["/A", "/b", "/c"], ["/A"])
    with pytest.raises(ValueError, match="sort mode"):
        family_dedup.sorted_families(d, "size")


def test_back_ends_follow_each_other_and_queries_are_unit_vectors():
    class Failing:
        dim = 3

        def __call__(self, texts):
            raise RuntimeError("lost")

    class Twos:
        dim = 4

        def __call__(self, texts):
            return np.full((len(texts), 4), 2.0)

    def never():
        raise OSError("no device")

    b = models.Backends(never, Failing, Twos)
    assert b.dim == 3 and np.allclose(np.linalg.norm(b(["a", "b"]), axis=1), 1) and b.dim == 4
    with pytest.raises(RuntimeError, match="no back end"):
        models.Backends(never)
    v = models.embed_query("pump check", lambda: models.HashEmbedder(16), "query: ")
    assert v.dtype == np.float32 and np.isclose(np.linalg.norm(v), 1) and not models.embed_query("", lambda: models.HashEmbedder(16)).any()


def test_vectors_as_float16_and_in_one_file(spark, tmp_path):
    d = spark.createDataFrame([(f"k{i:03d}", [i / 7.0, float(i)]) for i in range(200)], "k string, vector array<float>").repartition(5)
    half = models.as_float16(d)
    assert half.schema == d.schema and all(np.float16(r["vector"][0]) == np.float32(r["vector"][0]) for r in half.collect())
    assert sinks.write_npy(d, str(tmp_path / "v.npy"), "k", 2) == 200
    v = np.load(tmp_path / "v.npy")
    assert v.dtype == np.float16 and v[:, 1].tolist() == [float(i) for i in range(200)]
    assert sinks.write_npy(d.limit(0), str(tmp_path / "none.npy"), "k", 2) == 0 and np.load(tmp_path / "none.npy").shape == (0, 2)


def test_model_service_readiness():
    assert models.model_ready("phi:14b", lambda: ["other", "phi:14b"]) == (True, "phi:14b")
    assert models.model_ready("phi", lambda: ["phi-4:14b"]) == (True, "phi-4:14b") and models.model_ready("phi:7b", lambda: ["phi:14b"]) == (True, "phi:14b")
    assert models.model_ready("phi", lambda: ["llama"]) == (False, "model missing")

    def silent():
        raise ConnectionError

    assert models.model_ready("phi", silent) == (False, "no answer: ConnectionError")


def test_precheck(tmp_path):
    ok = precheck(config.from_dict({"source": str(tmp_path), "output": str(tmp_path / "new" / "out"), "parse": {"ocr_mode": "skip"}}), least_free_gb=0, models=lambda: (True, "m"))
    assert {f.status for f in ok} == {"PASS"} and verdict(ok) == ("PASS", 0) and [f.name for f in ok] == ["python", "packages", "source", "output", "free_disk", "tools", "models"]
    bad = precheck(config.from_dict({"source": str(tmp_path / "none"), "output": str(tmp_path)}), least_free_gb=1e9, packages=("no_such_package",), tools=("no_such_tool",), models=lambda: (False, "x"))
    assert {f.name: f.status for f in bad} == {"python": "PASS", "packages": "FAIL", "source": "FAIL", "output": "PASS", "free_disk": "WARN", "tools": "WARN", "models": "FAIL"} and verdict(bad)[1] == 1


def test_stop_requests(tmp_path):
    import os
    import signal

    with StopRequest(tmp_path / "stop", (signal.SIGUSR1,)) as stop:
        assert not stop()
        (tmp_path / "stop").touch()
        assert stop()
        stop.clear()
        os.kill(os.getpid(), signal.SIGUSR1)
        assert stop() and not (tmp_path / "stop").exists()


def test_profile_and_delta_reports(spark, tmp_path):
    t = spark.createDataFrame([("a|b", 3), (None, 1)], "name string, n int")
    sinks.write_profile({"names": t}, str(tmp_path / "p"), "Profile")
    assert "## names" in (tmp_path / "p/profile.md").read_text() and "a\\|b" in (tmp_path / "p/profile.md").read_text()
    scanned = spark.createDataFrame([("/a", "new"), ("/b", "unchanged")], "path string, delta_kind string")
    moved = spark.createDataFrame([("a", "copied", 5), ("c", "failed", 0)], "rel string, status string, bytes bigint")
    r = sinks.write_delta_report(scanned, moved, str(tmp_path / "d"))
    assert r["scanned"] == 2 and r["transfer"]["copied"] == {"files": 1, "bytes": 5} and [x[0] for x in spark.read.text(str(tmp_path / "d/input_list")).collect()] == ["a"]
