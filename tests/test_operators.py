import hypothesis.strategies as st
import pytest
from hypothesis import given, settings
from pyspark.sql import functions as F

from docloom.operators import audit, chunking, delta, exact_dedup, family_dedup, metadata, models, profile, search, skip
from docloom.operators.batches import assign_batches
from docloom.plans.components import connected_components
from docloom.plans.shared import attach_group, discard_all, materialize
from docloom.plans.topk import first_k, with_ordinal

FILES = "ordinal bigint, path string, hash string, mtime double, size bigint"
STATE = "path string, hash string, mtime double, size bigint, status string"


def decide(spark, files, state=()):
    d = exact_dedup.classify(spark.createDataFrame(files, FILES), spark.createDataFrame(list(state), STATE))
    return {r["path"].rsplit("/", 1)[-1]: r["decision"] for r in d.collect()}


@pytest.mark.parametrize(
    "files,state,want",
    [
        ([(1, "/d/Report.docx", "a", 1.0, 5), (2, "/d/Report_1.docx", "a", 1.0, 5)], [], {"Report.docx": "work", "Report_1.docx": "duplicate"}),
        ([(1, "/d/Data.csv", "a", 1.0, 5), (2, "/d/Data_1.csv", "b", 1.0, 5)], [], {"Data.csv": "work", "Data_1.csv": "work"}),
        ([(1, "/d/Orphan_1.txt", "a", 1.0, 5)], [], {"Orphan_1.txt": "work"}),
        ([(2, "/d/beta.txt", "a", 1.0, 5), (1, "/d/alpha.txt", "a", 1.0, 5)], [], {"alpha.txt": "work", "beta.txt": "duplicate"}),
        ([(1, "/d/stable.txt", "a", 1.5, 5)], [("/d/stable.txt", "a", 1.0, 5, "indexed")], {"stable.txt": "unchanged"}),
        ([(1, "/d/touched.txt", "a", 9.0, 5)], [("/d/touched.txt", "A", 1.0, 5, "indexed")], {"touched.txt": "unchanged"}),
        ([(1, "/d/changing.txt", "b", 9.0, 6)], [("/d/changing.txt", "a", 1.0, 5, "indexed")], {"changing.txt": "work"}),
        ([(1, "\\d\\dup.txt", "b", 1.0, 5)], [("/d/dup.txt", "a", 1.0, 5, "duplicate")], {"\\d\\dup.txt": "duplicate"}),
        ([(1, "/d/a.txt", None, None, None), (2, "/d/b.txt", None, None, None)], [], {"a.txt": "work", "b.txt": "work"}),
        ([], [("/d/a.txt", "a", 1.0, 5, "indexed")], {}),
    ],
)
def test_incremental_decisions(spark, files, state, want):
    assert decide(spark, files, state) == want


def test_copy_of_an_indexed_file(spark):
    files, state = [(1, "/d/new.txt", "a", 1.0, 5)], [("/d/old.txt", "a", 1.0, 5, "indexed")]
    assert decide(spark, files, state) == {"new.txt": "work"}
    d = exact_dedup.classify(spark.createDataFrame(files, FILES), spark.createDataFrame(state, STATE), against_state=True)
    assert d.first()["decision"] == "duplicate"


NAMES = {
    "contract_encrypted.pdf": True, "encrypted_budget.pdf": True, "Report.ENCRYPTED.v2.pdf": True, "ENCRYPTED-v2.pdf": True, "Budget_FY25_PASSWORD-PROTECTED.pdf": True, "Report_DRM-Protected_v2.docx": True,
    "unencrypted_notes.pdf": False, "UNENCRYPTED_FY25.pdf": False, "final_unencrypted.pdf": False, "encryption_policy.pdf": False, "EncryptionStandards.docx": False, "SecurityReview_Q3.pdf": False, "plain_report.pdf": False,
}


def test_filename_cues(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "p string").select("p", skip.skip_reason(F.col("p"), F.lit(5), skip.SkipPolicy()).alias("r"))
    assert {r["p"]: r["r"] is not None for r in df.collect()} == NAMES


def test_skip_order_and_magic_bytes(spark):
    rows = [("~$x.tmp", 0, b""), ("~$x.tmp", 1, b""), ("~x.doc", 1, b""), ("x.bak", 1, b""), ("big.pdf", 600 << 20, b""), ("book_djvu.txt", 1, b""), ("my_encrypted.pdf", 1, b"%PDF-1.4 /Encrypt 5 0 R"), ("a.docx", 1, bytes.fromhex("D0CF11E0A1B11AE1")), ("d.DWF", 1, None), ("ok.pdf", 1, b"%PDF-1.4"), ("photo.jpg", 1, None), (None, None, None)]
    d = spark.createDataFrame(rows, "path string, size bigint, header binary")
    got = [r["r"] for r in d.select(skip.skip_reason(F.col("path"), F.col("size"), skip.SkipPolicy(), F.col("header")).alias("r")).collect()]
    assert got == ["zero-byte file", "temp file prefix '~$'", "temp file prefix '~'", "temp file extension '.bak'", "over size limit (500 MB)", "OCR sidecar artifact (_djvu.txt)", "encrypted file (magic bytes)", "encrypted file (magic bytes)", "Design Web Format", None, None, None]
    modes = [d.where("path = 'photo.jpg'").select(skip.skip_reason(F.col("path"), F.col("size"), skip.SkipPolicy(ocr_mode=m))).first()[0] is not None for m in ("skip", "auto", "force")]
    assert modes == [True, False, False]
    assert skip.normalize_extensions([" SAO", ".sao", "", None, "x.y"]) == [".sao", ".x.y"]


def test_skip_records_reuse_exact_stamps(spark):
    f = spark.createDataFrame([("/a/x.dwf", 5, 1.0), ("/a/~y.txt", 5, 1.0)], "path string, size bigint, mtime double")
    s = spark.createDataFrame([("/a/x.dwf", "h", 1.0, 5, "deferred"), ("/a/~y.txt", "g", 1.5, 5, "skipped")], STATE)
    got = {r["path"]: (r["status"], r["sha256"]) for r in skip.skip_records(f, skip.SkipPolicy(), s).collect()}
    assert got == {"/a/x.dwf": ("deferred", "h"), "/a/~y.txt": ("skipped", None)}


def test_delta_scan_and_gate(spark):
    f = spark.createDataFrame([("/s/a", 1.0, 5), ("/s/b", 1.0, 5), ("/s/c", 9.0, 5), ("/s/canary.txt", 1.0, 1)], "path string, mtime double, size bigint")
    s = spark.createDataFrame([("/s/a", "h", 1.0, 5, "mirrored"), ("/s/b", "h", 1.0, 5, "hashed"), ("/s/c", "h", 1.0, 5, "mirrored"), ("/s/gone", "h", 1.0, 5, "mirrored"), ("/t/x", "h", 1.0, 5, "mirrored")], STATE)
    d = delta.delta_scan(f, s)
    assert {r["path"]: r["delta_kind"] for r in d.collect()} == {"/s/a": "unchanged", "/s/b": "resumed", "/s/c": "changed", "/s/canary.txt": "new"}
    assert tuple(delta.delta_summary(d).first()) == (4, 1, 1, 1, 1, 3)
    assert delta.canary_gate(d, ["canary*"]).first()["gate"] == "PASS" and delta.canary_gate(d, ["none*"]).first()["gate"] == "FAIL"
    assert [r["path"] for r in delta.deleted(f, s, "/s").collect()] == ["/s/gone"] and delta.deleted(f, s, "/s", complete=False).count() == 0


@pytest.mark.parametrize("text,size,overlap,want", [("Hello world.", 1200, 200, ["Hello world."]), ("", 1200, 200, []), ("   ", 1200, 200, []), (None, 1200, 200, [])])
def test_chunk_literals(text, size, overlap, want):
    assert chunking.chunk(text, size, overlap) == want


def test_chunk_rules():
    assert len(chunking.chunk("word " * 200, 100, 20)) > 1
    c = chunking.chunk("The quick brown fox jumps over the lazy dog. " * 20, 100, 20)
    assert c[0][-15:].strip() in c[1]
    assert chunking.chunk("a" * 60 + "\n\n" + "b" * 80, 100, 20)[0] == "a" * 60
    assert chunking.chunk("TITLE HERE\n" + "x" * 150, 100, 0)[1] == "x" * 61
    assert chunking.chunk("3.1 Scope \n\n" + "x" * 58 + "\n" + "y" * 90, 72, 0)[-1].endswith("y")
    assert chunking.heading_before("ABC DEF\n\nbody", 9, 160) == "ABC DEF" and chunking.heading_before("plain text\nbody", 11, 160) == "" and chunking.heading_before("Notes:\nbody", 7, 160) == "Notes:"
    assert all(len(x) <= 400 for x in chunking.chunk("a " * 500, 200, 50))


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab .\n", max_size=400), st.integers(20, 120), st.integers(0, 19))
def test_windows_cover_the_text(text, size, overlap):
    spans = list(chunking.cut_windows(text, size, overlap))
    assert spans[0][0] == 0 and spans[-1][1] == len(text)
    assert all(a < b <= a + size or not text for a, b in spans)
    assert all(n[0] <= p[1] for p, n in zip(spans, spans[1:], strict=False))


def test_chunk_rows_and_ids(spark):
    d = spark.createDataFrame([(1, "x", "A b. " * 400), (2, "y", None), (3, "z", "")], "doc_id bigint, chunk string, text string")
    c = chunking.chunk_rows(d)
    assert {r["doc_id"] for r in c.collect()} == {1}
    ids = lambda df: {tuple(r) for r in df.select("doc_id", "chunk_index", chunking.chunk_id(F.lit("X:\\A"), F.lit(1), F.col("chunk_start"), F.col("chunk_end"), F.col("chunk_text"))).collect()}
    assert ids(c) == ids(chunking.chunk_rows(d.repartition(3))) and all(len(x[2]) == 64 for x in ids(c))
    with pytest.raises(ValueError):
        chunking.chunk_rows(d, 100, 100)


DOCS = "file_id bigint, path string, ext string, stem_key string, parse_quality double, normalized_chars int, normalized_hash string, normalized_text string"


def test_family_decisions(spark):
    t = "\n".join(f"line number {i} of the report says that all is well" for i in range(12))
    rows = [(1, "/a/Report.docx", ".docx", "report", 1.0, len(t), "h1", t), (2, "/a/Report.pdf", ".pdf", "report", 0.9, len(t), "h2", t + "\nsigned"), (3, "/a/Report.doc", ".doc", "report", None, len(t), "h1", t), (4, "/a/Other.pdf", ".pdf", "other", 1.0, 9, "h4", "x"), (5, "/a/weak.pdf", ".pdf", "report", 0.1, 3, "", "abc"), (6, "/a/null.pdf", ".pdf", "report", None, None, None, None)]
    d = spark.createDataFrame(rows, DOCS)
    got = {r["file_id"]: (r["status"], r["canonical_path"], r["dedup_reason"]) for r in family_dedup.family_decisions(d).collect()}
    assert got[1] == ("canonical", "/a/Report.docx", "kept_best_in_family") and got[2] == ("duplicate", "/a/Report.docx", "near_duplicate_same_stem") and got[3] == ("duplicate", "/a/Report.docx", "exact_normalized_text")
    assert got[4][2] == "singleton_skipped" and got[5][0] == got[6][0] == "canonical"
    assert {(r["a"], r["b"]) for r in family_dedup.pair_scores(d).collect()} == {(1, 2)}
    assert family_dedup.family_decisions(d.limit(0)).count() == 0


def test_contained_texts_of_one_family_pair_at_any_length(spark):
    words = [f"w{i}" for i in range(1000)]
    rows = [(1, "/a", ".pdf", "s", 1.0, 5000, "h1", " ".join(words)), (2, "/b", ".pdf", "s", 1.0, 500, "h2", " ".join(words[300:400])), (3, "/c", ".pdf", "s", 1.0, 500, "h3", " ".join(words[600:900]))]
    got = {(r["a"], r["b"], r["similarity"]) for r in family_dedup.pair_scores(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {(1, 2, 1.0), (1, 3, 1.0)}


def test_family_decisions_in_blocks_equal_one_pass(spark):
    import random

    rng = random.Random(4)
    base = [[f"t{k}x{i}" for i in range(120)] for k in range(6)]
    rows = []
    for i in range(60):
        w = list(base[i % 6])
        if i % 3 == 1:
            w = [f"title{i}", f"edited{i}"] + w
        if i % 4 == 2:
            w = w[: rng.randrange(60, 120)]
        t = "\n".join(" ".join(w[x : x + 8]) for x in range(0, len(w), 8))
        rows.append((i, f"/p{i:03}", (".pdf", ".doc", ".docx")[i % 3], "hot", rng.random(), len(t), f"h{t}", t))
    rows += [(100, "/n", ".pdf", "hot", None, None, None, None), (101, "/m", ".pdf", "hot", 0.5, 10, "x", "short")]
    d = spark.createDataFrame(rows, DOCS)
    one = {tuple(r) for r in family_dedup.family_decisions(d).collect()}
    assert len(one) == 62 and len([r for r in one if r[2] == "duplicate"]) > 40
    assert {tuple(r) for r in family_dedup.family_decisions(d, family_rows=25).collect()} == one


def test_leaders_of_a_large_family_compare_few_pairs(monkeypatch):
    import random

    import pandas as pd

    rng = random.Random(7)
    texts = []
    for i in range(900):
        w = [f"w{rng.randrange(9000)}" for _ in range(300)] if i % 5 or not texts else texts[rng.randrange(len(texts))].split()[: rng.randrange(60, 301)]
        texts.append("\n".join(" ".join(w[x : x + 12]) for x in range(0, len(w), 12)))
    order = sorted(range(900), key=lambda i: -(i * 7919 % 900))
    pdf = pd.DataFrame([("hot", i, f"/p{i:03}", ".pdf", (i * 7919 % 900) / 900, 1000, f"h{texts[i]}", texts[i], 0, None, None, None) for i in range(900)], columns=family_dedup.IN)
    looked, near = [], family_dedup._near
    with monkeypatch.context() as m:
        m.setattr(family_dedup, "_near", lambda a, b: looked.append(1) or near(a, b))
        got = family_dedup._leaders(0.9, 200)(pdf)
    assert len(looked) < 9000
    units = [family_dedup._units(t) for t in texts]
    leaders, want = [], {}
    for i in order:
        hit = next((j for j in leaders if family_dedup._near(units[j], units[i]) >= 0.9), None) if i % 5 == 0 or i < 5 else None
        want[i] = f"/p{i:03}" if hit is None else f"/p{hit:03}"
        leaders += [i] if hit is None else []
    duplicates = {i: c for i, c in zip(got["file_id"], got["canonical_path"], strict=True) if i % 5 == 0}
    assert len(got) == 900 and any(c != f"/p{i:03}" for i, c in duplicates.items()) and duplicates == {i: c for i, c in want.items() if i % 5 == 0}


def test_blocks_of_a_hot_family_broadcast_no_texts(spark, monkeypatch):
    plans = []
    kept = family_dedup.materialize
    monkeypatch.setattr(family_dedup, "materialize", lambda df, *a: plans.append(df._jdf.queryExecution().toString()) or kept(df, *a))
    rows = [(i, f"/p{i:03}", ".pdf", "hot", 0.5, 300, f"h{i}", "\n".join(f"w{i % 20} {k} a b c d" for k in range(40))) for i in range(60)]
    out = family_dedup.family_decisions(spark.createDataFrame(rows, DOCS), family_rows=25)
    assert out.where("status = 'canonical'").count() == 20
    assert len(plans) > 5 and not [p for p in plans if "BroadcastHashJoin" in p]


def test_profile_tree(spark):
    names = ["bundle_a/doc.pdf", "bundle_a/doc_djvu.txt", "bundle_b/doc.pdf", "bundle_b/doc_djvu.txt", "scan_001.jpeg", "manual_encrypted.pdf"]
    t = profile.tree(spark.createDataFrame([(f"/root/{n}", 5) for n in names], "path string, size bigint"), F.lit("/root"))
    sig = {r["signal"]: r["files"] for r in profile.signal_counts(t).collect()}
    assert sig["ocr_sidecar_djvu_txt"] == 2 and sig["scan_named_image"] == 1 and sig["encrypted_pdf_name"] == 1
    dup = profile.folder_signatures(t, 2).collect()
    assert [(r["folders"], r["descendants"]) for r in dup] == [(2, 2)]
    assert {r["ext"]: r["files"] for r in profile.ext_histogram(t).collect()} == {".pdf": 3, ".txt": 2, ".jpeg": 1}
    assert {r["recommendation"] for r in profile.recommendations(t).collect()} == {"skip_ocr_sidecars", "review_encrypted_pdfs"}


def test_audit(spark):
    rows = spark.createDataFrame([("a", "text one", 8, 0.9, ["x"], 0), ("b", "", 3, None, [], 0)], "source_path string, text string, text_length int, parse_quality double, tags array<string>, zero int")
    cover = {r["field"]: r["present_rows"] for r in audit.field_coverage(rows, ["source_path", "text", "parse_quality", "tags", "zero", "absent"]).collect()}
    assert cover == {"source_path": 2, "text": 1, "parse_quality": 1, "tags": 1, "zero": 2, "absent": 0}
    r = audit.inspect(rows, ["b"], ["one"]).first()
    assert (r["total"], r["empty_text"], r["length_mismatch"], r["glob_hits"], r["marker_hits"], r["gate"]) == (2, 1, 1, 1, 1, "FAIL")
    c = spark.createDataFrame([("k1",), ("k2",)], "chunk_id string")
    v = spark.createDataFrame([("k1", 4)], "chunk_id string, dim int")
    e = spark.createDataFrame([("k9",)], "chunk_id string")
    m = spark.createDataFrame([(2, 5)], "chunk_count bigint, entity_count bigint")
    r = audit.integrity(c, v, e, m).first()
    assert r["gate"] == "FAIL" and r["issues"] == "entity_count_mismatch,vector_count_mismatch,chunks_without_vector" and r["warnings"] == "orphan_entities"


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 90_000), max_size=60))
def test_budget_batches(lengths):
    got = models.budget_batches(lengths, 20_000, 3, 10)
    want, i, batch = [], 0, 0
    while i < len(lengths):
        left, j = 20_000, i
        while j < len(lengths) and j - i < 10:
            n = max(1, lengths[j] // 4)
            if left - n < 0 and j - i >= 3:
                break
            left, j = left - n, j + 1
        want += [batch] * (j - i)
        batch, i = batch + 1, j
    assert got == want


def test_models(spark):
    c = spark.createDataFrame([("a", 1, "Some words of a text that is long enough."), ("b", 2, None)], "chunk_id string, doc_id int, text string")
    v = {r["chunk_id"]: r["vector"] for r in models.embed(c, lambda: models.HashEmbedder(8)).collect()}
    assert len(v["a"]) == 8 and sum(x * x for x in v["a"]) == pytest.approx(1, abs=1e-5) and sum(v["b"]) == 0
    docs = spark.createDataFrame([(1, "A first sentence here. Some words of a text that is long enough."), (2, None)], "doc_id int, text string")
    assert {r["chunk_id"]: r["enriched_text"] for r in models.enrich(c, docs).collect()}["a"].startswith("A first sentence here\n\nSome")

    def broken(contexts, texts):
        raise RuntimeError

    assert all(r["enriched_text"] is None for r in models.enrich(c, docs, broken).collect())
    found = models.extract(c, lambda ts: [[{"text": t[:4], "label": "X", "score": 0.9, "start": 0, "end": 4}, {"text": "n", "label": "Y", "score": 0.1, "start": 0, "end": 1}] for t in ts]).collect()
    assert [(r["text"], r["label"], r["score"]) for r in found] == [("Some", "X", 0.9)]
    assert metadata.pattern_entities(c).count() == 0
    d = assign_batches(spark.range(500).selectExpr("id AS doc_id", "repeat('x', 4000) AS text"), part=F.col("doc_id") % 4)
    assert d.groupBy("part", "batch").count().agg(F.max("count")).first()[0] <= 256


def test_search_against_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    m = rng.normal(size=(60, 5))
    rows = [(i, [float(x) for x in m[i]]) for i in range(60)] + [(100, None), (101, [0.0] * 5), (102, [1.0])]
    d = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {}
    for r in search.cosine_topk(d.where("vec_id < 3"), d, 4).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    for q in range(3):
        s = u @ u[q]
        s[q] = -9
        assert got[q] == set(np.argsort(-s)[:4].tolist())
    assert search.cosine_topk(d.limit(0), d, 4).count() == 0


def test_components(spark):
    e = [(5, 4), (4, 3), (3, 9), (20, 21), (7, 7), (None, 1), (20, 21)] + [(100, i) for i in range(101, 400)] + [(i, i + 1) for i in range(1000, 1100)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(e, "src bigint, dst bigint")).collect()}
    assert got[9] == got[5] == 3 and got[21] == 20 and got[7] == 7 and got[399] == 100 and got[1100] == 1000 and 1 not in got
    assert connected_components(spark.createDataFrame([], "src bigint, dst bigint")).count() == 0


def test_plans(spark):
    d = spark.range(1000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL ELSE concat('k', id) END AS k")
    rows = {r["id"]: r["n"] for r in attach_group(d, ["k"], {"n": F.count(F.lit(1))}, 1000).collect()}
    assert rows[0] == 334 and rows[1] is None and rows[2] == 1 and len(rows) == 1000
    o = with_ordinal(spark.range(500).select((F.lit(500) - F.col("id")).alias("v")).repartition(7), "v")
    assert all(r["ordinal"] == r["v"] for r in o.collect())
    assert {r["id"] for r in first_k(d.where("k = 'hot'"), ["k"], "id", 3).collect()} == {0, 3, 6}
    assert materialize(d).count() == 1000
    kept = materialize(d)
    assert discard_all(spark) > 0 and discard_all(spark) == 0
    with pytest.raises(Exception, match="."):
        kept.count()
