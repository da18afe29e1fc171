from datetime import datetime as dt

from docloom.llm.survivors import claims_of, discover_truth, group_survivors, surviving_records

SCHEMA = "file_id bigint, path string, status string, canonical_path string, dedup_reason string, similarity double, ext string, stem_key string, parse_quality double, raw_chars int, normalized_chars int, normalized_hash string, decided_at timestamp, root string, group_id int"


def row(i, path, canon, q=0.5, ext=".pdf", raw=10, at=1, h="h"):
    return (i, path, "canonical", canon, "x", 1.0, ext, "s", q, raw, raw, h, dt(2025, 1, at), "r", 7)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_survivors_and_ties(spark):
    rows = [
        row(5, "X:/a/one.pdf", "x:\\A\\two.docx"), row(3, "X:/a//TWO.docx", "X:/a/two.docx", ext=" DOCX "), row(8, "X:/a/three.doc", "X:/a/one.pdf", q=float("nan")),
        row(20, "X:/b/one.pdf", "X:/b/one.pdf"), row(21, "X:/c/x.pdf", "X:/gone.pdf", q=2.0), row(22, "X:/c/y.pdf", "x:/gone.pdf ", q=None, raw=-5),
        row(30, "X:/d/x.pdf", None), row(31, "X:/d/x.pdf", None), row(None, "X:/a/two.docx", "X:/a/two.docx"), row(5, "X:/a/one.pdf", "X:/z/old.pdf", at=1),
    ]
    rows[0] = row(5, "X:/a/one.pdf", "x:\\A\\two.docx", at=9)
    groups, _ = group_survivors(frame(spark, rows))
    got = {(r["group_id"], r["survivor_id"], r["members"]) for r in groups.collect()}
    assert got == {(3, 3, 3), (21, 21, 2)}


def test_hot_canonical_path(spark):
    rows = [row(i, f"X:/h/{i}.pdf", "X:/h/1.pdf", q=0.9 if i == 77 else 0.1) for i in range(1, 400)]
    out = surviving_records(frame(spark, rows)).collect()
    assert [(r["group_id"], r["survivor_id"], r["members"]) for r in out] == [(1, 77, 399)]


def test_truth_follows_reliable_sources(spark):
    rows = []
    for g in range(12):
        base = 100 * g
        for k, src in enumerate(("good", "fine", "bad")):
            h = "wrong" if src == "bad" else "right"
            rows.append(row(base + k, f"X:/{src}/x/{base}.pdf", f"X:/canon/{base}.pdf", h=f"{h}{g}"))
    # two votes of the bad source against one of the good
    rows += [row(5000, "X:/good/x/t.pdf", "X:/canon/t.pdf", h="right"), row(5001, "X:/bad/x/t.pdf", "X:/canon/t.pdf", h="wrong")]
    d = frame(spark, rows)
    _, members = group_survivors(d)
    best, sources = discover_truth(claims_of(members))
    value = {(r["group_id"], r["field"]): r["value"] for r in best.collect()}
    assert value[5000, "normalized_hash"] == "right" and value[0, "normalized_hash"] == "right0"
    r = {x["source"]: x["r"] for x in sources.collect()}
    assert r["x:/good/x"] > r["x:/bad/x"]


def test_empty_and_null_rows(spark):
    assert surviving_records(frame(spark, [])).count() == 0
    nothing = (9, None, None, None, None, None, None, None, None, None, None, None, None, None, None)
    assert surviving_records(frame(spark, [nothing, (None, *nothing[1:])])).count() == 0
