import pytest
from pyspark.sql import functions as F

from docloom.functions import paths as P
from docloom.functions import text as T
from docloom.functions import vectors as V


def one(spark, expr, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "path,ext,stem,parent",
    [
        ("X:\\a\\b\\Report.PDF", ".pdf", "Report", "X:/a/b"), ("/x/.bashrc", "", ".bashrc", "/x"), ("/x/..b.txt", ".txt", "..b", "/x"), ("name", "", "name", ""), ("a/b.tar.gz", ".gz", "b.tar", "a"), ("a/trailing.", "", "trailing.", "a"), ("", "", "", ""),
    ],
)
def test_path_parts(spark, path, ext, stem, parent):
    df = spark.createDataFrame([(path,)], "p string").select(P.ext(F.col("p")), P.stem(F.col("p")), P.parent(F.col("p")))
    assert tuple(df.first()) == (ext, stem, parent)


def test_null_paths_stay_null(spark):
    df = spark.createDataFrame([(None,)], "p string")
    assert tuple(df.select(P.ext(F.col("p")), P.norm_path(F.col("p")), T.stem_key(F.col("p"))).first()) == (None, None, None)


def test_globs_and_copies(spark):
    p = F.col("p")
    df = spark.createDataFrame([("X:\\in\\Scan_1.JPG",), ("X:/in/a.sao.zip",), ("X:/in/Report_12.docx",)], "p string")
    rows = df.select(P.matches_globs(p, ["*scan*.jpg", "x:/in/*.zip"]), P.suffix_copy_of(p), P.relocate(p, "X:/in", "Y:/out")).collect()
    assert [tuple(r) for r in rows] == [(True, "X:/in/Scan.JPG", "Y:/out/Scan_1.JPG"), (True, None, "Y:/out/a.sao.zip"), (False, "X:/in/Report.docx", "Y:/out/Report_12.docx")]
    assert P.glob_regex("[!a]?.txt") and df.select(P.glob_hits(p, ["*.zip", "*"])).first()[0] == ["*"]


def test_stem_key(spark):
    assert one(spark, T.stem_key(P.stem(F.col("p"))), p="Quarterly_Report_Final_1.pdf") == "quarterly report"
    assert one(spark, T.stem_key(P.stem(F.col("p"))), p="&&.pdf") == "and and"
    assert one(spark, T.stem_key(P.stem(F.col("p"))), p="---.pdf") == "---"


def test_normalized_text(spark):
    text = "Page 1 of 3\nAlpha Report\nalpha report\n2\nALPHA  Report"
    assert one(spark, T.normalized_text(F.col("t")), t=text) == "\n".join(["alpha report"] * 3)
    text = "Head\nbody one has broken wo-\nrds in it\nHead\nother body\nHead\nPrinted on Monday"
    assert one(spark, T.normalized_text(F.col("t")), t=text) == "body one has broken words in it\nother body"
    assert one(spark, T.normalized_text(F.col("t")), t=None) == ""


def test_similarity(spark):
    a = "\n".join(f"line {w} of the text" for w in "abc")
    assert one(spark, T.similarity(F.col("a"), F.col("b")), a=a, b=a + "\nsigned by me") >= 0.9
    assert one(spark, T.similarity(F.col("a"), F.col("b")), a="", b="x") == 0.0
    assert one(spark, T.word_shingles(F.col("t")), t="a b c a b c a b") == ["a b c a b", "b c a b c", "c a b c a"]
    assert one(spark, T.word_shingles(F.col("t")), t="two words") == ["two words"]


@pytest.mark.parametrize("text,score", [(None, 0.0), (" \n", 0.0), ("short", 0.3), ("\x01" * 60, 0.1), ("1234567 " * 20, 0.3), ("previous next navigation " * 5, 0.4), ("Plain words that go on and on. " * 3, 1.0), ("a1" * 30, 0.8)])
def test_parse_quality(spark, text, score):
    assert one(spark, T.parse_quality(F.col("t")), t=text) == score


def test_extraction(spark):
    html = "<html><STYLE>x</STYLE><script>y</script><p>Hello&nbsp; <b>there</b></p></html>"
    assert one(spark, T.html_text(F.col("t")), t=html) == "Hello&nbsp; there"
    xml = "<Event><System><Provider Name='p'/><EventID>7</EventID><TimeCreated SystemTime='t0'/></System><Data>a</Data><Data>b</Data></Event>"
    assert one(spark, T.event_line(F.col("t")), t=xml) == "[t0] EventID=7 Provider=p | a b"
    assert one(spark, T.event_line(F.col("t")), t="<x/>") == ""
    assert one(spark, T.xml_text(F.col("t")), t="<a><b>one</b> <c>two</c></a>") == "one\ntwo"
    assert one(spark, T.byte_runs(F.encode(F.col("t"), "UTF-8")), t="\x00\x01readable words here\x00ab\x00123456789!!\x00") == "readable words here"
    assert one(spark, T.numeric_dump(F.col("t")), t="12 34 " * 40) is True and one(spark, T.numeric_dump(F.col("t")), t=None) is False


def test_context_window(spark):
    doc = "".join(chr(97 + i % 26) for i in range(2000))
    w = T.context_window(F.col("d"), F.col("c"), 100, 60)
    got = one(spark, w, d="x" * 500 + "NEEDLE" + "y" * 500, c="NEEDLE")
    assert got.startswith("... ") and got.endswith(" ...") and "NEEDLE" in got
    assert one(spark, w, d="short", c="x") == "short" and one(spark, w, d=doc, c="absent!") == doc[:60]
    assert one(spark, w, d="NEEDLE" + "y" * 500, c="NEEDLE") == "NEEDLE" + "y" * 54 + " ..."


def test_small_text_functions(spark):
    assert one(spark, T.preview(F.col("t"), 10), t=" a  b\nc ") == "a b c" and len(one(spark, T.preview(F.col("t"), 10), t="x" * 50)) == 10
    assert one(spark, T.rewrite(F.col("t"), [("ab+", "<x>")]), t="zABBz ab") == "z<x>z <x>"
    assert one(spark, T.enriched(F.col("p"), F.col("t")), p="a long preamble", t="text") == "a long preamble\n\ntext" and one(spark, T.enriched(F.col("p"), F.col("t")), p="no", t="text") is None
    assert one(spark, T.token_estimate(F.col("t")), t="") == 1


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [6.0, 8.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>")
    rows = df.select(V.cosine(F.col("a"), F.col("b")).alias("c"), V.unit(F.col("a")).alias("u")).collect()
    assert rows[0]["c"] == pytest.approx(1) and rows[1]["c"] is None and rows[0]["u"] == pytest.approx([0.6, 0.8])
