import email.message
import gzip
import io
import json
import tarfile
import time
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom import config
from docloom.operators import contract, models
from docloom.plans.checkpoint import Checkpoint
from docloom.plans.pipeline import Plugins, build, dedup_only, run
from docloom.sources import files, parsers, sinks
from docloom.streaming.nightly import nightly, windowed_counts


def zipped(**members):
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        for n, d in members.items():
            z.writestr(n.replace("__", "/"), d)
    return b.getvalue()


@pytest.mark.parametrize(
    "name,content,text,quality",
    [
        ("a.txt", b"\xef\xbb\xbfsome words " + b"x" * 60, "some words", 1.0), ("a.md", b"short", "short", 0.5), ("a.csv", b"name,value\na,1\nb,2", "name,value", 0.9), ("a.json", b'{"a":[1]}', '"a": [', 0.9), ("b.json", b"{broken", "{broken", 0.9),
        ("a.xml", b"<r><item>one</item></r>", "one", 0.85), ("b.xml", b"<r><item>one</r>", "one", 0.85), ("a.htm", b"<p>Hi &amp; you</p><script>x</script>", "Hi & you", 0.6), ("a.rtf", rb"{\rtf1\ansi Hello \b bold\b0\par}", "Hello bold", 0.85),
        ("a.doc", b"\x00\x01the readable part of it\x00\xff", "the readable part of it", 0.3), ("a.dwg", b"\x00" * 100, "Type: .dwg", 0.15), ("a.png", b"123", "Size: 3", 0.1), ("a.stp", b"ISO-10303-21;\nFILE_NAME('n','d');\n#1=PRODUCT('P1','');\n", "Entities: 1", 0.8),
        ("x.txt", b"", "", 0.0), ("x.unknown", b"abc", "", 0.0), ("x.zip", b"not a zip", "", 0.0), ("x.pdf", b"%PDF", "", 0.0), ("latin.txt", "größe und maß ".encode("latin-1") * 9, "größe", 1.0),
    ],
)
def test_parsers(name, content, text, quality):
    got, q, _ = parsers.parse(name, content)
    assert text in got and q == quality


def test_reasons():
    assert [parsers.parse(n, b"x")[2] for n in ("a.evtx", "a.zip", "a.nope", "a.txt")] == ["library_missing", "parse_error", "unknown_format", None]
    assert parsers.parse("a.txt", None)[2] == "empty"


def test_office_formats():
    w = 'xmlns:w="w"'
    doc = zipped(**{"word__document.xml": f"<w:d {w}><w:p><w:r><w:t>One</w:t></w:r></w:p><w:p/><w:p><w:t>Two</w:t></w:p></w:d>"})
    assert parsers.parse("a.docx", doc)[:2] == ("One\n\nTwo", 1.0)
    slides = zipped(**{"ppt__slides__slide2.xml": "<s><txBody><p><t>B</t></p></txBody></s>", "ppt__slides__slide1.xml": "<s><txBody><p><t>A</t></p></txBody></s>", "ppt__slides__slide3.xml": "<s/>"})
    assert parsers.parse("a.pptx", slides)[0] == "[SLIDE 1]\nA\n\n[SLIDE 2]\nB"
    sheet = zipped(**{"xl__workbook.xml": '<w><sheet name="S"/></w>', "xl__sharedStrings.xml": "<s><si><t>h1</t></si><si><t>h2</t></si></s>", "xl__worksheets__sheet1.xml": '<w><row><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c></row><row><c r="B2"><v>7</v></c></row></w>'})
    assert parsers.parse("a.xlsx", sheet)[0] == "[SHEET] S\nh1 | h2\nh2: 7"
    odt = zipped(**{"meta.xml": "<m><title>T</title></m>", "content.xml": "<c><p>" + "long enough text " * 5 + "</p></c>"})
    assert parsers.parse("a.odt", odt)[0].startswith("title: T\n\nlong")
    book = zipped(**{"x.opf": '<p><item id="b" href="2.html"/><item id="a" href="1.html"/><itemref idref="b"/><itemref idref="a"/></p>', "1.html": "<p>first file</p>", "2.html": "<p>second file</p>"})
    assert parsers.parse("a.epub", book)[0] == "second file\n\nfirst file"


def test_mail_and_archives():
    m = email.message.EmailMessage()
    m["Subject"], m["From"], m["To"] = "Hello", "a@b.c", "d@e.f"
    m.set_content("The body of the message.")
    text = parsers.parse("a.eml", m.as_bytes())[0]
    assert text.startswith("Subject: Hello\nFrom: a@b.c") and text.endswith("The body of the message.")
    box = b"From x\n" + m.as_bytes() + b"\n\nFrom y\n" + m.as_bytes()
    assert parsers.parse("a.mbox", box)[0].count("Subject: Hello") == 2
    z = zipped(**{"in.txt": "inner text", "..__up.txt": "no", "nested.zip": b"x", "report.SAO.XML": "late", "report_sao.log": "kept"})
    assert {n for n, _ in parsers.archive_members("a.zip", z, ("sao", "rsf"))} == {"in.txt", "report_sao.log"}
    assert list(parsers.archive_members("x.sao.zip", z, (".SAO",))) == []
    assert parsers.parse("a.zip", z)[0].startswith("[ARCHIVE_MEMBER=in.txt]\ninner text")
    b = io.BytesIO()
    with tarfile.open(fileobj=b, mode="w:gz") as t:
        i = tarfile.TarInfo("t.txt")
        i.size = 4
        t.addfile(i, io.BytesIO(b"text"))
    assert parsers.parse("a.tgz", b.getvalue())[0] == "[ARCHIVE_MEMBER=t.txt]\ntext"
    assert parsers.parse("a.txt.gz", gzip.compress(b"zipped words"))[0] == "[ARCHIVE_MEMBER=a.txt]\nzipped words"


def test_registry_takes_a_parser(monkeypatch):
    monkeypatch.setattr(parsers, "REGISTRY", dict(parsers.REGISTRY))
    parsers.register(".pdf")(lambda name, content: ("text of a page", 0.9))
    assert parsers.parse("a.PDF", b"x") == ("text of a page", 0.9, None)


@pytest.fixture
def tree(tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "report.txt").write_text("MAINTENANCE REPORT\n" + "The pump PN-1234 was checked. " * 80)
    (src / "report_1.txt").write_text("MAINTENANCE REPORT\n" + "The pump PN-1234 was checked. " * 80)
    (src / "data.csv").write_text("part_number,status\nA,ok\nB,late")
    (src / "drawing.dwf").write_text("x")
    (src / "~$temp.txt").write_text("temporary")
    (src / "empty.txt").write_text("")
    return src


def test_pipeline_end_to_end(spark, tree, tmp_path):
    out = tmp_path / "out"
    cfg = config.from_dict({"source": str(tree), "output": str(out), "embed": {"dim": 16}})
    stages, folder = run(spark, cfg)
    chunks = [json.loads(x) for p in sorted((folder / "chunks.jsonl").glob("part-*")) for x in p.read_text().splitlines()]
    m = json.loads((folder / "manifest.json").read_text())
    assert m["chunk_count"] == len(chunks) > 2 and list(chunks[0]) == ["chunk_id", "text", "enriched_text", "source_path", "chunk_index", "text_length", "parse_quality"]
    assert np.load(folder / "vectors.npy").shape == (len(chunks), 16) and np.load(folder / "vectors.npy").dtype == np.float16
    assert json.loads((folder / "skip_manifest.json").read_text())["total_skipped"] == 3
    assert {r["decision"] for r in stages.decisions.collect()} == {"work", "duplicate"}
    assert files.newest_export(str(out)) == folder.resolve() and (out / "run_history.jsonl").read_text().count("\n") == 1
    files.register_npy(spark)
    v = spark.read.format("npy").option("path", str(folder / "vectors.npy")).option("rowsPerPartition", "1").load()
    assert v.count() == len(chunks) and len(v.first()["vector"]) == 16
    state = stages.decisions.join(files.scan(spark, str(tree)).select("ordinal", "mtime", "size"), "ordinal").select("path", "hash", "mtime", "size", F.lit("indexed").alias("status"))
    assert build(spark, cfg, files.scan(spark, str(tree)), state).chunks.count() == 0


def test_scan_with_contents_keeps_the_order(spark, tree):
    rows = files.scan(spark, str(tree), content=True).orderBy("ordinal").collect()
    assert [r["path"] for r in rows] == sorted(r["path"] for r in rows) and [r["ordinal"] for r in rows] == list(range(1, 7))
    assert all(len(r["content"]) == r["size"] for r in rows)


def test_facts_are_those_of_the_bytes(spark, tree):
    import hashlib

    s = files.scan(spark, str(tree)).select("ordinal", "path", "size", "mtime")
    for r in files.read_facts(s.unionByName(spark.createDataFrame([(99, "/none", 5, 0.0)], s.schema))).collect():
        data = b"" if r["path"] == "/none" else files.open_file(r["path"]).read()
        assert (r["hash"], r["header"]) == ((None, None) if r["path"] == "/none" else (hashlib.sha256(data).hexdigest(), data[:4096]))


def test_pipeline_with_all_plugins(spark, tree, tmp_path):
    cfg = config.from_dict({"source": str(tree), "output": str(tmp_path / "out"), "embed": {"dim": 8}})
    cp = Checkpoint(spark, f"file://{tmp_path}/cp", config.signature(cfg))

    def broken_backend():
        raise RuntimeError("no device")

    found = lambda texts: [[{"text": "PN-1234", "label": "PART", "score": 0.9, "start": 0, "end": 7}] if "PN-1234" in t else [] for t in texts]
    plug = lambda **k: Plugins(embedder=lambda: models.Backends(broken_backend, lambda: models.HashEmbedder(4)), enricher=models.lead_sentence, extractor=found, checkpoint=cp, metadata=True, **k)
    stages, folder = run(spark, cfg, plugins=plug(should_stop=lambda: True))
    assert stages.stopped and json.loads((folder / "manifest.json").read_text())["chunk_count"] == 0
    time.sleep(1.1)
    first = build(spark, cfg, files.scan(spark, str(tree)), plugins=plug())
    n = first.chunks.count()
    assert n > 2 and first.chunks.where("enriched_text is not null").count() == n and first.vectors.first()["vector"].__len__() == 4
    assert set(contract.CHUNK_FIELDS + contract.METADATA_FIELDS) <= set(first.chunks.columns)
    # the second run parses nothing and takes the chunks over from the checkpoint
    stages, folder = run(spark, cfg, plugins=plug())
    assert stages.parsed.count() == 0 and stages.chunks.count() == n and np.load(folder / "vectors.npy").shape == (n, 4)
    assert stages.entities.where("label = 'PART' and source_path is not null").count() > 0
    assert cp.done().count() == 0
    m = json.loads((folder / "skip_manifest.json").read_text())
    assert m["count"] == m["total_skipped"] == len(m["skipped_files"]) and m["deferred_formats"] == [{"extension": "dwf", "count": 1, "reason": "Design Web Format"}]
    assert "Skipped" in (folder / "run_report.txt").read_text()


def test_dedup_only_with_copy(spark, tree, tmp_path):
    rows, copied = dedup_only(spark, str(tree), spark.createDataFrame([], "path string, hash string, mtime double, size bigint, status string"), str(tmp_path / "copy"))
    assert {r["path"].rsplit("/", 1)[-1]: r["status"] for r in rows.collect()}["report_1.txt"] == "duplicate"
    assert {r["rel"]: r["status"] for r in copied.collect()} == {x: "copied" for x in ("report.txt", "data.csv", "drawing.dwf", "~$temp.txt", "empty.txt")}


def test_scan_lists_and_lines(spark, tree, tmp_path):
    s = files.scan(spark, str(tree), [".txt"])
    assert [r["ordinal"] for r in s.orderBy("path").collect()] == list(range(1, 5)) and files.scan(spark, str(tree), max_files=2).count() == 2
    lst = tmp_path / "list.txt"
    lst.write_text(f"# comment\n\n{tree}/report.txt\n{tree}/REPORT.TXT\n{tree}/missing.pdf\n")
    have, missing = files.input_list(spark, str(lst), s)
    assert have.count() == 1 and [tuple(r) for r in missing.collect()] == [(".pdf", 1)]
    j = tmp_path / "rows.jsonl"
    j.write_text('{"a": 1}\n\n{"a": 2}\n{"a": ')
    assert files.read_jsonl(spark, str(j), "a int").count() == 2 and files.read_jsonl(spark, str(j), "a int", keep_corrupt=True).count() == 3 and files.count_lines(spark, str(j)) == 4


def test_copies(spark, tree, tmp_path):
    dst = tmp_path / "mirror"
    f = spark.createDataFrame([(str(tree / "report.txt"), "report.txt"), (str(tree / "data.csv"), "sub/data.csv"), (str(tree / "none"), "none"), (str(tree / "data.csv"), "../out.csv")], "path string, rel string")
    status = lambda: {r["rel"]: r["status"] for r in sinks.copy_verified(f, str(dst)).collect()}
    assert status() == {"report.txt": "copied", "sub/data.csv": "copied", "none": "failed", "../out.csv": "failed"}
    (dst / "report.txt").write_text("other")
    assert status() == {"report.txt": "copied", "sub/data.csv": "skipped", "none": "failed", "../out.csv": "failed"}
    assert (dst / "report.txt").stat().st_mtime == pytest.approx((tree / "report.txt").stat().st_mtime)


def test_nightly_stream_sees_each_file_once(spark, tree, tmp_path):
    seen = []
    go = lambda: nightly(spark, str(tree), str(tmp_path / "cp"), lambda df, n: seen.extend(r["path"].rsplit("/", 1)[-1] for r in df.select("path").collect()), 2).awaitTermination(120)
    go()
    first = sorted(seen)
    (tree / "late.txt").write_text("new")
    go()
    assert len(first) == 5 and sorted(seen) == sorted([*first, "late.txt"])


def test_windowed_counts(spark):
    e = spark.createDataFrame([("2025-01-01 00:10:00", "a"), ("2025-01-01 00:50:00", "a"), ("2025-01-01 01:10:00", "b")], "ts string, event_type string").withColumn("ts", F.to_timestamp("ts"))
    assert sorted(r["n"] for r in windowed_counts(e).collect()) == [1, 2]


def test_config(tmp_path):
    (tmp_path / "c.yaml").write_text("source: in\nchunk:\n  size: 500\n")
    c = config.load(tmp_path / "c.yaml", {"chunk": {"overlap": 50}})
    assert (c.chunk.size, c.chunk.overlap, c.source) == (500, 50, str(tmp_path / "in"))
    assert config.signature(c) == config.signature(config.load(tmp_path / "c.yaml", {"chunk": {"overlap": 50}})) != config.signature(config.Config())
    for bad in ({"nope": 1}, {"chunk": {"size": 5}}, {"chunk": {"size": 200, "overlap": 200}}, {"parse": {"ocr_mode": "x"}}, {"delta": {"run_at": "25:00"}}):
        with pytest.raises(ValueError):
            config.from_dict(bad)
