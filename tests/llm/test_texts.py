import random

import numpy as np
import pytest

from docloom.llm.containers import fill, fill_containers, length_buckets
from docloom.llm.eval_leaks import eval_leaks
from docloom.llm.reading_level import FEATURES, OrdinalModel, features, held_out_agreement, reading_bands, reading_levels
from docloom.llm.scan_repair import KNOWN, Channel, _places, layout, repair_scans
from docloom.llm.splitting import cut, is_heading, split_texts
from docloom.llm.text_types import learn_votes, not_prose, text_types

CLEAN = (
    "The survey team repaired the northern antenna near the harbor because the cable was worn. "
    "After the annual audit the crew chief returned the printed manual and closed the order. "
    "The depot clerk counted nine modular units in the spares locker and listed them. "
)


def page(rng, n):
    """A scanned text of ``n`` pages with the lines at which each defect stands."""
    words = (CLEAN * (3 * n)).split()
    lines, defects, at, k = [], set(), 0, 0
    for p in range(1, n + 1):
        lines.append("Quarterly Report of the Depot")
        defects.add((len(lines), "running_line"))
        for _ in range(7):
            line = words[at : at + 9]
            at += 9
            if p == 2 and k == 0:
                line[2], k = line[2].replace("e", "c", 1) if "e" in line[2] else line[2], 1
            lines.append(" ".join(line))
        if p == 1:
            lines[-1] = lines[-1] + " mod-"
            defects.add((len(lines), "split_word"))
        lines.append(f"- {p} -")
        defects.add((len(lines), "page_number"))
        if p == 1:
            words[at] = "ular " + words[at]
    return "\n".join(lines), defects


def test_scan_defects_and_repair(spark):
    text, want = page(random.Random(1), 3)
    text = text.replace("annual audit", "annua1 audlt", 1)
    row = next(i for i, x in enumerate(text.split("\n"), 1) if "annua1" in x)
    rows = [(1, text)] + [(i, CLEAN * 20) for i in range(2, 8)] + [(20, None), (21, ""), (22, " \n "), (None, text), (23, "12\n" * 4)]
    d = spark.createDataFrame([(*r, "q") for r in rows], "file_id bigint, text string, defects string")
    out = {r["file_id"]: r for r in repair_scans(d).collect()}
    assert len(out) == 11 and out[20]["text"] is None and out[21]["defects"] == []
    found = {(x["line_no"], x["defect"]) for x in out[1]["defects"]}
    assert want <= found and (row, "misread") in found
    assert "annual audit" in out[1]["text"] and "modular" in out[1]["text"] and "Quarterly" not in out[1]["text"] and "- 2 -" not in out[1]["text"]
    assert not any(out[i]["defects"] for i in range(2, 8))


def test_layout_of_numbers_in_running_lines():
    body = [f"line {w} goes on and on in the" for w in "abcdefgh"]
    lines = ["The Title   1", *body[:4], "The Title   2", *body[4:], "The Title   3"]
    assert {i: k for i, k in layout(lines).items()} == {0: "running_line", 5: "running_line", 10: "running_line"}


def test_layout_with_misread_and_alternating_headers():
    body = ["goes on and on in the long body line", "so that nobody will ever see the end"]
    lines = ["Chiller Order", *body, "- 1 -", "Chi1ler 0rder", *body[::-1], "2   Depot Plan", *body, "- 3 -", "4   Depot P1an", "and the rest of it all"]
    got = layout(lines)
    assert {i for i, k in got.items() if k == "page_number"} == {3, 10}
    assert {i for i, k in got.items() if k == "running_line"} == {0, 4, 7, 11}


def test_repair_of_an_empty_table(spark):
    assert repair_scans(spark.createDataFrame([], "file_id bigint, text string")).count() == 0


@pytest.mark.parametrize("size,overlap,heading", [(100, 0, 0), (100, 20, 60), (60, 59, 20), (1, 0, 0), (10, 500, 5), (4000, 400, 200)])
def test_cut_is_admissible(size, overlap, heading):
    rng = random.Random(size + overlap)
    for text in (CLEAN, "word " * 500, "x" * 1000, "HEAD LINE\n" + CLEAN + "\n\n" + CLEAN * 4, "".join(rng.choice("ab .\n") for _ in range(900)).strip(), "äöü\U0001f600 " * 90):
        text = text.strip()
        spans = cut(text, size, overlap, heading)
        own = min(overlap, size - 1)
        assert spans[0][0] == 0 and spans[-1][1] == len(text)
        assert all(0 < b - a <= size for a, b in spans)
        assert all(n[0] == p[1] - own for p, n in zip(spans, spans[1:], strict=False))
    assert cut("", size, overlap) == []


def test_cut_prefers_paragraphs_and_keeps_headings():
    a, b = "Alpha beta gamma. " * 4, "Delta epsilon zeta. " * 4
    text = f"{a.strip()}\n\nNEXT PART\n{b.strip()}"
    spans = cut(text, 110, 0, 60)
    assert text[spans[1][0] :].startswith("NEXT PART")
    assert is_heading("3.1 Results", 60) and is_heading("Notes:", 60) and not is_heading("Some words.", 60) and not is_heading("A" * 80, 60)


def test_cut_against_all_cuts():
    """The dynamic programme finds the cheapest of all admissible cuts at the same boundaries."""
    from docloom.llm import splitting as S

    rng = random.Random(4)
    seen = 0
    for _ in range(200):
        text = "".join(rng.choice(["a", "b", ". ", "\n", "\n\n"]) for _ in range(40)).strip()
        size, overlap, n = 12, rng.randrange(4), len(text)
        place, cost = S.boundaries(text, 0)
        gaps = np.diff([0, *place, n])
        step = size - overlap
        if n <= size or gaps.max() > step // 2 or (cost == S.BLANK).any():
            continue
        seen += 1
        price = dict(zip(place.tolist(), cost.tolist(), strict=True)) | {n: 0.0}
        ideal = (n - overlap) / (1 + -(-(n - size) // step))

        def best(e, price=price, ideal=ideal, step=step, overlap=overlap, size=size):
            out = [price[e] + S.BALANCE * ((e - overlap - ideal) / ideal) ** 2] if e <= size else []
            out += [best(p) + price[e] + S.BALANCE * ((e - p - ideal) / ideal) ** 2 for p in price if max(e - step, overlap + 1) <= p < e]
            return min(out, default=float("inf"))

        ends = [b for _, b in cut(text, size, overlap, 0)]
        got = sum(price[e] for e in ends) + sum(S.BALANCE * ((e - p - ideal) / ideal) ** 2 for p, e in zip([overlap, *ends], ends, strict=False))
        assert abs(got - best(n)) < 1e-9
    assert seen >= 10


def test_split_texts_of_odd_rows(spark):
    runs = spark.createDataFrame([(1, 100, 10, 60), (2, None, 1, 1), (None, 50, 0, 0), (3, 50, None, None)], "run_id int, size int, overlap int, max_heading_len int")
    rows = [(1, CLEAN, 1), (2, CLEAN, 2), (3, CLEAN, 3), (4, CLEAN, None), (5, None, 1), (6, "  \n ", 1), (None, CLEAN, 1), (7, "short", 1), (8, CLEAN, 9), (1, CLEAN, 1)]
    d = spark.createDataFrame([(*r, 0) for r in rows], "file_id bigint, text string, run_id int, pieces int")
    out = split_texts(d, runs).collect()
    assert {r["file_id"] for r in out} == {1, 3, 7} and all(len(r["text"]) <= 100 for r in out)
    assert sum(r["file_id"] == 1 and r["piece_no"] == 1 for r in out) == 2
    assert split_texts(d.limit(0), runs).count() == 0 and split_texts(d, runs.limit(0)).count() == 0


LIST = "\n".join(f"- {w} valve" for w in "abcdefghijklmnop")
TABLE = "a | b | c\n" + "\n".join(f"{i} | x{i} | {i * 7}.5" for i in range(20))
JUNK = "\n".join("x9%q #z@w ^k7& 8v)b <p>= }q{ ~~x" for _ in range(12))


def test_text_types(spark):
    rows = [(1, CLEAN * 3), (2, LIST), (3, TABLE), (4, JUNK), (5, None), (6, ""), (7, " \n\t"), (None, LIST)] + [(i, [CLEAN * 2, LIST, TABLE, JUNK][i % 4]) for i in range(10, 50)]
    d = spark.createDataFrame([(*r, "v") for r in rows], "file_id bigint, text string, kind string")
    kinds = {r["file_id"]: r["kind"] for r in text_types(d).collect()}
    assert [kinds[i] for i in range(1, 8)] == ["prose", "list", "table", "junk", None, None, None]
    assert {r["file_id"]: r["kind"] for r in not_prose(d).where("file_id < 10").collect()} == {2: "list", 3: "table", 4: "junk"}
    assert text_types(d.limit(0)).count() == 0


def test_votes_learn_a_noisy_function():
    post = learn_votes({"0-0": 50, "1-1": 40, "0-1": 2, "---": 5})
    assert post["0-0"].argmax() == 0 and post["1-1"].argmax() == 1 and abs(post["---"].sum() - 1) < 1e-9
    assert learn_votes({}) == {}


def test_posterior_decides_against_the_lines_that_mislead():
    """One function errs often; what the other functions agree on wins over it, so its vote alone is not the type."""
    counts = {"000": 90, "111": 60, "222": 40, "011": 25, "100": 25, "022": 15, "3--": 3}
    post = learn_votes(counts)
    assert [int(post[k].argmax()) for k in ("011", "100", "022")] == [1, 0, 2]


def test_noise_with_column_signs_is_junk(spark):
    rng = random.Random(13)
    noise = lambda: "\n".join("".join(rng.choice("|!:;.,'`^~_- 1lI") for _ in range(50)) for _ in range(9))
    rows = [(i, noise()) for i in range(8)] + [(i, [CLEAN * 2, LIST, TABLE, JUNK][i % 4]) for i in range(10, 90)]
    d = spark.createDataFrame(rows, "file_id bigint, text string")
    assert {r["kind"] for r in not_prose(d).where("file_id < 8").collect()} == {"junk"}


def test_unseen_words_stay_unknown_at_any_load():
    """Words never counted are hardly ever taken as known, however full the tables are; frequent words stay known."""
    bits = 14
    rng = np.random.default_rng(3)
    for distinct in (1_000, 50_000, 2_000_000):
        table = np.zeros(4 << bits, np.uint32)
        seen = rng.integers(0, 1 << 63, distinct).astype(np.uint64)
        often = rng.integers(0, 1 << 63, 50).astype(np.uint64)
        for words, times in ((seen, 1), (often, 20_000)):
            for k, place in enumerate(_places(words, bits)):
                np.add.at(table, place + (k << bits), times)
        table[-1] = distinct + 50 * 20_000
        channel = Channel(table)
        unseen = rng.integers(0, 1 << 63, 20_000).astype(np.uint64).tolist()
        assert np.mean(np.array(channel.counts(unseen)) >= KNOWN) < 0.01
        assert min(channel.counts(often.tolist())) >= KNOWN


def test_short_pages_are_repaired(spark):
    """Two or three lines are a page if a sentence goes on in the next line."""
    rows = [(1, "The depot clerk counted nine modu-\nlar units in the spares locker and 1isted them."), (2, "The survey team repaired the northern an-\ntenna near the harbor because\nthe cab1e was worn.")] + [(i, CLEAN * 20) for i in range(10, 18)]
    out = {r["file_id"]: r for r in repair_scans(spark.createDataFrame(rows, "file_id bigint, text string")).collect()}
    assert {(x["line_no"], x["defect"]) for x in out[1]["defects"]} == {(1, "split_word"), (2, "misread")}
    assert out[1]["text"] == "The depot clerk counted nine modular units in the spares locker and listed them."
    assert out[2]["text"] == "The survey team repaired the northern antenna near the harbor because the cable was worn."


def test_cut_against_all_cuts_of_texts_with_words_and_headings():
    """Candidates that are left out beforehand cost nothing: no cut over all boundaries is cheaper."""
    from docloom.llm import splitting as S

    rng = random.Random(14)
    for _ in range(150):
        parts = [" ".join(rng.choice(["ab", "cde", "fghij", "k"]) for _ in range(rng.randrange(2, 14))) + rng.choice([". ", ".\n", "\n\n", " "]) for _ in range(30)]
        text = "".join(rng.choice(["", "", "HEAD LINE\n"]) + p for p in parts).strip()
        size, overlap, n = 120, 15, len(text)
        place, cost = S.boundaries(text, 40)
        price = dict(zip(place.tolist(), cost.tolist(), strict=True)) | {n: 0.0}
        step = size - overlap
        ideal = (n - overlap) / (1 + -(-(n - size) // step))
        best: dict[int, float] = {}
        for e in sorted(price):
            ways = [price[e] + S.BALANCE * ((e - overlap - ideal) / ideal) ** 2] if e <= size else []
            ways += [best[p] + price[e] + S.BALANCE * ((e - p - ideal) / ideal) ** 2 for p in best if max(e - step, overlap + 1) <= p < e]
            best[e] = min(ways, default=float("inf"))
        ends = [b for _, b in cut(text, size, overlap, 40)]
        got = sum(price[e] for e in ends) + sum(S.BALANCE * ((e - p - ideal) / ideal) ** 2 for p, e in zip([overlap, *ends], ends, strict=False))
        assert got <= best[n] + 1e-9


def test_level_meets_held_out_grades(spark):
    """Held-out grades are met better by the level than by the mean grade."""
    rng = random.Random(12)
    short, long = EASY.split(". "), HARD.split(" ")
    rows, grades = [], []
    for i in range(1, 81):
        g = 1 + i % 5
        rows.append((i, " ".join(rng.choice(short) + "." for _ in range(12 * (6 - g))) + " " + " ".join(" ".join(rng.choice(long) for _ in range(12 + 3 * g)) + "." for _ in range(3 * g))))
        grades.append((i, min(5, max(1, g + (rng.random() < 0.15)))))
    r = held_out_agreement(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(grades, "doc_id bigint, grade int")).first()
    assert r["held_out"] >= 8 and r["error"] < 0.6 * r["error_of_mean"] and r["within_one"] > 0.8


def test_length_buckets_are_optimal():
    from itertools import combinations

    rng = random.Random(2)
    for _ in range(40):
        lengths = sorted(rng.sample(range(60), rng.randrange(1, 9)))
        counts = [rng.randrange(1, 9) for _ in lengths]
        pad = lambda bounds: sum(c * (min(b for b in bounds if b >= n) - n) for n, c in zip(lengths, counts, strict=True))  # noqa: E731, B023
        for most in (1, 2, 3):
            best = min(pad([*c, lengths[-1]]) for k in range(most) for c in combinations(lengths[:-1], k))
            got = length_buckets(np.array(lengths), np.array(counts), most)
            assert len(got) <= most and pad(got) == best
    assert length_buckets(np.array([], int), np.array([], int)) == []


def test_fill_keeps_pieces_whole():
    rng = random.Random(8)
    n = np.array([rng.randrange(0, 101) for _ in range(500)] + [0, 0, 100])
    bounds = length_buckets(*np.unique(n, return_counts=True), 8)
    box, batch = fill(n, bounds, 100)
    assert (box >= 0).all() and np.bincount(box, n).max() <= 100
    assert np.bincount(box, n).mean() > 95
    assert fill(np.array([], int), [], 10)[0].tolist() == []


def test_buckets_decide_the_batches():
    """A batch holds as many pieces of its bucket as the bound allows before anything else is added; other bounds give other containers."""
    rng = random.Random(5)
    n = np.array([rng.randrange(1, 60) for _ in range(400)])
    bounds = length_buckets(*np.unique(n, return_counts=True), 6)
    box, batch = fill(n, bounds, 100)
    bucket = np.searchsorted(bounds, n)
    for c in np.unique(box):
        home = batch[box == c][0]
        own = (bucket[box == c] == home).sum()
        later = (box > c) & (bucket == home)
        assert own >= min(100 // bounds[home], own + later.sum())
        assert (bucket[box == c] <= home).all()
    other, _ = fill(n, [59], 100)
    assert len({tuple(np.flatnonzero(box == c)) for c in np.unique(box)} - {tuple(np.flatnonzero(other == c)) for c in np.unique(other)}) > 10


def test_containers(spark):
    d = spark.createDataFrame([(1, "a b c " * 50, 1), (2, None, 1), (3, "", 1), (4, "x", 1), (4, "x", 1), (None, "x", 1)], "doc_id bigint, text string, tokens int")
    s = spark.createDataFrame([(1, 64), (2, None), (None, 4096)], "spec_id int, capacity_tokens int")
    rows = fill_containers(d, s).collect()
    one = [r for r in rows if r["spec_id"] == 1]
    assert sorted(r["doc_id"] for r in one if r["doc_id"] != 1) == [2, 3, 4, 4]
    per: dict = {}
    for r in one:
        per[r["container_id"]] = per.get(r["container_id"], 0) + r["tokens"]
    assert max(per.values()) <= 64
    pieces = [r for r in one if r["doc_id"] == 1]
    assert len(pieces) == pieces[0]["pieces"] > 1 and sum(r["tokens"] for r in pieces) == [r for r in rows if r["spec_id"] is None and r["doc_id"] == 1][0]["tokens"]
    assert fill_containers(d.limit(0), s).count() == 0 and fill_containers(d, s.limit(0)).count() == 0


def test_leaks(spark):
    rng = random.Random(6)
    words = [f"q{i}r" for i in range(900)]
    item = [rng.choice(words) for _ in range(40)]
    other = lambda n: " ".join(rng.choice(words) for _ in range(n))
    docs = [
        (1, other(50) + " " + ", ".join(item[5:25]).upper() + "\n" + other(50)), (2, other(30) + " " + " ".join(item[3:17]) + " " + other(30)), (3, " ".join(item[10:25])), (4, None), (5, ""), (6, other(40)),
        (7, other(20) + " " + " ".join(item[:7] + ["zz" + item[7]] + item[8:15]) + " " + other(9)), (1, " ".join(item[5:25])), (None, " ".join(item)), (8, "x" + " ".join(item[10:25])),
    ]
    items = [(1, " ".join(item)), (2, None), (3, "too short"), (None, " ".join(item)), (1, " ".join(item))]
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id bigint, text string, item_id int")
    e = spark.createDataFrame(items, "item_id bigint, text string")
    rows = {(r["doc_id"], r["item_id"]): r for r in eval_leaks(d, e).collect()}
    assert {k for k, r in rows.items() if r["words"] >= 15} == {(1, 1), (3, 1)} and rows[1, 1]["words"] == 20
    assert eval_leaks(d.limit(0), e).count() == 0 and eval_leaks(d, e.limit(0)).count() == 0


def test_leaks_of_items_in_several_blocks(spark, monkeypatch):
    """Blocks bounded by their characters give the rows of one block."""
    from docloom.llm import eval_leaks as E

    rng = random.Random(16)
    words = [f"q{i}r" for i in range(900)]
    item = lambda: [rng.choice(words) for _ in range(30)]
    items = [item() for _ in range(9)]
    d = spark.createDataFrame([(k, " ".join(item() + x[4:24] + item())) for k, x in enumerate(items)], "doc_id bigint, text string")
    e = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id bigint, text string")
    whole = {tuple(r) for r in E.eval_leaks(d, e).collect()}
    monkeypatch.setattr(E, "BLOCK_CHARS", 300)
    assert len(whole) == 9 and {tuple(r) for r in E.eval_leaks(d, e).collect()} == whole


EASY = "The dog ran home. It was cold. We saw the big red van on the hill. He has a hat. " * 4
HARD = "Notwithstanding the quantitative classification of the asynchronous environment, the subordinate characterization undermines an exceptional accountability whose redundancy articulates, under conditional dependency (approx. 5 hours), the approximation of every inconsistent jurisdiction and institutional requirement. " * 3


def test_features():
    f = features([EASY, HARD, "", None, "No. 5 is here. See fig. 3 and rev. B of it. Done.", "Eins zwei."], np.ones(1 << 18, np.uint32))
    assert f["sentences"].tolist()[:4] == [16, 3, 0, 0] and f["sentence_words"][0] == pytest.approx(80 / 16)
    assert f["sentences"][4] == 3 and f["long_share"][1] > 0.45 and f["words"][3] == 0
    assert all(len(f[k]) == 6 and np.isfinite(f[k]).all() for k in FEATURES)


def test_reading_bands(spark):
    rows = [(1, EASY), (2, HARD), (3, None), (4, ""), (5, "Uno dos tres. " * 20), (None, EASY)] + [(i, EASY if i % 2 else HARD) for i in range(10, 40)]
    d = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, level string")
    labels = spark.createDataFrame([(i, 1 if i % 2 else 5) for i in range(10, 40)] + [(10, 4), (11, None), (None, 3), (999, 2)], "doc_id bigint, grade int")
    out = {r["doc_id"]: r["band"] for r in reading_bands(d, labels).where("doc_id < 10").collect()}
    assert out == {1: "easy", 2: "hard"}
    levels = {r["doc_id"]: r["level"] for r in reading_levels(d, labels.limit(0)).collect()}
    assert levels[3] is None and levels[1] == levels[2]
    assert reading_levels(d.limit(0), labels).count() == 0


def test_ordinal_model_on_held_out_rows():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, len(FEATURES)))
    y = np.digitize(x @ np.linspace(1, 2, len(FEATURES)) + rng.normal(size=600), [-4, -1, 1, 4]) + 1
    m = OrdinalModel(x[:400], y[:400])
    assert np.abs(m.level(x[400:]) - y[400:]).mean() < 0.5
    assert (np.diff(m.cuts) > 0).all()
