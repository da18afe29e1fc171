import random
import shutil

import numpy as np
import pytest

from docloom.llm.alignment import banded_distance
from docloom.llm.incremental import PrefixIndex, match_batches
from docloom.llm.layout_copies import layout_copies, record_key
from docloom.llm.near_duplicates import near_duplicate_groups

WORDS = [f"w{i}x" for i in range(3000)]


def text(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edit(rng, t, k):
    w = t.split()
    for _ in range(k):
        p = rng.randrange(len(w))
        kind = rng.randrange(3)
        if kind == 0:
            w[p] = rng.choice(WORDS)
        elif kind == 1:
            del w[p]
        else:
            w.insert(p, rng.choice(WORDS))
    return " ".join(w)


def grams(t):
    w = "".join(c if c.isalnum() else " " for c in t.lower()).split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(rows, threshold=0.9, least=200):
    sets = {i: grams(t) for i, t in rows if t and len(t) >= least and grams(t)}
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            if len(sets[a] & sets[b]) >= threshold * min(len(sets[a]), len(sets[b])):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {(find(i), i) for i in ids if find(i) != i}


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    rows = []
    for base in range(12):
        t = text(rng, rng.randrange(60, 300))
        rows.append((len(rows) + 1, t))
        for _ in range(rng.randrange(4)):
            rows.append((len(rows) + 1, edit(rng, t, rng.randrange(4))))
        if base % 4 == 0:  # moved halves, capitals and punctuation
            w = t.split()
            half = len(w) // 2
            rows.append((len(rows) + 1, ", ".join(w[half:]).upper() + " . " + " ".join(w[:half])))
    rows += [(900, None), (901, ""), (902, "short text"), (903, "x" * 5000), (904, text(rng, 30000))]
    return rows


def test_groups_against_brute_force(spark, corpus):
    d = spark.createDataFrame(corpus, "file_id bigint, normalized_text string")
    got = {(r["first"], r["id"]) for r in near_duplicate_groups(d).collect() if r["first"] != r["id"]}
    assert got == brute(corpus)


def test_hub_with_many_edited_copies(spark):
    rng = random.Random(9)
    t = text(rng, 200)
    rows = [(1, t)] + [(i, edit(rng, t, 3)) for i in range(2, 80)]
    d = spark.createDataFrame(rows, "file_id bigint, normalized_text string")
    got = {(r["first"], r["id"]) for r in near_duplicate_groups(d).collect() if r["first"] != r["id"]}
    assert got == brute(rows)


def test_template_that_holds_a_third_of_the_rows(spark):
    """True pairs whose keys are all shared by the other records of the template."""
    rng = random.Random(17)
    form = text(rng, 180).split()

    def record():  # one run of own words: the template part stays below the threshold
        w, at = list(form), rng.randrange(20, 140)
        w[at : at + 20] = text(rng, 22).split()
        return " ".join(w)

    rows = [(i, record()) for i in range(1, 301)]
    rows += [(1000 + i, edit(rng, t, 3)) for i, t in rows[:100]]
    rows += [(5000 + i, text(rng, 180)) for i in range(800)]
    rng.shuffle(rows)
    d = spark.createDataFrame(rows, "file_id bigint, normalized_text string")
    got = {(r["first"], r["id"]) for r in near_duplicate_groups(d).collect() if r["first"] != r["id"]}
    want = brute(rows)
    assert len(want) > 50 and got == want


def test_fragments_of_much_longer_texts(spark):
    rng = random.Random(23)
    rows = []
    for i in range(1, 61):
        t = text(rng, 400)
        rows += [(i, t), (100 + i, " ".join(t.split()[70:106]))]
    rows += [(1000 + i, edit(rng, " ".join(t.split()[100:220]), 2)) for i, t in rows[::2]]
    d = spark.createDataFrame(rows, "file_id bigint, normalized_text string")
    got = {(r["first"], r["id"]) for r in near_duplicate_groups(d).collect() if r["first"] != r["id"]}
    assert got == brute(rows)


def test_exact_copies_repeated_rows_clashing_columns_and_nulls(spark):
    rng = random.Random(3)
    t = text(rng, 80)
    rows = [(i, t if i % 2 else t.upper() + " !", "k", 1, None) for i in range(1, 40)] + [(5, t, "k", 1, None), (None, t, None, None, None), (50, None, None, None, None)]
    d = spark.createDataFrame(rows, "file_id bigint, normalized_text string, id string, rep int, text string")
    out = near_duplicate_groups(d).collect()
    assert {(r["first"], r["id"]) for r in out} == {(1, i) for i in range(1, 40)}
    assert all(r["similarity"] == 1.0 for r in out)


def test_empty_tables(spark):
    d = spark.createDataFrame([], "file_id bigint, normalized_text string")
    assert near_duplicate_groups(d).count() == 0
    assert layout_copies(d).count() == 0


def test_banded_distance_against_full_table():
    rng = np.random.default_rng(1)

    def full(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            nxt = [i]
            for j, y in enumerate(b, 1):
                nxt.append(min(row[j] + 1, nxt[-1] + 1, row[j - 1] + (x != y)))
            row = nxt
        return row[-1]

    left = [rng.integers(0, 4, rng.integers(0, 30)) for _ in range(200)]
    right = [np.delete(np.append(x, rng.integers(0, 4, 3)), slice(0, rng.integers(0, 3))) for x in left]
    for band in (2, 6):
        want = [min(full(a, b), band + 1) for a, b in zip(left, right, strict=True)]
        assert banded_distance(left, right, band).tolist() == want
    assert banded_distance([], [], 3).tolist() == []


STATE = "file_id bigint, path string, source_root string, hash string, mtime double, size bigint, status string, recorded_at timestamp"
DELTA = "file_id bigint, batch_no int, path string, hash string, found_at timestamp"
PRINTS = "file_id bigint, normalized_hash string, normalized_text string"


def test_batches_match_by_hash_text_and_order(spark):
    from datetime import datetime as dt

    rng = random.Random(11)
    a, b, c = text(rng, 120), text(rng, 150), text(rng, 90)
    old, new = dt(2025, 1, 1), dt(2025, 2, 1)
    state = [
        (1, "p1", None, "AA11", None, 1, "indexed", new), (2, "p2", None, "bb22", None, 1, "skipped", old), (2, "p2", None, "bb22", None, 1, "duplicate", new),
        (3, "p3", None, None, None, 1, "hashed", new), (4, "p4", None, "dd44", None, 1, "indexed", old), (4, "p4", None, "dd44", None, 1, "skipped", new), (None, "p", None, "aa11", None, 1, "indexed", new),
    ]
    delta = [(10, 1, "q", "aa11", old), (10, 1, "q", "aa11", new), (11, 1, "q", "ff", old), (12, 1, "q", "ee55", old), (13, 2, "q", "EE55", old), (14, 2, "q", "dd44", old), (15, 2, "q", None, old), (16, 2, "q", "", old), (17, 3, "q", "1717", old), (None, 3, "q", "aa11", old)]
    prints = [(1, "h1", a), (2, "h2", b), (3, "h3", c), (11, "x", edit(rng, a, 1)), (12, "y", c), (15, "h2", None), (16, None, edit(rng, c, 1)), (17, "", text(rng, 60))]
    out = match_batches(spark.createDataFrame(state, STATE), spark.createDataFrame(delta, DELTA), spark.createDataFrame(prints, PRINTS)).collect()
    # 12 repeats nothing accepted (3 is only hashed); 13 has 12's hash; 14's match was skipped last; 16 resembles 12
    assert {(r["first_file_id"], r["file_id"]) for r in out} == {(1, 10), (1, 11), (12, 13), (2, 15), (12, 16)}


def test_batches_with_empty_tables(spark):
    e = lambda s: spark.createDataFrame([], s)
    assert match_batches(e(STATE), e(DELTA), e(PRINTS)).count() == 0


def test_record_keys():
    a = record_key("part: LT-1\nship from: Mesa Crossing\nqty: 5")
    assert a == record_key("QTY = 5 | part = lt-1 | Ship From:  mesa crossing")
    assert a != record_key("part: lt-1\nship to: mesa crossing\nqty: 5")
    assert record_key("plain words without any fields") is None
    assert record_key("a: 1\na: 2") is None
    assert record_key("x" * 200_000 + "\n" + "y" * 200_000) is None


def test_layout_copies(spark):
    rows = [
        (5, "Alpha,  beta\ngamma"), (3, "alpha beta gamma."), (9, "alpha gamma beta"), (7, "part: a\nqty: 2"), (8, "QTY=2; PART=A"), (12, "part a qty 2"), (13, "qty: a\npart: 2"),
        (20, None), (21, ""), (22, " .,"), (None, "alpha beta gamma"), (3, "alpha beta gamma."), (30, "ä ö ü"), (31, "Ä  Ö Ü"),
    ]
    d = spark.createDataFrame([(*r, "z") for r in rows], "file_id bigint, normalized_text string, words string")
    got = {r["id"]: (r["first"], r["copies"]) for r in layout_copies(d).collect()}
    assert got == {3: (3, 2), 5: (3, 2), 9: (9, 1), 7: (7, 3), 8: (7, 3), 12: (7, 3), 13: (13, 1), 30: (30, 2), 31: (30, 2)}


def test_layout_copies_of_a_hot_text(spark):
    d = spark.range(1, 3001).selectExpr("id AS file_id", "CASE WHEN id % 3 = 0 THEN 'same  text' ELSE concat('text ', id) END AS normalized_text")
    rows = layout_copies(d).collect()
    assert len(rows) == 3000 and {(r["first"], r["copies"]) for r in rows if r["id"] % 3 == 0} == {(3, 1000)}


def test_layout_copies_in_parts(spark):
    """More rows than one filter serves: records and texts meet in the same part, whatever their layout."""
    record = lambda i: f"part: LT-{i % 40}\nqty: {i % 40}" if i % 2 else f"QTY = {i % 40} | part = lt-{i % 40}"
    rows = [(i, record(i) if i % 3 == 0 else f"Some  Words {i % 70}" if i % 3 == 1 else f"single row {i}") for i in range(1, 601)]
    d = spark.createDataFrame(rows, "file_id bigint, normalized_text string")
    whole = {tuple(r) for r in layout_copies(d).collect()}
    assert len(whole) == 600 and {tuple(r) for r in layout_copies(d, most_bits=1 << 11).collect()} == whole


@pytest.mark.parametrize("part", [0.15, 0.3, 0.5])
def test_batch_fragments_of_longer_history_texts(spark, part):
    from datetime import datetime as dt

    rng = random.Random(21)
    at = dt(2025, 1, 1)
    long = {i: text(rng, 400) for i in range(1, 7)}
    n = int(400 * part)
    fragments = {100 + i: " ".join(t.split()[50 : 50 + n]) for i, t in long.items()}
    state = [(i, "p", None, f"a{i}", None, 1, "indexed", at) for i in long]
    delta = [(i, 1, "q", f"b{i}", at) for i in fragments]
    prints = [(i, f"n{i}", t) for i, t in (long | fragments).items()]
    out = match_batches(spark.createDataFrame(state, STATE), spark.createDataFrame(delta, DELTA), spark.createDataFrame(prints, PRINTS)).collect()
    assert {(r["first_file_id"], r["file_id"]) for r in out} == {(i, 100 + i) for i in long}


def test_two_batches_against_the_stored_index_read_no_history(spark, tmp_path):
    """The second and third batch are accepted after everything that held the history, and the batch before, is gone."""
    from datetime import datetime as dt

    rng = random.Random(31)
    at = dt(2025, 1, 1)
    long = {i: text(rng, 300) for i in range(1, 9)}
    first = {100 + i: " ".join(t.split()[: 300 // i]) if i < 7 else text(rng, 100) for i, t in long.items()}
    second = {200 + i: edit(rng, t, 1) for i, t in first.items()} | {220: long[2].upper(), 221: text(rng, 80)}
    history = tmp_path / "history"
    files = "id bigint, fresh boolean, hash string, normalized_hash string, text string"
    spark.createDataFrame([(i, False, f"a{i}", None, t) for i, t in long.items()], files).write.parquet(str(history))
    batch = tmp_path / "batch"
    spark.createDataFrame([(i, True, f"b{i}", None, t) for i, t in first.items()], files).write.parquet(str(batch))

    def found(df):
        return {(r["first_file_id"], r["file_id"]) for r in df.collect()}

    index = str(tmp_path / "index")
    PrefixIndex(spark, index).append(spark.read.parquet(str(history)))
    shutil.rmtree(history)
    one = found(PrefixIndex(spark, index).accept(spark.read.parquet(str(batch))))
    shutil.rmtree(batch)
    two = found(PrefixIndex(spark, index).accept(spark.createDataFrame([(i, True, f"c{i}", None, t) for i, t in second.items()], files)))
    assert one == {(i, 100 + i) for i in range(1, 7)}
    every = {i: grams(t) for i, t in (long | first | second).items()}
    like = lambda a, b: len(every[a] & every[b]) >= 0.9 * min(len(every[a]), len(every[b]))
    assert two == {(min(a for a in every if a < b and like(a, b)), b) for b in second if any(a < b and like(a, b) for a in every)}

    at_once = [(i, "p", None, f"a{i}", None, 1, "indexed", at) for i in long]
    delta = [(i, 1 if i < 200 else 2, "q", f"b{i}", at) for i in first | second]
    prints = [(i, f"n{i}", t) for i, t in (long | first | second).items()]
    tables = spark.createDataFrame(at_once, STATE), spark.createDataFrame(delta, DELTA), spark.createDataFrame(prints, PRINTS)
    assert found(match_batches(*tables)) == found(match_batches(*tables, cuts=(1,))) == one | two


@pytest.mark.parametrize("how", ["sum", "or", "twice"])
def test_tables_merge_in_levels(spark, monkeypatch, how):
    """Merging two at a time, level by level, gives the table of one merge."""
    from docloom.llm import sketches as S

    d = spark.range(0, 3000, 1, 8).selectExpr("(id * 7919) % 1024 AS at")

    def fold(table, b):
        at = b.column(0).to_numpy()
        if how == "sum":
            S.add_counts(table, at)
        elif how == "or":
            S.set_bits(table, at)
        else:
            once, more = table[:128], table[128:]
            for x in at:
                if S.get_bits(once, np.array([x]))[0]:
                    S.set_bits(more, np.array([x]))
                S.set_bits(once, np.array([x]))

    args = (1024, "uint8", fold, "sum", 1) if how == "sum" else (128, "uint8", fold, how, 2 if how == "twice" else 1)
    one = S.merged_table(d, *args)
    monkeypatch.setattr(S, "FAN", 2)
    assert (S.merged_table(d, *args) == one).all()
    want = np.bincount((np.arange(3000) * 7919) % 1024, minlength=1024)
    if how == "sum":
        assert one[0].tolist() == want.tolist()
    else:
        assert S.get_bits(one[-1], np.arange(1024)).tolist() == (want > (how == "twice")).tolist()


def test_tables_are_broadcast_packed(spark, monkeypatch):
    sent = []
    sc, send = spark.sparkContext, type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(sc), "broadcast", lambda self, x: sent.append(getattr(x, "nbytes", None) or len(x)) or send(self, x))
    rng = random.Random(31)
    base = text(rng, 80)
    rows = [(i, text(rng, 80)) for i in range(30)] + [(40, base), (41, base + " end"), (42, edit(rng, base, 1))]
    got = {(r["id"], r["first"]) for r in near_duplicate_groups(spark.createDataFrame(rows, "file_id bigint, normalized_text string")).collect()}
    assert got == {(40, 40), (41, 40), (42, 40)}
    assert len(sent) > 3 and sum(sent) < 300_000
