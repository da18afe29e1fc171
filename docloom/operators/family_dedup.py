"""Near-duplicate families by file stem: canonical ranking, greedy leaders and review families."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T
from ..plans.shared import materialize

#: fixed values: rank of formats within a family
EXT_RANK = {".docx": 3, ".doc": 2, ".pdf": 1}


def ext_rank(c: Column) -> Column:
    out = F.lit(0)
    for e, r in EXT_RANK.items():
        out = F.when(c == e, r).otherwise(out)
    return out


def rank_key(path: str = "path") -> Column:
    """Best first when descending: quality, format, length, path."""
    q = F.col("parse_quality").cast("double")
    return F.struct(F.when(q.isNull() | F.isnan(q), F.lit(-1.0)).otherwise(q).alias("q"), ext_rank(F.col("ext")).alias("e"), F.coalesce("normalized_chars", F.lit(0)).alias("n"), F.lower(path).alias("p"))


def canonical_of_family(docs: DataFrame) -> DataFrame:
    """``stem_key, canonical_path, members``: the best ranked document of each family, pre-aggregated."""
    return docs.where("stem_key is not null").groupBy("stem_key").agg(F.max_by("path", rank_key()).alias("canonical_path"), F.count(F.lit(1)).alias("members"))


def _need(n: Column, threshold: float) -> Column:
    """Least shared units of a text of ``n`` units, for a similarity rounded to four places."""
    return F.ceil(F.lit(threshold - 5e-5) * n - 1e-9)


def _join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """A join by shuffle: the files of texts and units are so much smaller than their rows that a broadcast would fill the driver."""
    return left.join(right.hint("merge"), on, how)


def _placed(flat: DataFrame, family: list[str], doc: str) -> DataFrame:
    """Units ``u`` that several texts of a family hold, with their position among the ``n`` units of the text from rare to common.

    Units of one text come first in it and pair with nothing, so they only count.
    """
    often = flat.groupBy(*family, "u").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    own = W.partitionBy(*family, doc)
    seen = _join(flat, often, [*family, "u"])
    return seen.select(*family, doc, "n", "u", (F.col("n") - F.count(F.lit(1)).over(own) + F.row_number().over(own.orderBy("df", "u")) - 1).alias("pos"))


def _meet(small: DataFrame, large: DataFrame, on: list[str], doc: str, threshold: float, where: Column) -> DataFrame:
    """Pairs of which the smaller text's prefix (``n - need + 1`` rarest units) holds a unit of the larger one: exact at every ratio of sizes."""
    a = small.where(F.col("pos") <= F.col("n") - _need(F.col("n"), threshold)).select(*on, F.col(doc).alias("a"), F.col("n").alias("na"))
    b = large.select(*on, F.col(doc).alias("b"), F.col("n").alias("nb"), F.col("pos").alias("pb"))
    return _join(a, b, on).where(where & (F.col("pb") <= F.col("nb") - _need(F.col("na"), threshold)))


def pair_scores(docs: DataFrame, threshold: float = 0.9, min_chars: int = 200) -> DataFrame:
    """``a, b, similarity`` of different texts of one family that share at least ``threshold`` of the smaller one's 5-word runs.

    Copies of one text are represented by their smallest id. The smaller text's rarest runs (``n - ceil(threshold * n) + 1`` of them)
    meet all runs of the larger text, so common runs make few pairs and a text inside a longer one is found at any length.
    """
    d = docs.where((F.col("normalized_chars") >= min_chars) & F.col("normalized_text").isNotNull()).groupBy("stem_key", "normalized_text").agg(F.min("file_id").alias("file_id"))
    runs = materialize(d.select("file_id", "stem_key", F.transform(T.word_shingles(F.col("normalized_text")), lambda x: F.xxhash64(x)).alias("runs")).withColumn("n", F.size("runs")))
    flat = runs.select("file_id", "stem_key", "n", F.explode("runs").alias("u"))
    placed = materialize(_placed(flat, ["stem_key"], "file_id"))
    pairs = _meet(placed, placed, ["stem_key", "u"], "file_id", threshold, (F.col("a") != F.col("b")) & (F.col("na") <= F.col("nb"))).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    side = lambda c: runs.select(F.col("file_id").alias(c), F.col("runs").alias(f"r{c}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", F.round(T.containment(F.col("ra"), F.col("rb")), 4).alias("similarity")).where(F.col("similarity") >= threshold)


def _units(text: str) -> tuple[set, set]:
    words = re.findall(r"[a-z0-9]+", text.lower())
    grams = {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    return {x for x in text.split("\n") if x}, grams


def _near(a: tuple[set, set], b: tuple[set, set]) -> float:
    part = lambda x, y: len(x & y) / min(len(x), len(y)) if x and y else 0.0
    return round(max(part(a[0], b[0]), part(a[1], b[1])), 4)


#: rows of a family that are decided together, pairs of postings that are held at once, and rows below which all pairs are looked at
STEP, PAIRS, FEW = 500, 2_000_000, 40


def _hashes(values: list) -> np.ndarray:
    code, seen = pd.factorize(np.array(values, object))
    return pd.util.hash_array(seen, categorize=False)[code] if len(values) else np.empty(0, np.uint64)


def _hashed_units(texts: list) -> list[tuple[np.ndarray, np.ndarray]]:
    """``(doc, hash)`` of the distinct lines and of the distinct 5-word runs of each text; the strings are dropped again."""
    found: list[list] = [[], []]
    for at in range(0, len(texts), STEP):
        part = texts[at : at + STEP]
        lines = [[x for x in t.split("\n") if x] for t in part]
        words = [re.findall(r"[a-z0-9]+", t.lower()) for t in part]
        n = np.array([len(w) for w in words])
        short = [i for i in range(len(part)) if 0 < n[i] < 5]
        doc = np.repeat(np.arange(len(part)), n)
        h = _hashes([x for w in words for x in w])
        first = np.arange(len(h))[: max(0, len(h) - 4)]
        first = first[doc[first] == doc[first + 4]]
        run = np.zeros(len(first), np.uint64)
        for k in range(5):
            run = run * np.uint64(0x9E3779B97F4A7C15) + h[first + k]
        kinds = [(np.repeat(np.arange(len(part)), [len(x) for x in lines]), _hashes([x for y in lines for x in y])), (np.append(doc[first], short).astype(np.int64), np.append(run, _hashes([" ".join(words[i]) for i in short])))]
        for out, (d, u) in zip(found, kinds, strict=True):
            order = np.lexsort((u, d))
            d, u = d[order], u[order]
            new = np.ones(len(u), bool)
            new[1:] = (d[1:] != d[:-1]) | (u[1:] != u[:-1])
            out.append(((d[new] + at).astype(np.int32), u[new]))
    return [tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.empty(0, np.int32), np.empty(0, np.uint64)) for out in found]


class _Postings:
    """Units that several texts hold, in one order from rare to common, with their position among the ``n`` units of the text."""

    def __init__(self, doc: np.ndarray, u: np.ndarray, texts: int, threshold: float) -> None:
        self.n = np.bincount(doc, minlength=texts)
        self.need = np.ceil((threshold - 5e-5) * self.n - 1e-9).astype(np.int64)
        order = np.argsort(u, kind="stable")
        u, doc = u[order], doc[order]
        new = np.ones(len(u), bool)
        new[1:] = u[1:] != u[:-1]
        often = np.diff(np.append(np.flatnonzero(new), len(u)))
        place = np.empty(len(often), np.int32)
        place[np.argsort(often, kind="stable")] = np.arange(len(often))
        # units of one text come first in it and pair with nothing, so they only count
        several = np.repeat(often > 1, often)
        unit, doc = np.repeat(place, often)[several], doc[several]
        del order, u, new, several
        order = np.lexsort((unit, doc))
        unit, doc = unit[order], doc[order]
        held = np.bincount(doc, minlength=texts)
        pos = np.arange(len(doc)) - (np.cumsum(held) - held)[doc] + (self.n - held)[doc]
        prefix = pos <= (self.n - self.need)[doc]
        # in the order of texts, and in that of units
        self.doc, self.unit, self.pos, self.prefix = doc.astype(np.int32), unit, pos.astype(np.int32), prefix
        self.by_unit = np.argsort(self.unit, kind="stable").astype(np.int32)

    def pairs(self, rows: np.ndarray, others: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of one of the texts ``rows`` and an earlier one of ``others`` (flags by text) that can be similar: the smaller one's prefix meets the larger one."""
        theirs = self.by_unit[others[self.doc[self.by_unit]]]
        mine = np.flatnonzero(rows[self.doc])
        for mine_small in (True, False):
            left, right = (mine[self.prefix[mine]], theirs) if mine_small else (mine, theirs[self.prefix[theirs]])
            units = self.unit[right]
            lo, hi = np.searchsorted(units, self.unit[left], "left"), np.searchsorted(units, self.unit[left], "right")
            ends = np.cumsum(hi - lo)
            at = 0
            while at < len(left):
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, "right")))
                many = (hi - lo)[at:to]
                x = np.repeat(left[at:to], many)
                y = right[np.repeat(lo[at:to] - np.append(0, np.cumsum(many)[:-1]), many) + np.arange(many.sum())]
                dx, dy = self.doc[x], self.doc[y]
                (small, large), (ds, dl) = ((x, y), (dx, dy)) if mine_small else ((y, x), (dy, dx))
                size = self.n[ds] <= self.n[dl] if mine_small else self.n[ds] < self.n[dl]
                ok = (dy < dx) & size & (self.pos[large] <= self.n[dl] - self.need[ds])
                both = np.unique((dx[ok].astype(np.int64) << 32) | dy[ok])
                yield both >> 32, both & 0xFFFFFFFF
                at = to


def _leaders(threshold: float, min_chars: int):
    """Decisions of one family in the order of rank.

    A text meets only those earlier leaders that can be near, found by hashed units whose size is that of the texts; the units themselves are
    compared for these alone, so that neither memory nor time follows the number of pairs.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(
            rank_q=pdf["parse_quality"].fillna(-1.0), rank_e=pdf["ext"].map(EXT_RANK).fillna(0), rank_n=pdf["normalized_chars"].fillna(0), rank_p=pdf["path"].str.lower()
        ).sort_values(["row", "rank_q", "rank_e", "rank_n", "rank_p"], ascending=[True, False, False, False, False], kind="stable").drop(columns=["rank_q", "rank_e", "rank_p"])
        rows = list(pdf.itertuples())
        texts = [(r.normalized_text or "") if r.rank_n >= min_chars and r.normalized_hash else "" for r in rows]
        leader = np.zeros(len(rows), bool)
        by_hash: dict[str, str] = {}
        few = len(rows) <= FEW
        postings = [] if few else [_Postings(d, u, len(rows), threshold) for d, u in _hashed_units(texts)]
        units = lru_cache(FEW if few else 4 * STEP)(lambda i: _units(texts[i]))
        out = []
        for at in range(0, len(rows), STEP):
            block = range(at, min(at + STEP, len(rows)))
            open_rows = np.zeros(len(rows), bool)
            open_rows[[i for i in block if texts[i] and not (rows[i].same or rows[i].near or rows[i].normalized_hash in by_hash)]] = True
            others = leader | open_rows
            maybe: dict[int, set] = {}
            for p in postings:
                for x, y in p.pairs(open_rows, others):
                    for i, j in zip(x.tolist(), y.tolist(), strict=True):
                        maybe.setdefault(i, set()).add(j)
            for i in block:
                r, digest, verdict = rows[i], rows[i].normalized_hash or "", None
                if r.rank_n >= min_chars and digest:
                    if r.same or digest in by_hash:
                        verdict = (r.same or by_hash[digest], "exact_normalized_text", 1.0)
                    elif r.near:
                        verdict = (r.near, "near_duplicate_same_stem", r.near_score)
                    else:
                        earlier = range(i) if few else sorted(maybe.get(i, ()))
                        hit = next(((rows[j].path, s) for j in earlier if leader[j] and (s := _near(units(j), units(i))) >= threshold), None)
                        verdict = (hit[0], "near_duplicate_same_stem", hit[1]) if hit else None
                    if verdict is None:
                        leader[i] = True
                        by_hash.setdefault(digest, r.path)
                c, why, sim = verdict or (r.path, "kept_best_in_family", 1.0)
                out.append((r.file_id, r.path, "duplicate" if verdict else "canonical", c, why, sim, r.stem_key, r.row))
        return pd.DataFrame(out, columns=["file_id", "path", "status", "canonical_path", "dedup_reason", "similarity", "stem_key", "row"])

    return run


DECISION = "file_id bigint, path string, status string, canonical_path string, dedup_reason string, similarity double"
OUT = ["file_id", "path", "status", "canonical_path", "dedup_reason", "similarity"]
IN = ["stem_key", "file_id", "path", "ext", "parse_quality", "normalized_chars", "normalized_hash", "normalized_text", "row", "same", "near", "near_score"]


def _decide(docs: DataFrame, threshold: float, min_chars: int) -> DataFrame:
    return docs.select(*IN).groupBy("stem_key").applyInPandas(_leaders(threshold, min_chars), f"{DECISION}, stem_key string, row bigint")


def _no_leader(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"same": F.lit(None).cast("string"), "near": F.lit(None).cast("string"), "near_score": F.lit(None).cast("double")})


def _score(threshold: float):
    def run(batches):
        for pdf in batches:
            score = [_near(_units(x or ""), _units(y or "")) for x, y in zip(pdf["leader_text"], pdf["text"], strict=True)]
            out = pdf[["stem_key", "row", "leader"]].assign(score=pd.Series(score, index=pdf.index, dtype="float64"))
            yield out[out["score"] >= threshold]

    return run


def _hot_decisions(docs: DataFrame, largest: int, threshold: float, min_chars: int, block_rows: int) -> DataFrame:
    """The same greedy decisions for families too large for one task: blocks of ``block_rows`` in the order of rank, one after the other.

    A block meets the leaders of the blocks before by an exact prefix join (lines and 5-word runs) and by hash; what they don't decide
    is decided inside the block. Every document meets every earlier leader that can be near, as in one pass over the family.
    """
    docs = materialize(docs.withColumn("_id", F.monotonically_increasing_id()))
    order = docs.select("_id", "stem_key", rank_key().alias("k"), "path", "file_id")
    order = order.select("_id", F.row_number().over(W.partitionBy("stem_key").orderBy(F.desc("k"), "path", "file_id", "_id")).cast("bigint").alias("row"))
    able = (F.coalesce("normalized_chars", F.lit(0)) >= min_chars) & (F.coalesce("normalized_hash", F.lit("")) != "")
    docs = materialize(_join(docs, order, ["_id"]).withColumn("able", able))
    text = F.col("normalized_text")
    units = lambda kind, c: docs.where("able").select("stem_key", F.lit(kind).alias("kind"), "row", F.transform(c, lambda x: F.xxhash64(x)).alias("us"))
    flat = units("line", T.line_units(text)).unionByName(units("run", T.word_shingles(text))).select("stem_key", "kind", "row", F.size("us").alias("n"), F.explode("us").alias("u"))
    placed = materialize(_placed(flat, ["stem_key", "kind"], "row"))
    on = ["stem_key", "kind", "u"]
    within = lambda df, k: df.where((F.col("row") > k * block_rows) & (F.col("row") <= (k + 1) * block_rows))
    leaders = out = None
    for k in range(-(-largest // block_rows)):
        block = within(docs, k)
        if leaders is None:
            block = _no_leader(block)
        else:
            mine, theirs = within(placed, k), _join(placed, leaders.select("stem_key", "row"), ["stem_key", "row"])
            new = _meet(mine, theirs, on, "row", threshold, F.col("na") <= F.col("nb")).select("stem_key", F.col("a").alias("row"), F.col("b").alias("leader"))
            old = _meet(theirs, mine, on, "row", threshold, F.col("na") < F.col("nb")).select("stem_key", F.col("b").alias("row"), F.col("a").alias("leader"))
            pairs = new.unionByName(old).distinct()
            pairs = _join(pairs, block.select("stem_key", "row", text.alias("text")), ["stem_key", "row"])
            pairs = _join(pairs, docs.select("stem_key", F.col("row").alias("leader"), text.alias("leader_text")), ["stem_key", "leader"])
            hits = pairs.select("stem_key", "row", "leader", "leader_text", "text").mapInPandas(_score(threshold), "stem_key string, row bigint, leader bigint, score double")
            first = hits.groupBy("stem_key", "row").agg(F.min("leader").alias("leader"), F.min_by("score", "leader").alias("near_score"))
            near = _join(first, leaders.select("stem_key", F.col("row").alias("leader"), F.col("path").alias("near")), ["stem_key", "leader"]).drop("leader")
            same = leaders.select("stem_key", "normalized_hash", F.col("path").alias("same"))
            block = _join(_join(block, near, ["stem_key", "row"], "left"), same, ["stem_key", "normalized_hash"], "left")
        done = materialize(_decide(block, threshold, min_chars))
        out = done if out is None else out.unionByName(done)
        kept = _join(within(docs, k).where("able"), done.where("status = 'canonical'").select("stem_key", "row"), ["stem_key", "row"])
        kept = materialize(kept.select("stem_key", "row", "path", "normalized_hash"))
        leaders = kept if leaders is None else leaders.unionByName(kept)
    return out.select(*OUT)


def family_decisions(docs: DataFrame, threshold: float = 0.9, min_chars: int = 200, exts: tuple[str, ...] = (".pdf", ".doc", ".docx"), family_rows: int = 20_000) -> DataFrame:
    """Greedy leader decisions per stem family; families of one skip the comparison.

    The greedy order is sequential within a family. A family of more than ``family_rows`` documents is decided in blocks of that many,
    so that no task holds an unbounded group; the decisions are those of one pass.
    """
    d = docs.where(F.col("ext").isin(*exts))
    sizes = d.groupBy("stem_key").agg(F.count(F.lit(1)).alias("_size"))
    largest = sizes.where("stem_key is not null").agg(F.max("_size")).first()[0] or 0
    d = d.join(sizes, "stem_key")
    single = d.where("_size = 1").select("file_id", "path", F.lit("canonical").alias("status"), F.col("path").alias("canonical_path"), F.lit("singleton_skipped").alias("dedup_reason"), F.lit(1.0).alias("similarity"))
    many = d.where("_size > 1").select("_size", *IN[:8])
    out = single.unionByName(_decide(_no_leader(many.where(F.col("_size") <= family_rows).withColumn("row", F.lit(0).cast("bigint"))), threshold, min_chars).select(*OUT))
    if largest > family_rows:
        out = out.unionByName(_hot_decisions(many.where(F.col("_size") > family_rows).drop("_size"), largest, threshold, min_chars, family_rows))
    return out


def review_families(decisions: DataFrame) -> DataFrame:
    """Per canonical path: members, similarity range, review flags and recommendation."""
    dup = F.col("status") == "duplicate"
    near = dup & (F.col("dedup_reason") == "near_duplicate_same_stem") & (F.col("similarity") < 0.95)
    e = F.lower(F.coalesce("ext", F.lit("")))
    own = F.regexp_extract(F.lower("canonical_path"), r"[^./\\][^/\\]*(\.[^./\\]+)$", 1)
    g = decisions.where("canonical_path is not null").groupBy("canonical_path").agg(
        F.count(F.lit(1)).alias("members"), F.count_if(dup).alias("duplicates"),
        F.max(F.when(dup, F.col("similarity"))).alias("max_similarity"), F.min(F.when(dup, F.col("similarity"))).alias("min_similarity"),
        F.bool_or(e == ".docx").alias("_docx"), F.bool_or(e == ".doc").alias("_doc"), F.bool_or(e == ".pdf").alias("_pdf"), F.bool_or(near).alias("_near"), F.first(own).alias("_own"),
    ).where("duplicates > 0")
    flags = F.array_compact(
        F.array(
            F.when(F.col("_docx") & (F.col("_own") != ".docx"), "prefer_docx_if_parse_quality_is_close"),
            F.when(F.col("_doc") & (F.col("_own") == ".pdf"), "prefer_editable_source_over_pdf"),
            F.when(F.col("_pdf") & (F.col("_docx") | F.col("_doc")), "mixed_format_family"),
            F.when(F.col("_near"), "review_near_duplicate_threshold"),
        )
    )
    g = g.withColumn("flags", flags)
    return g.select("canonical_path", "members", "duplicates", "max_similarity", "min_similarity", F.when(F.size("flags") > 0, "review_canonical_choice").otherwise("keep_canonical_choice").alias("recommendation"), F.when(F.size("flags") > 0, F.array_join("flags", ",")).otherwise("low_risk_family").alias("flags"))


#: sort modes of the review: largest families, lowest similarity, or path
SORTS = {"largest": [F.desc, "members"], "similarity": [F.asc_nulls_last, "min_similarity"], "path": [F.asc, "canonical_path"]}


def sorted_families(families: DataFrame, mode: str = "largest", limit: int = 25) -> DataFrame:
    """The first ``limit`` (at least one) review families by a sort mode; ties by path."""
    if mode not in SORTS:
        raise ValueError(f"sort mode is one of {', '.join(SORTS)}")
    way, col = SORTS[mode]
    return families.orderBy(way(col), F.lower("canonical_path"), "canonical_path").limit(max(1, limit))
