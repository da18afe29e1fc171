"""Reading level (problem 10): regularised ordinal regression over vectorised text features, calibrated to graded texts.

Features of every document are computed a block of texts at a time on the bytes: sentence and word lengths, lexical diversity,
word rarity against the corpus's hashed word counts, connectives, a clause-depth proxy and document length. A proportional-odds model is
fitted on the labelled documents and applied to all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.shared import materialize, ship_package
from .hashing import _BASE, _BASE_INV, U, _powers, blocks, mix, word_hashes
from .sketches import add_counts, merged_table, spread

#: fixed values: abbreviations whose period ends no sentence
ABBREVIATIONS = "approx ref dwg sec fig vol no rev dr mr mrs ms prof st jr sr inc ltd co corp dept est etc eg ie vs al ed eds p pp par para art nos figs ch app tel ext max min mfg qty ser temp".split()
#: fixed values: words that join clauses
CONNECTIVES = "because although though since unless while whereas whenever however therefore thereby moreover furthermore nevertheless notwithstanding insofar consequently hence thus until once when whose which whom who that if whether yet so as after before".split()
#: fixed values: words that nearly every English text holds
ENGLISH = "the of and to in a an is was were are be by for on at with from it its that this which as or not but they we he she you all had has have his her their then there because while after before until no so".split()
FEATURES = ["sentence_words", "long_share", "word_letters", "diversity", "rarity", "connectives", "clauses", "log_words"]
COUNT_BITS = 18
_STRANGE = regex.compile(r"[^\x00-\x7f\p{L}\p{N}]")
_DASHES = {0x2018: "'", 0x2019: "'", 0x201C: '"', 0x201D: '"', 0x2026: "..."}

_LETTER = np.array([b >= 128 or chr(b).isalpha() for b in range(256)])
_DIGIT = np.array([b < 128 and chr(b).isdigit() for b in range(256)])
_UPPER = np.array([b < 128 and chr(b).isupper() for b in range(256)])
_SMALL = np.array([b < 128 and chr(b).islower() for b in range(256)])
_LOWER = np.array([ord(chr(b).lower()) if b < 128 and chr(b).isalnum() else b if b >= 128 else 0 for b in range(256)], np.uint8)
_SPACE = np.array([b in b" \t\r\n\x0b\x0c" for b in range(256)])
_CLOSER = np.array([b in b"\"')]}" for b in range(256)])
_STOP = np.array([b in b".!?" for b in range(256)])


def _hash_of(words: list[str]) -> np.ndarray:
    return np.sort(word_hashes([" ".join(words)])[0])


_ABBREVIATIONS, _CONNECTIVES, _ENGLISH = _hash_of(ABBREVIATIONS), _hash_of(CONNECTIVES), _hash_of(ENGLISH)


def _in(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    at = np.searchsorted(known, h)
    at[at == len(known)] = 0
    return known[at] == h


def features(texts: list, counts: np.ndarray) -> dict[str, np.ndarray]:
    """Arrays by text: words, sentences, the features and ``sentence_share`` (words that stand in ended sentences)."""
    m = len(texts)
    parts = [(t if t.isascii() else _STRANGE.sub(" ", t.translate(_DASHES))).encode("utf-8", "replace") if t else b"" for t in texts]
    gap = b"\n\n\n"
    raw = np.frombuffer(gap + gap.join(parts) + gap, np.uint8)
    begins = np.cumsum([len(gap), *(len(p) + len(gap) for p in parts)])
    low = _LOWER[raw]
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = low != 0
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    letters = np.append(0, np.cumsum(_LETTER[raw] & ((raw < 128) | (raw >= 192))))
    n_letters = letters[ends] - letters[starts]
    sums = np.empty(len(low) + 1, U)
    sums[0] = 0
    np.cumsum(low.astype(U) * _powers("up", _BASE, len(low))[: len(low)], out=sums[1:])
    h = mix((sums[ends] - sums[starts]) * _powers("down", _BASE_INV, len(low) + 1)[starts])
    doc = np.searchsorted(begins, starts, "right") - 1
    word = n_letters > 0
    # the next character that is no blank, the last one before, and the number of line feeds in between
    solid = np.flatnonzero(~_SPACE[raw])
    if not len(solid):
        solid = np.array([0])
    feeds = np.append(0, np.cumsum(raw == 10))
    # ends of sentences: a stop, closers, then white space and no small letter; the period of an abbreviation or initial doesn't count
    stop = np.flatnonzero(_STOP[raw])
    after = stop + 1
    for _ in range(3):
        after += _CLOSER[raw[np.minimum(after, len(raw) - 1)]]
    ok = _SPACE[raw[np.minimum(after, len(raw) - 1)]]
    stop, after = stop[ok], after[ok]
    nxt = solid[np.minimum(np.searchsorted(solid, after), len(solid) - 1)]
    new_block = (nxt < after) | (feeds[np.maximum(nxt, after)] - feeds[after] >= 2)
    before = np.searchsorted(ends, stop, "right") - 1
    touch = (before >= 0) & (ends[np.maximum(before, 0)] == stop) if len(ends) else np.zeros(len(stop), bool)
    b = np.maximum(before, 0)
    short = np.zeros(len(stop), bool)
    if len(ends):
        single = (ends[b] - starts[b] == 1) & word[b]
        short = touch & (raw[stop] == 46) & (_in(h[b], _ABBREVIATIONS) | single)
        # "no." at the end of a sentence is a word, before a figure an abbreviation; other abbreviations need something to follow
        figure = _DIGIT[raw[nxt]] | (_UPPER[raw[nxt]] & ~_LETTER[raw[np.minimum(nxt + 1, len(raw) - 1)]])
        short &= np.where(_in(h[b], _hash_of(["no", "unit", "par", "art", "max", "min", "co", "st", "app", "ed", "al", "est", "ext", "rev", "sec", "etc"])), figure, True)
    end = (~_SMALL[raw[nxt]] | new_block) & ~(short & ~new_block)
    stop = stop[end]
    # unended stretches before a blank line, or short lines before a capital, are headings and no sentences
    line_feed = np.flatnonzero(raw == 10)
    prev = solid[np.maximum(np.searchsorted(solid, line_feed) - 1, 0)]
    follow = solid[np.minimum(np.searchsorted(solid, line_feed), len(solid) - 1)]
    line_start = np.append(0, line_feed[:-1] + 1)
    width = np.maximum(line_feed - line_start, 0)
    line_doc = np.clip(np.searchsorted(begins, line_feed, "right") - 1, 0, m - 1)
    widest = np.zeros(m, np.int64)
    np.maximum.at(widest, line_doc, width)
    blank = feeds[np.maximum(follow, line_feed)] - feeds[line_feed] >= 2
    capital = ~_SMALL[raw[follow]] & (width * 10 < widest[line_doc] * 6)
    ended = _STOP[raw[prev]] | _CLOSER[raw[prev]]
    head = line_feed[~ended & (raw[prev] != 44) & (blank | capital) & (prev < line_feed)]
    cut = np.sort(np.concatenate([stop, head, begins - 1]))
    is_stop = np.isin(cut, stop)
    part = np.searchsorted(cut, starts)
    in_sentence = word & (part < len(cut)) & is_stop[np.minimum(part, len(cut) - 1)]
    n_words = np.bincount(doc[word], minlength=m)[:m]
    said = np.bincount(doc[in_sentence], minlength=m)[:m]
    # sentences that hold at least one word
    live = np.unique(part[in_sentence])
    sentences = np.bincount(np.clip(np.searchsorted(begins, cut[live], "right") - 1, 0, m - 1), minlength=m)[:m]
    some, div = np.maximum(n_words, 1), lambda a, c: a / np.maximum(c, 1)
    total = lambda flag: np.bincount(doc[flag], minlength=m)[:m]
    distinct = np.unique(mix(h[word]) ^ mix(doc[word].astype(U) + U(3)), return_index=True)[1]
    kinds = np.bincount(doc[word][distinct], minlength=m)[:m]
    known = counts[(h >> U(64 - COUNT_BITS)).astype(np.int64)]
    seen = np.log(max(1.0, float(counts.sum()))) - np.log(np.maximum(known, 1))
    commas = np.bincount(np.clip(np.searchsorted(begins, np.flatnonzero((raw == 44) | (raw == 59) | (raw == 58)), "right") - 1, 0, m - 1), minlength=m)[:m]
    joins = total(word & _in(h, _CONNECTIVES))
    return {
        "words": n_words,
        "sentences": sentences,
        "sentence_share": said / some,
        "english_share": total(word & _in(h, _ENGLISH)) / some,
        "sentence_words": div(said, sentences),
        "long_share": div(np.bincount(doc[in_sentence & (n_letters > 6)], minlength=m)[:m], said),
        "word_letters": np.bincount(doc[word], n_letters[word], minlength=m)[:m] / some,
        "diversity": kinds / np.sqrt(2.0 * some),
        "rarity": np.bincount(doc[word], seen[word], minlength=m)[:m] / some,
        "connectives": joins / some,
        "clauses": div(commas + joins, sentences),
        "log_words": np.log1p(n_words),
    }


def word_counts(texts: DataFrame) -> np.ndarray:
    """Hashed counts of the words of all texts (text); the table's size is fixed."""

    def fold(table: np.ndarray, b: pa.RecordBatch) -> None:
        t = b.column(1).to_pylist()
        for i, j in blocks(t):
            h, _ = word_hashes(t[i:j])
            add_counts(table, (h >> U(64 - COUNT_BITS)).astype(np.int64))

    return merged_table(texts, 1 << COUNT_BITS, "uint32", fold, "sum")[0]


class OrdinalModel:
    """Proportional odds with a ridge penalty, fitted by Newton-free gradient descent with momentum on standardised features."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 3000, rate: float = 0.1) -> None:
        self.grades = np.unique(y) if len(y) else np.array([1, 2, 3, 4, 5])
        self.mean = x.mean(0) if len(x) else np.zeros(len(FEATURES))
        self.scale = np.maximum(x.std(0), 1e-9) if len(x) else np.ones(len(FEATURES))
        k = len(self.grades)
        self.w = np.zeros(x.shape[1] if len(x) else len(FEATURES))
        self.cuts = np.linspace(-1, 1, k - 1) if k > 1 else np.empty(0)
        if len(y) == 0 or k < 2:
            return
        z, c = (x - self.mean) / self.scale, np.searchsorted(self.grades, y)
        first, gaps = self.cuts[0], np.log(np.maximum(np.diff(self.cuts), 1e-3))
        theta = np.concatenate([self.w, [first], gaps])
        d = len(self.w)
        momentum, square = np.zeros_like(theta), np.zeros_like(theta)
        for t in range(1, steps + 1):
            cuts = theta[d] + np.append(0, np.cumsum(np.exp(theta[d + 1 :])))
            eta = z @ theta[:d]
            hi = np.where(c < k - 1, cuts[np.minimum(c, k - 2)] - eta, 35.0)
            lo = np.where(c > 0, cuts[np.maximum(c - 1, 0)] - eta, -35.0)
            ph, pl = 1 / (1 + np.exp(-hi)), 1 / (1 + np.exp(-lo))
            p = np.maximum(ph - pl, 1e-12)
            gh, gl = ph * (1 - ph) / p, pl * (1 - pl) / p
            g_cut = np.zeros(k - 1)
            np.add.at(g_cut, c[c < k - 1], -gh[c < k - 1])
            np.add.at(g_cut, c[c > 0] - 1, gl[c > 0])
            tail = np.cumsum(g_cut[::-1])[::-1]
            grad = np.concatenate([z.T @ (gh * (c < k - 1) - gl * (c > 0)), [tail[0]], tail[1:] * np.exp(theta[d + 1 :])]) / len(y)
            grad[:d] += ridge * theta[:d]
            momentum, square = 0.9 * momentum + 0.1 * grad, 0.999 * square + 0.001 * grad**2
            theta = theta - rate * (momentum / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.999**t)) + 1e-8)
        self.w, self.cuts = theta[:d], theta[d] + np.append(0, np.cumsum(np.exp(theta[d + 1 :])))

    def level(self, x: np.ndarray) -> np.ndarray:
        """Expected grade."""
        if not len(self.cuts):
            return np.full(len(x), float(self.grades[0]) if len(self.grades) else np.nan)
        eta = ((x - self.mean) / self.scale) @ self.w
        above = 1 / (1 + np.exp(np.clip(self.cuts[None, :] - eta[:, None], -35, 35)))
        return self.grades[0] + above @ np.diff(self.grades)


def document_features(docs: DataFrame, doc_id: str = "doc_id", text_col: str = "text") -> DataFrame:
    spark = docs.sparkSession
    ship_package(spark)
    texts = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null")
    counts = spread(docs, word_counts(texts))
    names = ["words", "sentences", "sentence_share", "english_share", *FEATURES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = b.column(1).to_pylist()
            for i, j in blocks(t):
                f = features(t[i:j], counts.value)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), *(pa.array(f[n], pa.int32() if n in ("words", "sentences") else pa.float64()) for n in names)], ["doc_id", *names])

    return texts.mapInArrow(run, "doc_id bigint, words int, sentences int, " + ", ".join(f"{n} double" for n in names[2:]))


def held_out_agreement(docs: DataFrame, labels: DataFrame, share: int = 4, most_labels: int = 20_000) -> DataFrame:
    """How well the level meets grades it was not fitted on; one row.

    The grades of one document in ``share`` (by hash of its id) are held out. ``error`` is the mean absolute difference of level and grade,
    ``error_of_mean`` that of the mean grade of the others, ``within_one`` the share of differences of at most one.
    """
    held = F.pmod(F.xxhash64("doc_id"), F.lit(share)) == 0
    known = labels.where("doc_id is not null and grade is not null").select("doc_id", F.col("grade").cast("double").alias("grade")).distinct()
    levels = reading_levels(docs, known.where(~held).select("doc_id", F.col("grade").cast("int").alias("grade")), most_labels).select("doc_id", "level")
    mean = known.where(~held).agg(F.avg("grade").alias("m"))
    rows = known.where(held).join(levels.where("level is not null"), "doc_id").withColumn("m", mean.scalar())
    off = F.abs(F.col("level") - F.col("grade"))
    return rows.agg(F.count(F.lit(1)).alias("held_out"), F.avg(off).alias("error"), F.avg(F.abs(F.col("m") - F.col("grade"))).alias("error_of_mean"), F.avg((off <= 1).cast("double")).alias("within_one"))


def reading_levels(docs: DataFrame, labels: DataFrame, most_labels: int = 20_000) -> DataFrame:
    """Every document with its features and ``level``, the expected grade (null without a word).

    The model is fitted on at most ``most_labels`` labelled rows, taken by hash of (doc_id, grade); everything else covers all
    documents. Labels with a null or of an unknown document are ignored; several grades of a document all count. Without labels
    the level is the middle of the grades 1 to 5. Null and empty texts have 0 words. Repeated rows stay repeated; other columns are ignored.
    """
    table = materialize(document_features(docs))
    graded = table.where("words > 0").join(labels.where("grade is not null").select("doc_id", "grade").distinct(), "doc_id").orderBy(F.xxhash64("doc_id", "grade")).limit(most_labels)
    rows = graded.select("grade", *FEATURES).toPandas()
    model = OrdinalModel(rows[FEATURES].to_numpy(float), rows["grade"].to_numpy())
    score = sum((F.col(f) - F.lit(float(m))) / F.lit(float(s)) * F.lit(float(w)) for f, m, s, w in zip(FEATURES, model.mean, model.scale, model.w, strict=True))
    steps = np.diff(model.grades)
    level = F.lit(float(model.grades[0]))
    for cut, step in zip(model.cuts, steps, strict=True):
        level = level + F.lit(float(step)) / (1 + F.exp(F.lit(float(cut)) - F.col("_eta")))
    return table.withColumn("_eta", score).withColumn("level", F.when(F.col("words") > 0, level)).drop("_eta")


def reading_bands(docs: DataFrame, labels: DataFrame, least_words: int = 40) -> DataFrame:
    """``(doc_id, band)`` of the easy and hard documents written as English sentences: the model's level, then the exact limits."""
    levels = reading_levels(docs, labels)
    prose = (F.col("words") >= least_words) & (F.col("sentence_share") >= 0.6) & (F.col("english_share") >= 0.08)
    easy = (F.col("level") <= 3) & (F.col("sentence_words") <= 9) & (F.col("long_share") <= 0.2)
    hard = (F.col("level") >= 3) & (F.col("sentence_words") >= 22) & (F.col("long_share") >= 0.45)
    return levels.where(prose).select("doc_id", F.when(easy, "easy").when(hard, "hard").alias("band")).where("band is not null").distinct()
