"""Text statistics and types (problem 7): thresholds as noisy labelling functions, accuracies by expectation-maximisation.

Every statistic's threshold votes for a type or abstains; what most of the lines are is one vote among them. The number of documents with
each combination of votes is all that the learning needs; expectation-maximisation on the agreements gives each function's confusion
table without labels, and every document gets the posterior of its combination, which decides the type.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.shared import materialize, ship_package, widen

TYPES = ["prose", "list", "table", "junk"]
#: fixed values: common words of running text
COMMON = frozenset("the of and to in a an is was were are be been by for on at with from it its that this which as or not but we they he she you i all had has have his her their our your then there because while after before until no so if than when who what can will would could should der die das und ist nicht mit von den ein eine el la los las de que y en un una por con del le les des et est dans pour que une".split())
WORD = regex.compile(r"[\p{L}\p{N}]+")
GOOD = regex.compile(r"\p{Lu}?\p{Ll}{1,20}|\p{Lu}{1,20}")
CODE = regex.compile(r"[A-Z]{1,4}-?\d{1,6}|\d{1,4}(?:[.,:/-]\d{1,4})*|[A-Za-z]?\d{1,5}[A-Za-z]?")
VOWEL = regex.compile(r"[aeiouyàáâãäåæèéêëìíîïòóôõöøùúûüýœ]", regex.I)
MARKER = re.compile(r"\s*(?:[-•*·–▪●◦o]\s+|\[[ xX]?\]\s*|\(?\w{1,3}[.)]\s+|\d+(?:\.\d+)*[.)]?\s+)\S")
LEADER = re.compile(r"\.{3,}\s*\d+\s*$")
PAIRS = re.compile(r"[\w ]{1,30}: [^,:]*")
GAPS = re.compile(r"\S(?: {3,}|\t+)(?=\S)")
DELIMITED = re.compile(r"[\t|;,]| {3}")
STATS = ["words", "chars", "mean_word_length", "symbol_ratio", "punctuated_lines", "common_share", "good_share", "line_words", "list_share", "table_share", "junk_share", "prose_share", "delimited_lines", "digit_ratio", "marked_lines"]
RULE = re.compile(r"[\s|+:=_-]+")


def _readable(line: str) -> float:
    """Share of a line's visible characters in tokens that look like words, numbers or codes."""
    visible = good = 0
    for token in line.split():
        visible += len(token)
        for m in WORD.finditer(token):
            w = m.group()
            if GOOD.fullmatch(w):
                if len(w) <= 3 or (len(w) <= 20 and VOWEL.search(w) and len(VOWEL.findall(w)) * 6 >= len(w)):
                    good += len(w)
            elif CODE.fullmatch(w):
                good += len(w)
        good += 1 if token[-1] in ".,;:!?)\"'|" and len(token) > 1 else 0
        good += token.count("-") + token.count("|") if len(token) < 20 else 0
    return good / visible if visible else 1.0


def _delimiters(line: str) -> tuple[str, int]:
    """The delimiter that cuts a line most often, and how often."""
    best = ("", 0)
    if not DELIMITED.search(line):
        return best
    for d in ("\t", "|", ";", ","):
        n = line.count(d)
        if d == "," and n:
            n = n if len(re.findall(r",\S", line)) >= 0.8 * n or (len(PAIRS.findall(line)) > n and n >= 1) else 0
        if n > best[1]:
            best = (d, n)
    n = len(GAPS.findall(line))
    return ("gap", n) if n > best[1] and "\t" not in line else best


def _filled(line: str) -> bool:
    """Whether a row of columns holds letters and digits rather than stray signs, or is a rule between rows."""
    inner = [c for c in line if not c.isspace() and c not in "|\t;,"]
    return 2 * sum(map(str.isalnum, inner)) >= len(inner) or bool(RULE.fullmatch(line))


def line_kinds(lines: list[str], cut: list[tuple[str, int]]) -> list[str]:
    """prose, list, table, junk or blank for each line, given each line's delimiters."""
    full = [i for i, x in enumerate(lines) if x.strip()]
    out = ["blank"] * len(lines)
    for k, i in enumerate(full):
        x = lines[i].strip()
        near = [full[k + d] for d in (-1, 1) if 0 <= k + d < len(full)]
        words = WORD.findall(x)
        common = sum(w.lower() in COMMON for w in words)
        plain = common > 0
        d, n = cut[i]
        if ((n >= 2 and any(cut[j][0] == d and abs(cut[j][1] - n) <= max(1, n // 3) for j in near) and d != "|" or (d in ("|", "\t") and n >= 2)) and _filled(x)) or x.startswith("[SHEET]"):
            out[i] = "table"
        elif not (common >= max(2, 0.15 * len(words)) and sum(map(len, words)) > 0.7 * (len(x) - x.count(" "))) and _readable(x) < 0.6 and not LEADER.search(x):
            out[i] = "junk"
        elif LEADER.search(x) or (MARKER.match(lines[i]) and len(words) <= 14 and x[-1] != "."):
            out[i] = "list"
        elif n == 1 and d in ("\t", "|", "gap") and any(cut[j][0] == d and cut[j][1] == 1 for j in near):
            out[i] = "table"
        elif len(words) <= 8 and not plain and x[-1] not in ".!?:,;" and len(x) <= 80:
            out[i] = "list"
        else:
            out[i] = "prose"
    # a short line counts as a list item only beside another; a lone one is a heading or the rest of a paragraph
    for k, i in enumerate(full):
        if out[i] == "list" and not MARKER.match(lines[i]) and not LEADER.search(lines[i]):
            run = sum(1 for d in (-2, -1, 1, 2) if 0 <= k + d < len(full) and out[full[k + d]] == "list")
            if run < 2:
                out[i] = "prose"
    return out


def statistics(text: str | None) -> list[float]:
    lines = (text or "").split("\n")
    cut = [_delimiters(x) for x in lines]
    kinds = line_kinds(lines, cut)
    words = WORD.findall(text or "")
    chars = {k: 0 for k in (*TYPES, "blank")}
    for x, k in zip(lines, kinds, strict=True):
        chars[k] += len(x.strip())
    total = max(1, sum(chars.values()))
    full = [x.strip() for x in lines if x.strip()]
    visible = sum(len(x) - x.count(" ") for x in full)
    symbols = visible - sum(map(len, words))
    n = max(1, len(words))
    ascii_text = (text or "").isascii()
    good = sum(len(w) for w in words if (ascii_text and w.isalpha() and (w.islower() or w.istitle() or w.isupper()) or GOOD.fullmatch(w)) and (len(w) <= 3 or VOWEL.search(w)))
    return [
        float(len(words)), float(len(text or "")), sum(map(len, words)) / n, symbols / max(1, visible), sum(x[-1] in ".!?:;,\"')" for x in full) / max(1, len(full)),
        sum(w.lower() in COMMON for w in words) / n, good / max(1, sum(map(len, words))), len(words) / max(1, len(full)),
        chars["list"] / total, chars["table"] / total, chars["junk"] / total, chars["prose"] / total,
        sum(n >= 2 for (_, n), x in zip(cut, lines, strict=True) if x.strip()) / max(1, len(full)), sum(c.isdigit() for c in text or "") / max(1, visible),
        sum(bool(MARKER.match(x) or LEADER.search(x)) for x in lines) / max(1, len(full)),
    ]


def votes(s: list[float]) -> str:
    """One letter per labelling function: the type's number, or '-' for an abstention."""
    x = dict(zip(STATS, s, strict=True))
    pick = lambda yes, kind: str(TYPES.index(kind)) if yes else "-"
    most = max(TYPES, key=lambda k: x[f"{k}_share"])
    return "".join(
        [
            pick(x[f"{most}_share"] > 0.5, most),
            pick(x["common_share"] > 0.2, "prose"),
            pick(x["common_share"] > 0.08 and x["line_words"] > 6, "prose"),
            pick(x["punctuated_lines"] > 0.7 and x["line_words"] > 8, "prose"),
            pick(x["line_words"] < 5 and x["common_share"] < 0.05 and x["symbol_ratio"] < 0.15 and x["good_share"] > 0.6, "list"),
            pick(x["marked_lines"] > 0.5, "list"),
            pick(x["delimited_lines"] > 0.6 and x["symbol_ratio"] < 0.35, "table"),
            pick(x["digit_ratio"] > 0.15 and x["delimited_lines"] > 0.4, "table"),
            pick(x["symbol_ratio"] > 0.35, "junk"),
            pick(x["good_share"] < 0.4, "junk"),
        ]
    )


def learn_votes(counts: dict[str, int], rounds: int = 50) -> dict[str, np.ndarray]:
    """Posterior over TYPES of each vote combination, by expectation-maximisation over the combinations' counts."""
    if not counts:
        return {}
    keys = sorted(counts)
    n = np.array([counts[k] for k in keys], float)
    k_types, m = len(TYPES), len(keys[0])
    v = np.array([[TYPES_INDEX.get(c, k_types) for c in k] for k in keys])
    post = np.full((len(keys), k_types), 0.5)
    for t in range(k_types):
        post[:, t] += (v == t).sum(1)
    post /= post.sum(1, keepdims=True)
    for _ in range(rounds):
        prior = (post * n[:, None]).sum(0) + 1
        prior /= prior.sum()
        logp = np.tile(np.log(prior), (len(keys), 1))
        for j in range(m):
            table = np.full((k_types, k_types + 1), 0.1)
            for t in range(k_types + 1):
                table[:, t] += (post * n[:, None])[v[:, j] == t].sum(0)
            table /= table.sum(1, keepdims=True)
            logp += np.log(table[:, v[:, j]]).T
        new = np.exp(logp - logp.max(1, keepdims=True))
        new /= new.sum(1, keepdims=True)
        done = np.abs(new - post).max() < 1e-6
        post = new
        if done:
            break
    return dict(zip(keys, post, strict=True))


TYPES_INDEX = {str(i): i for i in range(len(TYPES))}


def text_types(docs: DataFrame, id_col: str = "file_id", text_col: str = "text") -> DataFrame:
    """Statistics, posterior of each type and the likeliest ``kind`` of every row with an id.

    Null, empty and blank texts have zero statistics, kind and posteriors null. Repeated rows stay repeated; other columns are ignored.
    The vote combinations that reach the driver number at most the product of the functions' outcomes (2,560), whatever the corpus.
    """
    spark = docs.sparkSession
    ship_package(spark)
    schema = "file_id bigint, " + ", ".join(f"{s} double" for s in STATS) + ", votes string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [statistics(t) for t in b.column(1).to_pylist()]
            cols = [pa.array([r[i] for r in rows], pa.float64()) for i in range(len(STATS))]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols, pa.array([votes(r) if r[0] or r[3] else None for r in rows], pa.string())], ["file_id", *STATS, "votes"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("file_id"), F.col(text_col).alias("text")).where("file_id is not null")
    table = materialize(widen(rows).mapInArrow(run, schema))
    counts = {r["votes"]: r["n"] for r in table.where("votes is not null").groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()}
    post = learn_votes(counts)
    learned = spark.createDataFrame([(k, *map(float, p), TYPES[int(p.argmax())]) for k, p in post.items()], "votes string, " + ", ".join(f"p_{t} double" for t in TYPES) + ", kind string")
    return table.join(F.broadcast(learned), "votes", "left").drop("votes")


def not_prose(docs: DataFrame) -> DataFrame:
    """``(file_id, kind)`` of the rows whose posterior type isn't prose, if indeed no more than half of their characters stand in prose."""
    t = text_types(docs)
    return t.where("kind <> 'prose' and prose_share <= 0.5").select("file_id", "kind").distinct()
