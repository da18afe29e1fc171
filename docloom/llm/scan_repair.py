"""Noise in texts from scanned pages (problem 3): layout traces, broken words and a noisy-channel correction of misread words.

The language model is hashed unigram and bigram counts over all texts that are not laid out as wrapped pages; its size is fixed, and what
cells hold by chance at their load is taken off every count, so that unseen words stay unknown however large the corpus. A word
the model hardly knows is compared with the words that character confusions lead back to; Viterbi picks the best sequence
of candidates for each line by confusion probability times bigram likelihood. Confusion probabilities come from the published kinds of
character confusions below and are re-estimated from the corrections of the corpus itself (one EM step).

The texts are looked at once: what a page leaves open (doubtful words and their candidates) is kept beside it in the shared folder, and
both the estimation and the decisions work on that.
"""

from __future__ import annotations

import difflib
import math
import pickle
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.shared import materialize, ship_package, widen
from .hashing import U, blocks, lettered_words, mix, word_hashes
from .sketches import add_counts, merged_table, spread

#: fixed values: character confusions of optical recognition, as "true read" pairs
CONFUSIONS = [
    ("e", "c"), ("t", "f"), ("a", "@"), ("i", "l"), ("o", "0"), ("s", "5"), ("d", "cl"), ("l", "1"), ("m", "rn"), ("u", "ii"), ("g", "q"), ("h", "b"), ("b", "8"), ("w", "vv"),
    ("rn", "m"), ("cl", "d"), ("li", "h"), ("h", "li"), ("n", "ri"), ("k", "lc"), ("i", "1"), ("i", "!"), ("i", "|"), ("l", "|"), ("l", "!"), ("l", "i"), ("z", "2"), ("g", "9"), ("b", "6"), ("s", "$"), ("o", "c"), ("c", "e"), ("f", "t"), ("u", "v"), ("v", "u"), ("a", "o"), ("o", "a"), ("nn", "m"), ("q", "9"), ("y", "v"),
]
#: the model has three tables (words by two hashes, pairs of words) of so many cells: one for every so many characters, within these powers of two
CHARS_PER_CELL, LEAST_BITS, MOST_BITS = 48, 18, 22
#: a word is known from so many occurrences on, beyond what a cell holds by chance
KNOWN = 2
#: share of unseen words that chance may make known
CHANCE = 0.001
#: prior count of a word that the model has never seen
UNSEEN = 1e-5
CLEAR = 0.995
ROMAN = r"(?:x{0,3}(?:ix|iv|v?i{1,3}|v|x))"
NUMBER = rf"(?:\d{{1,4}}|{ROMAN})"
PAGE = re.compile(rf"(?:(?:page|pg\.?|p\.?|seite|sheet|folio)\s*({NUMBER})(?:\s*(?:of|/)\s*\d+)?|(\d{{1,4}})\s*(?:of|/)\s*\d{{1,4}}|([-~*=.|–—_]+)\s*({NUMBER})\s*[-~*=.|–—_]+|[\[(<{{]\s*({NUMBER})\s*[\])>}}]|({NUMBER}))", re.I)
TAIL_NUMBER = re.compile(rf"^(.*\S)(?:\s{{2,}}|\s+[-|–—.,]?\s*(?:page|pg\.?|p\.)?\s*)({NUMBER})(?:\s*(?:of|/)\s*\d+)?\s*[-|–—\])]?$", re.I)
HEAD_NUMBER = re.compile(rf"^[-|–—\[(]?\s*(?:page|pg\.?|p\.)?\s*({NUMBER})(?:\s*(?:of|/)\s*\d+)?(?:\s{{2,}}|\s*[-|–—.,\])]?\s+)(\S.*)$", re.I)
NUMBERED = re.compile(rf"^\d{{1,4}}\s{{2,}}\S|\S\s{{2,}}(?:\d{{1,4}}|{ROMAN})$", re.I)
BREAK = re.compile(r"([^\W\d_]+)[-¬­‐‑]\s*$")
NEXT = re.compile(r"\s*([^\W\d_]+)")
TOKEN = re.compile(r"\S+")
EDGE = ".,;:()[]{}\"'?“”‘’<>"
COMPOUND = re.compile(r"[a-z]+-[a-z]+(?:-[a-z]+)*")
_M = (1 << 64) - 1
_ROMAN_VALUE = {"i": 1, "v": 5, "x": 10}


#: characters that a line with a number at its end or at its start can end or start with
LAST, FIRST = frozenset("0123456789ivxIVX-|–—])"), frozenset("0123456789ivxIVXpP-|–—[(")


def numbered_forms(x: str) -> list[tuple[str, str, str]]:
    """(end, text without its number, number) of a line that may carry the page's number at its end ("t") or start ("h")."""
    out = []
    if (x[-1:] in LAST or x[-1:].isdigit()) and (m := TAIL_NUMBER.match(x)) and len(m.group(1)) >= 6:
        out.append(("t", m.group(1), m.group(2)))
    if (x[:1] in FIRST or x[:1].isdigit()) and (m := HEAD_NUMBER.match(x)) and len(m.group(2)) >= 6:
        out.append(("h", m.group(2), m.group(1)))
    return out


def page_value(n: str) -> int:
    if n.isdigit():
        return int(n)
    v = [_ROMAN_VALUE[c] for c in n.lower()]
    return sum(-a if a < b else a for a, b in zip(v, [*v[1:], 0], strict=True))


def is_wrapped(lines: list[str]) -> bool:
    """Whether the text is broken into short lines like a page: many lines begin in the middle of a sentence."""
    full = [x.strip() for x in lines if x.strip()]
    return len(full) >= 2 and sum(x[0].islower() for x in full) >= 0.2 * len(full)


def _rising(values: list[int]) -> bool:
    """Numbers of pages: rising, with few of them missing."""
    steps = [b - a for a, b in zip(values, values[1:], strict=False)]
    return all(d > 0 for d in steps) and sum(steps) <= 2 * max(1, len(steps))


def _chain(found: list[tuple[int, int]]) -> list[int]:
    """Longest run of (line, value) rows whose values rise by one to three from row to row, as indices."""
    size, before = [0] * len(found), [-1] * len(found)
    last: dict[int, int] = {}  # value -> row of the longest run that ends in it
    for k, (_, v) in enumerate(found):
        j = max((last[v - d] for d in (1, 2, 3) if v - d in last), key=lambda j: (size[j], -j), default=-1)
        size[k], before[k] = (size[j] + 1 if j >= 0 else 1), j
        if v not in last or size[k] > size[last[v]]:
            last[v] = k
    at = max(range(len(found)), key=lambda k: (size[k], -k), default=-1)
    out = []
    while at >= 0:
        out.append(at)
        at = before[at]
    return out[::-1]


def _bare_form(x: str) -> str:
    """A running line without the page's number at either end."""
    forms = numbered_forms(x)
    return (forms[0][1] if forms else x).lower()


def layout(lines: list[str]) -> dict[int, str]:
    """Line index -> running_line or page_number.

    Marked page numbers come first, then lines that repeat exactly or but for a rising number, then bare numbers in rising order or at a
    page's edge, and last lines at a page's edge that resemble a running line but for recognition errors.
    """
    out: dict[int, str] = {}
    clean = [x.strip(" \t\r\x0c\xa0\u200b") for x in lines]
    full = [i for i, x in enumerate(clean) if x]
    place = {i: k for k, i in enumerate(full)}
    feed = {i for i, x in enumerate(lines) if "\x0c" in x}
    styles: dict[str, list[tuple[int, int]]] = {}
    for i in full:
        x = clean[i]
        m = PAGE.fullmatch(x) if len(x) <= 24 else None
        if m:
            k = next(k for k, g in enumerate(m.groups(), 1) if g and k != 3)
            n, at = m.group(k), m.start(k)
            style = re.sub(r"\d+", "#", x[:at].lower()) + ("d" if n.isdigit() else "r") + re.sub(r"\d+", "#", x[at + len(n) :].lower())
            styles.setdefault(style, []).append((i, page_value(n)))
    bare = {s: styles.pop(s) for s in ("d", "r") if s in styles}
    for found in styles.values():
        out.update(dict.fromkeys((i for i, _ in found), "page_number"))
    maybe = {i for found in bare.values() for i, _ in found}
    forms: dict[str, list[tuple[int, int | None]]] = {}
    for i in full:
        x = clean[i]
        if i in out or i in maybe:
            continue
        forms.setdefault(x.lower(), []).append((i, None))
        for name, body, number in numbered_forms(x):
            forms.setdefault(name + "\x00" + re.sub(r"\s+", " ", body).lower(), []).append((i, page_value(number)))
    for form, found in forms.items():
        where = [i for i, _ in found]
        if len(found) < 2 or ("\x00" in form and not _rising([v for _, v in found])):
            continue
        first = clean[where[0]][0]
        if "\x00" not in form and (len(form) < 5 or form[-1] in ".,;" or not (first.isupper() or first.isdigit()) or min(b - a for a, b in zip(where, where[1:], strict=False)) < 2):
            continue
        for i in where:
            out.setdefault(i, "running_line")

    def edge(i: int) -> bool:
        k = place[i]
        near = [full[k + d] for d in (-1, 1) if 0 <= k + d < len(full)]
        return len(near) < 2 or any(j in out for j in near) or bool({i, i - 1, i + 1} & feed)

    for found in bare.values():
        chain = _chain(found)
        for k in range(len(found)):
            i, v = found[k]
            if (k in chain and len(chain) >= 2) or (v <= 999 and edge(i)):
                out[i] = "page_number"
    known = {_bare_form(clean[i]) for i, kind in out.items() if kind == "running_line"}
    widest = max((len(clean[i]) for i in full), default=0)
    for _ in range(2):
        loose = [i for i in full if i not in out and clean[i][-1] not in ".,;" and (clean[i][0].isupper() or clean[i][0].isdigit()) and len(clean[i]) >= 6 and edge(i)]
        titles = [i for i in full if out.get(i) != "page_number" and i not in maybe and len(clean[i]) >= 6 and clean[i][-1] not in ".,;" and (clean[i][0].isupper() or clean[i][0].isdigit()) and (len(clean[i]) < 0.9 * widest or i in feed)]
        for i in loose:
            x = _bare_form(clean[i])
            if any(_alike(x, y) for y in known):
                out[i] = "running_line"
                continue
            if len(clean[i]) < 0.9 * widest or i in feed:
                twin = next((j for j in titles if abs(j - i) > 2 and j not in out and _alike(x, _bare_form(clean[j]))), None)
                if twin is not None:
                    out[i] = out[twin] = "running_line"
                    known.add(x)
        # lines with a number set apart at either end carry the page's number, at whatever place they stand
        for i in titles:
            if i in out or not NUMBERED.search(clean[i]):
                continue
            twin = next((j for j in titles if j != i and abs(j - i) > 2 and clean[j] != clean[i] and (NUMBERED.search(clean[j]) or j in out) and _alike(_bare_form(clean[i]), _bare_form(clean[j]))), None)
            if twin is not None:
                out[i] = out[twin] = "running_line"
        for found in bare.values():
            for i, v in found:
                if i not in out and v <= 999 and edge(i):
                    out[i] = "page_number"
    return out


def _alike(a: str, b: str) -> bool:
    """Equal up to a few recognition errors."""
    if abs(len(a) - len(b)) > max(3, len(a) // 6):
        return False
    m = difflib.SequenceMatcher(None, a, b, autojunk=False)
    return m.real_quick_ratio() >= 0.82 and m.quick_ratio() >= 0.82 and m.ratio() >= 0.82


def count_words(texts: DataFrame, bits: int) -> np.ndarray:
    """Hashed words (twice) and pairs of words of the texts (text) that are not wrapped, ``2 ** bits`` cells each, and the number of words last.

    Counted are words at least half of letters: only such words are ever asked for, and numbers, dates and codes have no end.
    """
    size = 1 << bits

    def fold(table: np.ndarray, b: pa.RecordBatch) -> None:
        t = [x for x in b.column(0).to_pylist() if x and not is_wrapped(x.split("\n"))]
        for i, j in blocks(t):
            h, off, ok = lettered_words(t[i:j])
            doc = np.repeat(np.arange(j - i), np.diff(off))
            every = h[ok]
            joined = [c for x in t[i:j] for c in COMPOUND.findall(x.lower())]
            if joined:
                h2, off2 = word_hashes([c.replace("-", " ") for c in joined])
                every = np.append(every, _compound(h2, off2))
            for k, place in enumerate(_places(every, bits)):
                add_counts(table[k * size : (k + 1) * size], place)
            if len(h) > 1:
                pair = _pair(h[:-1], h[1:])[(doc[:-1] == doc[1:]) & ok[:-1] & ok[1:]]
                add_counts(table[2 * size : 3 * size], (pair >> U(64 - bits)).astype(np.int64))
            table[-1] = min(int(table[-1]) + int(ok.sum()), np.iinfo(np.uint32).max)

    return merged_table(texts, 4 * size, "uint32", fold, "sum")[0]


def _compound(h: np.ndarray, off: np.ndarray) -> np.ndarray:
    return mix(np.add.reduceat(h * U(0x9FB21C651E98DF25) + (np.arange(len(h)) - np.repeat(off[:-1], np.diff(off))).astype(U), off[:-1]))


def _places(h: np.ndarray, bits: int) -> list[np.ndarray]:
    return [(h >> U(64 - bits)).astype(np.int64), (mix(h ^ U(0x2545F4914F6CDD1D)) >> U(64 - bits)).astype(np.int64)]


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * U(0xC2B2AE3D27D4EB4F) + b)


class Channel:
    """Language model and character confusions."""

    def __init__(self, table: np.ndarray, weights: dict[tuple[str, str], float] | None = None) -> None:
        self.bits = int(len(table)).bit_length() - 3
        size = 1 << self.bits
        self.one, self.two, self.bigrams = table[:size], table[size : 2 * size], table[2 * size : 3 * size]
        self.total = max(1, int(table[-1]))
        # what an unseen word finds: the lesser of two cells, in all but a small share of the cases
        at = np.arange(min(size, 1 << 17), dtype=U)
        a, b = ((mix(at + U(k << 40)) % U(size)).astype(np.int64) for k in (1, 2))
        self.noise = int(np.quantile(np.minimum(self.one[a], self.two[b]), 1 - CHANCE, method="higher"))
        self.noise = 0 if self.noise < KNOWN else self.noise
        even = 1.0 / len(CONFUSIONS)
        self.weight = [math.log((weights or {}).get(p, even) * (1 - CLEAR)) for p in CONFUSIONS]
        self.by_read: dict[str, list[tuple[str, int]]] = {}
        for k, (true, read) in enumerate(CONFUSIONS):
            self.by_read.setdefault(read, []).append((true, k))

    def hashes(self, words: list[str]) -> dict[str, int]:
        """Hash of every word that is one run of letters and digits."""
        good = [w for w in words if w.isalnum()]
        h, off = word_hashes(good)
        return {w: int(h[o]) for w, o, n in zip(good, off[:-1], np.diff(off), strict=True) if n == 1}

    def counts(self, hashes: list[int]) -> list[int]:
        if not hashes:
            return []
        a, b = _places(np.array(hashes, U), self.bits)
        found = np.minimum(self.one[a], self.two[b]).astype(np.int64)
        return np.maximum(found - self.noise, 0).tolist()

    def hyphened(self, pairs: list[tuple[str, str]]) -> list[int]:
        if not pairs:
            return []
        h, off = word_hashes([f"{a} {b}" for a, b in pairs])
        return self.counts(_compound(h, off).tolist())

    def readings(self, word: str) -> dict[str, tuple[int, ...]]:
        """Words that at most two confusions lead back to, with the confusions of the likeliest way."""
        ways = [(i, i + size, true, k) for i in range(len(word)) for size in (1, 2) if i + size <= len(word) for true, k in self.by_read.get(word[i : i + size], ())]
        out: dict[str, tuple[int, ...]] = {}

        def add(v: str, used: tuple[int, ...]) -> None:
            if v.isalpha() and (v not in out or self.way(used) > self.way(out[v])):
                out[v] = used

        for n, (i, j, true, k) in enumerate(ways):
            add(word[:i] + true + word[j:], (k,))
            for i2, j2, true2, k2 in ways[n + 1 :]:
                if i2 >= j:
                    add(word[:i] + true + word[j:i2] + true2 + word[j2:], (k, k2))
        out.pop(word, None)
        return out

    def way(self, used: tuple[int, ...]) -> float:
        """Log probability of confusions."""
        return sum(self.weight[k] for k in used)

    def pair_count(self, a: int, b: int) -> int:
        x = (a * 0xC2B2AE3D27D4EB4F + b) & _M
        x ^= x >> 30
        x = (x * 0xBF58476D1CE4E5B9) & _M
        x ^= x >> 27
        x = (x * 0x94D049BB133111EB) & _M
        x ^= x >> 31
        return int(self.bigrams[x >> (64 - self.bits)])


def _core(token: str) -> tuple[int, str]:
    """Where the token's word begins, and the word without punctuation at its ends."""
    a, b = 0, len(token)
    while a < b and token[a] in EDGE:
        a += 1
    while b > a and (token[b - 1] in EDGE or (token[b - 1] in "!-¬­" and b > a + 1)):
        b -= 1
    return a, token[a:b]


def _suspect(word: str) -> bool:
    """Whether a word may be misread at all: letters, perhaps with a few read as digits or signs, but no code, number or name of a field."""
    letters = sum(c.isalpha() for c in word)
    return len(word) >= 3 and letters >= 1 and letters * 2 >= len(word) and "_" not in word and not (any(c.isdigit() for c in word) and word.upper() == word and len(word) > 3)


class Page:
    """One text's lines, layout, body, broken words and the words to look at."""

    def __init__(self, text: str) -> None:
        self.lines = text.split("\n")
        self.wrapped = is_wrapped(self.lines)
        self.layout = layout(self.lines) if self.wrapped else {}
        self.body = [i for i, x in enumerate(self.lines) if i not in self.layout and x.strip(" \t\r\x0c")]
        self.breaks: list[tuple[int, int, str, str]] = []
        self.words: list[list] = []
        if not self.wrapped:
            return
        joined: dict[int, int] = {}
        for k, i in enumerate(self.body[:-1]):
            m = BREAK.search(self.lines[i])
            n = NEXT.match(self.lines[self.body[k + 1]]) if m else None
            if m and n and n.group(1)[0].islower():
                self.breaks.append((i, self.body[k + 1], m.group(1), n.group(1)))
                joined[i] = len(self.breaks) - 1
        second = {b[1] for b in self.breaks}
        for i in self.body:
            row = []
            tokens = TOKEN.findall(self.lines[i])
            for t, token in enumerate(tokens):
                if (i in second and t == 0) or (i in joined and t == len(tokens) - 1):
                    continue
                if token.isalpha():
                    row.append(token.lower())
                    continue
                for part in token.split("-"):
                    w = _core(part)[1].lower()
                    if w:
                        row.append(w)
            self.words.append([i, row])


def _sequence(channel: Channel, row: list[str], options: dict[str, list[tuple[str, float, int]]], known: dict[str, int], count: dict[str, int]) -> list[str]:
    """Best words of a line by Viterbi."""
    lattice = [options.get(w) or [(w, 0.0, count.get(w, 0))] for w in row]
    if all(len(x) == 1 for x in lattice):
        return row
    best = [(0.0, None)]
    back = []
    before: list[tuple[str, float, int]] = [("", 0.0, 0)]
    for cell in lattice:
        nxt, from_ = [], []
        for w, p, c in cell:
            unigram = (c + UNSEEN) / channel.total
            top = (-1e18, 0)
            for k, (v, _, cv) in enumerate(before):
                q = unigram
                if v and cv and (len(cell) > 1 or len(before) > 1):
                    both = channel.pair_count(known[v], known[w]) if v in known and w in known else 0
                    # a pair is no more frequent than its words; this undoes most collisions of the hashed table
                    q = 0.6 * min(both, c, cv) / cv + 0.4 * unigram
                s = best[k][0] + math.log(q)
                if s > top[0]:
                    top = (s, k)
            nxt.append((top[0] + p, None))
            from_.append(top[1])
        best, before = nxt, cell
        back.append(from_)
    at = max(range(len(best)), key=lambda k: best[k][0])
    out = []
    for cell, from_ in zip(reversed(lattice), reversed(back), strict=True):
        out.append(cell[at][0])
        at = from_[at]
    return out[::-1]


def _changed(observed: str, true: str) -> int:
    """First place where the two differ, from the left."""
    n = 0
    while n < min(len(observed), len(true)) and observed[n] == true[n]:
        n += 1
    return n


def observe(texts: list[str | None], channel: Channel) -> list[dict | None]:
    """What each wrapped text leaves to decide: layout, broken words, lines with doubtful words, their candidates and counts; None for other texts."""
    pages = [Page(t) if t else None for t in texts]
    vocabulary = {w for p in pages if p for _, row in p.words for w in row}
    glued = {(a + b).lower() for p in pages if p for _, _, a, b in p.breaks} | {x.lower() for p in pages if p for b in p.breaks for x in b[2:]}
    hashes = channel.hashes([*vocabulary, *glued])
    count = dict(zip(hashes, channel.counts(list(hashes.values())), strict=True))
    reach = {w: channel.readings(w) for w in vocabulary | glued if count.get(w, 0) < KNOWN and _suspect(w)}
    cand = channel.hashes(list({c for r in reach.values() for c in r}))
    cand_count = dict(zip(cand, channel.counts(list(cand.values())), strict=True))
    options = {}
    for w, r in reach.items():
        good = [(c, used, cand_count[c]) for c, used in r.items() if cand_count.get(c, 0) >= KNOWN and len(c) >= 2]
        if good:
            options[w] = good
    pairs = list({(b[2].lower(), b[3].lower()) for p in pages if p for b in p.breaks})
    hyphen = dict(zip(pairs, channel.hyphened(pairs), strict=True))
    out: list[dict | None] = []
    for p in pages:
        if p is None or not p.wrapped:
            out.append(None)
            continue
        breaks = [(i, j, a.lower(), b.lower(), hyphen[a.lower(), b.lower()]) for i, j, a, b in p.breaks]
        said = [w for _, row in p.words for w in row]
        prose = sum(count.get(w, 0) >= KNOWN for w in said) >= 0.7 * len(said)
        # a line that is mostly unknown is no text of the language at all
        rows = [(i, row) for i, row in p.words if any(w in options for w in row) and not (2 * sum(count.get(w, 0) >= KNOWN for w in row) < len(row) and not (prose and len(row) <= 4))]
        asked = {w for _, row in rows for w in row} | {x for _, _, a, b, _ in breaks for x in (a, b, a + b)}
        out.append({"layout": p.layout, "breaks": breaks, "rows": rows, "options": {w: options[w] for w in asked if w in options}, "count": {w: count[w] for w in asked if w in count}})
    return out


def decide(page: dict | None, channel: Channel) -> dict:
    """``defects`` {(line, defect)}, ``fixes`` {line: [(read, true)]}, ``breaks`` {line: True if the hyphen goes} and the layout."""
    result: dict = {"defects": set(), "fixes": {}, "breaks": {}, "layout": page["layout"] if page else None}
    if page is None:
        return result
    count = page["count"]
    weighed = {w: sorted(((c, channel.way(used), n) for c, used, n in good), key=lambda x: (-(x[1] + math.log(x[2])), x[0])) for w, good in page["options"].items()}
    result["defects"] |= set(page["layout"].items())
    for i, j, a, b, own in page["breaks"]:
        word = a + b
        whole = count.get(word, 0)
        fixed = weighed[word][0][0] if whole < KNOWN and own < KNOWN and word in weighed else None
        if own >= KNOWN and own >= whole:
            split = False
        elif whole >= KNOWN or fixed:
            split = True
        else:
            split = not (count.get(a, 0) >= KNOWN and count.get(b, 0) >= KNOWN)
        if not split:
            result["breaks"][i] = False
            for line, part in ((i, a), (j, b)):
                if part in weighed:
                    result["defects"].add((line, "misread"))
                    result["fixes"].setdefault(line, []).append((part, weighed[part][0][0]))
            continue
        result["breaks"][i] = True
        result["defects"].add((i, "split_word"))
        if fixed:
            line = i if _changed(word, fixed) < len(a) else j
            result["defects"].add((line, "misread"))
            result["fixes"].setdefault(line, []).append((word, fixed))
    options = {w: [(w, math.log(CLEAR), 0), *good] for w, good in weighed.items()}
    known = channel.hashes(list({w for _, row in page["rows"] for w in row} | {c for good in weighed.values() for c, _, _ in good}))
    for i, row in page["rows"]:
        for read, true in zip(row, _sequence(channel, row, options, known, count), strict=True):
            if read != true:
                result["defects"].add((i, "misread"))
                result["fixes"].setdefault(i, []).append((read, true))
    return result


def _like(read: str, true: str) -> str:
    return true.upper() if read.isupper() and len(read) > 1 else true.capitalize() if read[:1].isupper() else true


def repaired_text(text: str, result: dict) -> str:
    """Continuous paragraphs: layout lines dropped, broken words joined, misread words replaced, lines of a paragraph joined by blanks."""
    if result["layout"] is None:
        return text.strip() if text else text
    parts: list[str] = []
    joint = blank = False
    cut = False
    for i, raw in enumerate(text.split("\n")):
        if i in result["layout"]:
            cut = True
            continue
        x = raw.strip(" \t\r\x0c")
        if not x:
            blank = True
            continue
        for read, true in result["fixes"].get(i, ()):
            x = re.sub(rf"(?<!\w){re.escape(read)}(?!\w)", lambda m, true=true: _like(m.group(), true), x, flags=re.I)
        # a blank line at a page's edge ends no paragraph if the sentence goes on
        if parts and blank and not joint and not (cut and (parts[-1][-1:] not in ".!?:" and x[:1].islower())):
            parts.append("\n\n")
        elif parts and not joint:
            parts.append(" ")
        keep = result["breaks"].get(i)
        joint = keep is not None
        if keep:
            x = re.sub(r"[-¬­‐‑]\s*$", "", x)
        parts.append(x)
        blank = cut = False
    joined = "".join(parts)
    # words broken over two lines are corrected once they are whole
    for fixes in result["fixes"].values():
        for read, true in fixes:
            if read not in joined.lower():
                continue
            joined = re.sub(rf"(?<!\w){re.escape(read)}(?!\w)", lambda m, true=true: _like(m.group(), true), joined, flags=re.I)
    return joined


STATE = "file_id bigint, text string, page binary"


def _learn(pages: DataFrame, shared) -> dict[tuple[str, str], float]:
    """Confusion probabilities from the corrections themselves: counts by pair, a table of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        channel = Channel(shared.value)
        seen: Counter = Counter()
        for b in batches:
            for page in b.column(0).to_pylist():
                for fixes in decide(pickle.loads(page), channel)["fixes"].values():  # noqa: S301 - written by this job
                    for read, true in fixes:
                        a = _changed(read, true)
                        for k, (x, y) in enumerate(CONFUSIONS):
                            if true[a : a + len(x)] == x and read[a : a + len(y)] == y:
                                seen[k] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int32()), pa.array(list(seen.values()), pa.int64())], ["k", "n"])

    rows = pages.where("page is not null").select("page").mapInArrow(run, "k int, n bigint").groupBy("k").agg(F.sum("n").alias("n")).collect()
    n = {r["k"]: r["n"] for r in rows}
    total = sum(n.values()) + len(CONFUSIONS)
    return {p: (n.get(k, 0) + 1) / total for k, p in enumerate(CONFUSIONS)}


def repair_scans(docs: DataFrame, id_col: str = "file_id", text_col: str = "text", learn: bool = True) -> DataFrame:
    """``(file_id, text, defects)``: repaired text of every row, and its damaged lines as ``array<struct<line_no, defect>>``.

    Texts that aren't laid out as wrapped pages come back trimmed, without defects; null texts stay null; rows with a null id are ignored;
    repeated rows stay repeated; other columns are ignored. Whether a text stems from a scan is told from the text itself, since runs
    that skip recognition also meet pages scanned elsewhere; a text in one line, or in a script without letter case, counts as no page.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = widen(docs.select(F.col(id_col).cast("bigint").alias("file_id"), F.col(text_col).alias("text")).where("file_id is not null"))
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    bits = min(MOST_BITS, max(LEAST_BITS, (chars // CHARS_PER_CELL).bit_length()))
    shared = spread(docs, count_words(rows.select("text"), bits))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        channel = Channel(shared.value)
        for b in batches:
            t = b.column(1).to_pylist()
            for i, j in blocks(t):
                pages = [pickle.dumps(p) if p is not None else None for p in observe(t[i:j], channel)]
                part = b.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(pages, pa.binary())], ["file_id", "text", "page"])

    seen = materialize(rows.mapInArrow(look, STATE))
    weights = _learn(seen, shared) if learn else None

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        channel = Channel(shared.value, weights)
        kind = pa.list_(pa.struct([("line_no", pa.int64()), ("defect", pa.string())]))
        for b in batches:
            fixed, defects = [], []
            for t, page in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                r = decide(pickle.loads(page) if page is not None else None, channel)  # noqa: S301 - written by this job
                fixed.append(repaired_text(t, r) if t is not None else None)
                defects.append([{"line_no": line + 1, "defect": d} for line, d in sorted(r["defects"])])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fixed, pa.string()), pa.array(defects, kind)], ["file_id", "text", "defects"])

    return seen.mapInArrow(finish, "file_id bigint, text string, defects array<struct<line_no: bigint, defect: string>>")


__all__ = ["CONFUSIONS", "Channel", "Page", "count_words", "decide", "layout", "observe", "repair_scans", "repaired_text"]
