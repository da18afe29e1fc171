"""Vectorised word and shingle hashing for Arrow batches.

Words are runs of letters and digits without letter case. All functions work on a whole batch of texts at
once with NumPy, so the cost per byte stays near that of a memory scan; no Python code runs per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import regex

U = np.uint64
_NON_WORD = regex.compile(r"[^\p{L}\p{N}]+")
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
BLOCK_CHARS = 1_000_000


def _lower_table() -> np.ndarray:
    """Byte -> lower-cased byte, 0 for separators; bytes of non-ASCII letters stand for themselves."""
    table = np.zeros(256, np.uint8)
    for b in range(256):
        if b >= 128 or chr(b).isalnum():
            table[b] = ord(chr(b).lower()) if b < 128 else b
    return table


LOWER = _lower_table()
_POWERS: dict[str, np.ndarray] = {}


def _powers(name: str, base: int, n: int) -> np.ndarray:
    have = _POWERS.get(name)
    if have is None or len(have) < n:
        out = np.full(max(n, BLOCK_CHARS + 4096), base, U)
        out[0] = 1
        have = _POWERS[name] = np.multiply.accumulate(out)
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser (public constants)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def plain(text: str | None) -> str:
    """The text itself if ASCII, else lower-cased with single blanks for everything that is no letter or digit."""
    if not text:
        return ""
    return text if text.isascii() else _NON_WORD.sub(" ", text.lower())


def blocks(texts: list, limit: int = BLOCK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about ``limit`` characters; a longer text is a block of its own."""
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if size and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n + 1
    if start < len(texts):
        yield start, len(texts)


def _words(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every word of every text, the texts' offsets, and the words' ends and the characters they stand in."""
    parts = [plain(t).encode() for t in texts]
    data = b" ".join(parts) + b" "
    low = LOWER[np.frombuffer(data, np.uint8)]
    inside = np.empty(len(low) + 2, np.int8)
    inside[0] = inside[-1] = 0
    inside[1:-1] = low != 0
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sums = np.empty(len(low) + 1, U)
    sums[0] = 0
    np.cumsum(low.astype(U) * _powers("up", _BASE, len(low))[: len(low)], out=sums[1:])
    h = mix((sums[ends] - sums[starts]) * _powers("down", _BASE_INV, len(low) + 1)[starts])
    begins = np.cumsum([0, *(len(p) + 1 for p in parts)])
    return h, np.searchsorted(starts, begins), starts, ends, low


def word_hashes(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of every text, and the offsets (len(texts) + 1) of each text's words."""
    return _words(texts)[:2]


def lettered_words(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As :func:`word_hashes`, and whether at least half of each word's characters are letters."""
    h, off, starts, ends, low = _words(texts)
    digits = np.append(0, np.cumsum((low >= 48) & (low <= 57)))
    return h, off, 2 * (digits[ends] - digits[starts]) <= ends - starts


def shingles(h: np.ndarray, offsets: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, index of the text, index of the first word) of every run of k consecutive words within one text."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, U), np.empty(0, np.int64), np.empty(0, np.int64)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    s = h[:n].copy()
    for j in range(1, k):
        s = s * U(0xD6E8FEB86659FD93) + h[j : n + j]
    keep = np.flatnonzero(doc[:n] == doc[k - 1 :])
    return mix(s[keep]), doc[keep], keep


def word_values(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the words, the 32-bit values that stand for them in all later passes, and the texts' offsets."""
    h, off = word_hashes(texts)
    return h, (h >> U(32)).astype(np.uint32), off


def spread_values(values: np.ndarray) -> np.ndarray:
    """Word hashes to make shingles of, from the 32-bit values of words."""
    return mix(values.astype(U))


def word_blocks(column, limit: int = 200_000, most: int = 4096) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows ``i`` to ``j`` of a binary column of word values at a time, as hashes and offsets: about ``limit`` words, at most ``most`` rows."""
    rows = column.to_pylist()
    size = [len(r) // 4 if r else 0 for r in rows]
    i = 0
    while i < len(rows):
        j, total = i, 0
        while j < len(rows) and j - i < most and (total == 0 or total + size[j] <= limit):
            total += size[j]
            j += 1
        yield i, j, spread_values(np.frombuffer(b"".join(r or b"" for r in rows[i:j]), np.uint32)), np.cumsum([0, *size[i:j]])
        i = j


def text_shingles(texts: list, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, sorted within each text, and their offsets."""
    h, offsets = word_hashes(texts)
    s, doc, _ = shingles(h, offsets, k)
    order = np.lexsort((s, doc))
    s, doc = s[order], doc[order]
    first = np.ones(len(s), bool)
    first[1:] = (s[1:] != s[:-1]) | (doc[1:] != doc[:-1])
    s, doc = s[first], doc[first]
    return s, np.searchsorted(doc, np.arange(len(texts) + 1))
