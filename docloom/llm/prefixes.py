"""Rare-token prefixes: distinct word 5-grams of a text in one global order, from rare to common.

Of two texts that share at least ``threshold`` of the smaller one's tokens, the first shared token in the order stands among the first
``n - ceil(threshold * n) + 1`` tokens of the smaller text, at whatever place in the larger. So the smaller text's prefix against all
tokens of the larger one finds every such pair, whatever their sizes; of the larger text's tokens only those that some prefix holds matter.

All functions read ``words``, the 32-bit values of a text's words in order. A token is the upper 44 bits of a 5-gram's hash: tokens only
propose pairs, whose overlap is then counted exactly, so that tokens that coincide cost a look and change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from .hashing import U, shingles, word_blocks
from .sketches import add_counts, get_bits, merged_parts, merged_table, set_bits, table_of

K = 5
TOKEN_BITS = 44
MASK = U((1 << TOKEN_BITS) - 1)
#: cells of the counts (one byte each): so many a text, within these powers of two (64 MB at most); fuller cells only make the order coarser
CELLS_PER_TEXT, LEAST_BITS, MOST_BITS = 512, 16, 26
#: bits of a set of tokens: so many a row, within these powers of two (64 MB at most); fuller bits only let more rows through
BITS_PER_ROW, LEAST_WANTED, MOST_WANTED = 16, 20, 29


def count_bits(texts: int) -> int:
    return min(MOST_BITS, max(LEAST_BITS, (max(1, texts) * CELLS_PER_TEXT).bit_length()))


def count_parts(words: DataFrame, bits: int) -> DataFrame:
    """Slices of the hashed counts, saturating at 255, of the 5-grams of all ``words`` (words): ``2 ** bits`` cells."""

    def fold(table: np.ndarray, b: pa.RecordBatch) -> None:
        for _, _, h, off in word_blocks(b.column(0)):
            s, _, _ = shingles(h, off, K)
            add_counts(table, (s >> U(64 - bits)).astype(np.int64))

    return merged_parts(words.select("words"), 1 << bits, "uint8", fold, "sum")


def token_counts(words: DataFrame, texts: int) -> np.ndarray:
    bits = count_bits(texts)
    return table_of(count_parts(words, bits), 1 << bits, "uint8")[0]


def ordered_tokens(h: np.ndarray, off: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(token, text, position, count) of the distinct tokens of at most 4,096 texts, from rare to common within each text."""
    bits = int(len(counts)).bit_length() - 1
    s, doc, _ = shingles(h, off, K)
    s >>= U(64 - TOKEN_BITS)
    key = (doc.astype(U) << U(52)) | (counts[(s >> U(TOKEN_BITS - bits)).astype(np.int64)].astype(U) << U(TOKEN_BITS)) | s
    key.sort()
    if len(key):
        key = key[np.append(True, key[1:] != key[:-1])]
    doc = (key >> U(52)).astype(np.int64)
    first = np.searchsorted(doc, np.arange(len(off) - 1))
    return (key & MASK).astype(np.int64), doc, np.arange(len(key)) - first[doc] if len(key) else np.empty(0, np.int64), (key >> U(TOKEN_BITS)).astype(np.int64) & 255


def token_rows(counts: Broadcast, share: float, prefix_only: bool, buckets: int = 0):
    """Rows (token, id, pos, n[, bucket]) of texts (id, words): all tokens, or those of the prefix for ``share`` that occur more than once at all.

    A token counted once stands in one text only and meets nothing; it keeps its place in the order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, h, off in word_blocks(b.column(1)):
                token, doc, pos, count = ordered_tokens(h, off, counts.value)
                n = np.bincount(doc, minlength=j - i)
                if prefix_only:
                    keep = (pos <= (n - np.ceil(share * n - 1e-9))[doc]) & (count > 1)
                    token, doc, pos = token[keep], doc[keep], pos[keep]
                cols = [pa.array(token), b.column(0).take(pa.array(doc + i)), pa.array(pos, pa.int32()), pa.array(n[doc], pa.int32())]
                if buckets:
                    cols.append(pa.array(token % buckets, pa.int32()))
                yield pa.RecordBatch.from_arrays(cols, ["token", "id", "pos", "n", "bucket"][: len(cols)])

    return run


def wanted_rows(wanted: Broadcast):
    """Rows (token, id, n) of texts (id, words): their tokens whose bit is set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, h, off in word_blocks(b.column(1)):
                s, doc, _ = shingles(h, off, K)
                s >>= U(64 - TOKEN_BITS)
                key = (doc.astype(U) << U(52)) | s
                key.sort()
                key = key[np.append(True, key[1:] != key[:-1])] if len(key) else key
                token, doc = (key & MASK).astype(np.int64), (key >> U(52)).astype(np.int64)
                n = np.bincount(doc, minlength=j - i)
                keep = has_token(wanted.value, token)
                yield pa.RecordBatch.from_arrays([pa.array(token[keep]), b.column(0).take(pa.array(doc[keep] + i)), pa.array(n[doc[keep]], pa.int32())], ["token", "id", "n"])

    return run


def _bit(token: np.ndarray, size: int) -> np.ndarray:
    return token & (size - 1)


def has_token(bits: np.ndarray, token: np.ndarray) -> np.ndarray:
    return get_bits(bits, _bit(token, len(bits) * 8))


def token_bits(rows: DataFrame, number: int) -> np.ndarray:
    """Bits of the tokens of ``rows`` (token), ``number`` of them."""
    size = 1 << min(MOST_WANTED, max(LEAST_WANTED, (max(1, number) * BITS_PER_ROW).bit_length()))

    def fold(table: np.ndarray, b: pa.RecordBatch) -> None:
        set_bits(table, np.unique(_bit(b.column(0).to_numpy(zero_copy_only=False), size)))

    return merged_table(rows.select("token"), size // 8, "uint8", fold, "or")[0]
