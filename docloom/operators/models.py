"""Model operators as pluggable Arrow functions: enrichment, token-budget batches, embeddings, entities."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..plans.shared import ship_package


class Enricher(Protocol):
    def __call__(self, contexts: list[str], texts: list[str]) -> list[str | None]: ...


class Embedder(Protocol):
    dim: int

    def __call__(self, texts: list[str]) -> np.ndarray: ...


class HashEmbedder:
    """Deterministic stand-in for a model: hashed bag of words, unit length."""

    def __init__(self, dim: int = 64) -> None:
        self.dim = dim

    def __call__(self, texts: list[str]) -> np.ndarray:
        import zlib

        out = np.zeros((len(texts), self.dim), np.float32)
        for r, t in enumerate(texts):
            for w in (t or "").lower().split():
                h = zlib.crc32(w.encode())
                out[r, h % self.dim] += 1.0 if h & 1 << 31 else -1.0
        n = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(n > 0, n, 1)


class LetterEmbedder:
    """A stand-in whose vectors can be stated in SQL: counts of the letters a to z, unit length."""

    dim = 26

    def __call__(self, texts: list[str]) -> np.ndarray:
        out = np.array([[(t or "").lower().count(chr(97 + k)) for k in range(self.dim)] for t in texts], np.float32).reshape(len(texts), self.dim)
        n = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(n > 0, n, 1)


def lead_sentence(contexts: list[str], texts: list[str]) -> list[str | None]:
    """Deterministic stand-in for a language model: the context's first sentence."""
    return [(c or "").split(". ")[0][:150] or None for c in contexts]


def budget_batches(lengths: list[int], budget: int = 49_152, least: int = 8, most: int = 256) -> list[int]:
    """Batch number of each text in order: a batch closes when its token budget would go negative, between ``least`` and ``most`` rows."""
    out, batch, left, rows = [], 0, budget, 0
    for n in lengths:
        tokens = max(1, n // 4)
        if rows >= most or (rows >= least and left < tokens):
            batch, left, rows = batch + 1, budget, 0
        left, rows = left - tokens, rows + 1
        out.append(batch)
    return out


def embed(chunks: DataFrame, embedder: Callable[[], Embedder], key: str = "chunk_id", text: str = "text", prefix: str = "", budget: int = 49_152) -> DataFrame:
    """``key, vector``: vectors keyed by chunk id, in token-budget batches; a batch that runs out of memory is halved and tried again."""
    ship_package(chunks.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = embedder()

        def vectors(texts: list[str]) -> np.ndarray:
            try:
                return model(texts)
            except MemoryError:
                if len(texts) == 1:
                    raise
                half = len(texts) // 2
                return np.concatenate([vectors(texts[:half]), vectors(texts[half:])])

        for b in batches:
            texts = [prefix + (t or "") for t in b.column(1).to_pylist()]
            number = np.array(budget_batches([len(t) for t in texts], budget))
            for k in range(number.max(initial=-1) + 1):
                rows = np.flatnonzero(number == k)
                v = vectors([texts[i] for i in rows]).astype(np.float32)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * v.shape[1], pa.int32()), pa.array(v.ravel()))
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows)), flat], [key, "vector"])

    kind = chunks.schema[key].dataType.simpleString()
    return chunks.select(key, text).mapInArrow(run, f"{key} {kind}, vector array<float>")


def embed_query(text: str, embedder: Callable[[], Embedder], prefix: str = "") -> np.ndarray:
    """float32 vector of one query text, with the query prefix; unit length unless it has no words."""
    v = np.asarray(embedder()([prefix + (text or "")]), np.float32)[0]
    n = float(np.linalg.norm(v))
    return v / n if n > 0 else v


class Backends:
    """Embedder that takes the first of several back ends that starts, and moves on to the next one if that fails on a batch.

    Each back end is a callable that makes an embedder. Vectors are brought to unit length.
    """

    def __init__(self, *makers: Callable[[], Embedder]) -> None:
        self.makers, self.now, self.tried = makers, None, []
        self._next()

    def _next(self) -> None:
        while len(self.tried) < len(self.makers):
            maker = self.makers[len(self.tried)]
            self.tried.append(maker)
            try:
                self.now = maker()
            except Exception:  # noqa: BLE001, S112 - a back end that doesn't start leaves it to the next
                continue
            self.dim = self.now.dim
            return
        raise RuntimeError("no back end for embeddings starts")

    def __call__(self, texts: list[str]) -> np.ndarray:
        while True:
            try:
                v = np.asarray(self.now(texts), np.float32)
                break
            except MemoryError:
                raise
            except Exception:  # noqa: BLE001 - a failing back end is left for the next one
                self._next()
        n = np.linalg.norm(v, axis=1, keepdims=True)
        return v / np.where(n > 0, n, 1)


def as_float16(vectors: DataFrame, col: str = "vector") -> DataFrame:
    """Vectors rounded to what float16 holds, the precision of the exported file."""
    at = vectors.columns.index(col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column(at)
            flat = v.values.slice(v.offsets[0].as_py(), v.offsets[-1].as_py() - v.offsets[0].as_py()).to_numpy(zero_copy_only=False).astype(np.float16).astype(np.float32)
            offsets = pa.array(np.asarray(v.offsets) - v.offsets[0].as_py(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, pa.array(flat)) if i == at else b.column(i) for i in range(b.num_columns)], b.schema.names)

    return vectors.mapInArrow(run, vectors.schema)


def model_ready(wanted: str, listed: Callable[[], list[str]]) -> tuple[bool, str]:
    """Whether a model service answers and holds the model: equal name, else a name that begins with it, else the same base name before the colon."""
    try:
        names = listed()
    except Exception as e:  # noqa: BLE001 - whatever the service's client raises, it doesn't answer
        return False, f"no answer: {type(e).__name__}"
    base = wanted.split(":")[0]
    for test in (lambda n: n == wanted, lambda n: n.startswith(wanted), lambda n: n.split(":")[0] == base):
        hit = sorted(n for n in names if test(n))
        if hit:
            return True, hit[0]
    return False, "model missing"


def enrich(chunks: DataFrame, docs: DataFrame, enricher: Enricher = lead_sentence, doc_key: str = "doc_id", key: str = "chunk_id", text: str = "text", least: int = 10) -> DataFrame:
    """``key, enriched_text``: preamble and text; null where the model fails or says too little. Documents join by key, never broadcast."""
    ship_package(chunks.sparkSession)
    ctx = chunks.join(docs.select(doc_key, F.col("text").alias("_doc")), doc_key).select(key, text, T.context_window(F.col("_doc"), F.col(text)).alias("_ctx"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, contexts = b.column(1).to_pylist(), b.column(2).to_pylist()
            try:
                said = enricher(contexts, texts)
            except Exception:  # a failing model leaves nulls, as the contract says
                said = [None] * len(texts)
            out = [f"{p}\n\n{t}" if p and len(p) > least else None for p, t in zip(said, texts, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], [key, "enriched_text"])

    kind = chunks.schema[key].dataType.simpleString()
    return ctx.mapInArrow(run, f"{key} {kind}, enriched_text string")


def extract(chunks: DataFrame, extractor: Callable[[list[str]], list[list[dict]]], key: str = "chunk_id", text: str = "text", threshold: float = 0.5, batch: int = 16, least: int = 20) -> DataFrame:
    """``key, text, label, score, start, end`` of a model's entities; a failing batch gives no rows."""
    ship_package(chunks.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for i in range(0, len(texts), batch):
                try:
                    found = extractor(texts[i : i + batch])
                except Exception:  # a failing batch gives no rows, as the contract says
                    continue
                rows += [(k, e["text"], e["label"], round(float(e["score"]), 4), int(e["start"]), int(e["end"])) for k, es in zip(ids[i : i + batch], found, strict=True) for e in es if e["score"] >= threshold]
            cols = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = [b.schema.field(0).type, pa.string(), pa.string(), pa.float64(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], [key, "text", "label", "score", "start", "end"])

    kind = chunks.schema[key].dataType.simpleString()
    return chunks.where(F.length(text) >= least).select(key, text).mapInArrow(run, f"{key} {kind}, text string, label string, score double, start int, end int")
