"""Exact vector search of a stated query set against all rows, in blocks of queries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..plans.shared import ship_package

BLOCK = 4096


def cosine_topk(queries: DataFrame, rows: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, vec_id, score``: the ``k`` nearest rows of each query by cosine (six places), ties by id, without the row itself.

    Queries come in blocks of ``BLOCK`` (bounded broadcast); each task keeps its best ``k`` a query, so only those are shuffled. Null
    vectors, vectors of another length than the block's first and zero vectors have no neighbours.
    """
    spark = rows.sparkSession
    ship_package(spark)
    schema = f"query_id bigint, {key} bigint, score double"
    out = None
    block: list[tuple[int, list[float]]] = []

    def scan(found: list[tuple[int, list[float]]]) -> DataFrame:
        dim = len(found[0][1])
        found = [f for f in found if len(f[1]) == dim]
        ids = np.array([f[0] for f in found], np.int64)
        q = np.array([f[1] for f in found], np.float64)
        q /= np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-300)
        shared = spark.sparkContext.broadcast((ids, q))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            qi, qv = shared.value
            for b in batches:
                vecs = b.column(1).to_pylist()
                some = [i for i, v in enumerate(vecs) if v is not None and len(v) == dim and any(v)]
                if not some:
                    continue
                m = np.array([vecs[i] for i in some], np.float64)
                m /= np.linalg.norm(m, axis=1, keepdims=True)
                rid = b.column(0).to_numpy(zero_copy_only=False)[some]
                s = np.round(qv @ m.T, 6)
                s[qi[:, None] == rid[None, :]] = -2
                n = min(k, s.shape[1])
                order = np.lexsort((np.broadcast_to(rid, s.shape), -s), axis=1)[:, :n]
                at = np.repeat(np.arange(len(qi)), n)
                best, who = s[at, order.ravel()], rid[order.ravel()]
                ok = best >= -1
                yield pa.RecordBatch.from_arrays([pa.array(qi[at][ok]), pa.array(who[ok]), pa.array(best[ok])], ["query_id", key, "score"])

        local = rows.select(key, vector).mapInArrow(run, schema)
        w = W.partitionBy("query_id").orderBy(F.desc("score"), key)
        return local.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= k).drop("_k")

    for r in queries.where(F.col(vector).isNotNull()).select(key, vector).toLocalIterator():
        block.append((r[0], list(r[1])))
        if len(block) == BLOCK:
            out = scan(block) if out is None else out.unionByName(scan(block))
            block = []
    if block:
        out = scan(block) if out is None else out.unionByName(scan(block))
    return out if out is not None else spark.createDataFrame([], schema)
