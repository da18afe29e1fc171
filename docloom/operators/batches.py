"""Token-budget batches over a table: sequential inside hash parts, streamed through, never collected."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.shared import ship_package

PART_ROWS = 100_000


def assign_batches(docs: DataFrame, key: str = "doc_id", text: str = "text", part: Column | None = None, budget: int = 49_152, least: int = 8, most: int = 256) -> DataFrame:
    """``key, part, batch``: batches in order of key inside each part.

    A batch closes when its token budget would go negative, between ``least`` and ``most`` rows. Parts are those of ``part`` (an integer), else hash
    parts of about ``PART_ROWS`` rows. A task streams the rows of its parts in order and keeps only the open batch's counters. Null texts have
    no characters and count one token; repeated keys are batched each time they occur.
    """
    ship_package(docs.sparkSession)
    if part is None:
        part = F.pmod(F.xxhash64(key), F.lit(max(1, docs.count() // PART_ROWS)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, batch, left, rows = None, 0, budget, 0
        for b in batches:
            out = np.empty(b.num_rows, np.int32)
            for k, (p, n) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)):
                if p != now:
                    now, batch, left, rows = p, 0, budget, 0
                tokens = max(1, n // 4)
                if rows >= most or (rows >= least and left < tokens):
                    batch, left, rows = batch + 1, budget, 0
                left, rows = left - tokens, rows + 1
                out[k] = batch
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out)], [key, "part", "batch"])

    rows = docs.select(F.col(key).alias("key"), part.cast("int").alias("part"), F.length(F.coalesce(text, F.lit(""))).alias("n"))
    return rows.repartition("part").sortWithinPartitions("part", "key").mapInArrow(run, f"{key} bigint, part int, batch int")
