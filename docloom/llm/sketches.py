"""Fixed-size tables merged over all partitions: hashed counts and Bloom bits.

Their size is a parameter and doesn't follow the data, so the merged table may be broadcast. Each task folds all
its input into one local table, emits it in slices, and the slices are merged on the executors, at most ``FAN`` at a time,
level by level; only the merged table, of bounded size, reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICES = 16
#: tables merged by one task; more of them take more levels
FAN = 64


def merged_table(df: DataFrame, size: int, dtype: str, fold: Callable[[np.ndarray, pa.RecordBatch], None], how: str, tables: int = 1) -> np.ndarray:
    """The table of :func:`merged_parts` on the driver."""
    return table_of(merged_parts(df, size, dtype, fold, how, tables), size, dtype, tables)


def table_of(parts: DataFrame, size: int, dtype: str, tables: int = 1) -> np.ndarray:
    """Join the slices of a table of fixed size."""
    out = np.zeros((tables, SLICES, size // SLICES), dtype)
    for row in parts.toLocalIterator():
        out[:, row["slice"]] = np.frombuffer(bytes(row["cells"]), dtype).reshape(tables, -1)
    return out.reshape(tables, size)


def add_counts(table: np.ndarray, places: np.ndarray) -> None:
    """Add one for each place, saturating at the type's largest value, at the cost of the places and not of the table."""
    at, n = np.unique(places, return_counts=True)
    most = np.iinfo(table.dtype).max
    table[at] = np.minimum(table[at].astype(np.int64) + n, most)


def merged_parts(df: DataFrame, size: int, dtype: str, fold: Callable[[np.ndarray, pa.RecordBatch], None], how: str, tables: int = 1) -> DataFrame:
    """Fold every batch of ``df`` into an array of ``tables x size`` cells per task and merge the arrays: rows (slice, cells).

    ``how``: "sum" adds cells (saturating at the type's largest value), "or" joins bits, "twice" expects two tables of bits
    (seen, seen more than once) and also marks as repeated what two tasks have both seen. ``fold`` changes the array in place.
    """
    step = tables * size // SLICES

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(tables * size, dtype)
        some = False
        for b in batches:
            if b.num_rows:
                some = True
                fold(table, b)
        if some:
            shaped = table.reshape(tables, SLICES, -1)
            part = pa.array([TaskContext.get().partitionId()] * SLICES, pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), part, pa.array([pa.compress(np.ascontiguousarray(shaped[:, i]).tobytes(), codec="zstd", asbytes=True) for i in range(SLICES)], pa.binary())], ["slice", "part", "cells"])

    def merged(t: pa.Table) -> np.ndarray:
        out = None
        for raw in t["cells"]:
            x = np.frombuffer(pa.decompress(raw.as_py(), step * np.dtype(dtype).itemsize, codec="zstd", asbytes=True), dtype).reshape(tables, -1)
            if out is None:
                out = x.copy()
            elif how == "sum":
                out = np.where(out > np.iinfo(dtype).max - x, np.iinfo(dtype).max, out + x).astype(dtype)
            elif how == "twice":
                out[1] |= x[1] | (out[0] & x[0])
                out[0] |= x[0]
            else:
                out |= x
        return out

    def level(t: pa.Table) -> pa.Table:
        return pa.table({"slice": t["slice"][:1], "part": t["part"][:1], "cells": pa.array([pa.compress(np.ascontiguousarray(merged(t)).tobytes(), codec="zstd", asbytes=True)], pa.binary())})

    def last(t: pa.Table) -> pa.Table:
        return pa.table({"slice": t["slice"][:1], "cells": pa.array([merged(t).tobytes()], pa.binary())})

    tasks = 2 * max(1, df.sparkSession.sparkContext.defaultParallelism)
    parts = df.coalesce(tasks).mapInArrow(local, "slice int, part int, cells binary")
    while tasks > FAN:
        parts = parts.withColumn("part", F.floor(F.col("part") / FAN).cast("int")).groupBy("slice", "part").applyInArrow(level, "slice int, part int, cells binary")
        tasks = -(-tasks // FAN)
    return parts.groupBy("slice").applyInArrow(last, "slice int, cells binary")


def spread(df: DataFrame, array: np.ndarray) -> Broadcast:
    """Broadcast a table of fixed size."""
    return df.sparkSession.sparkContext.broadcast(array)


class Packed:
    """A broadcast table that is unpacked by the task that reads it: the driver and each executor keep a file of the packed bytes."""

    def __init__(self, df: DataFrame, array: np.ndarray) -> None:
        self.dtype, self.nbytes, self.table = array.dtype.str, array.nbytes, None
        self.packed = df.sparkSession.sparkContext.broadcast(pa.compress(np.ascontiguousarray(array).tobytes(), codec="zstd", asbytes=True))

    def __getstate__(self) -> dict:
        return self.__dict__ | {"table": None}

    @property
    def value(self) -> np.ndarray:
        if self.table is None:
            self.table = np.frombuffer(pa.decompress(self.packed.value, self.nbytes, codec="zstd", asbytes=True), self.dtype)
        return self.table


def set_bits(bits: np.ndarray, at: np.ndarray) -> None:
    np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))


def get_bits(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
