"""Vector functions as Columns over array<float> or array<double>."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; null if either is a null vector."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def unit(a: Column) -> Column:
    n = norm(a)
    return F.transform(a, lambda x: F.coalesce(F.try_divide(x.cast("double"), n), F.lit(0.0)))
