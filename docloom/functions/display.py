"""Sizes and times for readers, as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS = [(1 << 30, "GB"), (1 << 20, "MB"), (1 << 10, "KB")]


def bytes_text(n: Column) -> Column:
    """``1.5 GB``, ``3.0 KB`` or ``17 B``; null stays null."""
    out = F.when(n.isNotNull(), F.concat(n.cast("bigint").cast("string"), F.lit(" B")))
    for size, unit in reversed(_UNITS):
        out = F.when(n >= size, F.concat(F.format_string("%.1f", F.bround(n / F.lit(float(size)), 1)), F.lit(f" {unit}"))).otherwise(out)
    return out


def elapsed_text(seconds: Column) -> Column:
    """``H:MM:SS``, or ``M:SS`` below an hour; negative counts as zero."""
    s = F.greatest(F.lit(0), F.floor(seconds)).cast("bigint")
    h, m = F.floor(s / 3600), F.floor((s % 3600) / 60)
    return F.when(h > 0, F.format_string("%d:%02d:%02d", h, m, s % 60)).when(seconds.isNotNull(), F.format_string("%d:%02d", m, s % 60))
