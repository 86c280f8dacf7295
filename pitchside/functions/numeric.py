"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def coerce_double(c: str | Column) -> Column:
    """Text or number to double; unparseable → NULL, NaN → NULL."""
    d = _col(c).try_cast("double")
    return F.when(F.isnan(d), F.lit(None).cast("double")).otherwise(d)


def coerce_int(c: str | Column, default: int | None = 0) -> Column:
    """Text or number to int, truncating ("3.0" → 3); unparseable → ``default``."""
    i = coerce_double(c).try_cast("int")
    return i if default is None else F.coalesce(i, F.lit(default))


def exact_mean(c: str | Column) -> Column:
    """Mean of a double column from an exact decimal sum.

    Values of a reading's size keep all their digits in 18 decimals; they are summed exactly and
    divided once, so the result is the same double however rows are split over partitions (a
    floating-point running sum depends on arrival order)."""
    col = _col(c)
    return F.sum(col.cast("decimal(28,18)")).cast("double") / F.count(col)
