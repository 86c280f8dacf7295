"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c: str | Column, fmt: str | None = None) -> Column:
    """Tolerant date parse: unparseable text becomes NULL instead of failing.

    Without ``fmt`` the cast rules apply, which accept ``yyyy``, ``yyyy-MM`` and
    ``yyyy-MM-dd`` (optionally followed by a time part)."""
    col = _col(c)
    if fmt:
        return F.try_to_date(col.cast(StringType()), F.lit(fmt))
    return F.try_to_date(col)


def parse_date_typed(df, name: str, fmt: str | None = None) -> Column:
    """Like :func:`parse_date` but passes date / timestamp columns through."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, DateType):
        return F.col(name)
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return F.to_date(F.col(name))
    return parse_date(name, fmt)


def weekday0(c: str | Column) -> Column:
    """Day of week with Monday = 0 … Sunday = 6."""
    return F.weekday(_col(c))


def day_name(c: str | Column) -> Column:
    """Full English day name ('Saturday'); ``dayname()`` would give 'Sat'."""
    return F.date_format(_col(c), "EEEE")


def month_name(c: str | Column) -> Column:
    """Full English month name ('June')."""
    return F.date_format(_col(c), "MMMM")


def weekend_flag(c: str | Column) -> Column:
    return (weekday0(c) >= 5).cast("int")


def date_parts(c: str | Column) -> dict[str, Column]:
    """year, month, quarter, day, day_of_week (Mon=0), day_name."""
    col = _col(c)
    return {
        "year": F.year(col),
        "month": F.month(col),
        "quarter": F.quarter(col),
        "day": F.dayofmonth(col),
        "day_of_week": weekday0(col),
        "day_name": day_name(col),
    }
