"""Join helpers with an explicit size check before broadcasting.

A lookup side is broadcast only when its row count and its estimated size in
bytes have been measured and are under bounds; otherwise the join is left to
the planner (sort-merge or shuffle-hash, with AQE skew handling).  Callers
materialise lookups first (see ``pipeline.materialize``), which observes both
numbers during the write, so the check costs no extra job.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType, DecimalType, StringType, StructType

# A lookup is broadcast only when it has at most this many rows and at most
# this many bytes (estimated from its values; the hashed relation built from
# it is a small multiple of that).
MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 256 * 1024 * 1024

# Fixed widths (bytes) by type name; variable-width values are measured.
_FIXED_WIDTH = {"boolean": 1, "byte": 1, "short": 2, "integer": 4, "long": 8, "float": 4,
                "double": 8, "date": 4, "timestamp": 8, "timestamp_ntz": 8}


def _value_bytes(col: Column, dt: DataType) -> Column:
    if isinstance(dt, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(col), F.lit(0))
    if isinstance(dt, StructType):
        return reduce(lambda a, b: a + b, [_value_bytes(col.getField(f.name), f.dataType) for f in dt.fields],
                      F.lit(0))
    if isinstance(dt, DecimalType):
        return F.lit(16)
    return F.lit(_FIXED_WIDTH.get(dt.typeName(), 64))


def row_bytes(df: DataFrame) -> Column:
    """Per-row size estimate: string lengths plus fixed widths (a Column)."""
    return reduce(lambda a, b: a + b, [_value_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields],
                  F.lit(0)).cast("long")


def session_bound(df: DataFrame, name: str, default: int) -> int:
    """A size bound from the session (``spark.pitchside.<name>``), else ``default``:
    a cluster sets its bounds to match executor and driver memory."""
    value = df.sparkSession.conf.get(f"spark.pitchside.{name}", None)
    return default if value is None else int(value)


def bounded_row_count(df: DataFrame, bound: int) -> int:
    """Exact row count, or ``bound + 1`` when the frame holds more than ``bound`` rows."""
    return df.limit(bound + 1).count()


def can_broadcast(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> bool:
    """True when ``df`` is within both bounds (defaults: ``spark.pitchside.maxBroadcastRows``
    / ``maxBroadcastBytes``, else the module constants).  Uses the numbers
    observed while the frame was written; otherwise measures at most
    ``max_rows + 1`` rows."""
    if max_rows is None:
        max_rows = session_bound(df, "maxBroadcastRows", MAX_BROADCAST_ROWS)
    if max_bytes is None:
        max_bytes = session_bound(df, "maxBroadcastBytes", MAX_BROADCAST_BYTES)
    rows = getattr(df, "_pitchside_rows", None)
    size = getattr(df, "_pitchside_bytes", None)
    if rows is None or size is None:
        row = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"),
                                         F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("b")).first()
        rows, size = row.n, row.b
    return rows <= max_rows and size <= max_bytes


def lookup_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left",
                *, null_safe: bool = False, checked: bool | None = None) -> DataFrame:
    """Join ``left`` to a lookup ``right`` on same-named keys.

    ``checked`` True  → broadcast ``right`` (its size was verified by the caller);
    ``checked`` None  → no hint: the planner and AQE decide from statistics;
    ``checked`` False → no hint either (right is known to be large)."""
    rhs = F.broadcast(right) if checked else right
    if not null_safe:
        return left.join(rhs, list(keys), how)
    r = rhs.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])
