"""Surrogate keys: contiguous ids 1..n following a total order.

``dense_ids`` is the textbook ``row_number() over (order by …)``; Spark runs it
in a single task, so it is only for sets whose size has been measured:
``number_rows`` materialises the set, reads the row count observed during the
write, and uses the window only under ``MAX_SINGLE_TASK_ROWS``; beyond it the
same ids come from ``sequential_ids``.

``sequential_ids`` scales to the fact table: range-partition on the order key
(the range partitioner samples the whole composite key, so even a hot leading
value is split across partitions), sort within partitions, and record each
row's (partition, position) as data by writing the frame to the shared
checkpoint folder.  Per-partition counts — one row per partition, a number
fixed by configuration, not by data — become offsets through a running sum and
are broadcast back.  Nothing is collected to the driver and no task sees more
than one range partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_POS_BITS = 33
_POS_MASK = (1 << _POS_BITS) - 1

# A measured set of at most this many rows may be numbered in one window task
# (a sort of a few hundred MB of short rows); a larger one takes the ranged path.
MAX_SINGLE_TASK_ROWS = 1_000_000
# Target size of one range partition when the input's size has been measured.
RANGE_PARTITION_BYTES = 128 * 1024 * 1024


def range_partitions(df: DataFrame, max_rows: int = MAX_SINGLE_TASK_ROWS) -> int:
    """Range partitions for ``df``: from its measured size when known (about
    ``RANGE_PARTITION_BYTES`` and at most ``max_rows`` rows per partition),
    else ``spark.sql.shuffle.partitions`` (sized by the cluster)."""
    rows = getattr(df, "_pitchside_rows", None)
    size = getattr(df, "_pitchside_bytes", None)
    if rows is None or size is None:
        return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-size // RANGE_PARTITION_BYTES), -(-rows // max_rows))


def _order(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _carry_size(staged: DataFrame, out: DataFrame) -> None:
    """Numbering keeps every row and adds one 8-byte id: carry the observed size."""
    out._pitchside_rows = staged._pitchside_rows
    size = getattr(staged, "_pitchside_bytes", None)
    out._pitchside_bytes = None if size is None else size + 8 * staged._pitchside_rows


def _default_materialize():
    from pitchside.plans.pipeline import materialize
    return materialize


def dense_ids(df: DataFrame, order_cols: Sequence[str | Column], id_col: str) -> DataFrame:
    """Ids by a global window (one task) — only for sets of a measured small size."""
    w = Window.orderBy(*_order(order_cols))
    return df.select(F.row_number().over(w).cast("bigint").alias(id_col), *df.columns)


def sequential_ids(df: DataFrame, order_cols: Sequence[str | Column], id_col: str, *,
                   num_partitions: int | None = None, materialize=None,
                   max_rows_per_partition: int = MAX_SINGLE_TASK_ROWS) -> DataFrame:
    """Ids 1..n in ``order_cols`` order without a single-task window.

    ``order_cols`` must be a total order (ties would make ids depend on the
    layout).  ``materialize(df, name) -> DataFrame`` persists the ranged layout
    reliably (default: write under ``spark.checkpoint.dir``).  The number of
    range partitions follows the frame's measured size when it is known
    (``range_partitions``), else ``spark.sql.shuffle.partitions``."""
    materialize = materialize or _default_materialize()
    n = num_partitions or range_partitions(df, max_rows_per_partition)
    ranged = (df.repartitionByRange(n, *_order(order_cols))
                .sortWithinPartitions(*_order(order_cols))
                .withColumn("_mid", F.monotonically_increasing_id()))
    staged = materialize(ranged, "ranged_ids")
    part = F.shiftright(F.col("_mid"), _POS_BITS)
    counts = staged.groupBy(part.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range partition; written once so every consumer reuses it
    offsets = materialize(
        counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")), "id_offsets")
    out = (staged.withColumn("_pid", part)
           .join(F.broadcast(offsets), "_pid")
           .withColumn(id_col, F.col("_base") + (F.col("_mid").bitwiseAND(F.lit(_POS_MASK))) + 1))
    out = out.select(id_col, *df.columns)
    _carry_size(staged, out)                        # every row keeps its partition's offset
    return out


def number_rows(df: DataFrame, order_cols: Sequence[str | Column], id_col: str, *,
                max_single_task_rows: int | None = None, materialize=None) -> DataFrame:
    """Ids 1..n in ``order_cols`` order (a total order), planned by measured size.

    ``df`` is written once to the shared checkpoint folder and its row count is
    observed during that write (no extra job); a set within
    ``max_single_task_rows`` is numbered by one window task, a larger one by
    ``sequential_ids``.  A frame whose row count is already known (written
    earlier, ``_pitchside_rows`` set) is not written again.  The bound
    defaults to ``spark.pitchside.maxSingleTaskRows``, else
    ``MAX_SINGLE_TASK_ROWS``."""
    from pitchside.plans.joins import session_bound

    if max_single_task_rows is None:
        max_single_task_rows = session_bound(df, "maxSingleTaskRows", MAX_SINGLE_TASK_ROWS)
    materialize = materialize or _default_materialize()
    staged = df if getattr(df, "_pitchside_rows", None) is not None else materialize(df, "to_number")
    if staged._pitchside_rows <= max_single_task_rows:
        out = dense_ids(staged, order_cols, id_col)
        _carry_size(staged, out)
        return out
    return sequential_ids(staged, order_cols, id_col, materialize=materialize,
                          max_rows_per_partition=max_single_task_rows)


def first_appearance_ids(df: DataFrame, keys: Sequence[str], pos_col: str, id_col: str,
                         *, extra_aggs: Sequence[Column] = (),
                         max_single_task_rows: int | None = None) -> DataFrame:
    """Distinct ``keys`` numbered by their first appearance (min ``pos_col``).

    The group-by is partial (map-side) so it scales with the input; the
    numbering sees one row per distinct key and is planned by the measured
    number of keys (see ``number_rows``).  ``pos_col`` must be unique per row,
    so first appearances are a total order."""
    g = df.groupBy(*keys).agg(F.min(pos_col).alias("_first"), *extra_aggs)
    ids = number_rows(g, ["_first"], id_col, max_single_task_rows=max_single_task_rows)
    return ids.select(id_col, *[c for c in g.columns if c != "_first"])
