"""Quantiles from mergeable sketches, one state for each file of a table.

Exact quantiles (``quality.quantile_values``) read the table again whenever it grows.  A sketch state
is kept beside the table instead: for each file and numeric column a KLL sketch with the count,
smallest and largest value.  New files are sketched by themselves, states are merged, and the
quantiles of the whole table follow from the merged states without reading a row.  The answers are
approximate: a value's rank is off by ``rank_error`` of the rows at most, with about 99 % confidence.
Exact quantiles stay the default of all reports.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size parameter of a sketch and the share of rows by which a rank may be off with it.
SKETCH_K, RANK_ERROR = 800, 0.005
STATE_SCHEMA = "file string, column_name string, n long, low double, high double, sketch binary"


def _values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    one = lambda c: F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("double").alias("v"))
    opened = df.select(F.input_file_name().alias("file"), F.explode(F.array(*map(one, cols))).alias("e"))
    return opened.select("file", "e.*").where("v IS NOT NULL AND NOT isnan(v)")


def file_states(df: DataFrame, cols: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    """One state a file and column; a task folds its values before the shuffle, so only sketches move."""
    return _values(df, cols).groupBy("file", "column_name").agg(
        F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"), F.kll_sketch_agg_double("v", k).alias("sketch"))


def refresh_states(df: DataFrame, cols: Sequence[str], path: str, k: int = SKETCH_K) -> DataFrame:
    """The states stored at ``path``, after adding those of files of ``df`` that have none yet; other files are not read."""
    spark = df.sparkSession
    spark.createDataFrame([], STATE_SCHEMA).write.mode("append").parquet(path)
    done = {r["file"] for r in spark.read.schema(STATE_SCHEMA).parquet(path).select("file").distinct().collect()}  # file names only
    new = [f for f in df.inputFiles() if f not in done]
    if new:
        file_states(spark.read.schema(df.schema).parquet(*new), cols, k).write.mode("append").parquet(path)
    return spark.read.schema(STATE_SCHEMA).parquet(path)


def merged(states: DataFrame) -> DataFrame:
    """States of all files as one a column."""
    return states.groupBy("column_name").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.kll_merge_agg_double("sketch").alias("sketch"))


def quantiles(states: DataFrame, probs: Sequence[float]) -> DataFrame:
    """column_name, prob, n, value: approximate quantiles of the whole table."""
    def value(p: float) -> Column:
        return F.col("low") if p <= 0 else F.col("high") if p >= 1 else F.kll_sketch_get_quantile_double("sketch", F.lit(p))

    cells = F.array(*[F.struct(F.lit(p).alias("prob"), value(p).alias("value")) for p in map(float, probs)])
    return merged(states).select("column_name", "n", F.explode(cells).alias("q")).select("column_name", "q.prob", "n", "q.value")


def rank_errors(df: DataFrame, estimates: DataFrame) -> DataFrame:
    """``estimates`` with ``rank_error``: how far, as a share of the rows, each value lies from its rank in ``df``."""
    rows = estimates.collect()  # columns times quantiles
    counts = df.agg(*[c.alias(f"{name}_{i}") for i, r in enumerate(rows) for name, c in (
        ("lt", F.count_if(F.col(f"`{r['column_name']}`") < r["value"])), ("le", F.count_if(F.col(f"`{r['column_name']}`") <= r["value"])))]).first()
    found = []
    for i, r in enumerate(rows):
        below, upto = counts[f"lt_{i}"] / r["n"], counts[f"le_{i}"] / r["n"]
        found.append((r["column_name"], r["prob"], r["value"], max(0.0, below - r["prob"], r["prob"] - upto)))
    return df.sparkSession.createDataFrame(found, "column_name string, prob double, value double, rank_error double")
