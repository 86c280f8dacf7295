"""Enrichment: attach a monthly reading to each match, with a yearly fallback.

The readings side is aggregated first (one row per country × year × month, a
table bounded by the calendar and the number of countries, not by the number
of matches), so the join against the large matches side only ever ships that
small aggregate.  Whether it is broadcast is decided by
:func:`pitchside.plans.joins.lookup_join` after checking its size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchside.functions.labels import bin_label
from pitchside.functions.numeric import exact_mean

TEMP = "avg_temperature_celsius"
CAT = "temperature_category"


def prepare_readings(readings: DataFrame, *, grain: str = "month", closed: str = "right") -> DataFrame:
    """Mean reading per (country, year[, month]) plus its category.

    NULL keys are dropped first (a group-by on NULL keys has no counterpart on
    the matches side)."""
    if grain not in ("month", "year"):
        raise ValueError("grain must be 'month' or 'year'")
    month_col = "month_num" if "month_num" in readings.columns else "month"
    keys = ["country", "year"] + ([month_col] if grain == "month" else [])
    g = (readings.dropna(subset=keys)
         .groupBy(*keys).agg(exact_mean("temperature").alias(TEMP)))
    if grain == "month" and month_col != "month":
        g = g.withColumnRenamed(month_col, "month")
    return g.withColumn(CAT, bin_label(TEMP, closed=closed))


def yearly_from_monthly(cells: DataFrame) -> DataFrame:
    """Mean of the monthly means per (country, year) — the fallback lookup."""
    return (cells.groupBy("country", "year")
            .agg(exact_mean(TEMP).alias("_year_temp")))


def join_readings(matches: DataFrame, cells: DataFrame, *, fallback: bool = True,
                  yearly: DataFrame | None = None, join=None) -> DataFrame:
    """Left join on (country, year, month); unmatched rows fall back to the
    yearly mean, re-labelled with left-closed bins."""
    from pitchside.plans.joins import lookup_join

    join = join or lookup_join
    keys = ["country", "year", "month"] if "month" in cells.columns else ["country", "year"]
    out = join(matches, cells, keys)
    if not fallback or keys == ["country", "year"]:
        return out
    yearly = yearly if yearly is not None else yearly_from_monthly(cells)
    out = join(out, yearly, ["country", "year"])
    return (out.withColumns({
        CAT: F.when(F.col(TEMP).isNotNull(), F.col(CAT))
              .otherwise(bin_label("_year_temp", closed="left")),
        TEMP: F.coalesce(F.col(TEMP), F.col("_year_temp")),
    }).drop("_year_temp"))


def enrich(matches: DataFrame, readings: DataFrame, *, fallback: bool = True,
           grain: str = "month", join=None) -> DataFrame:
    """``matches_clean`` + ``readings_clean`` → enriched matches (lazy)."""
    cells = prepare_readings(readings, grain=grain)
    return join_readings(matches, cells, fallback=fallback, join=join)


def enrichment_report(enriched: DataFrame) -> DataFrame:
    """One row: totals, match rate and min / max / mean / median of the reading."""
    from pitchside.operators.quality import quantile_values

    t, middle = F.col(TEMP), quantile_values(enriched, [TEMP], (0.5,))[TEMP][0]
    total = F.count(F.lit(1))
    matched = F.count(t)
    return enriched.agg(
        total.alias("total_matches"),
        matched.alias("matches_with_temperature"),
        (total - matched).alias("matches_without_temperature"),
        F.when(total > 0, matched * F.lit(100.0).cast("double") / total)
         .otherwise(F.lit(0.0)).alias("match_rate_percent"),
        F.min(t).alias("temp_min"),
        F.max(t).alias("temp_max"),
        exact_mean(t).alias("temp_mean"),
        F.lit(middle).cast("double").alias("temp_median"),
    )


def category_distribution(enriched: DataFrame) -> DataFrame:
    return (enriched.where(F.col(CAT).isNotNull())
            .groupBy(CAT).agg(F.count(F.lit(1)).alias("count")))


def infer_column(df: DataFrame, candidates=("host_country", "location", "venue_country"),
                 name: str = "country") -> DataFrame:
    """Add ``name`` from the first existing candidate column (plan-time choice)."""
    if name in df.columns:
        return df
    for c in candidates:
        if c in df.columns:
            return df.withColumn(name, F.col(c))
    return df.withColumn(name, F.lit(None).cast("string"))
