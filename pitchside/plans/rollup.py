"""Stored partial aggregates: one small table that answers the reports by climate, place and month.

``build`` folds the fact to one row per year, date, place and climate with counts, sums and
extremes that can be added up again.  The table is stored by year: when the matches of some years are
loaded again, ``refresh`` replaces the state of those years and leaves the others as they are.  The
named queries below read the state and its dimensions; the fact is not touched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchside.functions import labels
from pitchside.plans import catalog
from pitchside.plans.catalog import Star, away_goals, away_won, category_rank, goals, goals_or_zero, home_goals, home_won, level_score, played
from pitchside.sources.io import replace_years

GRAIN = ["year", "date_id", "location_id", "temperature_id"]


def parts() -> dict[str, Column]:
    """What a group of matches contributes; every one is added up (``top_``: the largest is taken)."""
    home, away = F.coalesce(home_goals(), F.lit(0)), F.coalesce(away_goals(), F.lit(0))
    return {
        "n_rows": F.count(F.lit(1)), "n_ids": F.count("match_id"), "n_played": F.count_if(played()),
        "n_ids_played": F.count(F.when(played(), F.col("match_id"))),
        "n_home": F.count(home_goals()), "n_away": F.count(away_goals()),
        "sum_home": F.sum(home), "sum_away": F.sum(away), "sum_goals": F.sum(F.when(played(), goals())), "sum_any": F.sum(goals_or_zero()),
        "sum_gap": F.sum(home_goals() - away_goals()), "top_goals": F.max(goals()),
        "n_home_won": F.count_if(home_won()), "n_away_won": F.count_if(away_won()), "n_level": F.count_if(level_score()),
    }


def build(fact: DataFrame) -> DataFrame:
    return fact.groupBy(*GRAIN).agg(*[c.alias(n) for n, c in parts().items()])


def merge(state: DataFrame) -> DataFrame:
    """States of separate loads as one: rows of a group are added up."""
    return state.groupBy(*GRAIN).agg(*[(F.max(n) if n.startswith("top_") else F.sum(n)).alias(n) for n in parts()])


def refresh(fact: DataFrame, path: str, years: list[int] | None = None) -> str:
    """Write the state of ``fact`` under ``path``, or replace that of the given years only."""
    return replace_years(build(fact if years is None else fact.where(F.col("year").isin(years))), path, years)


class StateStar(Star):
    """The star with the stored state in the place of the fact."""

    def __init__(self, spark, path: str):
        super().__init__(spark)
        self.state = spark.read.parquet(path)

    def rows_of(self, name: str) -> DataFrame:
        return self.state if name == "fact_matches" else super().rows_of(name)


def _sum(c: str) -> Column:
    return F.sum(c)


def _mean(total: str | Column, n: str | Column, digits: int = 2) -> Column:
    whole = F.sum(n)
    return F.round(F.when(whole > 0, F.sum(total) / whole), digits)


def _celsius(n: str = "n_rows", digits: int = 2) -> Column:
    warm = F.col("celsius")
    return _mean(warm * F.col(n), F.when(warm.isNotNull(), F.col(n)), digits)


def _range(digits: int) -> dict[str, Column]:
    return {"min_temp": F.round(F.min("celsius"), digits), "max_temp": F.round(F.max("celsius"), digits)}


def _results() -> dict[str, Column]:
    return {"home_wins": _sum("n_home_won"), "away_wins": _sum("n_away_won"), "draws": _sum("n_level")}


def _share(part: str, whole: str) -> Column:
    return F.round(F.lit(100.0) * F.sum(part) / F.sum(whole), 2)


def _by(frame: DataFrame, key: Column | str, name: str, **measures: Column) -> DataFrame:
    return frame.groupBy((F.col(key) if isinstance(key, str) else key).alias(name)).agg(*[m.alias(n) for n, m in measures.items()])


def _categories(frame: DataFrame, **measures: Column) -> DataFrame:
    return _by(frame, "category", "temperature_category", **measures)


def _played(star: StateStar) -> DataFrame:
    return star.facts("climate").where("n_played > 0")


#: Named queries answered from the state, with the result of the query of that name in the catalog.
PLANS: dict[str, Callable[[StateStar], DataFrame]] = {
    "goals_by_temperature_category": lambda s: _categories(
        s.facts("climate").where("category IS NOT NULL"), match_count=_sum("n_ids"), avg_goals_per_match=_mean("sum_any", "n_rows"),
        **_range(2), avg_temp=_celsius()).orderBy(category_rank()),
    "home_advantage_by_temperature": lambda s: _categories(
        _played(s), total_matches=_sum("n_ids_played"), **_results(), home_win_percent=_share("n_home_won", "n_ids_played")).orderBy(category_rank()),
    "temperature_distribution": lambda s: _by(
        s.facts("climate").where("celsius IS NOT NULL"), labels.range_bucket(F.col("celsius")), "temp_range_start",
        match_count=_sum("n_ids"), avg_goals=_mean("sum_any", "n_rows")).orderBy("temp_range_start"),
    "seasonal_patterns": lambda s: s.facts("date", "climate?").groupBy(F.col("date_month").alias("month"), "month_name").agg(
        _sum("n_ids").alias("match_count"), _mean("sum_any", "n_rows").alias("avg_goals"), _celsius().alias("avg_temperature")).orderBy("month"),
    "goals_by_temperature_range": lambda s: _by(
        _played(s), labels.temperature_range_label(F.col("celsius")), "temperature_range", total_matches=_sum("n_ids_played"),
        avg_goals_per_match=_mean("sum_goals", "n_played"), **_range(1)).orderBy("min_temp"),
    "scoring_by_category": lambda s: _categories(
        s.facts("climate").where("category IS NOT NULL"), matches=_sum("n_rows"), avg_home_goals=_mean("sum_home", "n_home"),
        avg_away_goals=_mean("sum_away", "n_away"), avg_total_goals=_mean("sum_goals", "n_played"), highest_scoring_match=F.max("top_goals"),
        **_range(1), avg_temp=_celsius(digits=1)).orderBy(category_rank()),
    "home_advantage_detail": lambda s: _categories(
        _played(s), total_matches=_sum("n_played"), **_results(), home_win_percentage=_share("n_home_won", "n_played"),
        avg_goal_difference=_mean("sum_gap", "n_played")),
    "climate_zone_win_rates": lambda s: _by(
        s.facts("climate"), labels.climate_zone(F.col("celsius")), "climate_zone", total_matches=_sum("n_rows"),
        avg_goals=_mean("sum_goals", "n_played"), **_results()).orderBy(F.desc("total_matches"), "climate_zone"),
    "matches_by_category": lambda s: _categories(
        s.facts("climate"), match_count=_sum("n_rows"), avg_goals=_mean("sum_goals", "n_played"), **_range(1),
        avg_temp=_celsius(digits=1)).orderBy(category_rank()),
}
assert set(PLANS) <= set(catalog.PLANS)
