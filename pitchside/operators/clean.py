"""Cleaning: renames, tolerant parsing, filters, derived columns, keep-first dedup.

All steps are one lazy plan.  The only shuffle is the keep-first dedup, written
as a partial aggregate so that even a key holding a third of all rows is folded
map-side before it moves.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pitchside.functions.dates import date_parts, parse_date, parse_date_typed
from pitchside.functions.labels import outcome_label, winner_label
from pitchside.functions.numeric import coerce_double, coerce_int
from pitchside.operators.whole_rows import distinct_rows
from pitchside.functions.text import COUNTRY_ALIASES, TEAM_ALIASES, alias_exact, alias_regex, strip_ws

# Source column names → standard names.
MATCH_RENAMES: dict[str, str] = {
    "Year": "year", "Date": "date", "Time": "time", "Round": "round", "Stadium": "stadium",
    "City": "city", "Country": "country", "HomeTeam": "home_team", "HomeGoals": "home_goals",
    "AwayGoals": "away_goals", "AwayTeam": "away_team", "Observation": "observation",
}
READING_RENAMES: dict[str, str] = {
    "Entity": "country", "Code": "country_code", "Month": "month", "Monthly average": "temperature",
}
YEARS = (1930, 2014)
TEMPERATURE_BOUNDS = (-50.0, 60.0)
MATCH_KEY = ("match_date", "home_team", "away_team")
READING_KEY = ("country", "date")
ORDER_COL = "src_pos"


def with_source_order(df: DataFrame, order_col: str = ORDER_COL) -> DataFrame:
    """Ensure a source-order column exists.

    Inputs that carry their own order (a line number, a file offset) keep it.  Otherwise rows
    are ordered by a digest of their content: an arbitrary order, but the same however the
    input is split into files and tasks (rows that tie are equal, so any of them may be kept)."""
    if order_col in df.columns:
        return df
    content = F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns)]), {"ignoreNullFields": "false"})
    return df.withColumn(order_col, F.sha2(content.cast("binary"), 256))


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename only the columns that exist."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def filter_year_range(df: DataFrame, years: tuple[int, int] = YEARS, col: str = "year") -> DataFrame:
    return df.where(F.col(col).between(years[0], years[1]))


def filter_value_range(df: DataFrame, col: str, bounds: tuple[float, float]) -> DataFrame:
    c = F.col(col)
    return df.where(c.isNotNull() & ~F.isnan(c) & c.between(bounds[0], bounds[1]))


def drop_null_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def dedup_by_key(df: DataFrame, keys: Sequence[str], order_col: str = ORDER_COL) -> DataFrame:
    """Keep the first row (smallest ``order_col``) of every key; NULL keys group together.

    ``min_by`` is an ordinary aggregate, so Spark computes it partially on the
    map side: a hot key is reduced to one row per input partition before the
    shuffle, never gathered in one task."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    winner = F.min_by(F.struct(*[F.col(c) for c in rest]), F.col(order_col)).alias("_first")
    return (df.groupBy(*keys).agg(winner)
              .select(*[F.col(k) for k in keys], *[F.col(f"_first.{c}").alias(c) for c in rest])
              .select(*df.columns))


def dedup_full_row(df: DataFrame) -> DataFrame:
    """One of each group of equal rows.

    A stored table is read more than once and only its digests and the rows of repeated digests are shuffled.  Anything
    else would run as often as it is read: its rows are folded in the tasks that make them and shuffled once."""
    return distinct_rows(df) if hasattr(df, "_pitchside_rows") else df.dropDuplicates()


def derive_match_columns(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "total_goals": F.col("home_goals") + F.col("away_goals"),
        "winner": winner_label("home_goals", "away_goals", "home_team", "away_team"),
        "outcome": outcome_label("home_goals", "away_goals"),
    })


class RejectLog:
    """Counts of the rows that each cleaning rule drops, taken while the cleaned table is written.

    The rules are observed where they apply, inside the plan that cleans, so the source is scanned and parsed once.
    The counts are those of the write: should a lost executor make Spark run a part of the scan again, that part is
    counted again, and ``reject_counts`` gives the numbers of a fresh pass."""

    def __init__(self, recount=None):
        self._seen = Observation(f"rejects_{uuid.uuid4().hex[:8]}")
        self._rules: list[str] = []
        self._recount = recount

    def watch(self, df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
        """``df`` with the number of its rows and of those that each rule (a condition) drops observed."""
        self._rules = ["input", *rules]
        return df.observe(self._seen, F.count(F.lit(1)).alias("input"), *[F.count_if(c).alias(n) for n, c in rules.items()])

    def counts(self, written: DataFrame) -> dict[str, int]:
        """Rows by rule, once the cleaned table is ``written`` (by ``pipeline.materialize``, which counts its rows)."""
        kept = written._pitchside_rows
        if not kept and self._recount is not None:
            # a plan without rows may be cut together with its counters: count by a pass
            return {r["rule"]: r["rows"] for r in self._recount().collect()}
        found = {r: self._seen.get[r] for r in self._rules}
        found["duplicate_key"] = found["input"] - sum(found[r] for r in self._rules[1:]) - kept
        return found | {"output": kept}

    def frame(self, written: DataFrame) -> DataFrame:
        return written.sparkSession.createDataFrame(list(self.counts(written).items()), "rule string, rows long")


def clean_and_count(raw: DataFrame, clean=None, **options) -> tuple[DataFrame, DataFrame]:
    """The cleaned table, written once, and the rows that each rule dropped on the way."""
    from pitchside.plans.pipeline import materialize

    clean = clean or clean_matches
    count = reject_counts if clean is clean_matches else reject_counts_readings
    log = RejectLog(lambda: count(raw, **options))
    written = materialize(clean(raw, rejects=log, **options), "cleaned")
    return written, log.frame(written)


#: Derived from the kept row, after the dedup: they are not sorted and shuffled with it.
DERIVED = ("month", "quarter", "day", "day_of_week", "day_name", "total_goals", "winner", "outcome")
MATCH_COLUMNS = ("year", "date", "time", "round", "stadium", "city", "country", "home_team",
                 "home_goals", "away_goals", "away_team", "observation", "match_date", "month",
                 "quarter", "day", "day_of_week", "day_name", "total_goals", "winner", "outcome")


def clean_matches(raw: DataFrame, *, years: tuple[int, int] = YEARS,
                  aliases: Sequence[tuple[str, str]] = TEAM_ALIASES,
                  order_col: str = ORDER_COL, dedup: bool = True, rejects: RejectLog | None = None) -> DataFrame:
    """Raw results → ``matches_clean`` (one lazy plan); ``rejects`` counts what each rule drops."""
    df = rename_columns(with_source_order(raw, order_col), MATCH_RENAMES)
    df = df.withColumn("match_date", parse_date_typed(df, "date"))
    parts = date_parts("match_date")
    df = df.withColumn("year", parts["year"])
    if rejects is not None:
        dated = F.col("match_date").isNotNull()
        df = rejects.watch(df, {"bad_date": ~dated, "out_of_years": dated & ~F.col("year").between(years[0], years[1])})
    df = df.where(F.col("match_date").isNotNull())
    df = filter_year_range(df, years)
    fixes: dict[str, Column] = {}
    for team in ("home_team", "away_team"):
        if team in df.columns:
            fixes[team] = alias_regex(strip_ws(team), aliases)
    for goals in ("home_goals", "away_goals"):
        if goals in df.columns:
            fixes[goals] = coerce_int(goals, 0)
    for loc in ("city", "country", "stadium"):
        if loc in df.columns:
            fixes[loc] = strip_ws(loc)
    df = df.withColumns(fixes)
    own = [c for c in MATCH_COLUMNS if c not in DERIVED]
    df = df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in own], order_col)
    if dedup:
        df = dedup_by_key(df, MATCH_KEY, order_col)
    df = derive_match_columns(df.withColumns({c: v for c, v in parts.items() if c in DERIVED}))
    return df.select(*MATCH_COLUMNS, order_col)


READING_COLUMNS = ("country", "country_code", "month", "temperature", "date", "year",
                   "month_num", "quarter")


def clean_readings(raw: DataFrame, *, bounds: tuple[float, float] = TEMPERATURE_BOUNDS,
                   years: tuple[int, int] = YEARS, aliases: Mapping[str, str] = COUNTRY_ALIASES,
                   order_col: str = ORDER_COL, dedup: bool = True, rejects: RejectLog | None = None) -> DataFrame:
    """Raw monthly readings → ``readings_clean`` (one lazy plan); ``rejects`` counts what each rule drops."""
    df = rename_columns(with_source_order(raw, order_col), READING_RENAMES)
    df = df.withColumn("date", parse_date(F.col("month").cast("string")))
    df = df.withColumns({"year": F.year("date"), "month_num": F.month("date"),
                         "quarter": F.quarter("date")})
    df = df.withColumn("temperature", coerce_double("temperature"))
    if rejects is not None:
        t, dated = F.col("temperature"), F.col("date").isNotNull()
        known = dated & t.isNotNull() & ~F.isnan(t)
        inside = known & t.between(bounds[0], bounds[1])
        df = rejects.watch(df, {"bad_date": ~dated, "no_value": dated & ~known, "out_of_range": known & ~inside,
                                "out_of_years": inside & ~F.col("year").between(years[0], years[1])})
    df = df.where(F.col("date").isNotNull())
    df = filter_value_range(df, "temperature", bounds)
    df = df.withColumn("country", alias_exact(strip_ws("country"), aliases))
    df = filter_year_range(df, years)
    if "country_code" not in df.columns:
        df = df.withColumn("country_code", F.lit(None).cast("string"))
    df = df.select(*READING_COLUMNS, order_col)
    return dedup_by_key(df, READING_KEY, order_col) if dedup else df


def _as_rules(agg: DataFrame, rules: Sequence[str]) -> DataFrame:
    return agg.select(F.explode(F.array(*[
        F.struct(F.lit(r).alias("rule"), F.col(r).cast("bigint").alias("rows")) for r in rules])).alias("r")).select("r.*")


def reject_counts_readings(raw_readings: DataFrame, *, bounds: tuple[float, float] = TEMPERATURE_BOUNDS,
                           years: tuple[int, int] = YEARS, aliases: Mapping[str, str] = COUNTRY_ALIASES) -> DataFrame:
    """Rows that each cleaning rule drops from the readings, in the order in which the rules apply."""
    df = rename_columns(raw_readings, READING_RENAMES)
    d, t = parse_date(F.col("month").cast("string")), coerce_double("temperature")
    valued = d.isNotNull() & t.isNotNull()
    inside = valued & t.between(bounds[0], bounds[1])
    kept = inside & F.year(d).between(years[0], years[1])
    key = F.struct(alias_exact(strip_ws("country"), aliases), d)
    agg = df.agg(F.count(F.lit(1)).alias("input"), F.count_if(d.isNull()).alias("bad_date"),
                 F.count_if(d.isNotNull() & t.isNull()).alias("no_value"), F.count_if(valued & ~inside).alias("out_of_range"),
                 F.count_if(inside & ~kept).alias("out_of_years"), F.count_if(kept).alias("_kept"),
                 F.count_distinct(F.when(kept, key)).alias("output"))
    return _as_rules(agg.withColumn("duplicate_key", F.col("_kept") - F.col("output")),
                     ("input", "bad_date", "no_value", "out_of_range", "out_of_years", "duplicate_key", "output"))


def reject_counts(raw_matches: DataFrame, *, years: tuple[int, int] = YEARS,
                  aliases: Sequence[tuple[str, str]] = TEAM_ALIASES) -> DataFrame:
    """Rows dropped per cleaning rule, in one aggregation pass plus the key count.

    Returns (rule, rows) for: input, bad_date, out_of_years, duplicate_key, output."""
    df = rename_columns(raw_matches, MATCH_RENAMES)
    d = parse_date_typed(df, "date")
    y = F.year(d)
    kept = d.isNotNull() & y.between(years[0], years[1])
    key = F.struct(d, alias_regex(strip_ws("home_team"), aliases), alias_regex(strip_ws("away_team"), aliases))
    agg = df.agg(
        F.count(F.lit(1)).alias("input"),
        F.count_if(d.isNull()).alias("bad_date"),
        F.count_if(d.isNotNull() & ~y.between(years[0], years[1])).alias("out_of_years"),
        F.count_if(kept).alias("_kept"),
        F.count_distinct(F.when(kept, key)).alias("output"),
    )
    agg = agg.withColumn("duplicate_key", F.col("_kept") - F.col("output"))
    return _as_rules(agg, ("input", "bad_date", "out_of_years", "duplicate_key", "output"))
