"""Star schema: four dimensions and one fact over the enriched matches.

Dimension grains follow the reference's contract: date, team name,
(city, country) and (country, year, month, reading, category).  Every
dimension is a distinct/group-by of the enriched rows (partial aggregates, so
hot keys fold map-side); its keys are numbered by ``number_rows``, which
measures the distinct set before choosing a one-task window or the ranged id
path.  The fact has exactly one row per enriched row (each dimension is unique
on its join key, so no join can fan out).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchside.functions.dates import day_name, month_name, weekday0, weekend_flag
from pitchside.functions.text import code_prefix, infer_group
from pitchside.operators.keys import first_appearance_ids, number_rows
from pitchside.plans.joins import lookup_join

TEMP = "avg_temperature_celsius"
CAT = "temperature_category"

DIM_DATE_COLUMNS = ("date_id", "full_date", "year", "month", "day", "quarter", "day_of_week",
                    "day_name", "month_name", "is_weekend")
FACT_COLUMNS = ("match_id", "date_id", "location_id", "home_team_id", "away_team_id",
                "temperature_id", "home_goals", "away_goals", "total_goals", "round", "year")


def date_attributes(c: str = "full_date") -> dict:
    d = F.col(c)
    return {
        "year": F.year(d), "month": F.month(d), "day": F.dayofmonth(d), "quarter": F.quarter(d),
        "day_of_week": weekday0(d), "day_name": day_name(d), "month_name": month_name(d),
        "is_weekend": weekend_flag(d),
    }


def dim_date(enriched: DataFrame) -> DataFrame:
    if "match_date" in enriched.columns:
        dates = enriched.select(F.col("match_date").alias("full_date")).where(
            F.col("full_date").isNotNull()).distinct()
    else:  # no date column: build one from year, month and day (1 where there is none)
        day = F.coalesce(F.col("day"), F.lit(1)) if "day" in enriched.columns else F.lit(1)
        dates = (enriched.select(F.concat_ws("-", "year", "month", day).try_cast("date").alias("full_date"))
                 .where(F.col("full_date").isNotNull()).distinct())
    ids = number_rows(dates, ["full_date"], "date_id")
    return ids.withColumns(date_attributes()).select(*DIM_DATE_COLUMNS)


def distinct_entities(df: DataFrame, cols=("home_team", "away_team"), name: str = "team_name") -> DataFrame:
    """Union of several columns as one distinct set, from one scan."""
    return (df.select(F.explode(F.array(*[F.col(c) for c in cols])).alias(name))
              .where(F.col(name).isNotNull()).distinct())


def dim_team(enriched: DataFrame) -> DataFrame:
    ids = number_rows(distinct_entities(enriched), ["team_name"], "team_id")
    return ids.select("team_id", "team_name", code_prefix("team_name").alias("team_code"),
                      infer_group("team_name").alias("confederation"))


def dim_location(enriched: DataFrame, pos_col: str = "match_id") -> DataFrame:
    """Distinct (city, country) by first appearance; stadium = first non-NULL
    stadium seen for that location (none when city or country is NULL)."""
    first_stadium = F.min_by("stadium", F.when(F.col("stadium").isNotNull(), F.col(pos_col)))
    loc = first_appearance_ids(enriched, ["city", "country"], pos_col, "location_id",
                               extra_aggs=[first_stadium.alias("stadium")])
    keyed = F.col("city").isNotNull() & F.col("country").isNotNull()
    return loc.select(
        "location_id", "city", "country",
        F.when(keyed, F.col("stadium")).alias("stadium"),
        F.lit(None).cast("double").alias("latitude"),
        F.lit(None).cast("double").alias("longitude"))


def dim_temperature(enriched: DataFrame, pos_col: str = "match_id") -> DataFrame:
    keys = ["country", "year", "month", TEMP, CAT]
    rows = enriched.where(F.col(TEMP).isNotNull())
    return first_appearance_ids(rows, keys, pos_col, "temperature_id").select(
        "temperature_id", *keys)


def attach_dates(f: DataFrame, dim_date: DataFrame, *, broadcast_dims: bool | None = None) -> DataFrame:
    """Add ``date_id``: by match date, else by (year, month), else by year (the first date of it)."""
    if "match_date" in f.columns:
        dates, keys = dim_date.select("date_id", F.col("full_date").alias("match_date")), ["match_date"]
    else:
        keys = [c for c in ("year", "month") if c in f.columns]
        if not keys:
            return f.withColumn("date_id", F.lit(None).cast("long"))
        dates = dim_date.groupBy(*keys).agg(F.min("date_id").alias("date_id"))
    return lookup_join(f, dates, keys, checked=broadcast_dims)


def measure_columns(columns: list[str]) -> list[str]:
    """Measures that pass through beside the fixed ones: goal and score columns, attendance, stage."""
    own = {"attendance", "stage"}
    return [c for c in columns if c not in FACT_COLUMNS and (c in own or "goal" in c.lower() or "score" in c.lower())]


def fact_matches(enriched: DataFrame, dims: dict[str, DataFrame], *, broadcast_dims: bool | None = None) -> DataFrame:
    """Fact rows = enriched rows (which must carry ``match_id``).

    Dates fall back to (year, month) or year, and the place to city or country alone, where a
    source lacks the other.  ``broadcast_dims`` True when the caller verified the dimension sizes."""
    f = attach_dates(enriched, dims["dim_date"], broadcast_dims=broadcast_dims)
    place = [c for c in ("city", "country") if c in f.columns]
    if place:
        dl = dims["dim_location"].groupBy(*place).agg(F.min("location_id").alias("location_id")) if len(place) == 1 \
            else dims["dim_location"].select("location_id", *place)
        f = lookup_join(f, dl, place, null_safe=True, checked=broadcast_dims)
    else:
        f = f.withColumn("location_id", F.lit(None).cast("long"))
    team = dims["dim_team"]
    for side in ("home", "away"):
        f = lookup_join(f, team.select(F.col("team_id").alias(f"{side}_team_id"), F.col("team_name").alias(f"{side}_team")),
                        [f"{side}_team"], checked=broadcast_dims)
    # one temperature row per (country, year, month): the lowest id wins
    dt = (dims["dim_temperature"].groupBy("country", "year", "month")
          .agg(F.min("temperature_id").alias("temperature_id")))
    keys = ["country", "year", "month"]
    if all(k in f.columns for k in keys):
        f = lookup_join(f, dt, keys, checked=broadcast_dims)
    else:
        f = f.withColumn("temperature_id", F.lit(None).cast("long"))
    fixed = [F.col(c) if c in f.columns else F.lit(None).cast("string" if c == "round" else "int").alias(c) for c in FACT_COLUMNS]
    return f.select(*fixed, *measure_columns(enriched.columns))


DIMENSION_BUILDERS = {
    "dim_date": dim_date,
    "dim_team": dim_team,
    "dim_location": dim_location,
    "dim_temperature": dim_temperature,
}


def build_dimensions(enriched: DataFrame) -> dict[str, DataFrame]:
    return {name: build(enriched) for name, build in DIMENSION_BUILDERS.items()}


def star_stats(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, records, columns) for each table, as one small frame."""
    parts = [df.agg(F.count(F.lit(1)).alias("records"))
               .select(F.lit(name).alias("table_name"), "records",
                       F.lit(len(df.columns)).alias("columns"))
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
