"""Explicit schemas: raw sources (the reference's own column names) and the star."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType, DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
    TimestampNTZType,
)


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


S, I, L, D, DT = StringType(), IntegerType(), LongType(), DoubleType(), DateType()

RAW_MATCHES = _s(("Year", I), ("Date", S), ("Time", S), ("Round", S), ("Stadium", S), ("City", S),
                 ("Country", S), ("HomeTeam", S), ("HomeGoals", S), ("AwayGoals", S),
                 ("AwayTeam", S), ("Observation", S))
RAW_READINGS = _s(("Entity", S), ("Code", S), ("Month", S), ("Monthly average", D))

MATCH_ORDER_FIELDS = _s(("l_orderkey", L), ("l_linenumber", I), ("l_partkey", L), ("l_suppkey", L),
                        ("l_quantity", D), ("l_extendedprice", D))

FACT_MATCHES = _s(("match_id", L), ("date_id", L), ("location_id", L), ("home_team_id", L),
                  ("away_team_id", L), ("temperature_id", L), ("home_goals", I), ("away_goals", I),
                  ("total_goals", I), ("round", S), ("year", I))
DIM_DATE = _s(("date_id", L), ("full_date", DT), ("year", I), ("month", I), ("day", I), ("quarter", I),
              ("day_of_week", I), ("day_name", S), ("month_name", S), ("is_weekend", I))
DIM_TEAM = _s(("team_id", L), ("team_name", S), ("team_code", S), ("confederation", S))
DIM_LOCATION = _s(("location_id", L), ("city", S), ("country", S), ("stadium", S), ("latitude", D),
                  ("longitude", D))
DIM_TEMPERATURE = _s(("temperature_id", L), ("country", S), ("year", I), ("month", I),
                     ("avg_temperature_celsius", D), ("temperature_category", S))

STAR = {"fact_matches": FACT_MATCHES, "dim_date": DIM_DATE, "dim_team": DIM_TEAM,
        "dim_location": DIM_LOCATION, "dim_temperature": DIM_TEMPERATURE}

# primary keys and foreign keys of the star (the DDL's constraints)
PRIMARY_KEYS = {"fact_matches": "match_id", "dim_date": "date_id", "dim_team": "team_id",
                "dim_location": "location_id", "dim_temperature": "temperature_id"}
FOREIGN_KEYS = (("date_id", "dim_date", "date_id"), ("location_id", "dim_location", "location_id"),
                ("home_team_id", "dim_team", "team_id"), ("away_team_id", "dim_team", "team_id"),
                ("temperature_id", "dim_temperature", "temperature_id"))

BOOL = BooleanType()

# The driver's base tables (only the ones the pipeline reads).  Reading with a
# schema skips Parquet footer inference (one Spark job per read).
NTZ = TimestampNTZType()
SOURCE_TABLES = {
    "lineitem": _s(("l_orderkey", L), ("l_partkey", L), ("l_suppkey", L), ("l_linenumber", I),
                   ("l_quantity", D), ("l_extendedprice", D), ("l_discount", D), ("l_tax", D),
                   ("l_returnflag", S), ("l_linestatus", S), ("l_shipdate", NTZ)),
    "orders": _s(("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S), ("o_totalprice", D),
                 ("o_orderdate", NTZ), ("o_orderpriority", S)),
    "customer": _s(("c_custkey", L), ("c_name", S), ("c_nationkey", I), ("c_acctbal", D),
                   ("c_mktsegment", S)),
    "supplier": _s(("s_suppkey", L), ("s_name", S), ("s_nationkey", I), ("s_acctbal", D)),
    "nation": _s(("n_nationkey", I), ("n_name", S), ("n_regionkey", I)),
    "region": _s(("r_regionkey", I), ("r_name", S)),
}
