"""Operator-level keys: one Spark callable and one DuckDB oracle each.

Spark frames carry the source order as ``src_pos``; outputs flatten it to
``k1 … k6`` (the names the oracle chain uses) where row identity matters.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pitchside import schemas
from pitchside.functions import (
    alias_exact, alias_regex, code_prefix, coerce_int, date_parts, day_name, infer_group,
    month_name, null_default, parse_date, strip_ws, title_case, weekday0, weekend_flag,
)
from pitchside.functions.labels import bin_label
from pitchside.operators import clean as C
from pitchside.operators import enrich as E
from pitchside.operators import quality as Q
from pitchside.operators import star as ST
from pitchside.operators.keys import number_rows, sequential_ids
from pitchside.operators import insights as INS
from pitchside.plans import catalog, catalog_oracle
from pitchside.plans.oracle import alias_exact_sql, alias_regex_sql, bin_sql, coerce_int_sql, \
    confederation_case, mean_sql, spark_round, star_query, strip, with_chain
from pitchside.plans.pipeline import STAR_TABLES, star_session
from pitchside.plans.joins import can_broadcast
from pitchside.plans.registry import register
from pitchside.session import scratch_path
from pitchside.sources import io
from pitchside.sources.fixtures import matches_raw, readings_raw, table

K6 = ["k1", "k2", "k3", "k4", "k5", "k6"]
MATCH_FIELDS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]

# Test alias maps over the fixture's NATION_* names (the reference's own maps
# name real countries and are exercised by the unit tests).
TEST_TEAM_ALIASES = (("NATION_1", "NATION_ONE_"), ("ONE_0", "TEN"))
TEST_COUNTRY_ALIASES = {"NATION_3": "NATION_THREE", "NATION_1": "NATION_ONE"}
NARROW_YEARS = (1996, 1998)


def W(query: str, *, dirty: bool = False, star: bool = False) -> str:
    return spark_round(with_chain(query, dirty=dirty, star=star))


def flat_m(df: DataFrame) -> DataFrame:
    """src_pos(struct of 6) → k1 … k6."""
    rest = [c for c in df.columns if c != "src_pos"]
    return df.select(*rest, *[F.col(f"src_pos.{f}").alias(k) for f, k in zip(MATCH_FIELDS, K6)])


def flat_r(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c != "src_pos"]
    return df.select(*rest, F.col("src_pos.o_orderkey").alias("k1"))


def clean_m(spark, sf, **kw) -> DataFrame:
    return C.clean_matches(matches_raw(spark, sf), **kw)


def clean_r(spark, sf, **kw) -> DataFrame:
    return C.clean_readings(readings_raw(spark, sf), **kw)


def cells(spark, sf) -> DataFrame:
    return E.prepare_readings(clean_r(spark, sf))


def star(spark, sf) -> dict[str, DataFrame]:
    return star_session(spark, sf)


def star_tables(spark, sf) -> dict[str, DataFrame]:
    t = star(spark, sf)
    return {n: t[n] for n in STAR_TABLES}


RAW_COLS = [f.name for f in schemas.RAW_MATCHES.fields]
RAW_SQL_COLS = ", ".join(f'"{c}"' for c in RAW_COLS)
CLEAN_COLS = list(C.MATCH_COLUMNS)
CLEAN_SQL_COLS = ", ".join(CLEAN_COLS)
READ_COLS = list(C.READING_COLUMNS)
READ_SQL_COLS = ", ".join(READ_COLS)

# =================================================================== sources / sinks


@register("scan_csv_roundtrip", W(f"SELECT {RAW_SQL_COLS}, {', '.join(K6)} FROM m_raw", dirty=True))
def scan_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    df = flat_m(matches_raw(spark, sf, dirty=True))
    path = scratch_path(spark, "csv_roundtrip") + ".csv"
    io.write_table(df, path, "csv")
    schema = StructType(list(schemas.RAW_MATCHES.fields))
    for f in schemas.MATCH_ORDER_FIELDS.fields:
        schema = schema.add(K6[MATCH_FIELDS.index(f.name)], f.dataType)
    return io.read_table(spark, path, schema)


@register("scan_parquet", W("""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date, o_totalprice
FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000"""))
def scan_parquet(spark: SparkSession, sf: str) -> DataFrame:
    # projection and both predicates reach the Parquet scan (ReadSchema / PushedFilters)
    o = table(spark, sf, "orders")
    return (o.where((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100000))
             .select("o_orderkey", F.to_date("o_orderdate").alias("order_date"), "o_totalprice"))


@register("scan_json_roundtrip", W('SELECT "Entity", "Code", "Month", "Monthly average", k1 FROM r_raw', dirty=True))
def scan_json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    df = flat_r(readings_raw(spark, sf, dirty=True))
    path = scratch_path(spark, "json_roundtrip") + ".json"
    io.write_table(df, path, "json")
    return io.read_table(spark, path, StructType(list(schemas.RAW_READINGS.fields)).add("k1", schemas.L))


@register("read_auto_format", W("SELECT c_custkey, c_nationkey, c_mktsegment FROM customer"))
def read_auto_format(spark: SparkSession, sf: str) -> DataFrame:
    return io.read_table(spark, f"{sf.rstrip('/')}/customer.parquet").select(
        "c_custkey", "c_nationkey", "c_mktsegment")


_STAR_COUNTS_SQL = " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, COUNT(*) AS records, {len(schemas.STAR[n].fields)} AS columns FROM {n}"
    for n in STAR_TABLES)


@register("load_star_tables", W(_STAR_COUNTS_SQL, star=True))
def load_star_tables(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_path(spark, "star_files")
    io.save_tables(star_tables(spark, sf), base)
    loaded = io.load_tables(spark, base, register=False)
    return ST.star_stats({n: loaded[n] for n in STAR_TABLES})


@register("star_row_counts", W(_STAR_COUNTS_SQL, star=True))
def star_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    return ST.star_stats(star_tables(spark, sf))


@register("write_parquet_roundtrip", W("SELECT * FROM fact_matches", star=True))
def write_parquet_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "parquet_roundtrip") + ".parquet"
    io.write_table(star(spark, sf)["fact_matches"], path)
    return spark.read.parquet(path)


@register("write_auto_format", W("SELECT * FROM dim_location", star=True))
def write_auto_format(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "auto_format") + ".csv"
    io.write_table(star(spark, sf)["dim_location"], path)          # csv by suffix
    return io.read_table(spark, path, schemas.DIM_LOCATION)


@register("write_csv_results", star_query(catalog_oracle.TEXTS["goals_by_temperature_category"]))
def write_csv_results(spark: SparkSession, sf: str) -> DataFrame:
    star(spark, sf)
    out = scratch_path(spark, "analytics_results")
    name = "goals_by_temperature_category"
    paths = catalog.QueryCatalog(spark).save_csv([name], out)
    return io.read_table(spark, paths[name],
                         "temperature_category string, match_count bigint, avg_goals_per_match double, "
                         "min_temp double, max_temp double, avg_temp double")


def _completeness_sql() -> str:
    parts = []
    for name, st in schemas.STAR.items():
        cols = [f.name for f in st.fields]
        miss = " + ".join(f"COUNT_IF({c} IS NULL)" for c in cols)
        k = len(cols)
        parts.append(
            f"SELECT '{name}' AS table_name, COUNT(*) AS total_records, {k} AS total_columns, "
            f"CAST({miss} AS BIGINT) AS missing_cells, "
            f"CASE WHEN COUNT(*) * {k} > 0 THEN ROUND((COUNT(*) * {k} - ({miss})) * 100e0 / (COUNT(*) * {k}), 2) "
            f"ELSE 0e0 END AS overall_completeness_percent FROM {name}")
    return " UNION ALL ".join(parts)


@register("write_json_report", W(_completeness_sql(), star=True))
def write_json_report(spark: SparkSession, sf: str) -> DataFrame:
    report = Q.completeness(star_tables(spark, sf))
    path = scratch_path(spark, "readiness_report") + ".json"
    io.write_table(report, path, "json")
    return io.read_table(spark, path, report.schema)


@register("save_as_table_roundtrip", W("SELECT * FROM dim_team", star=True))
def save_as_table_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_path(spark, "warehouse")
    database = "gold_" + base.rsplit("/", 1)[1]           # a name of its own for each run
    spark.sql(f"CREATE DATABASE {database} LOCATION '{base}/_db'")
    io.save_tables({"dim_team": star(spark, sf)["dim_team"]}, base, database=database)
    return spark.table(f"{database}.dim_team")


def _contract_sql(table: str = "m_raw", broken: bool = False) -> str:
    rows = []
    for f in schemas.RAW_MATCHES.fields:
        want = f.dataType.simpleString()
        gone = broken and f.name == "Round"
        have = "NULL" if gone else "'bigint'" if broken and f.name == "Year" else "'int'" if f.name == "Year" else "'string'"
        rows.append(f"SELECT 'matches' AS source, '{f.name}' AS column_name, '{want}' AS expected_type, {have} AS actual_type, "
                    f"{not gone} AS present, coalesce({have} = '{want}', FALSE) AS type_ok, {'0 * COUNT(*)' if gone else f'COUNT({chr(34)}{f.name}{chr(34)})'} AS values FROM {table}")
    rows.append(f"SELECT 'matches', '<rows>', 'non-empty', CASE WHEN COUNT(*) > 0 THEN 'non-empty' ELSE 'empty' END, "
                f"COUNT(*) > 0, COUNT(*) > 0, COUNT(*) FROM {table}")
    return " UNION ALL ".join(rows)


@register("source_contract", W(_contract_sql(), dirty=True))
def source_contract(spark: SparkSession, sf: str) -> DataFrame:
    raw = matches_raw(spark, sf, dirty=True).drop("src_pos")
    return io.source_contract(raw, schemas.RAW_MATCHES, "matches")


@register("source_contract_broken", W(_contract_sql(broken=True)))
def source_contract_broken(spark: SparkSession, sf: str) -> DataFrame:
    """All raw matches without one column, and with another type for one."""
    raw = matches_raw(spark, sf).drop("src_pos", "Round").withColumn("Year", F.col("Year").cast("long"))
    return io.source_contract(raw, schemas.RAW_MATCHES, "matches")


@register("partitioned_by_year", W("SELECT * FROM fact_matches WHERE year = 1998", star=True))
def partitioned_by_year(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "fact_by_year")
    # rows of a year meet in a few tasks first, else every task would write a file per year
    fact = star(spark, sf)["fact_matches"].repartition("year", F.pmod(F.xxhash64("match_id"), F.lit(4)))
    io.write_table(fact, path, "parquet", partition_by=["year"])
    # the year predicate prunes partitions: only year=1998 files are listed
    df = spark.read.parquet(path).where(F.col("year") == 1998)
    return df.select(*[f.name for f in schemas.FACT_MATCHES.fields])


# =================================================================== projections


@register("rename_columns", W("""SELECT "Year" AS year, "Date" AS date, "Time" AS time, "Round" AS round,
 "Stadium" AS stadium, "City" AS city, "Country" AS country, "HomeTeam" AS home_team,
 "HomeGoals" AS home_goals, "AwayGoals" AS away_goals, "AwayTeam" AS away_team,
 "Observation" AS observation, k1, k2, k3, k4, k5, k6 FROM m_raw"""))
def rename_columns(spark: SparkSession, sf: str) -> DataFrame:
    # names absent from the source are ignored
    return flat_m(C.rename_columns(matches_raw(spark, sf), {**C.MATCH_RENAMES, "Absent": "absent"}))


@register("parse_dates", W("""SELECT "Date" AS date_raw, try_cast("Date" AS DATE) AS match_date, k1, k2, k3, k4, k5, k6
FROM m_raw""", dirty=True))
def parse_dates(spark: SparkSession, sf: str) -> DataFrame:
    raw = flat_m(matches_raw(spark, sf, dirty=True))
    return raw.select(F.col("Date").alias("date_raw"), parse_date("Date").alias("match_date"), *K6)


_DATES_SQL = "(SELECT DISTINCT try_cast(\"Date\" AS DATE) AS d FROM m_raw WHERE try_cast(\"Date\" AS DATE) IS NOT NULL)"


def _distinct_dates(spark, sf) -> DataFrame:
    return (matches_raw(spark, sf, dirty=True).select(parse_date("Date").alias("d"))
            .where(F.col("d").isNotNull()).distinct())


@register("date_parts", W(f"""SELECT d, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
 CAST(quarter(d) AS INTEGER) AS quarter, CAST(day(d) AS INTEGER) AS day FROM {_DATES_SQL}""", dirty=True))
def date_parts_q(spark: SparkSession, sf: str) -> DataFrame:
    p = date_parts("d")
    return _distinct_dates(spark, sf).select("d", *[p[k].alias(k) for k in ("year", "month", "quarter", "day")])


@register("day_month_names", W(f"""SELECT d, CAST(isodow(d) - 1 AS INTEGER) AS day_of_week, dayname(d) AS day_name,
 monthname(d) AS month_name FROM {_DATES_SQL}""", dirty=True))
def day_month_names(spark: SparkSession, sf: str) -> DataFrame:
    return _distinct_dates(spark, sf).select("d", weekday0("d").alias("day_of_week"),
                                             day_name("d").alias("day_name"), month_name("d").alias("month_name"))


@register("weekend_flag", W(f"""SELECT d, CAST(CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend
FROM {_DATES_SQL}""", dirty=True))
def weekend_flag_q(spark: SparkSession, sf: str) -> DataFrame:
    return _distinct_dates(spark, sf).select("d", weekend_flag("d").alias("is_weekend"))


@register("trim_text", W(f"""SELECT "HomeTeam" AS team_raw, {strip('"HomeTeam"')} AS team, COUNT(*) AS n
FROM m_raw GROUP BY 1, 2""", dirty=True))
def trim_text(spark: SparkSession, sf: str) -> DataFrame:
    raw = matches_raw(spark, sf, dirty=True)
    return raw.groupBy(F.col("HomeTeam").alias("team_raw"), strip_ws("HomeTeam").alias("team")) \
              .agg(F.count(F.lit(1)).alias("n"))


@register("title_case", W("""SELECT "City" AS city_raw, concat(upper(substring("City", 1, 1)), lower(substring("City", 2))) AS city,
 COUNT(*) AS n FROM m_raw GROUP BY 1, 2"""))
def title_case_q(spark: SparkSession, sf: str) -> DataFrame:
    # fixture cities are single upper-case words, where initcap = first upper + rest lower
    raw = matches_raw(spark, sf)
    return raw.groupBy(F.col("City").alias("city_raw"), title_case("City").alias("city")) \
              .agg(F.count(F.lit(1)).alias("n"))


@register("alias_regex_replace", W(f"""SELECT "AwayTeam" AS team_raw, {alias_regex_sql('"AwayTeam"', TEST_TEAM_ALIASES)} AS team,
 {alias_regex_sql('"AwayTeam"')} AS team_reference_map, COUNT(*) AS n FROM m_raw GROUP BY 1, 2, 3"""))
def alias_regex_replace(spark: SparkSession, sf: str) -> DataFrame:
    raw = matches_raw(spark, sf)
    return raw.groupBy(F.col("AwayTeam").alias("team_raw"),
                       alias_regex("AwayTeam", TEST_TEAM_ALIASES).alias("team"),
                       alias_regex("AwayTeam").alias("team_reference_map")) \
              .agg(F.count(F.lit(1)).alias("n"))


@register("alias_exact_map", W(f"""SELECT "Entity" AS country_raw, {alias_exact_sql('"Entity"', TEST_COUNTRY_ALIASES)} AS country,
 COUNT(*) AS n FROM r_raw GROUP BY 1, 2"""))
def alias_exact_map(spark: SparkSession, sf: str) -> DataFrame:
    raw = readings_raw(spark, sf)
    return raw.groupBy(F.col("Entity").alias("country_raw"),
                       alias_exact("Entity", TEST_COUNTRY_ALIASES).alias("country")) \
              .agg(F.count(F.lit(1)).alias("n"))


@register("numeric_coerce", W(f"""SELECT "HomeGoals" AS goals_raw, {coerce_int_sql('"HomeGoals"')} AS goals, COUNT(*) AS n
FROM m_raw GROUP BY 1, 2""", dirty=True))
def numeric_coerce(spark: SparkSession, sf: str) -> DataFrame:
    raw = matches_raw(spark, sf, dirty=True)
    return raw.groupBy(F.col("HomeGoals").alias("goals_raw"), coerce_int("HomeGoals").alias("goals")) \
              .agg(F.count(F.lit(1)).alias("n"))


@register("total_goals", W("SELECT home_goals, away_goals, total_goals, COUNT(*) AS n FROM m_clean GROUP BY 1, 2, 3"))
def total_goals(spark: SparkSession, sf: str) -> DataFrame:
    return clean_m(spark, sf).groupBy("home_goals", "away_goals", "total_goals").agg(F.count(F.lit(1)).alias("n"))


@register("winner_label", W("SELECT winner, COUNT(*) AS n FROM m_clean GROUP BY 1"))
def winner_label(spark: SparkSession, sf: str) -> DataFrame:
    return clean_m(spark, sf).groupBy("winner").agg(F.count(F.lit(1)).alias("n"))


@register("outcome_label", W("SELECT outcome, COUNT(*) AS n FROM m_clean GROUP BY 1"))
def outcome_label(spark: SparkSession, sf: str) -> DataFrame:
    return clean_m(spark, sf).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@register("temperature_category", W(f"""SELECT country, year, month, avg_temperature_celsius,
 temperature_category, {bin_sql('avg_temperature_celsius', 'left')} AS category_left_closed FROM cells_c"""))
def temperature_category(spark: SparkSession, sf: str) -> DataFrame:
    return cells(spark, sf).withColumn("category_left_closed",
                                       bin_label("avg_temperature_celsius", closed="left"))


@register("team_code", W("SELECT team_name, team_code FROM dim_team", star=True))
def team_code(spark: SparkSession, sf: str) -> DataFrame:
    teams = ST.distinct_entities(clean_m(spark, sf))
    return teams.select("team_name", code_prefix("team_name").alias("team_code"))


@register("infer_group", W(f"""SELECT city, {confederation_case('city')} AS city_group,
 {confederation_case('home_team')} AS team_group, COUNT(*) AS n FROM m_clean GROUP BY 1, 2, 3"""))
def infer_group_q(spark: SparkSession, sf: str) -> DataFrame:
    m = clean_m(spark, sf)
    return m.groupBy("city", infer_group("city").alias("city_group"),
                     infer_group("home_team").alias("team_group")).agg(F.count(F.lit(1)).alias("n"))


# all raw matches under team names, so that every group occurs
_TEAMS = "Germany Brazil Mexico Ghana Japan Atlantis".split()
_NAMED_SQL = f"(SELECT {_TEAMS!r}[k1 % {len(_TEAMS)} + 1] || ' ' || (k2 % 3) AS team FROM m_raw)"


def named_teams(spark: SparkSession, sf: str) -> DataFrame:
    m = flat_m(matches_raw(spark, sf))
    name = F.element_at(F.array(*map(F.lit, _TEAMS)), (F.col("k1") % len(_TEAMS) + 1).cast("int"))
    return m.select(F.concat_ws(" ", name, F.col("k2") % 3).alias("team"))


@register("infer_group_names", W(f"SELECT team, {confederation_case('team')} AS team_group, COUNT(*) AS n FROM {_NAMED_SQL} GROUP BY team"))
def infer_group_names(spark: SparkSession, sf: str) -> DataFrame:
    return named_teams(spark, sf).groupBy("team", infer_group("team").alias("team_group")).agg(F.count(F.lit(1)).alias("n"))


@register("null_defaults", W("""SELECT coalesce("HomeGoals", 'Unknown') AS goals, coalesce("Time", 'Unknown') AS time,
 COUNT(*) AS n FROM m_raw GROUP BY 1, 2""", dirty=True))
def null_defaults(spark: SparkSession, sf: str) -> DataFrame:
    raw = matches_raw(spark, sf, dirty=True)
    return raw.groupBy(null_default("HomeGoals").alias("goals"), null_default("Time").alias("time")) \
              .agg(F.count(F.lit(1)).alias("n"))


@register("infer_country", W("SELECT country, COUNT(*) AS n FROM m_clean GROUP BY 1"))
def infer_country(spark: SparkSession, sf: str) -> DataFrame:
    m = clean_m(spark, sf).withColumnRenamed("country", "host_country")
    return E.infer_column(m).groupBy("country").agg(F.count(F.lit(1)).alias("n"))


# =================================================================== filters


@register("filter_year_range", W(f"""SELECT year, COUNT(*) AS n FROM m_clean
WHERE year BETWEEN {NARROW_YEARS[0]} AND {NARROW_YEARS[1]} GROUP BY 1"""))
def filter_year_range(spark: SparkSession, sf: str) -> DataFrame:
    m = clean_m(spark, sf, years=NARROW_YEARS)
    return m.groupBy("year").agg(F.count(F.lit(1)).alias("n"))


@register("filter_value_range", W("""SELECT country, COUNT(*) AS n, MIN(temperature) AS min_t, MAX(temperature) AS max_t
FROM r_clean_f GROUP BY 1""", dirty=True))
def filter_value_range(spark: SparkSession, sf: str) -> DataFrame:
    r = C.clean_readings(readings_raw(spark, sf, dirty=True), dedup=False)
    return r.groupBy("country").agg(F.count(F.lit(1)).alias("n"), F.min("temperature").alias("min_t"),
                                    F.max("temperature").alias("max_t"))


@register("drop_null_keys", W("""SELECT CAST(year(match_date) AS INTEGER) AS year, COUNT(*) AS n
FROM m_clean_p WHERE match_date IS NOT NULL GROUP BY 1""", dirty=True))
def drop_null_keys(spark: SparkSession, sf: str) -> DataFrame:
    raw = matches_raw(spark, sf, dirty=True).withColumn("match_date", parse_date("Date"))
    return C.drop_null_keys(raw, ["match_date"]).groupBy(F.year("match_date").alias("year")) \
            .agg(F.count(F.lit(1)).alias("n"))


@register("reject_counts", W("""SELECT rule, CAST(rows AS BIGINT) AS rows FROM (
 SELECT 'input' AS rule, COUNT(*) AS rows FROM m_raw
 UNION ALL SELECT 'bad_date', COUNT(*) FROM m_clean_p WHERE match_date IS NULL
 UNION ALL SELECT 'out_of_years', COUNT(*) FROM m_clean_p WHERE match_date IS NOT NULL AND year(match_date) NOT BETWEEN 1930 AND 2014
 UNION ALL SELECT 'duplicate_key', (SELECT COUNT(*) FROM m_clean_d) - (SELECT COUNT(*) FROM m_clean)
 UNION ALL SELECT 'output', COUNT(*) FROM m_clean)""", dirty=True))
def reject_counts(spark: SparkSession, sf: str) -> DataFrame:
    return C.clean_and_count(matches_raw(spark, sf, dirty=True))[1]


@register("reject_counts_readings", W("""SELECT rule, CAST(rows AS BIGINT) AS rows FROM (
 SELECT 'input' AS rule, COUNT(*) AS rows FROM r_raw
 UNION ALL SELECT 'bad_date', COUNT(*) FROM r_clean_p WHERE date IS NULL
 UNION ALL SELECT 'no_value', COUNT(*) FROM r_clean_p WHERE date IS NOT NULL AND temperature IS NULL
 UNION ALL SELECT 'out_of_range', COUNT(*) FROM r_clean_p WHERE date IS NOT NULL AND temperature NOT BETWEEN -50 AND 60
 UNION ALL SELECT 'out_of_years', COUNT(*) FROM r_clean_p WHERE date IS NOT NULL AND temperature BETWEEN -50 AND 60 AND year(date) NOT BETWEEN 1930 AND 2014
 UNION ALL SELECT 'duplicate_key', (SELECT COUNT(*) FROM r_clean_f) - (SELECT COUNT(*) FROM r_clean)
 UNION ALL SELECT 'output', COUNT(*) FROM r_clean)""", dirty=True))
def reject_counts_readings(spark: SparkSession, sf: str) -> DataFrame:
    return C.clean_and_count(readings_raw(spark, sf, dirty=True), C.clean_readings)[1]


@register("reject_counts_recount", W("""SELECT rule, CAST(rows AS BIGINT) AS rows FROM (
 SELECT 'input' AS rule, COUNT(*) AS rows FROM m_raw
 UNION ALL SELECT 'bad_date', COUNT(*) FROM m_clean_p WHERE match_date IS NULL
 UNION ALL SELECT 'out_of_years', COUNT(*) FROM m_clean_p WHERE match_date IS NOT NULL AND year(match_date) NOT BETWEEN 1930 AND 2014
 UNION ALL SELECT 'duplicate_key', (SELECT COUNT(*) FROM m_clean_d) - (SELECT COUNT(*) FROM m_clean)
 UNION ALL SELECT 'output', COUNT(*) FROM m_clean)"""))
def reject_counts_recount(spark: SparkSession, sf: str) -> DataFrame:
    """The same counts by a pass of their own, where the cleaned table is not written."""
    return C.reject_counts(matches_raw(spark, sf))


@register("clean_matches", W(f"SELECT {CLEAN_SQL_COLS}, {', '.join(K6)} FROM m_clean"))
def clean_matches(spark: SparkSession, sf: str) -> DataFrame:
    return flat_m(clean_m(spark, sf))


@register("clean_matches_dirty", W(f"SELECT {CLEAN_SQL_COLS}, {', '.join(K6)} FROM m_clean", dirty=True))
def clean_matches_dirty(spark: SparkSession, sf: str) -> DataFrame:
    return flat_m(C.clean_matches(matches_raw(spark, sf, dirty=True)))


@register("clean_readings", W(f"SELECT {READ_SQL_COLS}, k1 FROM r_clean"))
def clean_readings(spark: SparkSession, sf: str) -> DataFrame:
    return flat_r(clean_r(spark, sf))


@register("clean_readings_dirty", W(f"SELECT {READ_SQL_COLS}, k1 FROM r_clean", dirty=True))
def clean_readings_dirty(spark: SparkSession, sf: str) -> DataFrame:
    return flat_r(C.clean_readings(readings_raw(spark, sf, dirty=True)))


# =================================================================== joins

_ENR_COLS = "k1, k2, k3, k4, k5, k6, country, year, month, avg_temperature_celsius, temperature_category"


@register("enrich_exact", W("""SELECT m.k1, m.k2, m.k3, m.k4, m.k5, m.k6, m.country, m.year, m.month,
 c.avg_temperature_celsius, c.temperature_category
FROM m_clean m LEFT JOIN cells_c c ON m.country = c.country AND m.year = c.year AND m.month = c.month"""))
def enrich_exact(spark: SparkSession, sf: str) -> DataFrame:
    e = E.enrich(clean_m(spark, sf), clean_r(spark, sf), fallback=False)
    return flat_m(e).select(*_ENR_COLS.split(", "))


@register("enrich_yearly", W(f"""WITH yc AS (
  SELECT country, year, {mean_sql('temperature')} AS t
  FROM r_clean WHERE country IS NOT NULL AND year IS NOT NULL GROUP BY 1, 2)
SELECT m.k1, m.k2, m.k3, m.k4, m.k5, m.k6, m.country, m.year, m.month,
 yc.t AS avg_temperature_celsius, {bin_sql('yc.t')} AS temperature_category
FROM m_clean m LEFT JOIN yc ON m.country = yc.country AND m.year = yc.year"""))
def enrich_yearly(spark: SparkSession, sf: str) -> DataFrame:
    e = E.enrich(clean_m(spark, sf), clean_r(spark, sf), grain="year")
    return flat_m(e).select(*_ENR_COLS.split(", "))


@register("enrich_with_fallback", W(f"SELECT {_ENR_COLS} FROM enriched"))
def enrich_with_fallback(spark: SparkSession, sf: str) -> DataFrame:
    e = E.enrich(clean_m(spark, sf), clean_r(spark, sf))
    return flat_m(e).select(*_ENR_COLS.split(", "))


@register("enriched", W(f"SELECT match_id, {CLEAN_SQL_COLS}, avg_temperature_celsius, temperature_category, "
                        f"{', '.join(K6)} FROM enriched_ids", star=False))
def enriched(spark: SparkSession, sf: str) -> DataFrame:
    e = star(spark, sf)["enriched"]
    return flat_m(e.select("match_id", *CLEAN_COLS, "avg_temperature_celsius", "temperature_category", "src_pos"))


@register("fact_build", W("""SELECT match_id, date_id, location_id, home_team_id, away_team_id, temperature_id
FROM fact_matches""", star=True))
def fact_build(spark: SparkSession, sf: str) -> DataFrame:
    t = star(spark, sf)
    dims = {n: t[n] for n in ("dim_date", "dim_team", "dim_location", "dim_temperature")}
    small = all(can_broadcast(d) for d in dims.values())   # observed row counts of the written dims
    f = ST.fact_matches(t["enriched"], dims, broadcast_dims=small)
    return f.select("match_id", "date_id", "location_id", "home_team_id", "away_team_id", "temperature_id")


@register("role_playing_join", W("""SELECT fm.match_id, ht.team_name AS home_team, awt.team_name AS away_team
FROM fact_matches fm JOIN dim_team ht ON fm.home_team_id = ht.team_id
JOIN dim_team awt ON fm.away_team_id = awt.team_id""", star=True))
def role_playing_join(spark: SparkSession, sf: str) -> DataFrame:
    t = star(spark, sf)
    team = F.broadcast(t["dim_team"]) if can_broadcast(t["dim_team"]) else t["dim_team"]
    ht, awt = team.alias("ht"), team.alias("awt")
    fm = t["fact_matches"].alias("fm")
    return (fm.join(ht, F.col("fm.home_team_id") == F.col("ht.team_id"))
              .join(awt, F.col("fm.away_team_id") == F.col("awt.team_id"))
              .select("fm.match_id", F.col("ht.team_name").alias("home_team"),
                      F.col("awt.team_name").alias("away_team")))


@register("date_fallback_join", W("""SELECT e.match_id, d.date_id AS fallback_date_id
FROM enriched_ids e LEFT JOIN (SELECT year, month, MIN(date_id) AS date_id FROM dim_date GROUP BY 1, 2) d
ON e.year = d.year AND e.month = d.month""", star=True))
def date_fallback_join(spark: SparkSession, sf: str) -> DataFrame:
    t = star(spark, sf)
    dated = ST.attach_dates(t["enriched"].drop("match_date"), t["dim_date"], broadcast_dims=can_broadcast(t["dim_date"]))
    return dated.select("match_id", F.col("date_id").alias("fallback_date_id"))


@register("fact_without_dates", W("""SELECT e.match_id, d.date_id, e.home_goals, e.away_goals, e.total_goals, e.round, e.year,
 e.home_goals * 1000 AS attendance, 'stage ' || e.round AS stage, e.away_goals AS penalty_score
FROM enriched_ids e LEFT JOIN (SELECT year(f) AS y, month(f) AS m, CAST(row_number() OVER (ORDER BY f) AS BIGINT) AS date_id
 FROM (SELECT DISTINCT make_date(year, month, 1) AS f FROM enriched_ids)) d ON e.year = d.y AND e.month = d.m""", star=True))
def fact_without_dates(spark: SparkSession, sf: str) -> DataFrame:
    """A source without match dates, and with further measures that pass through."""
    t = star(spark, sf)
    e = t["enriched"].drop("match_date", "day").withColumns({
        "attendance": F.col("home_goals") * 1000, "stage": F.concat(F.lit("stage "), "round"), "penalty_score": F.col("away_goals")})
    fact = ST.fact_matches(e, {**t, "dim_date": ST.dim_date(e)})
    return fact.select("match_id", "date_id", "home_goals", "away_goals", "total_goals", "round", "year", "attendance", "stage", "penalty_score")


@register("dim_date_from_parts", W("""SELECT CAST(row_number() OVER (ORDER BY f) AS BIGINT) AS date_id, f AS full_date, CAST(day(f) AS INTEGER) AS day
FROM (SELECT DISTINCT match_date AS f FROM enriched_ids)""", star=True))
def dim_date_from_parts(spark: SparkSession, sf: str) -> DataFrame:
    e = star(spark, sf)["enriched"].drop("match_date")
    return ST.dim_date(e).select("date_id", "full_date", "day")


# =================================================================== aggregations


@register("readings_monthly_avg", W("SELECT country, year, month, avg_temperature_celsius FROM cells"))
def readings_monthly_avg(spark: SparkSession, sf: str) -> DataFrame:
    return cells(spark, sf).select("country", "year", "month", "avg_temperature_celsius")


@register("readings_yearly_avg", W(f"""SELECT country, year,
 {mean_sql('temperature')} AS avg_temperature_celsius,
 y.y_temp AS mean_of_monthly_means
FROM r_clean JOIN yearly y USING (country, year) GROUP BY country, year, y.y_temp"""))
def readings_yearly_avg(spark: SparkSession, sf: str) -> DataFrame:
    r = clean_r(spark, sf)
    per_year = E.prepare_readings(r, grain="year").drop("temperature_category")
    fallback = E.yearly_from_monthly(E.prepare_readings(r)).withColumnRenamed("_year_temp", "mean_of_monthly_means")
    return per_year.join(fallback, ["country", "year"])


@register("enrichment_report", W(f"""SELECT COUNT(*) AS total_matches, COUNT(avg_temperature_celsius) AS matches_with_temperature,
 COUNT(*) - COUNT(avg_temperature_celsius) AS matches_without_temperature,
 CASE WHEN COUNT(*) > 0 THEN COUNT(avg_temperature_celsius) * 100e0 / COUNT(*) ELSE 0e0 END AS match_rate_percent,
 MIN(avg_temperature_celsius) AS temp_min, MAX(avg_temperature_celsius) AS temp_max,
 {mean_sql('avg_temperature_celsius')} AS temp_mean,
 quantile_cont(avg_temperature_celsius, 0.5) AS temp_median FROM enriched"""))
def enrichment_report(spark: SparkSession, sf: str) -> DataFrame:
    return E.enrichment_report(E.enrich(clean_m(spark, sf), clean_r(spark, sf)))


@register("category_distribution", W("""SELECT temperature_category, COUNT(*) AS count FROM enriched
WHERE temperature_category IS NOT NULL GROUP BY 1"""))
def category_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return E.category_distribution(E.enrich(clean_m(spark, sf), clean_r(spark, sf)))


@register("first_per_group", W("SELECT city, country, stadium FROM dim_location", star=True))
def first_per_group(spark: SparkSession, sf: str) -> DataFrame:
    e = star(spark, sf)["enriched"]
    return e.groupBy("city", "country").agg(
        F.min_by("stadium", F.when(F.col("stadium").isNotNull(), F.col("match_id"))).alias("stadium"))


# =================================================================== windows / keys / dedup


@register("surrogate_keys", W("SELECT team_id, team_name FROM dim_team", star=True))
def surrogate_keys(spark: SparkSession, sf: str) -> DataFrame:
    teams = ST.distinct_entities(clean_m(spark, sf))
    return number_rows(teams, ["team_name"], "team_id")


@register("surrogate_keys_scalable", W(f"SELECT CAST(row_number() OVER (ORDER BY {', '.join(K6)}) AS BIGINT) AS match_id, "
                                       f"{', '.join(K6)} FROM m_clean"))
def surrogate_keys_scalable(spark: SparkSession, sf: str) -> DataFrame:
    m = clean_m(spark, sf).select("src_pos")
    return flat_m(sequential_ids(m, ["src_pos"], "match_id"))


@register("result_share_window", W("""SELECT outcome, COUNT(*) AS n,
 ROUND(COUNT(*) * 100e0 / SUM(COUNT(*)) OVER (), 2) AS share FROM m_clean GROUP BY outcome"""))
def result_share_window(spark: SparkSession, sf: str) -> DataFrame:
    g = clean_m(spark, sf).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())   # over the (3-row) grouped result
    return g.select("outcome", "n", F.round(F.col("n") * F.lit(100.0).cast("double") / total, 2).alias("share"))


@register("distinct_entities", W("""SELECT home_team AS team_name FROM m_clean WHERE home_team IS NOT NULL
UNION SELECT away_team FROM m_clean WHERE away_team IS NOT NULL"""))
def distinct_entities(spark: SparkSession, sf: str) -> DataFrame:
    return ST.distinct_entities(clean_m(spark, sf))


@register("dedup_by_key", W(f"SELECT match_date, home_team, away_team, {', '.join(K6)} FROM m_clean", dirty=True))
def dedup_by_key(spark: SparkSession, sf: str) -> DataFrame:
    m = C.clean_matches(matches_raw(spark, sf, dirty=True), dedup=False)
    return flat_m(C.dedup_by_key(m, C.MATCH_KEY).select("match_date", "home_team", "away_team", "src_pos"))


@register("dedup_full_row", W("""SELECT DISTINCT "Date", "HomeTeam", "AwayTeam", "HomeGoals", "AwayGoals" FROM m_raw""",
                              dirty=True))
def dedup_full_row(spark: SparkSession, sf: str) -> DataFrame:
    raw = matches_raw(spark, sf, dirty=True).select("Date", "HomeTeam", "AwayTeam", "HomeGoals", "AwayGoals")
    return C.dedup_full_row(raw)


# =================================================================== star builders

for _name in STAR_TABLES:
    def _make(name):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return star(spark, sf)[name]
        run.__name__ = name
        return run
    register(_name, W(f"SELECT * FROM {_name}", star=True))(_make(_name))


# =================================================================== data quality


def _tables_sql(fn) -> str:
    return " UNION ALL ".join(fn(name, [(f.name, f.dataType) for f in st.fields]) for name, st in schemas.STAR.items())


def _is_num(t) -> bool:
    from pyspark.sql.types import NumericType
    return isinstance(t, NumericType)


def _is_str(t) -> bool:
    from pyspark.sql.types import StringType
    return isinstance(t, StringType)


register("dq_table_completeness", W(_completeness_sql(), star=True))(
    lambda spark, sf: Q.completeness(star_tables(spark, sf)))


def _colcomp(name, cols):
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{c}' AS column_name, CASE WHEN COUNT(*) > 0 THEN "
        f"ROUND(COUNT({c}) * 100e0 / COUNT(*), 2) ELSE 0e0 END AS completeness_percent FROM {name}"
        for c, _ in cols)


register("dq_column_completeness", W(_tables_sql(_colcomp), star=True))(
    lambda spark, sf: Q.column_completeness(star_tables(spark, sf)))
register("dq_critical_missing", W(f"SELECT * FROM ({_tables_sql(_colcomp)}) WHERE completeness_percent < 90",
                                  star=True))(
    lambda spark, sf: Q.critical_missing(star_tables(spark, sf)))


def _dups(name, cols):
    cl = ", ".join(c for c, _ in cols)
    return (f"SELECT '{name}' AS table_name, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS total_records, "
            f"CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS duplicate_records, "
            f"CASE WHEN COALESCE(SUM(n), 0) > 0 THEN ROUND(COALESCE(SUM(n - 1), 0) * 100e0 / SUM(n), 2) ELSE 0e0 END "
            f"AS duplicate_percentage FROM (SELECT COUNT(*) AS n FROM {name} GROUP BY {cl})")


register("dq_duplicates", W(_tables_sql(_dups), star=True))(
    lambda spark, sf: Q.duplicates(star_tables(spark, sf), schemas.PRIMARY_KEYS))


def _numstr(name, cols):
    parts = [f"SELECT '{name}' AS table_name, '{c}' AS column_name FROM {name} "
             f"HAVING COUNT({c}) > 0 AND COUNT_IF({c} IS NOT NULL AND try_cast({c} AS DOUBLE) IS NULL) = 0"
             for c, t in cols if _is_str(t)]
    return " UNION ALL ".join(parts) if parts else ""


register("dq_numeric_strings", W(" UNION ALL ".join(
    p for p in (_numstr(n, [(f.name, f.dataType) for f in st.fields]) for n, st in schemas.STAR.items()) if p),
    star=True))(lambda spark, sf: Q.numeric_strings(star_tables(spark, sf)))


def _iqr(name, cols):
    parts = []
    for c, t in cols:
        if not _is_num(t):
            continue
        parts.append(
            f"SELECT '{name}' AS table_name, '{c}' AS column_name, q[1] AS q1, q[2] AS q3, "
            f"(SELECT COUNT_IF(CAST({c} AS DOUBLE) < q[1] - 1.5 * (q[2] - q[1]) OR CAST({c} AS DOUBLE) > q[2] + 1.5 * (q[2] - q[1])) FROM {name}) AS outlier_count, "
            f"ROUND((SELECT COUNT_IF(CAST({c} AS DOUBLE) < q[1] - 1.5 * (q[2] - q[1]) OR CAST({c} AS DOUBLE) > q[2] + 1.5 * (q[2] - q[1])) FROM {name}) * 100e0 / "
            f"(SELECT COUNT(*) FROM {name}), 2) AS outlier_percentage "
            f"FROM (SELECT quantile_cont(CAST({c} AS DOUBLE), [0.25, 0.75]) AS q FROM {name})")
    return " UNION ALL ".join(parts)


register("dq_iqr_outliers", W(f"SELECT * FROM ({_tables_sql(_iqr)}) WHERE outlier_count > 0", star=True))(
    lambda spark, sf: Q.iqr_outliers(star_tables(spark, sf)))


def _profile(name, cols):
    parts = []
    for c, t in cols:
        if not _is_num(t):
            continue
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{name}' AS table_name, '{c}' AS column_name, COUNT({x}) AS count, "
            f"ROUND(AVG({x}), 9) AS mean, ROUND(STDDEV_SAMP({x}), 9) AS std, MIN({x}) AS min, MAX({x}) AS max, "
            f"quantile_cont({x}, 0.5) AS median FROM {name} HAVING COUNT({x}) > 0")
    return " UNION ALL ".join(parts)


def _shape(name, cols):
    parts = []
    for c, t in cols:
        if not _is_num(t):
            continue
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{name}' AS table_name, '{c}' AS column_name, "
            f"ROUND(CASE WHEN COUNT({x}) >= 3 THEN skewness({x}) END, 9) AS skewness, "
            f"ROUND(CASE WHEN COUNT({x}) >= 4 THEN kurtosis({x}) END, 9) AS kurtosis FROM {name} HAVING COUNT({x}) > 0")
    return " UNION ALL ".join(parts)


# sums of doubles depend on the order of rows in their last digits: both sides of the comparison round
def _nine(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 9) for c in cols})


register("profile_numeric", W(_tables_sql(_profile), star=True))(
    lambda spark, sf: _nine(Q.profile_numeric(star_tables(spark, sf)), "mean", "std"))
register("profile_shape", W(_tables_sql(_shape), star=True))(
    lambda spark, sf: _nine(Q.profile_numeric(star_tables(spark, sf), shape=True), "skewness", "kurtosis"))


def _feature_types_sql() -> str:
    rows = []
    for f in schemas.FACT_MATCHES.fields:
        kinds = (["numeric"] if _is_num(f.dataType) else ["categorical"] if _is_str(f.dataType) else [])
        kinds += ["temporal"] if "date" in f.name or "time" in f.name else []
        rows += [f"SELECT '{f.name}' AS column_name, '{k}' AS feature_type, COUNT({f.name}) AS non_null FROM fact_matches" for k in kinds]
    return " UNION ALL ".join(rows)


register("feature_types", W(_feature_types_sql(), star=True))(
    lambda spark, sf: Q.feature_types(star(spark, sf)["fact_matches"]))
register("feature_totals", W(f"""SELECT feature_type, COUNT(*) AS columns, COUNT_IF(non_null > 0) AS columns_with_values
FROM ({_feature_types_sql()}) GROUP BY feature_type""", star=True))(
    lambda spark, sf: Q.feature_totals(Q.feature_types(star(spark, sf)["fact_matches"])))

register("feature_cardinality", W("""SELECT 'round' AS column_name, COUNT(DISTINCT round) AS unique_values,
 CASE WHEN COUNT(*) > 0 THEN ROUND(COUNT(DISTINCT round) / COUNT(*), 4) ELSE 0e0 END AS cardinality_ratio
FROM fact_matches""", star=True))(lambda spark, sf: Q.feature_cardinality(star(spark, sf)["fact_matches"]))


def _corr_sql() -> str:
    cols = [f.name for f in schemas.FACT_MATCHES.fields if _is_num(f.dataType)]
    parts = [f"SELECT '{a}' AS feature1, '{b}' AS feature2, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS r "
             f"FROM fact_matches" for i, a in enumerate(cols) for b in cols[i + 1:]]
    return f"SELECT feature1, feature2, ROUND(r, 3) AS correlation FROM ({' UNION ALL '.join(parts)}) WHERE abs(r) > 0.7"


register("strong_correlations", W(_corr_sql(), star=True))(
    lambda spark, sf: Q.strong_correlations(star(spark, sf)["fact_matches"]))

register("bias_temporal", W("""SELECT year, COUNT(*) AS year_count,
 (SELECT MAX(year) - MIN(year) FROM dim_date) AS coverage_years FROM dim_date GROUP BY year""", star=True))(
    lambda spark, sf: Q.bias_temporal(star(spark, sf)["dim_date"]))

register("bias_geographic", W("""SELECT country, COUNT(*) AS location_count,
 (SELECT COUNT(DISTINCT country) FROM dim_location) AS unique_countries
FROM dim_location WHERE country IS NOT NULL GROUP BY country ORDER BY location_count DESC, country ASC LIMIT 10""",
                              star=True))(lambda spark, sf: Q.bias_geographic(star(spark, sf)["dim_location"]))

register("bias_entity", W("SELECT COUNT(*) AS total_teams FROM dim_team", star=True))(
    lambda spark, sf: Q.bias_entity(star(spark, sf)["dim_team"]))

_READINESS_SQL = f"""SELECT ROUND(c.a, 2) AS avg_completeness, LEAST(d.s, 20e0) AS duplicate_penalty,
 ROUND(c.a * 0.7 + (100e0 - LEAST(d.s, 20e0)) * 0.3, 2) AS readiness_score
FROM (SELECT AVG(overall_completeness_percent) AS a FROM ({_completeness_sql()})) c,
     (SELECT SUM(duplicate_percentage) AS s FROM ({_tables_sql(_dups)})) d"""

register("readiness_score", W(_READINESS_SQL, star=True))(
    lambda spark, sf: Q.readiness(star_tables(spark, sf), schemas.PRIMARY_KEYS))

register("readiness_band", W(f"""SELECT readiness_score,
 CASE WHEN readiness_score >= 90 THEN 'EXCELLENT' WHEN readiness_score >= 70 THEN 'GOOD' ELSE 'NEEDS IMPROVEMENT' END AS band,
 readiness_score >= 50 AS passed FROM ({_READINESS_SQL})""", star=True))(
    lambda spark, sf: Q.readiness_band(Q.readiness(star_tables(spark, sf), schemas.PRIMARY_KEYS)))


@register("stage_metrics", W("""SELECT 'ingest' AS stage, (SELECT COUNT(*) FROM m_raw) AS rows_in, (SELECT COUNT(*) FROM m_raw) AS rows_out
UNION ALL SELECT 'clean', (SELECT COUNT(*) FROM m_raw), (SELECT COUNT(*) FROM m_clean)
UNION ALL SELECT 'enrich', (SELECT COUNT(*) FROM m_clean), (SELECT COUNT(avg_temperature_celsius) FROM enriched)
UNION ALL SELECT 'model', (SELECT COUNT(*) FROM enriched), (SELECT COUNT(*) FROM fact_matches)""", star=True))
def stage_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Rows in and out of each stage: counted while the stages wrote their tables, only the matched rows are read again."""
    t = star(spark, sf)
    raw, clean, fact = t["matches_clean"]._pitchside_raw_rows, t["matches_clean"]._pitchside_rows, t["fact_matches"]._pitchside_rows
    matched = t["enriched"].agg(F.count("avg_temperature_celsius").alias("n"))
    rows = [("ingest", F.lit(raw), F.lit(raw)), ("clean", F.lit(raw), F.lit(clean)), ("enrich", F.lit(clean), F.col("n")),
            ("model", F.lit(clean), F.lit(fact))]
    return matched.select(F.explode(F.array(*[
        F.struct(F.lit(s).alias("stage"), a.cast("long").alias("rows_in"), b.cast("long").alias("rows_out")) for s, a, b in rows]))
        .alias("r")).select("r.*")


_MEANS = catalog_oracle.TEXTS["goals_by_temperature_category"]


@register("key_insights", star_query(f"""SELECT 'mean_goals' AS insight, temperature_category AS subject, avg_goals_per_match AS value FROM ({_MEANS})
UNION ALL SELECT * FROM (SELECT 'highest_scoring_category', temperature_category, avg_goals_per_match FROM ({_MEANS})
 ORDER BY avg_goals_per_match DESC, temperature_category LIMIT 1)
UNION ALL SELECT 'highest_scoring_match', home_team || ' - ' || away_team, CAST(total_goals AS DOUBLE)
 FROM (SELECT *, row_number() OVER (ORDER BY total_goals DESC, match_id) AS k FROM ({catalog_oracle.TEXTS["doc_top10_matches"]})) WHERE k = 1"""))
def key_insights(spark: SparkSession, sf: str) -> DataFrame:
    star(spark, sf)
    queries = catalog.QueryCatalog(spark)
    return INS.key_insights(queries.run("goals_by_temperature_category"), queries.run("doc_top10_matches"))


# =================================================================== constraints

register("check_constraints", W("""SELECT 'chk_scores_non_negative' AS rule, 'fact_matches' AS table_name,
 COUNT_IF(NOT (home_goals >= 0 AND away_goals >= 0)) AS violations FROM fact_matches
UNION ALL SELECT 'chk_temp_range', 'dim_temperature', COUNT_IF(NOT (avg_temperature_celsius BETWEEN -50 AND 60)) FROM dim_temperature
UNION ALL SELECT 'chk_valid_month', 'dim_date', COUNT_IF(NOT (month BETWEEN 1 AND 12)) FROM dim_date
UNION ALL SELECT 'chk_valid_day', 'dim_date', COUNT_IF(NOT (day BETWEEN 1 AND 31)) FROM dim_date""", star=True))(
    lambda spark, sf: Q.check_constraints(star(spark, sf)["fact_matches"], star(spark, sf)["dim_temperature"],
                                          star(spark, sf)["dim_date"]))

register("check_unique_keys", W(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{k}' AS key_column, "
    f"CAST(COALESCE(SUM(CASE WHEN {k} IS NULL THEN n END), 0) AS BIGINT) AS null_keys, "
    f"COUNT_IF({k} IS NOT NULL AND n > 1) AS duplicate_keys FROM (SELECT {k}, COUNT(*) AS n FROM {t} GROUP BY {k})"
    for t, k in schemas.PRIMARY_KEYS.items()), star=True))(
    lambda spark, sf: Q.check_unique_keys(star_tables(spark, sf), schemas.PRIMARY_KEYS))

register("check_referential", W(" UNION ALL ".join(
    f"SELECT '{fk}' AS fk_column, '{dim}' AS dim_table, COUNT(*) AS orphan_rows FROM fact_matches f "
    f"WHERE f.{fk} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{pk} = f.{fk})"
    for fk, dim, pk in schemas.FOREIGN_KEYS), star=True))(
    lambda spark, sf: Q.check_referential(star(spark, sf)["fact_matches"], star(spark, sf),
                                          schemas.FOREIGN_KEYS))


_NUMSTR_SQL = " UNION ALL ".join(p for p in (_numstr(n, [(f.name, f.dataType) for f in st.fields]) for n, st in schemas.STAR.items()) if p)
_REPORT_SECTIONS = {
    "completeness": _completeness_sql(),
    "column_completeness": _tables_sql(_colcomp),
    "quality_duplicates": _tables_sql(_dups),
    "quality_numeric_strings": _NUMSTR_SQL,
    "quality_outliers": f"SELECT * FROM ({_tables_sql(_iqr)}) WHERE outlier_count > 0",
    "profile_numeric": _tables_sql(_profile),
    "profile_shape": _tables_sql(_shape),
    "features_types": _feature_types_sql(),
    "features_totals": f"SELECT DISTINCT feature_type FROM ({_feature_types_sql()})",
    "features_cardinality": "SELECT 1",
    "correlations": _corr_sql(),
    "bias_temporal": "SELECT DISTINCT year FROM dim_date",
    "bias_geographic": "SELECT DISTINCT country FROM dim_location WHERE country IS NOT NULL LIMIT 10",
    "bias_entity": "SELECT 1",
    "readiness": "SELECT 1",
    "lineage": "SELECT unnest(['ingest', 'clean', 'enrich', 'model'])",
}


@register("readiness_report", W(" UNION ALL ".join(
    f"SELECT '{name}' AS section, COUNT(*) AS rows FROM ({text})" for name, text in _REPORT_SECTIONS.items()), star=True))
def readiness_report(spark: SparkSession, sf: str) -> DataFrame:
    """The whole report saved section by section as JSON, and the rows that each saved section holds."""
    sections = {**Q.validate_all(star_tables(spark, sf), schemas.PRIMARY_KEYS), "lineage": stage_metrics(spark, sf)}
    paths = io.save_report(sections, scratch_path(spark, "full_report"))
    frames = [io.read_table(spark, paths[name], frame.schema).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("section"), "rows")
              for name, frame in sections.items()]
    return functools.reduce(DataFrame.unionByName, frames)


# =================================================================== the same checks on a spoilt star

# the fact with null, repeated and unknown keys, negative and absurd scores, a text column of numbers
_SPOILT = {
    "match_id": "CASE WHEN match_id % 1009 = 0 THEN NULL ELSE match_id END",
    "date_id": "CASE WHEN match_id % 977 = 0 THEN -1 ELSE date_id END",
    "home_team_id": "CASE WHEN match_id % 997 = 0 THEN home_team_id + 1000 ELSE home_team_id END",
    "home_goals": "CASE WHEN match_id % 991 = 0 THEN -1 WHEN match_id % 983 = 0 THEN 99 ELSE home_goals END",
    "round": "CAST(total_goals AS {text})",
}
_FACT = [f.name for f in schemas.FACT_MATCHES.fields]


def _spoilt_columns(text: str) -> list[str]:
    return [f"{_SPOILT[c].format(text=text)} AS {c}" if c in _SPOILT else c for c in _FACT]


def spoilt_fact(spark: SparkSession, sf: str) -> DataFrame:
    rows = star(spark, sf)["fact_matches"].selectExpr(*_spoilt_columns("string"))
    return rows.unionByName(rows.where("match_id % 500 = 0"))


def _on_spoilt(query: str) -> str:
    cte = f"spoilt_rows AS (SELECT {', '.join(_spoilt_columns('VARCHAR'))} FROM fact_matches),\nspoilt AS (SELECT * FROM spoilt_rows UNION ALL SELECT * FROM spoilt_rows WHERE match_id % 500 = 0)"
    return with_chain(spark_round(query), extra_ctes=cte)


_SPOILT_TYPES = [(f.name, schemas.FACT_MATCHES["round"].dataType if f.name == "round" else f.dataType) for f in schemas.FACT_MATCHES.fields]

register("dq_numeric_strings_spoilt", _on_spoilt(_numstr("spoilt", _SPOILT_TYPES)))(
    lambda spark, sf: Q.numeric_strings({"spoilt": spoilt_fact(spark, sf)}))
register("dq_iqr_outliers_spoilt", _on_spoilt(f"SELECT * FROM ({_iqr('spoilt', _SPOILT_TYPES)}) WHERE outlier_count > 0"))(
    lambda spark, sf: Q.iqr_outliers({"spoilt": spoilt_fact(spark, sf)}))
register("dq_duplicates_spoilt", _on_spoilt(_dups("spoilt", _SPOILT_TYPES)))(
    lambda spark, sf: Q.duplicates({"spoilt": spoilt_fact(spark, sf)}, {}))
register("check_constraints_spoilt", _on_spoilt("""SELECT 'chk_scores_non_negative' AS rule, 'fact_matches' AS table_name,
 COUNT_IF(NOT (home_goals >= 0 AND away_goals >= 0)) AS violations FROM spoilt
UNION ALL SELECT 'chk_temp_range', 'dim_temperature', COUNT_IF(avg_temperature_celsius < 5 OR avg_temperature_celsius > 20) FROM dim_temperature
UNION ALL SELECT 'chk_valid_month', 'dim_date', COUNT(*) FROM dim_date WHERE month > 10
UNION ALL SELECT 'chk_valid_day', 'dim_date', COUNT(*) FROM dim_date WHERE day > 30"""))(
    lambda spark, sf: Q.check_constraints(
        spoilt_fact(spark, sf), star(spark, sf)["dim_temperature"],
        star(spark, sf)["dim_date"].withColumns({"month": F.col("month") + 2, "day": F.col("day") + 1}), bounds=(5.0, 20.0)))
register("check_unique_keys_spoilt", _on_spoilt("""SELECT 'spoilt' AS table_name, 'match_id' AS key_column, COUNT_IF(match_id IS NULL) AS null_keys,
 (SELECT COUNT(*) FROM (SELECT match_id FROM spoilt WHERE match_id IS NOT NULL GROUP BY match_id HAVING COUNT(*) > 1)) AS duplicate_keys FROM spoilt"""))(
    lambda spark, sf: Q.check_unique_keys({"spoilt": spoilt_fact(spark, sf)}, {"spoilt": "match_id"}))
register("check_referential_spoilt", _on_spoilt(" UNION ALL ".join(
    f"SELECT '{fk}' AS fk_column, '{dim}' AS dim_table, COUNT(*) AS orphan_rows FROM spoilt f "
    f"WHERE f.{fk} IS NOT NULL AND f.{fk} NOT IN (SELECT {pk} FROM {dim})" for fk, dim, pk in schemas.FOREIGN_KEYS)))(
    lambda spark, sf: Q.check_referential(spoilt_fact(spark, sf), star(spark, sf), schemas.FOREIGN_KEYS))
