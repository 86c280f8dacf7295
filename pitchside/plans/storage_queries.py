"""Keys of what is kept in storage: quarantined lines, reloaded years, stored partial aggregates,
sketch states and the one report document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pitchside import schemas
from pitchside.functions.text import DEFAULT_GROUP
from pitchside.operators import clean as C
from pitchside.operators import quality as Q
from pitchside.operators import rules as R
from pitchside.operators import sketches
from pitchside.plans import catalog, catalog_oracle, rollup
from pitchside.plans.operator_queries import (
    K6, MATCH_FIELDS, RAW_COLS, TEST_COUNTRY_ALIASES, W, _NAMED_SQL, _completeness_sql, _corr_sql, _dups, _iqr, _profile, _tables_sql, flat_m, flat_r, named_teams, star,
    star_tables,
)
from pitchside.plans.oracle import alias_exact_sql, confederation_case, star_query
from pitchside.plans.registry import register
from pitchside.session import scratch_path
from pitchside.sources import io, warehouse
from pitchside.sources.fixtures import matches_raw, readings_raw

# =================================================================== lines that do not fit the schema

FLAT_MATCHES = StructType(list(schemas.RAW_MATCHES.fields))
for _f in schemas.MATCH_ORDER_FIELDS.fields:
    FLAT_MATCHES = FLAT_MATCHES.add(K6[MATCH_FIELDS.index(_f.name)], _f.dataType)
FLAT_READINGS = StructType(list(schemas.RAW_READINGS.fields)).add("k1", schemas.L)


def broken_csv(spark: SparkSession, sf: str) -> str:
    """All raw matches as CSV lines; by the order key, some have a cell too many and some a word in a whole-number column."""
    df = flat_m(matches_raw(spark, sf, dirty=True)).select(*FLAT_MATCHES.fieldNames())
    line = F.to_csv(F.struct(*[F.when(F.col("k1") % 10 == 1, F.lit("year?")).otherwise(F.col(c).cast("string")).alias(c) if c == "Year" else F.col(c)
                               for c in df.columns]), {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    path = scratch_path(spark, "broken_lines") + ".csv"
    df.select(F.when(F.col("k1") % 10 == 0, F.concat(line, F.lit(",surplus"))).otherwise(line).alias("value")).write.text(path)
    return path


def broken_json(spark: SparkSession, sf: str) -> str:
    """All raw readings as JSON lines; by the order key, some end before their brace and some hold text for a number."""
    df = flat_r(readings_raw(spark, sf)).select(*FLAT_READINGS.fieldNames())
    line = F.to_json(F.struct(*[f"`{c}`" for c in df.columns]))
    path = scratch_path(spark, "broken_lines") + ".json"
    df.select(F.when(F.col("k1") % 10 == 0, F.rtrim(line, F.lit("}"))).when(F.col("k1") % 10 == 1, F.regexp_replace(line, '"k1":', '"k1":"no",'))
              .otherwise(line).alias("value")).write.text(path)
    return path


def _accounted(found: io.Ingested, rejects: DataFrame) -> DataFrame:
    """Every line by what became of it: quarantined while reading, dropped by a cleaning rule, or kept."""
    spark = rejects.sparkSession
    stored = found.quarantine.agg(F.lit("quarantined").alias("rule"), F.count("line").alias("rows"))
    read = spark.createDataFrame([("lines", found.lines), ("malformed", found.malformed)], "rule string, rows long")
    return read.unionByName(stored).unionByName(rejects)


def _lines_sql(raw: str) -> str:
    bad = "count_if(k1 % 10 IN (0, 1))"
    return (f"SELECT 'lines' AS rule, COUNT(*) AS rows FROM {raw} UNION ALL SELECT 'malformed', {bad} FROM {raw} "
            f"UNION ALL SELECT 'quarantined', {bad} FROM {raw} UNION ALL SELECT 'input', COUNT(*) - {bad} FROM {raw}")


@register("ingest_csv_broken_lines", W(f"""SELECT rule, CAST(rows AS BIGINT) AS rows FROM (
 WITH p AS (SELECT *, match_date IS NOT NULL AND year(match_date) BETWEEN 1930 AND 2014 AS fits FROM m_clean_p WHERE k1 % 10 > 1),
 o AS (SELECT COUNT(*) AS n FROM (SELECT DISTINCT match_date, home_team, away_team FROM m_clean_d WHERE k1 % 10 > 1))
 {_lines_sql("m_raw")}
 UNION ALL SELECT 'bad_date', count_if(match_date IS NULL) FROM p
 UNION ALL SELECT 'out_of_years', count_if(match_date IS NOT NULL AND NOT fits) FROM p
 UNION ALL SELECT 'duplicate_key', count_if(fits) - (SELECT n FROM o) FROM p
 UNION ALL SELECT 'output', n FROM o)""", dirty=True))
def ingest_csv_broken_lines(spark: SparkSession, sf: str) -> DataFrame:
    path = broken_csv(spark, sf)
    found = io.ingest(spark, path, FLAT_MATCHES, scratch_path(spark, "ingested"), header="false")
    raw = found.rows.select(*RAW_COLS, F.struct(*[F.col(k).alias(f) for f, k in zip(MATCH_FIELDS, K6)]).alias("src_pos"))
    return _accounted(found, C.clean_and_count(raw)[1])


@register("ingest_json_broken_lines", W(f"""SELECT rule, CAST(rows AS BIGINT) AS rows FROM (
 WITH p AS (SELECT * FROM r_clean_p WHERE k1 % 10 > 1),
 o AS (SELECT COUNT(*) AS n FROM (SELECT DISTINCT country, date FROM r_clean_f WHERE k1 % 10 > 1))
 {_lines_sql("r_raw")}
 UNION ALL SELECT 'bad_date', count_if(date IS NULL) FROM p
 UNION ALL SELECT 'no_value', count_if(date IS NOT NULL AND temperature IS NULL) FROM p
 UNION ALL SELECT 'out_of_range', count_if(date IS NOT NULL AND temperature NOT BETWEEN -50 AND 60) FROM p
 UNION ALL SELECT 'out_of_years', count_if(date IS NOT NULL AND temperature BETWEEN -50 AND 60 AND year(date) NOT BETWEEN 1930 AND 2014) FROM p
 UNION ALL SELECT 'duplicate_key', (SELECT COUNT(*) FROM r_clean_f WHERE k1 % 10 > 1) - n FROM o
 UNION ALL SELECT 'output', n FROM o)"""))
def ingest_json_broken_lines(spark: SparkSession, sf: str) -> DataFrame:
    path = broken_json(spark, sf)
    found = io.ingest(spark, path, FLAT_READINGS, scratch_path(spark, "ingested"))
    raw = found.rows.select(*schemas.RAW_READINGS.fieldNames(), F.struct(F.col("k1").alias("o_orderkey")).alias("src_pos"))
    return _accounted(found, C.clean_and_count(raw, C.clean_readings)[1])


@register("quarantined_lines", W("SELECT CAST(k1 AS VARCHAR) AS k1, COUNT(*) AS lines FROM m_raw WHERE k1 % 10 IN (0, 1) GROUP BY k1", dirty=True))
def quarantined_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The quarantine keeps the lines as they were: the order key is still their 13th cell."""
    path = broken_csv(spark, sf)
    found = io.ingest(spark, path, FLAT_MATCHES, scratch_path(spark, "ingested"), header="false")
    cells = F.split("line", ",")
    return found.quarantine.groupBy(F.get(cells, F.lit(12)).alias("k1")).agg(F.count("line").alias("lines"))


# =================================================================== rules kept as tables

#: Rules that fit nothing, or only behind a better one: the work is that of a large rule table.
_IDLE = 5000


def _with_idle(spark: SparkSession, rules: DataFrame, kind: str) -> DataFrame:
    idle = spark.range(_IDLE).select((F.col("id") + 100).alias("priority"), F.lit(kind).alias("kind"),
                                     F.concat(F.lit("NATION_"), F.col("id") + 1000).alias("pattern"), F.lit("idle").alias("result"))
    late = spark.createDataFrame([(10_000, kind, "NATION_1", "late"), (10_001, kind, "Germany 1", "late")], R.RULE_SCHEMA)
    return rules.unionByName(idle).unionByName(late)


@register("alias_rules_table", W(f"""SELECT "Entity" AS country_raw, {alias_exact_sql('"Entity"', TEST_COUNTRY_ALIASES)} AS country,
 COUNT(*) AS n FROM r_raw GROUP BY 1, 2"""))
def alias_rules_table(spark: SparkSession, sf: str) -> DataFrame:
    rules = _with_idle(spark, R.alias_rules(spark, TEST_COUNTRY_ALIASES), "value")
    named = R.apply_rules(readings_raw(spark, sf).select(F.col("Entity").alias("country_raw")), "country_raw", rules, "country")
    return named.groupBy("country_raw", "country").agg(F.count(F.lit(1)).alias("n"))


@register("group_rules_table", W(f"SELECT team, {confederation_case('team')} AS team_group, COUNT(*) AS n FROM {_NAMED_SQL} GROUP BY team"))
def group_rules_table(spark: SparkSession, sf: str) -> DataFrame:
    rules = _with_idle(spark, R.group_rules(spark), "part")
    grouped = R.apply_rules(named_teams(spark, sf), "team", rules, "team_group", F.lit(DEFAULT_GROUP))
    return grouped.groupBy("team", "team_group").agg(F.count(F.lit(1)).alias("n"))


# =================================================================== years loaded again


@register("reload_years", W("SELECT * FROM fact_matches", star=True))
def reload_years(spark: SparkSession, sf: str) -> DataFrame:
    """The fact by year, two of its years spoilt, then loaded again, one of them twice."""
    fact = star(spark, sf)["fact_matches"]
    path = io.replace_years(fact, scratch_path(spark, "fact_years"))
    some = [1994, 1997]
    io.replace_years(fact.where(F.col("year").isin(some)).withColumn("round", F.lit("wrong")).where("match_id % 2 = 0"), path, some)
    for years in ([1997], [1994], [1997]):
        io.replace_years(fact.where(F.col("year").isin(years)), path, years)
    return spark.read.parquet(path).select(*[f.name for f in schemas.FACT_MATCHES.fields])


def matches_of_dates(fact_by_year: DataFrame, dates: DataFrame) -> DataFrame:
    """Facts of the given dates; the dates' years prune the folders of the fact while the query runs."""
    wanted = dates.select(F.col("date_id").alias("_date_id"), F.col("year").alias("_year"))
    return fact_by_year.join(wanted, (F.col("year") == F.col("_year")) & (F.col("date_id") == F.col("_date_id"))).drop("_date_id", "_year")


@register("matches_of_dates", W("SELECT f.* FROM fact_matches f JOIN dim_date d USING (date_id) WHERE d.day_name = 'Sunday' AND d.year % 3 = 0", star=True))
def matches_of_dates_q(spark: SparkSession, sf: str) -> DataFrame:
    t = star(spark, sf)
    path = io.replace_years(t["fact_matches"], scratch_path(spark, "fact_years"))
    dates = t["dim_date"].where("day_name = 'Sunday' AND year % 3 = 0")
    return matches_of_dates(spark.read.parquet(path), dates).select(*[f.name for f in schemas.FACT_MATCHES.fields])


# =================================================================== stored partial aggregates


def rollup_star(spark: SparkSession, sf: str) -> rollup.StateStar:
    """The state of all matches, written in two loads, the second of which replaces two years."""
    fact = star(spark, sf)["fact_matches"]
    path = rollup.refresh(fact.where("year <> 1996 OR match_id % 2 = 0"), scratch_path(spark, "match_state"))
    rollup.refresh(fact, path, [1995, 1996])
    return rollup.StateStar(spark, path)


def _rollup_query(name: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return rollup.PLANS[name](rollup_star(spark, sf))
    run.__name__ = f"rollup_{name}"
    return run


for _name in rollup.PLANS:
    register(f"rollup_{_name}", star_query(catalog_oracle.TEXTS[_name]))(_rollup_query(_name))


# =================================================================== sketch states

_SKETCHED = ["match_id", "home_goals", "temperature_id", "location_id"]
_PROBS = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]


@register("quantile_states", W(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({p} AS DOUBLE) AS prob, quantile_cont(CAST({c} AS DOUBLE), {p}) AS exact, TRUE AS within FROM fact_matches"
    for c in _SKETCHED for p in _PROBS), star=True))
def quantile_states(spark: SparkSession, sf: str) -> DataFrame:
    """Quantiles from the merged states of the fact's files, their measured rank error, and the exact values beside them."""
    path = io.write_table(star(spark, sf)["fact_matches"], scratch_path(spark, "sketched_fact"), "parquet")
    fact = spark.read.schema(schemas.FACT_MATCHES).parquet(path)
    states = sketches.refresh_states(fact, _SKETCHED, scratch_path(spark, "sketch_states"))
    found = sketches.rank_errors(fact, sketches.quantiles(states, _PROBS))
    exact = Q.quantile_values(fact, _SKETCHED, _PROBS)
    beside = spark.createDataFrame([(c, p, v) for c in _SKETCHED for p, v in zip(_PROBS, exact[c])], "column_name string, prob double, exact double")
    return found.join(beside, ["column_name", "prob"]).select("column_name", "prob", "exact", (F.col("rank_error") <= sketches.RANK_ERROR).alias("within"))


# =================================================================== bucketed tables


@register("bucketed_checks", W(" UNION ALL ".join([
    """SELECT 'fact_matches.match_id' AS checked, COUNT_IF(match_id IS NULL) AS nulls_or_orphans,
 (SELECT COUNT(*) FROM (SELECT match_id FROM fact_matches WHERE match_id IS NOT NULL GROUP BY match_id HAVING COUNT(*) > 1)) AS duplicates FROM fact_matches""",
    """SELECT 'fact_matches.temperature_id', COUNT(*), 0 FROM fact_matches f WHERE f.temperature_id IS NOT NULL
 AND NOT EXISTS (SELECT 1 FROM dim_temperature d WHERE d.temperature_id = f.temperature_id AND d.temperature_id % 5 > 0)""",
    "SELECT 'warm matches', COUNT_IF(t.avg_temperature_celsius > 15), 0 FROM fact_matches f LEFT JOIN dim_temperature t USING (temperature_id)"]), star=True))
def bucketed_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Key check, references (every fifth climate is missing) and a lookup on bucketed tables, none of which moves the fact."""
    t = star(spark, sf)
    base = scratch_path(spark, "bucketed")
    database = "buckets_" + base.rsplit("/", 1)[1]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{base}/_db'")
    stored = warehouse.save_bucketed(
        {"by_match": t["fact_matches"], "by_climate": t["fact_matches"], "climate": t["dim_temperature"]},
        {"by_match": "match_id", "by_climate": "temperature_id", "climate": "temperature_id"}, database, base, buckets=8)
    key = warehouse.key_faults(stored["by_match"], "match_id").select(
        F.lit("fact_matches.match_id").alias("checked"), F.col("null_keys").alias("nulls_or_orphans"), F.col("duplicate_keys").alias("duplicates"))
    lost = warehouse.orphans(stored["by_climate"], "temperature_id", stored["climate"].where("temperature_id % 5 > 0"), "temperature_id").select(
        F.lit("fact_matches.temperature_id").alias("checked"), F.col("orphan_rows").alias("nulls_or_orphans"), F.lit(0).cast("long").alias("duplicates"))
    warm = warehouse.attach(stored["by_climate"], "temperature_id", stored["climate"], "temperature_id", ["avg_temperature_celsius"])
    warm = warm.agg(F.count_if(F.col("avg_temperature_celsius") > 15).alias("nulls_or_orphans")).select(
        F.lit("warm matches").alias("checked"), "nulls_or_orphans", F.lit(0).cast("long").alias("duplicates"))
    return key.unionByName(lost).unionByName(warm)


# =================================================================== queries given as text


@register("catalog_sql_text", star_query("""SELECT yr AS year, town AS city, count(*) AS matches, sum(g) AS goals
FROM wide WHERE dated AND placed AND g >= 9 AND yr BETWEEN 1993 AND 1996 GROUP BY yr, town"""))
def catalog_sql_text(spark: SparkSession, sf: str) -> DataFrame:
    star(spark, sf)
    queries = catalog.QueryCatalog(spark)
    queries.register("rich_matches", """SELECT d.year, l.city, count(*) AS matches, sum(f.home_goals + f.away_goals) AS goals
        FROM fact_matches f JOIN dim_date d ON f.date_id = d.date_id JOIN dim_location l ON f.location_id = l.location_id
        WHERE f.home_goals + f.away_goals >= :least AND d.year BETWEEN :first AND :last GROUP BY d.year, l.city""", least=5, first=1900, last=2100)
    return queries.run("rich_matches", least=9, first=1993, last=1996)


# =================================================================== one report document


def _long(section: str, subject: str, source: str, *metrics: str) -> str:
    return " UNION ALL ".join(f"SELECT '{section}' AS section, {subject} AS subject, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM ({source})" for m in metrics)


_DOCUMENT_SQL = " UNION ALL ".join([
    _long("completeness", "table_name", _completeness_sql(), "total_records", "total_columns", "missing_cells", "overall_completeness_percent"),
    _long("duplicates", "table_name", _tables_sql(_dups), "total_records", "duplicate_records", "duplicate_percentage"),
    _long("outliers", "table_name || '.' || column_name", f"SELECT * FROM ({_tables_sql(_iqr)}) WHERE outlier_count > 0",
          "q1", "q3", "outlier_count", "outlier_percentage"),
    _long("profile", "table_name || '.' || column_name", _tables_sql(_profile), "count", "mean", "std", "min", "max", "median"),
    _long("correlations", "feature1 || '.' || feature2", _corr_sql(), "correlation"),
    _long("bias_temporal", "CAST(year AS VARCHAR)", "SELECT year, COUNT(*) AS year_count FROM dim_date GROUP BY year", "year_count"),
])
#: The columns that name a row of a section; all its other columns are metrics.
_SUBJECTS = {"completeness": ["table_name"], "duplicates": ["table_name"], "outliers": ["table_name", "column_name"],
             "profile": ["table_name", "column_name"], "correlations": ["feature1", "feature2"], "bias_temporal": ["year"]}


@register("readiness_document", W(_DOCUMENT_SQL, star=True))
def readiness_document(spark: SparkSession, sf: str) -> DataFrame:
    """The report saved as one JSON document and read back, value by value."""
    t = star_tables(spark, sf)
    known = Q.quartiles(t)
    nine = lambda df, *cols: df.withColumns({c: F.round(c, 9) for c in cols})  # noqa: E731 - sums of doubles depend on the order of rows
    sections = {
        "completeness": Q.completeness(t), "duplicates": Q.duplicates(t, schemas.PRIMARY_KEYS), "outliers": Q.iqr_outliers(t, known=known),
        "profile": nine(Q.profile_numeric(t, known=known), "mean", "std"), "correlations": Q.correlations(t["fact_matches"]),
        "bias_temporal": Q.bias_temporal(t["dim_date"]).drop("coverage_years")}
    path = scratch_path(spark, "readiness_document")
    schema = io.save_report_document(sections, path)
    document = io.read_report_document(spark, path, schema)
    frames = []
    for name, frame in sections.items():
        metrics = [c for c in frame.columns if c not in _SUBJECTS[name]]
        rows = document.select(F.explode(name).alias("r")).select("r.*")
        frames.append(rows.select(
            F.lit(name).alias("section"), F.concat_ws(".", *_SUBJECTS[name]).alias("subject"),
            F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])).alias("m"))
            .select("section", "subject", "m.*"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
