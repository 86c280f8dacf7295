"""Every check finds something on a spoilt star, and the builders take poorer sources."""

import pytest

from pitchside import schemas
from pitchside.operators import clean as C
from pitchside.operators import star as ST
from pitchside.plans.registry import spark_queries
from tests.conftest import SF001


@pytest.mark.parametrize("name, value", [
    ("dq_numeric_strings_spoilt", "column_name"), ("dq_iqr_outliers_spoilt", "outlier_count"), ("dq_duplicates_spoilt", "duplicate_records"),
    ("check_constraints_spoilt", "violations"), ("check_unique_keys_spoilt", "duplicate_keys"), ("check_referential_spoilt", "orphan_rows"),
    ("infer_group_names", "team_group")])
def test_each_check_reports_something(spark, name, value):
    rows = spark_queries()[name](spark, SF001).collect()
    found = {r[value] for r in rows}
    assert found - {0, "Other"}


def test_referential_check_reads_the_fact_once(spark, star_small):
    from pitchside.operators import quality as Q
    df = Q.check_referential(star_small["fact_matches"], star_small, schemas.FOREIGN_KEYS)
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert plan.split("Subqueries")[0].count("ReadSchema: struct<date_id:bigint,location_id:bigint") == 1


def test_fact_without_dates_places_or_readings_columns(spark, star_small):
    e = star_small["enriched"]
    for gone, null in ((["match_date", "day", "month"], "temperature_id"), (["city"], None), (["city", "country"], "location_id")):
        poorer = e.drop(*gone)
        fact = ST.fact_matches(poorer, star_small)
        assert fact.count() == e.count()
        if null:
            assert fact.where(f"{null} IS NOT NULL").count() == 0
        assert fact.where("date_id IS NULL").count() == 0


def test_order_does_not_depend_on_splits(spark, tmp_path):
    rows = [("2000-01-0" + str(k % 3 + 1), "A", str(k % 5), str(k), "B", f"round {k}") for k in range(300)]
    raw = spark.createDataFrame(rows, "Date string, HomeTeam string, HomeGoals string, AwayGoals string, AwayTeam string, Round string")
    seen = []
    for files, size in ((1, "1k"), (7, "128m")):
        path = str(tmp_path / f"files{files}")
        raw.repartition(files).write.parquet(path)
        before = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            got = C.clean_matches(spark.read.parquet(path))
            seen.append(sorted((str(r.match_date), r.home_goals, r.away_goals, r["round"], r.src_pos) for r in got.collect()))
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert seen[0] == seen[1] and len(seen[0]) == 3


def test_no_break_space_is_stripped(spark):
    from pitchside.functions.text import strip_ws
    df = spark.createDataFrame([("\u00a0 Brazil\u2003\t",)], "t string")
    assert df.select(strip_ws("t").alias("t")).first().t == "Brazil"


def test_csv_results_keep_padded_cells(spark, tmp_path):
    from pitchside.sources import io
    path = str(tmp_path / "padded.csv")
    io.write_table(spark.createDataFrame([("  a ",)], "t string"), path)
    assert io.read_table(spark, path, "t string").first().t == "  a "
