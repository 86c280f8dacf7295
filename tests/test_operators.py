"""Operators on hand-made rows: cleaning, enrichment fallback, star joins, quality."""

import datetime as dt
import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pitchside.operators import clean as C
from pitchside.operators import enrich as E
from pitchside.operators import quality as Q
from pitchside.operators import star as ST
from pitchside.operators.keys import dense_ids, number_rows, sequential_ids

RAW = ("Year int, Date string, Time string, Round string, Stadium string, City string, Country string, "
       "HomeTeam string, HomeGoals string, AwayGoals string, AwayTeam string, Observation string, "
       "src_pos struct<k:int>")


def raw_matches(spark, rows):
    full = [(None, d, None, "G", "S", city, country, h, hg, ag, a, None, (i,))
            for i, (d, city, country, h, hg, ag, a) in enumerate(rows)]
    return spark.createDataFrame(full, RAW)


def test_clean_drops_bad_dates_coerces_and_keeps_first(spark):
    raw = raw_matches(spark, [
        ("bad", "C", "X", "A", "1", "0", "B"),          # dropped: bad date
        ("2014-06-14", "C", "X", " A ", "x", "2", "B"),  # kept (first of the key)
        ("2014-06-14", "C", "X", "A", "5", "5", "B"),    # duplicate key → removed
        ("1920-01-01", "C", "X", "A", "1", "1", "B"),    # out of years
    ])
    out = C.clean_matches(raw).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.home_team, r.home_goals, r.away_goals, r.total_goals, r.winner, r.outcome) == \
        ("A", 0, 2, 2, "B", "Away Win")
    assert (r.day_of_week, r.day_name, r.year, r.month, r.quarter) == (5, "Saturday", 2014, 6, 2)
    counts = {x.rule: x.rows for x in C.reject_counts(raw).collect()}
    assert counts == {"input": 4, "bad_date": 1, "out_of_years": 1, "duplicate_key": 1, "output": 1}


def test_dedup_keeps_smallest_order_under_a_hot_key(spark):
    rows = [(i % 3, 1000 - i, f"v{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, src_pos int, v string").repartition(8)
    out = {r.k: r.v for r in C.dedup_by_key(df, ["k"], "src_pos").collect()}
    assert out == {0: "v2997", 1: "v2998", 2: "v2999"}


def test_fallback_uses_mean_of_monthly_means_left_closed(spark):
    readings = spark.createDataFrame(
        [("X", 1998, 3, 10.0), ("X", 1998, 5, 30.0), ("X", 1998, 5, 30.0), ("X", 1997, 6, 10.0)],
        "country string, year int, month_num int, temperature double")
    matches = spark.createDataFrame(
        [("X", 1998, 6, 1), ("X", 1998, 3, 2), ("Y", 1998, 3, 3), ("X", 1997, 6, 4)],
        "country string, year int, month int, id int")
    out = {r.id: (r.avg_temperature_celsius, r.temperature_category)
           for r in E.enrich(matches, readings).collect()}
    assert out[1] == (20.0, "Warm")         # no reading for June: (10 + 30) / 2, left-closed → Warm
    assert out[2] == (10.0, "Cold")         # exact month, right-closed: 10 is Cold
    assert out[3] == (None, None)           # no reading that year at all
    assert out[4] == (10.0, "Cold")


def test_null_city_is_found_null_safe(spark):
    enriched = spark.createDataFrame(
        [(1, None, "X", "S1"), (2, "C", "X", None), (3, "C", "X", "S2"), (4, None, "X", "S3")],
        "match_id long, city string, country string, stadium string")
    loc = ST.dim_location(enriched).collect()
    by = {(r.city, r.country): r for r in loc}
    assert by[(None, "X")].location_id == 1 and by[(None, "X")].stadium is None
    assert by[("C", "X")].location_id == 2 and by[("C", "X")].stadium == "S2"
    from pitchside.plans.joins import lookup_join
    dl = ST.dim_location(enriched).select("location_id", "city", "country")
    joined = lookup_join(enriched, dl, ["city", "country"], null_safe=True).collect()
    assert sorted((r.match_id, r.location_id) for r in joined) == [(1, 1), (2, 2), (3, 2), (4, 1)]


def test_team_dimension_grain_prevents_fan_out(spark):
    # one team playing in three host countries: one dim row, fact rows unchanged
    enriched = spark.createDataFrame(
        [(i + 1, dt.date(2014, 6, 1 + i), "A", "B", c, "city", "S", 1, 0, 1, "R", 2014, 6, None, None)
         for i, c in enumerate(["X", "Y", "Z"])],
        "match_id long, match_date date, home_team string, away_team string, country string, "
        "city string, stadium string, home_goals int, away_goals int, total_goals int, round string, year int, "
        "month int, avg_temperature_celsius double, temperature_category string")
    dims = ST.build_dimensions(enriched)
    assert dims["dim_team"].where(F.col("team_name") == "A").count() == 1
    fact = ST.fact_matches(enriched, dims)
    assert fact.count() == 3
    assert fact.where(F.col("temperature_id").isNull()).count() == 3


def test_sequential_ids_match_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"), F.lit("x").alias("v"))
    ids = sequential_ids(df, ["k"], "rid", num_partitions=7).select("rid", "k").collect()
    assert sorted((r.rid, r.k) for r in ids) == [(i + 1, i) for i in range(5000)]
    small = dense_ids(df.limit(10), ["k"], "rid").collect()
    assert sorted(r.rid for r in small) == list(range(1, 11))


def test_number_rows_same_ids_on_both_paths(spark):
    # the measured size picks the plan; both plans give the same ids
    df = spark.range(0, 3000).select((F.col("id") * 7919 % 3000).alias("k"), (F.col("id") % 5).alias("v"))
    window = number_rows(df, ["k"], "rid", max_single_task_rows=3000)
    ranged = number_rows(df, ["k"], "rid", max_single_task_rows=2999)
    assert "SinglePartition" in window._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in ranged._jdf.queryExecution().executedPlan().toString()
    exp = [(i + 1, i) for i in range(3000)]
    for out in (window, ranged):
        assert sorted((r.rid, r.k) for r in out.select("rid", "k").collect()) == exp


def test_first_appearance_ids_on_the_ranged_path(spark):
    df = spark.createDataFrame([("b", 3), ("a", 5), ("b", 1), ("c", 2), ("a", 4)], "g string, pos int")
    small = ST.first_appearance_ids(df, ["g"], "pos", "gid")
    big = ST.first_appearance_ids(df, ["g"], "pos", "gid", max_single_task_rows=1)
    for out in (small, big):
        assert sorted((r.gid, r.g) for r in out.collect()) == [(1, "b"), (2, "c"), (3, "a")]


def test_moments_match_pandas(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 2, 7, 9]], "x double")
    row = Q.profile_numeric({"t": df}, shape=True).collect()[0]
    assert math.isclose(row.skewness, 0.7225071865, rel_tol=1e-8)
    s = pd.Series([1, 2, 2, 7, 9], dtype=float)
    assert math.isclose(row.kurtosis, s.kurtosis(), rel_tol=1e-8)
    prof = Q.profile_numeric({"t": df}).collect()[0]
    assert math.isclose(prof["std"], 3.5637059362, rel_tol=1e-9)
    assert prof["median"] == 2.0 and prof["count"] == 5


def test_pairwise_correlation_skips_null_pairs(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (2.0, None), (7.0, 9.0), (9.0, 1.0)],
                               "x double, y double")
    r = df.agg(F.corr("x", "y")).first()[0]
    assert math.isclose(r, 0.2849569577, rel_tol=1e-8)
    assert Q.strong_correlations(df).count() == 0


def test_readiness_formula(spark):
    comp = spark.createDataFrame([(v,) for v in [97.81, 100.0, 100.0, 66.67, 100.0]],
                                 "overall_completeness_percent double")
    dup = spark.createDataFrame([(0.0,)] * 5, "duplicate_percentage double")
    row = Q.readiness_band(Q.readiness_from(comp, dup)).first()
    assert row.readiness_score == 95.03 and row.band == "EXCELLENT" and row.passed


def test_quantiles_are_exact_under_a_hot_value(spark):
    # a third of the rows hold one value, a tenth are NULL, the rest are spread
    df = spark.range(0, 6000).select(
        F.when(F.col("id") % 3 == 0, F.lit(42.0))
         .when(F.col("id") % 10 == 1, F.lit(None).cast("double"))
         .otherwise((F.col("id") * 7919 % 4999) / 7.0).alias("v"),
        (F.col("id") * 31 % 6007).cast("double").alias("w"), F.lit(None).cast("double").alias("none"))
    probs = (0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0)
    got, pdf = Q.quantile_values(df, ["v", "w", "none"], probs), df.toPandas()
    for c in ("v", "w"):
        assert got[c] == pytest.approx(pdf[c].dropna().quantile(list(probs)).tolist(), rel=1e-12, abs=1e-12), c
    assert got["none"] == [None] * len(probs)
    row = Q.quantiles(df, "w", (0.5,)).first()
    assert row.q0 == pdf["w"].quantile(0.5)


def test_quantiles_never_meet_in_one_task(spark, monkeypatch):
    # the ranked rows are partitioned by the range they lie in, never as a whole column
    from pitchside.plans import pipeline
    seen = []
    real = pipeline.materialize
    monkeypatch.setattr(pipeline, "materialize", lambda df, name: seen.append(df) or real(df, name))
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5003).alias("v"))
    Q.quantile_values(df, ["v"], (0.5,))
    plan = seen[0]._sc._jvm.PythonSQLUtils.explainString(seen[0]._jdf.queryExecution(), "simple")
    assert "rangepartitioning(c" in plan and "SinglePartition" not in plan and "percentile" not in plan


def test_duplicates_with_and_without_key_agree(spark):
    rows = [(1, "a"), (1, "a"), (2, "b"), (None, "c"), (None, "c"), (3, "d"), (3, "e")]
    df = spark.createDataFrame(rows, "k int, v string")
    full = Q.duplicates({"t": df}).first()
    keyed = Q.duplicates({"t": df}, {"t": "k"}).first()
    assert (full.total_records, full.duplicate_records) == (7, 2)
    assert tuple(keyed) == tuple(full)
    uniq = spark.createDataFrame([(i, "x") for i in range(5)], "k int, v string")
    assert Q.duplicates({"u": uniq}, {"u": "k"}).first().duplicate_records == 0


def test_small_and_scalable_keys_build_the_same_star(spark):
    from pitchside.plans.pipeline import build_star_schema
    from pitchside.sources.fixtures import matches_raw, readings_raw
    from tests.conftest import SF0001
    enriched = E.enrich(C.clean_matches(matches_raw(spark, SF0001)),
                        C.clean_readings(readings_raw(spark, SF0001)))
    a = build_star_schema(enriched, keys="small")["fact_matches"]
    b = build_star_schema(enriched, keys="scalable")["fact_matches"]
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_raw_csv_without_source_order_runs_end_to_end(spark, tmp_path):
    from pitchside import schemas
    from pitchside.plans.pipeline import run_pipeline
    from pitchside.sources.io import read_table
    m = tmp_path / "m.csv"
    m.write_text("Year,Date,Time,Round,Stadium,City,Country,HomeTeam,HomeGoals,AwayGoals,AwayTeam,Observation\n"
                 "2014,2014-06-12,17:00,Group A,Arena,Sao Paulo,Brazil,Brazil,3,1,Croatia,\n"
                 "2014,2014-06-13,13:00,Group A,Estadio,Natal,Brazil,Mexico,1,0,Cameroon,\n"
                 "2014,2014-06-12,17:00,Group A,Arena,Sao Paulo,Brazil,Brazil,3,1,Croatia,\n")
    r = tmp_path / "r.csv"
    r.write_text("Entity,Code,Month,Monthly average\nBrazil,BRA,2014-06,22.5\nBrazil,BRA,2014-05,23.5\n")
    t = run_pipeline(spark, read_table(spark, str(m), schemas.RAW_MATCHES),
                     read_table(spark, str(r), schemas.RAW_READINGS))
    # without a source order the ids follow the content, so only the set of rows is fixed
    rows = t["fact_matches"].collect()
    assert sorted(x.match_id for x in rows) == [1, 2]
    assert sorted((x.home_goals, x.away_goals) for x in rows) == [(1, 0), (3, 1)]
    temps = {x.temperature_category for x in t["dim_temperature"].collect()}
    assert temps == {"Warm"}
    teams = {x.team_name: x.confederation for x in t["dim_team"].collect()}
    assert teams["Brazil"] == "CONMEBOL" and teams["Croatia"] == "UEFA" and teams["Mexico"] == "CONCACAF"


def test_sequential_ids_with_a_hot_leading_key(spark):
    # a third of all rows share the leading sort value; the composite key is still total
    df = spark.range(0, 6000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k1"),
        (F.lit(6000) - F.col("id")).alias("k2"))
    out = sequential_ids(df, ["k1", "k2"], "rid", num_partitions=6)
    got = [(r.rid, r.k1, r.k2) for r in out.orderBy("rid").collect()]
    exp = sorted((r.k1, r.k2) for r in df.collect())
    assert [(k1, k2) for _, k1, k2 in got] == exp
    assert [r for r, _, _ in got] == list(range(1, 6001))
    # range partitioning on the composite key spreads the hot value over several tasks
    spread = (df.repartitionByRange(6, "k1", "k2")
                .groupBy(F.spark_partition_id().alias("p")).agg(F.count_if(F.col("k1") == 0).alias("hot"))
                .where(F.col("hot") > 0).count())
    assert spread >= 2


def test_referential_counts_every_orphan_row(spark):
    # key 9 has no dimension row and repeats; NULL keys are not orphans
    fact = spark.createDataFrame([(k,) for k in (1, 1, 1, 2, 9, 9, 9, None)], "team_id long")
    dim = spark.createDataFrame([(1,), (2,)], "team_id long")
    out = Q.check_referential(fact, {"dim_team": dim}, [("team_id", "dim_team", "team_id")]).collect()
    assert [(r.fk_column, r.orphan_rows) for r in out] == [("team_id", 3)]
    clean = Q.check_referential(fact.where("team_id < 9"), {"dim_team": dim}, [("team_id", "dim_team", "team_id")])
    assert clean.first().orphan_rows == 0


def test_iqr_outliers_strict_bounds(spark):
    # x: Q1 = 3.25, Q3 = 7.75, IQR = 4.5 → bounds [-3.5, 14.5]; only 100 is outside.
    # y sits exactly on its upper bound (strict comparison: not an outlier); table b has none.
    a = spark.createDataFrame([(float(v), w) for v, w in zip([1, 2, 3, 4, 5, 6, 7, 8, 9, 100],
                                                             [1, 1, 1, 1, 1, 1, 1, 1, 1, 1])] + [(None, 1)],
                              "x double, y int")
    b = spark.createDataFrame([(float(v),) for v in range(20)], "z double")
    rows = Q.iqr_outliers({"a": a, "b": b}).collect()
    assert [(r.table_name, r.column_name, r.q1, r.q3, r.outlier_count, r.outlier_percentage)
            for r in rows] == [("a", "x", 3.25, 7.75, 1, 9.09)]


def test_broadcast_check_bounds_rows_and_bytes(spark):
    from pitchside.plans.joins import can_broadcast, row_bytes
    from pitchside.plans.pipeline import materialize
    df = spark.createDataFrame([("abc", 1, (1, "xy")), (None, 2, (3, None))],
                               "s string, n long, t struct<i:int, u:string>")
    assert [r.b for r in df.select(row_bytes(df).alias("b")).collect()] == [3 + 8 + 4 + 2, 0 + 8 + 4 + 0]
    m = materialize(df, "bytes_check")
    assert (m._pitchside_rows, m._pitchside_bytes) == (2, 29)
    assert can_broadcast(m) and not can_broadcast(m, max_bytes=28) and not can_broadcast(m, max_rows=1)
    assert can_broadcast(df) and not can_broadcast(df, max_bytes=28)    # measured when not written


def test_shared_quartiles_give_the_same_reports(spark):
    a = spark.createDataFrame([(float(v), v % 3) for v in [1, 2, 3, 4, 5, 6, 7, 8, 9, 100]] + [(None, 1)],
                              "x double, y int")
    tables = {"a": a, "b": spark.createDataFrame([(float(v),) for v in range(20)], "z double")}
    known = Q.quartiles(tables)
    assert known["a"]["x"] == [3.25, 5.5, 7.75]
    for own, shared in ((Q.iqr_outliers(tables), Q.iqr_outliers(tables, known=known)),
                        (Q.profile_numeric(tables), Q.profile_numeric(tables, known=known))):
        assert sorted(tuple(r) for r in own.collect()) == sorted(tuple(r) for r in shared.collect())


def test_range_partitions_follow_the_measured_size(spark):
    from pitchside.operators.keys import range_partitions
    from pitchside.plans.pipeline import materialize
    df = spark.range(0, 3000).select((F.col("id") * 7).alias("k"))
    assert range_partitions(df) == int(spark.conf.get("spark.sql.shuffle.partitions"))   # size unknown
    m = materialize(df, "sized")
    assert range_partitions(m) == 1                      # 24 KB: one partition
    assert range_partitions(m, max_rows=1000) == 3       # but never more than max_rows rows each
    out = number_rows(m, ["k"], "rid", max_single_task_rows=1000)
    assert sorted((r.rid, r.k) for r in out.collect()) == [(i + 1, i * 7) for i in range(3000)]


def test_keep_first_dedup_with_a_hot_key_across_partitions(spark):
    # a third of the rows share key 0 and are spread over every partition; the
    # kept row is the one with the smallest source position, whatever the layout
    df = (spark.range(0, 6000, numPartitions=8)
          .select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                  ((F.col("id") * 7919) % 6000).alias("src_pos"),
                  (F.col("id") * 10).alias("v"))
          .repartition(8))
    out = {r.k: (r.src_pos, r.v) for r in C.dedup_by_key(df, ["k"]).collect()}
    pdf = df.toPandas().sort_values("src_pos").drop_duplicates("k")
    assert out == {r.k: (r.src_pos, r.v) for r in pdf.itertuples()}
    assert len(out) == 4001


def test_size_bounds_follow_the_session(spark):
    from pitchside.plans.joins import can_broadcast
    from pitchside.plans.pipeline import materialize
    m = materialize(spark.createDataFrame([("abc", 1)], "s string, n long"), "bounds")
    assert can_broadcast(m)
    spark.conf.set("spark.pitchside.maxBroadcastBytes", "10")
    spark.conf.set("spark.pitchside.maxSingleTaskRows", "2")
    try:
        assert not can_broadcast(m)
        df = spark.range(0, 50).select((F.col("id") * 3 % 50).alias("k"))
        out = number_rows(df, ["k"], "rid")
        assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()
        assert sorted((r.rid, r.k) for r in out.collect()) == [(i + 1, i) for i in range(50)]
    finally:
        spark.conf.unset("spark.pitchside.maxBroadcastBytes")
        spark.conf.unset("spark.pitchside.maxSingleTaskRows")
    assert can_broadcast(m)
