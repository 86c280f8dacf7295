"""Plan assertions: pushdown, broadcast dims, no single-task ranking of the fact."""

from pitchside.plans import catalog
from pitchside.plans.pipeline import star_session
from tests.conftest import SF0001


def plan(df, mode="formatted"):
    return df._jdf.queryExecution().executedPlan().toString() if mode == "executed" else \
        df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def test_scan_pushes_filters_and_prunes(spark):
    import __spark_entry__ as E
    p = plan(E.queries()["scan_parquet"](spark, SF0001))
    assert "PushedFilters: [IsNotNull(o_orderstatus), IsNotNull(o_totalprice), EqualTo(o_orderstatus,F)" in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double,o_orderdate" in p


def test_star_queries_broadcast_dimensions(spark):
    star_session(spark, SF0001)
    df = catalog.QueryCatalog(spark).run("top_scoring_matches")
    p = plan(df)
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_scalable_ids_use_range_partitioning(spark):
    from pyspark.sql import functions as F
    from pitchside.operators.keys import sequential_ids
    df = spark.range(0, 1000).select((F.col("id") * 3 % 1000).alias("k"))
    out = sequential_ids(df, ["k"], "rid", num_partitions=4)
    p = plan(out)
    # the big side is only read back from files; the single-partition window
    # touches the per-partition counts, never the rows
    assert "rangepartitioning" not in p.lower()   # layout already materialised
    assert out.count() == 1000


def test_dedup_is_partial_aggregate(spark):
    from pitchside.operators.clean import dedup_by_key
    df = spark.range(0, 100).selectExpr("id % 3 AS k", "id AS src_pos", "id AS v")
    p = plan(dedup_by_key(df, ["k"]))
    assert p.count("Aggregate") >= 2   # partial (map side) + final


def test_left_join_with_right_side_filter_becomes_inner(spark):
    star_session(spark, SF0001)
    p = plan(catalog.QueryCatalog(spark).run("temperature_impact_on_goals"))
    assert "LeftOuter" not in p and "Inner" in p


def test_fact_build_broadcasts_every_dimension(spark):
    from pitchside.operators import star as ST
    t = star_session(spark, SF0001)
    dims = {n: t[n] for n in ("dim_date", "dim_team", "dim_location", "dim_temperature")}
    p = plan(ST.fact_matches(t["enriched"], dims, broadcast_dims=True))
    assert p.count("BroadcastHashJoin") >= 5 and "SortMergeJoin" not in p


def test_validate_all_sections(spark):
    from pitchside import schemas
    from pitchside.operators import quality as Q
    t = star_session(spark, SF0001)
    tables = {n: t[n] for n in schemas.STAR}
    out = Q.validate_all(tables, schemas.PRIMARY_KEYS)
    assert out["readiness"].first().band in ("EXCELLENT", "GOOD", "NEEDS IMPROVEMENT")
    assert out["completeness"].count() == 5


def test_no_query_shuffles_the_fact_by_its_key(spark):
    # aggregates shuffle only bounded grouping keys; distinct counts travel as bitmaps
    star_session(spark, SF0001)
    cat = catalog.QueryCatalog(spark)
    for name in cat.names():
        p = plan(cat.run(name), "executed")
        assert "Expand" not in p, name
        for line in p.split("\n"):
            if "hashpartitioning(" in line:
                keys = line.split("hashpartitioning(")[1]
                assert "match_id" not in keys, (name, line)


def test_team_totals_read_the_fact_once(spark):
    star_session(spark, SF0001)
    cat = catalog.QueryCatalog(spark)
    for name in ("team_performance_summary", "top_teams_all_time"):
        assert plan(cat.run(name)).count("home_goals:int") == 1, name


def test_fact_build_without_broadcast_gives_the_same_fact(spark):
    # beyond the broadcast bounds the lookups become shuffle joins (AQE splits a
    # hot key's partition); the fact must not change
    from pitchside.operators import star as ST
    t = star_session(spark, SF0001)
    dims = {n: t[n] for n in ("dim_date", "dim_team", "dim_location", "dim_temperature")}
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                             "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = ST.fact_matches(t["enriched"], dims, broadcast_dims=False)
        p = plan(shuffled, "executed")
        # the five lookups shuffle; the only broadcast left is the id offsets
        # (one row per range partition) inside the enriched frame
        assert p.count("SortMergeJoin") + p.count("ShuffledHashJoin") >= 5
        assert p.count("BroadcastHashJoin") == 1
        got = sorted(tuple(r) for r in shuffled.collect())
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert got == sorted(tuple(r) for r in t["fact_matches"].collect())


def test_enrichment_without_broadcast_gives_the_same_rows(spark):
    from pitchside.operators import clean as C
    from pitchside.operators import enrich as E
    from pitchside.plans.joins import lookup_join
    from pitchside.sources.fixtures import matches_raw, readings_raw
    mc = C.clean_matches(matches_raw(spark, SF0001))
    rc = C.clean_readings(readings_raw(spark, SF0001))
    cols = ["src_pos", "avg_temperature_celsius", "temperature_category"]
    want = sorted(tuple(r) for r in E.enrich(mc, rc).select(*cols).collect())
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                             "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = E.enrich(mc, rc, join=lambda l, r, k: lookup_join(l, r, k, checked=False)).select(*cols)
        p = plan(shuffled, "executed")
        assert p.count("SortMergeJoin") + p.count("ShuffledHashJoin") >= 2
        got = sorted(tuple(r) for r in shuffled.collect())
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert got == want


def test_scan_spreading_only_for_a_few_splits(spark):
    from pitchside.sources.io import ensure_parallelism
    one = spark.range(0, 100, numPartitions=1)
    assert ensure_parallelism(one, 8).rdd.getNumPartitions() == 8
    wide = spark.range(0, 1000, numPartitions=40)
    assert ensure_parallelism(wide, 400).rdd.getNumPartitions() == 40   # already wide: left as is


def test_tasks_of_a_wide_plan_hold_a_bounded_number_of_rows(spark, tmp_path):
    from pitchside.sources.io import bound_task_rows
    spark.range(0, 5000, numPartitions=2).selectExpr("id % 700 AS k", "id AS v").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    cores = spark.sparkContext.defaultParallelism
    dealt = bound_task_rows(df, "k", 5000 // (4 * cores))
    assert dealt.rdd.getNumPartitions() >= 4 * cores
    assert sorted((r.v, r.k) for r in dealt.collect()) == [(i, i % 700) for i in range(5000)]
    other = spark.range(700).withColumnRenamed("id", "j").hint("shuffle_merge")
    assert plan(dealt.join(other, dealt.k == other.j), "executed").count("Exchange") == 2   # the join takes the deal as it is
    assert "hashpartitioning(k" not in plan(bound_task_rows(df, "k"))                       # few rows: spread, not dealt


def test_matches_of_a_large_scan_are_joined_in_bounded_tasks(spark, monkeypatch):
    from pitchside.sources import fixtures, io
    want = sorted(map(str, fixtures.matches_raw(spark, SF0001).collect()))
    monkeypatch.setattr(io.bound_task_rows, "__defaults__", (50,))
    raw = fixtures.matches_raw(spark, SF0001)
    assert "hashpartitioning(l_orderkey" in plan(raw) and sorted(map(str, raw.collect())) == want


def test_columns_derived_from_the_kept_row_are_not_deduplicated_with_it(spark):
    from pitchside.operators import clean as C
    from pitchside.sources.fixtures import matches_raw
    df = C.clean_matches(matches_raw(spark, SF0001))
    above, below = df._jdf.queryExecution().optimizedPlan().toString().split("Aggregate", 1)
    assert "EEEE" in above and "quarter(" in above and "EEEE" not in below and "quarter(" not in below
    assert df.columns == [*C.MATCH_COLUMNS, "src_pos"]
    r = df.orderBy("src_pos").first()
    assert (r.year, r.month, r.day, r.quarter) == (r.match_date.year, r.match_date.month, r.match_date.day, (r.match_date.month + 2) // 3)
    assert r.day_of_week == r.match_date.weekday() and r.day_name == r.match_date.strftime("%A") and r.total_goals == r.home_goals + r.away_goals


def test_full_row_dedup_runs_its_input_once(spark):
    from pitchside.operators import clean as C
    from pitchside.plans.pipeline import materialize
    df = spark.range(0, 100).selectExpr("id % 40 AS a", "CASE WHEN id % 40 < 3 THEN NULL ELSE concat('x', id % 40) END AS b")
    out = C.dedup_full_row(df)
    assert plan(out, "executed").count("Range (") == 1 and out.columns == ["a", "b"]
    want = {(k, None if k < 3 else f"x{k}") for k in range(40)}
    got = [tuple(r) for r in out.collect()]
    assert len(got) == 40 and set(got) == want
    stored = C.dedup_full_row(materialize(df, "stored"))       # read again cheaply: by digests
    assert sorted(map(tuple, stored.collect()), key=str) == sorted(got, key=str) and "_digest_0" in plan(stored)
