"""Driver contract: entry runs, every key has a callable, oracles match at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.compare import TABLES, digest

SF = "/root/testdata/sf0.001"
SAMPLE = ["goals_by_temperature_category", "team_performance_summary", "clean_matches",
          "enrich_with_fallback", "dim_location", "dim_temperature", "fact_matches", "readiness_score",
          "dq_iqr_outliers", "profile_numeric", "reject_counts", "surrogate_keys_scalable",
          "scan_csv_roundtrip", "check_referential", "temperature_category", "tournament_evolution"]


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["temperature_category", "match_count", "avg_goals_per_match", "min_temp",
                          "max_temp", "avg_temp"]
    assert len(rows) >= 1


def test_every_key_has_an_oracle():
    from pitchside.plans import registry
    assert set(registry.spark_queries()) == set(registry.oracle_queries())
    assert set(registry.spark_queries()) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(sdf.columns, srows, 15)[0] == digest(dcols, drows, 15)[0]


def test_repeated_match_ids_count_once(spark, duck):
    # the catalog runs on any registered star, also on a fact whose key repeats
    from pitchside.plans import catalog
    from pitchside.plans.pipeline import register_views, star_session
    tables = dict(star_session(spark, SF))
    once = {r.year: r.total_matches for r in catalog.QueryCatalog(spark).run("tournament_trends_over_time").collect()}
    try:
        tables["fact_matches"].unionByName(tables["fact_matches"].limit(50)).createOrReplaceTempView("fact_matches")
        for name in ("tournament_trends_over_time", "tournament_evolution"):
            assert {r.year: r.total_matches for r in catalog.QueryCatalog(spark).run(name).collect()} == once
    finally:
        register_views(tables)
