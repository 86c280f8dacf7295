"""Invariants of the star built from the driver tables (sf0.001)."""

from pyspark.sql import functions as F

from pitchside import schemas
from pitchside.operators import quality as Q


def test_star_schemas(star_small):
    for name, schema in schemas.STAR.items():
        got = [(f.name, f.dataType) for f in star_small[name].schema.fields]
        assert got == [(f.name, f.dataType) for f in schema.fields], name


def test_fact_rows_equal_clean_rows_and_ids_contiguous(star_small):
    fact, enriched = star_small["fact_matches"], star_small["enriched"]
    n = fact.count()
    assert n == enriched.count() > 0
    r = fact.agg(F.min("match_id"), F.max("match_id"), F.countDistinct("match_id")).first()
    assert tuple(r) == (1, n, n)
    for name, key in schemas.PRIMARY_KEYS.items():
        t = star_small[name]
        r = t.agg(F.min(key), F.max(key), F.countDistinct(key), F.count(F.lit(1))).first()
        assert r[0] == 1 and r[1] == r[2] == r[3], name


def test_no_orphans_and_category_counts(star_small):
    orphans = Q.check_referential(star_small["fact_matches"], star_small, schemas.FOREIGN_KEYS)
    assert all(r.orphan_rows == 0 for r in orphans.collect())
    fact, dt = star_small["fact_matches"], star_small["dim_temperature"]
    matched = star_small["enriched"].where(F.col("avg_temperature_celsius").isNotNull()).count()
    per_cat = fact.join(dt, "temperature_id").groupBy("temperature_category").count().collect()
    assert sum(r["count"] for r in per_cat) == matched


def test_match_ids_follow_source_order(star_small):
    e = star_small["enriched"].select("match_id", "src_pos").orderBy("src_pos").collect()
    assert [r.match_id for r in e] == list(range(1, len(e) + 1))


def test_constraints_hold(star_small):
    assert all(r.violations == 0 for r in Q.check_constraints(
        star_small["fact_matches"], star_small["dim_temperature"], star_small["dim_date"]).collect())
    keys = Q.check_unique_keys(star_small, schemas.PRIMARY_KEYS).collect()
    assert all(r.null_keys == 0 and r.duplicate_keys == 0 for r in keys)
