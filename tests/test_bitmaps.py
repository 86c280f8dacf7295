"""Distinct counts by bitmaps against sets in Python."""

import random

from pyspark.sql import functions as F

from pitchside.operators import bitmaps


def rows(n=3000, seed=1):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        g = None if rng.random() < 0.05 else rng.randrange(4)
        ident = None if rng.random() < 0.1 else rng.choice([rng.randrange(-5, 9), rng.randrange(200_000), (1 << 40) + rng.randrange(3)])
        out.append((g, ident, rng.choice([None, rng.randrange(70_000)]), None if rng.random() < 0.2 else rng.randrange(9), k))
    return out


SCHEMA = "g int, id long, other long, v int, _b0 int"


def test_counts_and_measures_equal_sets(spark):
    data = rows() + rows(500)          # the second part repeats the first rows: repeated ids count once
    df = spark.createDataFrame(data, SCHEMA).repartition(7)
    got = bitmaps.aggregate(
        df, {"grp": F.col("g")}, {"ids": F.col("id"), "high": F.when(F.col("v") >= 5, F.col("id")), "others": F.col("other")},
        {"n": bitmaps.rows(), "mean": bitmaps.average(F.col("v")), "sum": bitmaps.total(F.col("v")), "top": bitmaps.largest(F.col("v"))})
    assert got.columns == ["grp", "ids", "high", "others", "n", "mean", "sum", "top"]
    for r in got.collect():
        part = [x for x in data if x[0] == r["grp"]]
        v = [x[3] for x in part if x[3] is not None]
        assert r["ids"] == len({x[1] for x in part if x[1] is not None})
        assert r["high"] == len({x[1] for x in part if x[1] is not None and x[3] is not None and x[3] >= 5})
        assert r["others"] == len({x[2] for x in part if x[2] is not None})
        assert (r["n"], r["sum"], r["top"]) == (len(part), sum(v), max(v)) and abs(r["mean"] - sum(v) / len(v)) < 1e-12


def test_a_group_without_ids_counts_none(spark):
    df = spark.createDataFrame([(1, None, None, None, 0), (2, 5, None, 1, 0)], SCHEMA)
    got = {r["g"]: (r["ids"], r["mean"]) for r in bitmaps.aggregate(df, {"g": F.col("g")}, {"ids": F.col("id")}, {"mean": bitmaps.average(F.col("v"))}).collect()}
    assert got == {1: (0, None), 2: (1, 1.0)}
    assert bitmaps.aggregate(df.where("g > 9"), {"g": F.col("g")}, {"ids": F.col("id")}, {}).collect() == []
    assert bitmaps.distinct_count(df, F.col("id")).first()[0] == 1 and bitmaps.distinct_count(df.where("g > 9"), F.col("id")).first()[0] == 0


def test_only_groups_and_buckets_are_shuffled(spark):
    df = spark.range(100_000).withColumn("g", F.col("id") % 3)
    out = bitmaps.aggregate(df, {"g": F.col("g")}, {"ids": F.col("id")}, {"n": bitmaps.rows()})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "hashpartitioning(id" not in plan
    assert sorted(map(tuple, out.collect())) == [(0, 33334, 33334), (1, 33333, 33333), (2, 33333, 33333)]
