"""Equal rows by digest, and correlations and quantiles without moving what need not move."""

import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from pitchside.operators import quality as Q
from pitchside.operators import whole_rows as W

SCHEMA = "a int, b string, c double, _digest string"


def rows(seed=3):
    rng = random.Random(seed)
    out = [(k, f"text {k}", k / 7, None) for k in range(400)]
    out += [(rng.choice([None, 1]), rng.choice([None, "x"]), rng.choice([None, 0.0, -0.0, float("nan")]), rng.choice([None, "x"])) for _ in range(300)]
    return out + out[:20]


def key(r):
    c = r[2]
    return (r[0], r[1], "nan" if c is not None and c != c else 0.0 if c == 0 else c, r[3])


def colliding(columns):
    """A digest with few values: nearly every row has the digest of different rows."""
    return [F.pmod(F.hash(*columns), F.lit(5)).cast("long")]


def test_counts_and_distinct_rows_equal_python(spark):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    groups = Counter(map(key, data))
    for digest in (W.row_digest, colliding):
        assert tuple(W.duplicate_counts(df, digest).first()) == (len(data), len(data) - len(groups))
        out = W.distinct_rows(df, digest)
        assert out.columns == df.columns and Counter(map(key, out.collect())) == Counter(set(groups))


def test_beyond_the_broadcast_bound_the_result_is_the_same(spark):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA)
    spark.conf.set("spark.pitchside.maxBroadcastRows", "1")
    try:
        assert W.distinct_rows(df).count() == len(set(map(key, data)))
    finally:
        spark.conf.unset("spark.pitchside.maxBroadcastRows")


def test_only_digests_and_suspects_are_shuffled(spark, tmp_path):
    path = str(tmp_path / "wide")
    spark.range(2000).select("id", *[F.concat(F.lit("x" * 50), F.col("id")).alias(f"c{k}") for k in range(10)]).write.parquet(path)
    df = spark.read.parquet(path)
    # no digest repeats: the rows are returned as they are, with no exchange
    assert "Exchange" not in W.distinct_rows(df)._jdf.queryExecution().executedPlan().toString()
    twice = df.unionByName(df.where("id < 3"))
    plan = W.distinct_rows(twice)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and W.distinct_rows(twice).count() == 2000
    assert W.distinct_rows(df.where("id < 0")).count() == 0 and tuple(W.duplicate_counts(df.where("id < 0")).first()) == (0, 0)


def test_correlations_of_many_columns_in_the_jvm(spark):
    rng = np.random.default_rng(7)
    data = rng.normal(size=(120, 300))
    data[:, 7] = 2 * data[:, 200] + 1e9          # a large offset must not cost digits
    data[:, 31] = -data[:, 33] + 0.2 * data[:, 34]
    data[:, 50] = 4.0                             # no spread: no correlation
    table = [[None if (i + 3 * j) % 41 == 0 else float(x) for j, x in enumerate(r)] for i, r in enumerate(data)]
    df = spark.createDataFrame(table, ", ".join(f"`c.{j}` double" for j in range(300))).repartition(4)
    out = Q.strong_correlations(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in plan and "Python" not in plan and len(plan) < 60_000
    want = {}
    held = np.array([[np.nan if x is None else x for x in r] for r in table])
    for i in range(300):
        ok = ~np.isnan(held[:, [i]]) & ~np.isnan(held)
        for j in range(i + 1, 300):
            x, y = held[ok[:, j], i], held[ok[:, j], j]
            if x.std() > 0 and y.std() > 0:
                r = np.corrcoef(x, y)[0, 1]
                if abs(r) > 0.7:
                    want[f"c.{i}", f"c.{j}"] = round(r, 3)
    assert {("c.7", "c.200"), ("c.31", "c.33")} <= set(want)
    assert {(r[0], r[1]): r[2] for r in out.collect()} == want


def test_correlations_of_few_columns_and_rows(spark):
    assert Q.strong_correlations(spark.range(5)).collect() == []
    two = spark.createDataFrame([(1, 2.0)], "a int, b double")
    assert Q.strong_correlations(two).collect() == [] and Q.strong_correlations(two.where("a > 1")).collect() == []
    three = spark.createDataFrame([(1, 2.0), (2, 4.0), (3, float("nan"))], "a int, b double")
    assert [tuple(r) for r in Q.strong_correlations(three).collect()] == [("a", "b", 1.0)]


def test_quantiles_of_ids_need_no_value_counts(spark):
    df = spark.range(5, 1006).withColumns({"v": F.col("id") % 7, "gap": F.when(F.col("id") == 8, 9).otherwise(F.col("id"))})
    assert Q.dense_columns(df, df.columns) == {"id": (5, 1001)}
    got = Q.quantile_values(df, ["v", "id", "gap"], (0.25, 0.5, 0.999))
    for c in ("v", "id", "gap"):
        want = np.quantile([r[c] for r in df.collect()], (0.25, 0.5, 0.999))
        assert np.allclose(got[c], want)
    nulls = df.select(F.when(F.col("id") > 10, F.col("id")).alias("id"))
    assert Q.dense_columns(nulls, ["id"]) == {"id": (11, 995)}
