import math
import random

import numpy as np
from pyspark.sql import functions as F

from pitchside.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, step, k=5):
    usable = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, _ in rows
              if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in {(i, tuple(v)) for i, v in usable if i % step == 0}:
        scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in usable if j != i)[:k]
        out += [(i, r, j, -s) for r, (s, j) in enumerate(scores, 1)]
    return sorted(out)


def test_equals_brute_force_with_ties_and_odd_rows(spark, monkeypatch):
    rng = random.Random(1)
    monkeypatch.setattr(topk, "GROUP_ROWS", 200)
    monkeypatch.setattr(topk, "BATCH_ROWS", 4)
    monkeypatch.setattr(topk, "BLOCK", 16)
    rows = [(i, [rng.choice([-1.0, -0.5, 0.25, 1.0]) * rng.random() ** 3 for _ in range(6)], 0) for i in range(600)]
    rows += [(i, rows[7][1], 1) for i in range(600, 660)]                    # one very common vector: ties
    rows += [(700, None, 0), (701, [1.0, None], 0), (702, [float("nan")], 0), (703, [float("inf"), 1.0], 0), (None, [1.0], 0),
             (50, rows[50][1], 0), (800, [], 0), (801, [0.5], 0), (850, [3e6] * 6, 0), (851, [-3e6] * 6, 0)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 50 == 0).collect())
    assert got == brute(rows, 50)


def test_pruning_opens_few_blocks():
    rng = np.random.default_rng(0)
    blocks = []
    for b in range(40):
        m = rng.integers(-3, 4, (16, 8)) + 40 * (b == 17)
        blocks.append((np.arange(16) + 16 * b, m, m.max(0).tolist(), m.min(0).tolist()))
    q = np.ones((3, 8), np.int64)
    at, ids, score, opened = topk.search_blocks(np.array([-1, -2, -3]), q, blocks, 5)
    assert set(ids // 16) == {17} and len(at) == 15 and opened == 3


def test_empty_table_and_no_queries(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert topk.top_k(empty, F.col("vec_id") % 50 == 0).collect() == []
    assert topk.top_k(spark.createDataFrame([(1, [1.0], 0)], SCHEMA), F.col("vec_id") % 50 == 0).collect() == []
    assert topk.top_k(spark.createDataFrame([(50, [1.0], 0)], SCHEMA), F.col("vec_id") % 50 == 0).collect() == []
