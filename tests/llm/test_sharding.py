import zlib
from collections import Counter

from pyspark.sql import functions as F

from pitchside.llm import sharding
from tests.llm.util import documents, frame


def jump(key, shards):
    """The published loop, on Python integers."""
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_shards_equal_the_published_loop(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.xxhash64(F.col("id").cast("string")).alias("h"))
    for shards in (1, 2, 24):
        got = sharding.assign_shards(df, "doc_id", shards).collect()
        assert all((r.shard, r.grown_shard) == (jump(r.h % (1 << 64), shards), jump(r.h % (1 << 64), shards + 1)) for r in got)
        moved = [r for r in got if r.shard != r.grown_shard]
        assert all(r.grown_shard == shards for r in moved)
        assert abs(len(moved) - 3000 / (shards + 1)) < 6 * (3000 / (shards + 1)) ** 0.5


def test_documents(spark):
    rows = documents(50) + [(3, "same", None, None, 4)] * 30 + [(None, "a", None, None, 1), (None, None, None, None, None)]
    got = sharding.shard_documents(frame(spark, rows, extra=True)).collect()
    assert got[0].asDict().keys() == {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"}
    want = Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), "key") for d, t, *_ in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32, r.law) for r in got) == want
    for s in range(24):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    assert len({r.shard for r in got if r.doc_id == 3}) == 1
    assert sharding.shard_documents(frame(spark, [])).collect() == []


def test_slots_of_blocks_and_long_runs(spark):
    df = spark.range(500).select((F.col("id") % 3).cast("int").alias("shard"), (F.col("id") % 90).alias("x"))
    df = df.unionByName(spark.range(25_000).select(F.lit(1).alias("shard"), F.lit(7).cast("long").alias("x")))
    got = sharding.number_slots(df, 3, block_rows=16).collect()
    for s in range(3):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots))) and len(slots) > 100


def test_no_python_in_the_plan(spark):
    plan = sharding.shard_documents(frame(spark, documents(5)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_an_id_has_one_shard_whatever_the_type_of_its_column(spark):
    df = spark.range(1000).select(F.col("id").alias("long"), F.col("id").cast("int").alias("int"), F.col("id").cast("string").alias("text"))
    shards = [[(r.shard, r.grown_shard) for r in sharding.assign_shards(df.orderBy("long"), c, 24).collect()] for c in df.columns]
    assert shards[0] == shards[1] == shards[2]


def test_columns_with_the_names_of_the_steps_are_carried(spark):
    names = ["_jump", "_copies", "_block", "_first", "_total", "_base", "_from", "_i", "_s", "_b", "slot"]
    df = spark.createDataFrame([(k, *[f"{n}{k % 4}" for n in names]) for k in range(40)] * 2, ["doc_id", *names])
    placed = sharding.number_slots(sharding.assign_shards(df, "doc_id", 3), 3, block_rows=4)
    rows = placed.collect()
    assert len(rows) == 80 and all(r[n] == f"{n}{r['doc_id'] % 4}" for r in rows for n in names if n != "slot")
    for s in range(3):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
