"""Operator 10: sharding by jump consistent hashing (DataFrame functions only).

A row's shard depends on its key and the number of shards alone.  The key is hashed to
64 bits; a linear congruential generator seeded with it draws the next shard count at
which the key would move.  No ring or lookup table exists, and with one more shard a row
either stays or goes to the new shard, which happens with probability 1/(n+1).

Defined cases: a null key hashes like a fixed value and takes one shard; a null text has
size 8 and checksum 0; repeated rows share a shard and get different slots; an empty table
gives an empty result.  Columns beside the key are carried unchanged, and the names
``shard``, ``grown_shard`` and ``slot`` are replaced where the input has them.
"""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Multiplier of the generator in the published algorithm (fixed value).
LCG = 2862933555777941757
TWO64 = Decimal(1 << 64)
#: Rows that one sort of the slot numbering holds on average.
BLOCK_ROWS = 4096


def _unsigned(c: Column) -> Column:
    c = c.cast("decimal(20,0)")
    return F.when(c < 0, c + F.lit(TWO64).cast("decimal(20,0)")).otherwise(c).cast("decimal(20,0)")


def _draw(k: Column) -> Column:
    # exact in decimal(38,0): the product stays below 2**64 * 2**62
    product = k * F.lit(LCG).cast("decimal(19,0)") + F.lit(1).cast("decimal(1,0)")
    return (product % F.lit(TWO64).cast("decimal(20,0)")).cast("decimal(20,0)")


def jump_shards(key_hash: Column, shards: int) -> Column:
    """Struct ``(shard, grown_shard)``: the shard among ``shards`` and among ``shards + 1``.

    The jumps do not depend on the number of shards, so one walk gives both: the last
    position below ``shards`` and the last position below ``shards + 1``.
    """
    if shards < 1:
        raise ValueError("shards must be positive")

    def step(s: Column, _: Column) -> Column:
        at = s["next"]
        jumped = ((at + 1) * (F.lit(float(1 << 31)) / (F.floor(
            s["k"] / F.lit(1 << 33).cast("decimal(11,0)")).cast("double") + 1))).cast("long")
        moved = F.struct(_draw(s["k"]).alias("k"), jumped.alias("next"),
                         F.when(at < shards, at).otherwise(s["shard"]).alias("shard"), at.alias("grown"))
        return F.when(at <= shards, moved).otherwise(s)

    start = F.struct(_draw(_unsigned(key_hash)).alias("k"), F.lit(0).cast("long").alias("next"),
                     F.lit(0).cast("long").alias("shard"), F.lit(0).cast("long").alias("grown"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(shards)), start, step,
                       lambda s: F.struct(s["shard"].cast("int").alias("shard"), s["grown"].cast("int").alias("grown_shard")))


def _fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of ``df`` has them."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name in taken:
            name = "_" + name
        out.append(name)
    return out


def assign_shards(df: DataFrame, key: str, shards: int) -> DataFrame:
    """Add ``shard`` and ``grown_shard`` for every row: a projection, no shuffle.

    The key is hashed as text, so an id has one shard whether its column is an integer, a long or a string."""
    jump, = _fresh(df, "_jump")
    jumps = df.withColumn(jump, jump_shards(F.xxhash64(F.col(key).cast("string")), shards))
    return jumps.withColumns({"shard": F.col(f"{jump}.shard"), "grown_shard": F.col(f"{jump}.grown_shard")}).drop(jump)


def number_slots(rows: DataFrame, shards: int, shard: str = "shard", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add ``slot``: 0, 1, 2 ... within each shard, without sorting a shard in one task.

    Equal rows are counted before the shuffle, so a row repeated any number of times is one
    record.  Each shard is cut into blocks by a hash of the whole row; a block is sorted by
    itself, and the running total of the block sizes gives its first slot.
    """
    cols = rows.columns
    copies, block, first, total, base, from_, i, s_, b_ = _fresh(rows, "_copies", "_block", "_first", "_total", "_base", "_from", "_i", "_s", "_b")
    per_shard = max(1, math.ceil(rows.count() / (block_rows * shards)))
    runs = (rows.groupBy(*cols).agg(F.count(F.lit(1)).alias(copies))
            .withColumn(block, F.pmod(F.xxhash64(F.lit("slot"), *cols), F.lit(per_shard))))
    totals = runs.groupBy(shard, block).agg(F.sum(copies).alias(total))
    before = Window.partitionBy(shard).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col(shard).alias(s_), F.col(block).alias(b_), F.coalesce(F.sum(total).over(before), F.lit(0)).alias(base))
    inside = Window.partitionBy(shard, block).orderBy(*cols).rowsBetween(Window.unboundedPreceding, -1)
    placed = (runs.withColumn(first, F.coalesce(F.sum(copies).over(inside), F.lit(0)))
              .join(totals, F.col(shard).eqNullSafe(F.col(s_)) & (F.col(block) == F.col(b_))))
    # a long run of equal rows is opened in steps, so no array grows with it
    step = F.lit(10_000)
    return (placed.withColumn(from_, F.explode(F.sequence(F.lit(0).cast("long"), F.col(copies) - 1, step.cast("long"))))
            .withColumn(i, F.explode(F.sequence(F.col(from_), F.least(F.col(from_) + step, F.col(copies)) - 1)))
            .select(*[c for c in cols if c != "slot"], (F.col(base) + F.col(first) + F.col(i)).alias("slot")))


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """The digest of every document: its size, checksum, shard, slot and shard among one more."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    digest = docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
                         F.crc32(text.cast("binary")).alias("text_crc32"))
    placed = number_slots(assign_shards(digest, "doc_id", shards), shards)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                         F.col("slot").cast("long").alias("slot"), "grown_shard")


def write_shards(rows: DataFrame, path: str) -> None:
    """Write rows that carry ``shard`` as one folder a shard; a shard may take many files."""
    rows.write.partitionBy("shard").parquet(path)
