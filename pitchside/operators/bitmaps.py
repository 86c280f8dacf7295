"""Exact distinct counts by mergeable bitmaps.

A distinct count of a key in an ordinary aggregate multiplies every row by the number of such
counts and shuffles (group, key) pairs.  Ids are small whole numbers, so a set of them is a
bitmap: ids are cut into buckets of 32,768, a bucket's members are bits of 4 KB.  A task folds its
rows into one bitmap per group and bucket before anything moves; bitmaps of a bucket are united
after the shuffle and their bits counted.  An id counts once however often it occurs.

What is shuffled follows groups times buckets, never rows: with ids in the order of the table, a
task of n rows holds about n / 32,768 buckets.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Measure:
    """An aggregate in two steps: ``parts`` over rows, each added up by its ``merge``, and ``finish`` of the merged parts."""

    parts: tuple[Column, ...]
    merge: tuple
    finish: object

    def map(self, f) -> "Measure":
        """The measure followed by a function of its result."""
        return Measure(self.parts, self.merge, lambda *p: f(self.finish(*p)))


def _first(p: Column) -> Column:
    return p


def rows() -> Measure:
    return Measure((F.count(F.lit(1)),), (F.sum,), _first)


def total(c: Column) -> Measure:
    return Measure((F.sum(c),), (F.sum,), _first)


def largest(c: Column) -> Measure:
    return Measure((F.max(c),), (F.max,), _first)


def average(c: Column) -> Measure:
    return Measure((F.sum(c), F.count(c)), (F.sum, F.sum), lambda s, n: F.when(n > 0, s / n))


def aggregate(frame: DataFrame, keys: Mapping[str, Column], distinct: Mapping[str, Column], measures: Mapping[str, Measure]) -> DataFrame:
    """``keys``, the number of distinct non-null whole numbers of every ``distinct`` column, and the ``measures``."""
    ids, marks = list(distinct), {k: F.bitmap_bucket_number(c) for k, c in distinct.items()}
    rowed = frame.select(*[c.alias(k) for k, c in keys.items()],
                         *[b.alias(f"_bucket_of_{i}") for i, b in enumerate(marks.values())],
                         *[F.bitmap_bit_position(c).alias(f"_place_of_{i}") for i, c in enumerate(distinct.values())],
                         *[F.col(f"`{c}`") for c in frame.columns if c not in keys])
    parts = [(name, k, part) for name, m in measures.items() for k, part in enumerate(m.parts)]
    # one bucket per id column in a group of the first step; null ids get a bucket of their own
    first = rowed.groupBy(*keys, *[f"_bucket_of_{i}" for i in range(len(ids))]).agg(
        *[F.bitmap_construct_agg(F.col(f"_place_of_{i}")).alias(f"_bitmap_of_{i}") for i in range(len(ids))],
        *[part.alias(f"_{name}_{k}") for name, k, part in parts])
    # from here on there is a row for a group and its buckets: unite each column's bitmaps, then count
    sets = F.array(*[F.struct(F.lit(i).alias("of"), F.col(f"_bucket_of_{i}").alias("bucket"), F.col(f"_bitmap_of_{i}").alias("map")) for i in range(len(ids))])
    opened = first.select(*keys, F.explode(sets).alias("_s"), *[f"_{name}_{k}" for name, k, _ in parts])
    opened = opened.select(*keys, "_s.*", *[F.when(F.col("_s.of") == 0, F.col(f"_{name}_{k}")).alias(f"_{name}_{k}") for name, k, _ in parts])
    merged = opened.groupBy(*keys, "of", "bucket").agg(
        F.bitmap_or_agg("map").alias("_map"),
        *[m.merge[k](f"_{name}_{k}").alias(f"_{name}_{k}") for name, m in measures.items() for k in range(len(m.parts))])
    counted = merged.withColumn("_n", F.when(F.col("bucket").isNotNull(), F.bitmap_count("_map")))
    final = counted.groupBy(*keys).agg(
        *[F.coalesce(F.sum(F.when(F.col("of") == i, F.col("_n"))), F.lit(0)).alias(k) for i, k in enumerate(ids)],
        *[m.merge[k](f"_{name}_{k}").alias(f"_{name}_{k}") for name, m in measures.items() for k in range(len(m.parts))])
    finished = {name: m.finish(*[F.col(f"_{name}_{k}") for k in range(len(m.parts))]) for name, m in measures.items()}
    return final.select(*keys, *ids, *[c.alias(name) for name, c in finished.items()])


def distinct_count(frame: DataFrame, ids: Column) -> DataFrame:
    """One row: how many different whole numbers ``ids`` holds."""
    one = frame.groupBy(F.bitmap_bucket_number(ids).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(ids)).alias("map"))
    return one.agg(F.coalesce(F.sum(F.when(F.col("bucket").isNotNull(), F.bitmap_count("map"))), F.lit(0)).alias("distinct_ids"))

