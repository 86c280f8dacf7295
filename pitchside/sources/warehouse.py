"""Star tables stored in buckets, so that work by key needs no exchange.

A table bucketed by a column keeps all rows of a value in one of ``buckets`` files sets, sorted.
Counting a key, checking it against a dimension bucketed alike, and joining a dimension beyond the
broadcast bound then read the buckets side by side; only results move.  The number of buckets
follows the measured size of the largest table and is the same for all tables of a database.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchside.plans.joins import row_bytes

BUCKET_BYTES = 128 * 1024 * 1024


def bucket_count(tables: Mapping[str, DataFrame], least: int = 1) -> int:
    """Buckets of about ``BUCKET_BYTES`` for the largest table (its measured size, else one pass over it)."""
    def size(df: DataFrame) -> int:
        known = getattr(df, "_pitchside_bytes", None)
        return known if known is not None else df.agg(F.coalesce(F.sum(row_bytes(df)), F.lit(0))).first()[0]

    return max(least, *[-(-size(df) // BUCKET_BYTES) for df in tables.values()])


def save_bucketed(tables: Mapping[str, DataFrame], keys: Mapping[str, str], database: str, path: str, buckets: int | None = None) -> dict[str, DataFrame]:
    """Store each table in ``database`` under ``path``, bucketed and sorted by its column in ``keys``; returns the stored tables."""
    spark = next(iter(tables.values())).sparkSession
    n = buckets or bucket_count(tables)
    out = {}
    for name, df in tables.items():
        # rows of a bucket meet in one task first, else every task would write a file for every bucket
        dealt = df.repartition(n, keys[name])
        (dealt.write.mode("overwrite").format("parquet").option("path", f"{path.rstrip('/')}/{name}")
         .bucketBy(n, keys[name]).sortBy(keys[name]).saveAsTable(f"{database}.{name}"))
        out[name] = spark.table(f"{database}.{name}")
    return out


def drop_bucketed(spark, database: str) -> None:
    """Forget the tables of a database; the files stay under their path."""
    for t in spark.catalog.listTables(database):
        if not t.isTemporary:
            spark.sql(f"DROP TABLE {database}.{t.name}")
    spark.sql(f"DROP DATABASE {database}")


def key_faults(table: DataFrame, key: str) -> DataFrame:
    """One row: null_keys and duplicate_keys of a table bucketed by its key; no row is shuffled."""
    groups = table.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("_n"))), F.lit(0)).cast("bigint").alias("null_keys"),
                      F.count_if(F.col(key).isNotNull() & (F.col("_n") > 1)).alias("duplicate_keys"))


def orphans(fact: DataFrame, foreign_key: str, dimension: DataFrame, key: str) -> DataFrame:
    """One row: orphan_rows, facts whose key the dimension lacks.  Both are bucketed by the key and merged bucket by bucket."""
    known = dimension.select(F.col(key).alias("_known"))
    return (fact.where(F.col(foreign_key).isNotNull()).select(foreign_key)
            .join(known.hint("merge"), F.col(foreign_key) == F.col("_known"), "left_anti").agg(F.count(F.lit(1)).alias("orphan_rows")))


def attach(fact: DataFrame, foreign_key: str, dimension: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The fact with columns of a dimension of any size, joined bucket by bucket."""
    side = dimension.select(F.col(key).alias("_known"), *columns).hint("merge")
    return fact.join(side, F.col(foreign_key) == F.col("_known"), "left").drop("_known")
