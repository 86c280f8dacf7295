"""Equal rows found by fingerprint, confirmed by comparison.

Grouping a table by all its columns moves every row whole.  Here only a 128-bit digest of each row
is shuffled; rows whose digest occurs once are different from all others and stay where they are.
The rows of the repeated digests, and only those, are grouped by all columns, so two different rows
that share a digest are still told apart.  Nulls compare equal.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchside.plans.joins import can_broadcast

Digest = Callable[[list[str]], list[Column]]


def row_digest(columns: list[str]) -> list[Column]:
    """Two 64-bit hashes of a row; nulls are marked, so that they do not vanish from the hash."""
    parts = [p for c in columns for p in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return [F.xxhash64(*parts), F.xxhash64(F.lit("second"), *reversed(parts))]


def _marked(df: DataFrame, digest: Digest) -> tuple[DataFrame, list[str]]:
    hashes = digest(df.columns)
    names = [f"_digest_{k}" for k in range(len(hashes))]
    return df.select("*", *[h.alias(n) for h, n in zip(hashes, names)]), names


def _repeated(df: DataFrame, digest: Digest) -> tuple[DataFrame, DataFrame, list[str]]:
    """The marked rows and the digests that occur more than once."""
    from pitchside.plans.pipeline import materialize

    marked, names = _marked(df, digest)
    repeated = marked.groupBy(*names).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*names)
    return marked, materialize(repeated, "repeated_digests"), names


def _semi(marked: DataFrame, repeated: DataFrame, names: list[str], how: str) -> DataFrame:
    # few digests (their number was observed while they were written) go to the rows; many, beyond the bound, meet them in a shuffle
    return marked.join(F.broadcast(repeated) if can_broadcast(repeated) else repeated, names, how).drop(*names)


def duplicate_counts(df: DataFrame, digest: Digest = row_digest) -> DataFrame:
    """One row: total_records, duplicate_records (rows minus distinct rows)."""
    marked, repeated, names = _repeated(df, digest)
    suspects = _semi(marked, repeated, names, "left_semi")
    groups = suspects.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    surplus = groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicate_records"))
    return df.agg(F.count(F.lit(1)).alias("total_records")).withColumn("duplicate_records", surplus.scalar())


def distinct_rows(df: DataFrame, digest: Digest = row_digest) -> DataFrame:
    """``df`` with one of each group of equal rows."""
    marked, repeated, names = _repeated(df, digest)
    if not repeated._pitchside_rows:
        return df
    return _semi(marked, repeated, names, "left_anti").unionByName(_semi(marked, repeated, names, "left_semi").dropDuplicates())
