"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchside.session import scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, tag: str, *by: str, compression: str = "snappy") -> DataFrame:
    """Write to the shared checkpoint folder and read back: cuts the lineage, so a lost
    executor costs a re-read and not a re-run of everything upstream.  ``by``: a folder for each value of these columns."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", tag)
    df.write.partitionBy(*by).parquet(path, compression=compression)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def release(df: DataFrame | None = None, part: str = "") -> None:
    """Delete a table that ``materialize`` wrote (or one folder of it) and nothing reads any more, and let Spark drop the exchanges of plans
    that nobody holds: their files otherwise stay until the driver happens to collect its garbage."""
    spark = SparkSession.getActiveSession()
    if df is not None:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{df._written_to}/{part}" if part else df._written_to)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    gc.collect()
    spark._jvm.System.gc()


def text_rows(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` as long and ``text`` as string (null: empty), and the named columns; nothing else is read."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more)


def crc_mod(key: str, n: int):
    """crc32 of an id written as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % n


def tokenizer_path() -> str:
    """The tokenizer file that the queries use; the operator takes any path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
