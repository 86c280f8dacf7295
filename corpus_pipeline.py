"""The corpus pipeline: quality, near duplicates, repeated passages, benchmark leaks, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's ``docs``.  All stages but the last keep the columns of
``documents``; the last returns doc_id, n_tokens, the ids (little-endian unsigned 32-bit integers)
and the checksums of ids and decoded text.

Defined cases: each stage has those of its operator; null texts count as empty, a row whose
text becomes empty stays, repeated rows of an id are one document after the second stage while
rows without an id are judged each by its text, and an empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pitchside.llm import bpe, cotraining, decontam, simhash, suffix_dedup
from pitchside.llm.common import materialize, read_table, tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject."""
    return cotraining.keep_good(docs, cotraining.train(docs, read_table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of every group of near duplicates (3-word shingles, at most 3 differing bits)."""
    return simhash.keep_one(docs, shingle=3, radius=3)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a document with a smaller id also holds."""
    return suffix_dedup.remove_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontam.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with the checksums of the round trip."""
    return bpe.encode_documents(docs, tokenizer_path(), outputs=("ids",))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("passages", passages),
    ("decontamination", decontamination),
    ("token_ids", token_ids),
]

#: The classifier, the suffix sort and the tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
