"""The named queries of this subpackage: thin digests of the operators over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from pitchside.llm import (
    bpe, cotraining, decontam, lexical, periodic_runs, quality_rules, sharding, simhash, suffix_dedup, suffix_tree_lm, topk, toxicity, url_reputation,
)
from pitchside.llm.common import crc_mod, read_table, tokenizer_path


def op1_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_mod("doc_id", 5) == 1
    scored = suffix_tree_lm.score_corpus(read_table(spark, sf_dir, "documents"), held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(simhash.near_duplicates(read_table(spark, sf_dir, "documents")))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.digest(decontam.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = read_table(spark, sf_dir, "documents"), crc_mod("doc_id", 4) == 2
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op6_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return cotraining.score(docs, cotraining.train(docs, read_table(spark, sf_dir, "labels")))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the labels name documents; a page's outcome is the label of the document with its id
    labels = read_table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), F.when(F.col("quality") == 0, 1).when(F.col("quality").isNotNull(), 0).alias("bad"))
    return url_reputation.judge_urls(read_table(spark, sf_dir, "pages"), labels)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(read_table(spark, sf_dir, "documents"), tokenizer_path(), outputs=())


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_digest(read_table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(read_table(spark, sf_dir, "documents"), ["doc_id"])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_planted_runs(read_table(spark, sf_dir, "documents"))
    return periodic_runs.digest(periodic_runs.collapse_runs(docs, texts=False))


QUERIES = {
    "op1_suffix_tree_lm": op1_suffix_tree_lm,
    "op2_topk_search": op2_topk_search,
    "op3_simhash": op3_simhash,
    "op4_decontamination": op4_decontamination,
    "op5_toxicity": op5_toxicity,
    "op6_cotraining": op6_cotraining,
    "op7_url_filter": op7_url_filter,
    "op8_bpe": op8_bpe,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_sharding": op10_sharding,
    "op11_lexical_search": op11_lexical_search,
    "op12_quality_rules": op12_quality_rules,
    "op13_periodic_runs": op13_periodic_runs,
    "pipeline": corpus_pipeline.run,
}
ORACLES = {
    "op2_topk_search": topk.ORACLE_SQL,
    "op4_decontamination": decontam.ORACLE_SQL,
    "op7_url_filter": url_reputation.ORACLE_SQL,
    "op9_suffix_dedup": suffix_dedup.ORACLE_SQL,
    "op11_lexical_search": lexical.ORACLE_SQL,
}
