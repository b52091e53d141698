"""Registered queries of the operators, on the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rosterlake.llm import (
    centroids, mixing, ngram_lm, packing, preference, private, quality, simhash, suffixes, toxicity, turns,
    warc, winnow)
from rosterlake.llm.sql import SQL
from rosterlake.session import configure

__all__ = ["SPARK", "SQL"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers
    return str(public_tokenizers.path("word_bpe_49k.json"))


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.edited_likeness(_table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(_table(spark, sf_dir, "documents"))


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = mixing.mix(_table(spark, sf_dir, "documents"))
    return made.select("doc_id", "size", "source_size", "target",
                       (F.col("size") * F.col("copies")).alias("taken"))


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.removal_report(_table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = ngram_lm.backoff_scores(_table(spark, sf_dir, "documents"))
    return made.withColumn("mean_log10", F.round("mean_log10", 6))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(_table(spark, sf_dir, "pages"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxic_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(_table(spark, sf_dir, "documents"), tokenizer_path())


def op10_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference.format_pairs(preference.swapped_answers(_table(spark, sf_dir, "conversations")))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(_table(spark, sf_dir, "embeddings"))


def op12_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.repaired_conversations(_table(spark, sf_dir, "conversations"))


def op13_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private.personal_data(_table(spark, sf_dir, "documents"))


SPARK: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_fingerprints, op2_simhash, op3_mix, op4_repeats, op5_quality, op6_backoff, op7_warc,
        op8_toxicity, op9_packing, op10_preference, op11_centroids, op12_turns, op13_private)}
