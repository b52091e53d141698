"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all that the one before
kept; ``run`` writes every stage's rows and reads them again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rosterlake.llm import mixing, packing, quality, simhash, suffixes
from rosterlake.llm.queries import tokenizer_path
from rosterlake.session import configure, cut


# bytes of a repeated passage that goes: less than passages of 50 words have, as a rule
PASSAGE_BYTES = 200


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rules and isolation forest; rejected documents go."""
    return quality.keep_good(docs, configure(spark).read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash groups; the smallest id of each stays."""
    configure(spark)
    return simhash.keep_one(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of passages of ``PASSAGE_BYTES`` that stand elsewhere too go."""
    configure(spark)
    return suffixes.remove_repeats(docs, PASSAGE_BYTES)


def mixed_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks."""
    configure(spark)
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with sequence and offset."""
    configure(spark)
    return packing.packed_documents(docs, tokenizer_path())


STAGES = [
    ("quality rules", good_documents),
    ("near copies", one_of_near_copies),
    ("repeated passages", without_repeated_passages),
    ("mixing", mixed_to_weights),
    ("packing", packed),
]

# no stage but the fixed rules of the first can be put in SQL; tested by brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
