"""The corpus pipeline: stages that turn ``documents`` into packed training sequences."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hrflow.llm.exact_dedup import drop_exact_duplicates
from hrflow.llm.packing import pack
from hrflow.llm.repeats import without_repeats
from hrflow.llm.simhash_dedup import drop_simhash_duplicates
from hrflow.llm.toxicity import drop_toxic, train_toxicity

#: Documents that score at least this much are rejected.
TOXIC_FROM = 0.3
#: Bytes of the shortest passage that is cut: 50 short words.
PASSAGE = 200


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model of the labelled ones among them rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return drop_toxic(docs, train_toxicity(docs, labels), TOXIC_FROM)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints (three-word shingles) that differ in at most 3 bits stays."""
    return drop_simhash_duplicates(docs, width=3, distance=3)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of ``PASSAGE`` bytes and more that occur again are cut out; all documents stay, with their new length."""
    return without_repeats(docs, length=PASSAGE, gram=32).withColumn("n_chars", F.char_length("text").cast("long"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens, one row a piece."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", near_dedup),
    ("suffix-array dedup", suffix_array_dedup),
    ("best-fit packing", packing),
]

#: SQL cannot express the toxicity model nor the packing; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages, in order, to the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
