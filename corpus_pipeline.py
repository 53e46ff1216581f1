"""The corpus pipeline: filters, deduplicates and packs ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's ``docs``. All but the last return the columns they were given, whatever
else these hold beside ``doc_id`` and ``text``. Models are learned from the labels of the documents
that reach the stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from starbrook.llm import exact_dedup, near_dedup, packing, quality_rules, toxicity
from starbrook.llm.bpe import Ranks
from starbrook.session import scratch_path
from starbrook.sources import files


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the learned decision list."""
    return quality_rules.keep_good(docs, quality_rules.learn_from(spark, docs, sf_dir))


def harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half."""
    return toxicity.keep_clean(docs, toxicity.learn_from(spark, docs, sf_dir))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that of the largest id."""
    return exact_dedup.drop_repeats(docs)


def different(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, that of the smallest id."""
    return near_dedup.drop_copies(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    ranks = Ranks.from_tokenizers(public_tokenizers.path(packing.VOCABULARY))
    return packing.pack(packing.pieces(docs, ranks))


STAGES = [
    ("quality_rules", good),
    ("toxicity", harmless),
    ("exact_dedup", distinct),
    ("near_dedup", different),
    ("packing", packed),
]

# learned models, signatures and token ids have no SQL; tests/llm compares with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, keep: bool = False) -> DataFrame:
    """All stages over ``documents``. What a stage wrote is deleted when the next one has written,
    unless ``keep`` asks for it."""
    docs, before = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before and not keep:
            files.delete(spark, before)
        before = path
    return docs
