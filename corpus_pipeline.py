"""A training-data pipeline over the documents: five stages, each one operator
of ``parley.llm``.

A stage takes (spark, docs, sf_dir) and returns what it keeps, with the
columns of documents; the last returns the packed sequences.  ``run`` writes
each stage's result as Parquet in the shared checkpoint folder and reads it
again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parley.llm import ngram_join, packing, quality_classifier, quality_rules, source_mixing
from parley.llm.common import read_table, written


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality_classifier.keep_documents(docs, read_table(spark, sf_dir, "labels", "doc_id", "quality"))


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.keep_documents(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return ngram_join.one_per_component(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source mix takes them."""
    return source_mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_classifier", classify),
    ("quality_rules", apply_rules),
    ("ngram_join", deduplicate),
    ("source_mixing", mix),
    ("best_fit_packing", pack),
]

# A trained classifier and a tokenizer are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
