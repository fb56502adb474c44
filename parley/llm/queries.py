"""The registered queries of this subpackage: each operator over its whole
table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from parley.llm import oracles
from parley.llm.ann_forest import nearest_neighbours
from parley.llm.common import read_table
from parley.llm.html_extract import extract_pages
from parley.llm.language_id import identify_pages
from parley.llm.merkle import FIELDS, merkle_manifest
from parley.llm.ngram_join import jaccard_links
from parley.llm.packing import pack_documents
from parley.llm.quality_classifier import quality_scores
from parley.llm.quality_rules import quality_rules
from parley.llm.sharding import shard_documents
from parley.llm.simhash import simhash_components
from parley.llm.source_mixing import mix_sources
from parley.llm.token_stream import token_files_round_trip
from parley.llm.whitening import whiten


def documents(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents", "doc_id", "text", *more)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(documents(spark, sf_dir, "source"))


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_links(documents(spark, sf_dir))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(read_table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels", "doc_id", "quality")
    return quality_scores(documents(spark, sf_dir), labels)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(documents(spark, sf_dir))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages", "page_id", "url", "html")
    return identify_pages(pages, documents(spark, sf_dir, "lang"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files_round_trip(documents(spark, sf_dir))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(documents(spark, sf_dir))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest(read_table(spark, sf_dir, "documents", *FIELDS))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_rules": op1_quality_rules,
        "op2_source_mixing": op2_source_mixing,
        "op3_nearest_neighbours": op3_nearest_neighbours,
        "op4_ngram_join": op4_ngram_join,
        "op5_best_fit_packing": op5_best_fit_packing,
        "op6_html_extraction": op6_html_extraction,
        "op7_quality_classifier": op7_quality_classifier,
        "op8_sharding": op8_sharding,
        "op9_language_id": op9_language_id,
        "op10_token_files": op10_token_files,
        "op11_simhash": op11_simhash,
        "op12_whitening": op12_whitening,
        "op13_merkle": op13_merkle,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_quality_rules": oracles.QUALITY_RULES,
        "op2_source_mixing": oracles.SOURCE_MIXING,
        "op4_ngram_join": oracles.NGRAM_JOIN,
        "op13_merkle": oracles.MERKLE,
    }
