"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import line_dedup
from .context_mixing import mixing_scores
from .decontamination import benchmark_leaks
from .embedding_dedup import embedding_components
from .language_id import identify_languages
from .ngram_join import ngram_jaccard_components
from .oracles import ORACLES  # noqa: F401
from .packing import pack_documents, word_vocabulary
from .quality import classify_quality
from .token_counts import token_counts
from .url_filter import DEFAULT_PATTERNS, filter_urls, site_rule


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_components(_table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_table(spark, sf_dir, "documents"), word_vocabulary())


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(_table(spark, sf_dir, "documents"), word_vocabulary())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_components(_table(spark, sf_dir, "embeddings"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "documents"))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


SITE_RULES = [site_rule("block", "net"), site_rule("allow", "example.net", "/en/"), site_rule("block", "example.com", "/de/"), site_rule("allow", "org", "/fr/")]


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(_table(spark, sf_dir, "pages"), SITE_RULES + DEFAULT_PATTERNS)


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing_scores(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_token_counts": op2_token_counts,
    "op3_packing": op3_packing,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_line_dedup": op5_line_dedup,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_language_id": op7_language_id,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_url_filters": op9_url_filters,
    "op10_lm_scoring": op10_lm_scoring,
}
