"""From raw documents to packed training sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandforge.llm.common import Stage
from strandforge.llm.decontamination import benchmark_leaks
from strandforge.llm.line_dedup import dedup_documents
from strandforge.llm.ngram_join import ngram_jaccard_components
from strandforge.llm.packing import pack_documents, word_vocabulary
from strandforge.llm.quality import keep_quality


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return keep_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated line chunks; those of which nothing is left go."""
    return dedup_documents(docs)


def _without(spark: SparkSession, docs: DataFrame, found: DataFrame) -> DataFrame:
    """The documents whose ids are not among those found; the ids are written first, so that few of them never shuffle the texts."""
    ids = Stage(spark, "found").write(found.select("doc_id").distinct())
    return docs.join(ids, "doc_id", "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id."""
    groups = ngram_jaccard_components(docs)
    return _without(spark, docs, groups.where("doc_id <> component_id"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return _without(spark, docs, benchmark_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 tokens."""
    pieces = pack_documents(docs, word_vocabulary())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("decontamination", decontaminate), ("packing", packing)]

#: The classifier and the shingle hashes have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written before the next reads it."""
    stage = Stage(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage.write(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
