"""Corpus curation in five stages, each written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from brindle.llm import stages
from brindle.llm.common import drop_written, written

#: No SQL can express the language model of the first stage; every stage's rows and the run's are tested against brute force.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents with a main language."""
    return stages.with_known_language(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes later copies of repeated line runs."""
    return stages.without_copied_lines(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates."""
    return stages.without_near_copies(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as its source's target weight asks."""
    return stages.mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into length buckets and batches."""
    return stages.packed(docs)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("ngram_join", ngram_join), ("source_mixing", source_mixing), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage has read is deleted once the next one is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
        if before is not None:
            drop_written(before)
        before = docs
    return docs
