"""The queries of this subpackage, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import cover_tree, exact_dedup, kneser_ney, language_id, line_dedup, mixing, ngram_join, packing, pii, token_counts


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.lm_scores(_docs(spark, sf_dir))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_docs(spark, sf_dir))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_docs(spark, sf_dir))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(_docs(spark, sf_dir))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_docs(spark, sf_dir))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(_docs(spark, sf_dir))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.token_counts(_docs(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(_docs(spark, sf_dir))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(_docs(spark, sf_dir)).select("doc_id", "text", "n_lines", "n_removed", "removed")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_topk_search, op2_lm_scoring, op3_source_mixing, op4_exact_dedup, op5_language_id, op6_packing, op7_pii, op8_token_counts, op9_ngram_join, op10_line_dedup)}


def oracle_sql() -> dict[str, str]:
    return {"op1_topk_search": cover_tree.SQL, "op3_source_mixing": mixing.SQL, "op4_exact_dedup": exact_dedup.SQL, "op9_ngram_join": ngram_join.SQL}
