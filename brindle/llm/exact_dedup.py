"""Exact deduplication by skew-safe combining, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import heavy_join, squeezed, text_of, written

SALTS = 16


def sha256_hex(text: Column) -> Column:
    return F.sha2(text, 256)


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS, digest: Callable[[Column], Column] = sha256_hex) -> DataFrame:
    """One row per input row: ``id_col, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after deleting the characters of ``[\\x20\\x09-\\x0D]``; null counts as empty. Of a
    group the row with the most code points stays, then the smallest id; null ids come last. Three combining steps, each
    grouping by digest *and* full content: inside each input partition (the map side of the first aggregate), by digest
    and salt, and over the salts. A group of any size thus arrives at the last step as at most ``salts`` rows.

    The rows find their group by digest alone, those of large groups spread over several tasks. That is exact while every digest stands for one content, which the last
    step has counted; contents that share a digest are joined on the content too.
    Rows that repeat an id within a group are all kept or all dropped. An empty table gives an empty result; other
    columns are not read.
    """
    text = text_of(text_col)
    rows = df.select(F.col(id_col).alias("_id"), text.alias("_text")).withColumn("_norm", squeezed(F.col("_text")))
    rows = rows.withColumn("_dig", digest(F.col("_norm")))
    best = F.struct((-F.char_length("_text")).alias("n"), F.col("_id").isNull().alias("none"), F.col("_id").alias("id"))
    salted = (
        rows.select("_dig", F.pmod(F.xxhash64("_id"), F.lit(salts)).cast("int").alias("_salt"), "_norm", best.alias("_best"))
        .groupBy("_dig", "_salt", "_norm")
        .agg(F.min("_best").alias("_best"), F.count(F.lit(1)).alias("_n"))
    )
    contents = salted.groupBy("_dig", "_norm").agg(F.min("_best").alias("_best"), F.sum("_n").alias("_n"))
    groups = written(
        contents.groupBy("_dig").agg(F.count(F.lit(1)).alias("_contents"), F.min("_best").alias("_best"), F.sum("_n").alias("_n")),
        "exact-groups",
    )
    single = groups.where("_contents = 1").select("_dig", F.col("_best.id").alias("keep_id"), F.col("_n").alias("group_size"))
    shared = groups.where("_contents > 1").select("_dig")
    keyed = rows.select("_id", "_dig")
    if shared.isEmpty():
        found = heavy_join(keyed, single, "_dig", "group_size")
    else:
        apart = contents.join(shared, "_dig", "left_semi").select("_dig", "_norm", F.col("_best.id").alias("keep_id"), F.col("_n").alias("group_size"))
        clashing = rows.join(shared, "_dig", "left_semi").select("_id", "_dig", "_norm").join(apart, ["_dig", "_norm"]).select("_id", "_dig", "keep_id", "group_size")
        found = heavy_join(keyed, single, "_dig", "group_size").select("_id", "_dig", "keep_id", "group_size").unionByName(clashing)
    return found.select(F.col("_id").alias(id_col), "keep_id", "group_size", F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("_dig").alias("text_sha256"))


SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents
), g AS (
  SELECT doc_id, norm, first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""
