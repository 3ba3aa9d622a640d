"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import small, text_of, word_count, written

BINS = 4096
#: Rows of one source's boundary bin that are sorted together; larger bins are divided again.
SORTED_ROWS = 20_000


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``sizes`` (``_key, source_size``; one row per source, keys in code-point order) with ``target``.

    Sources share ``share`` times all sizes by weight; a target stops at ``most`` times its source's size and the excess
    goes to the others by weight. Filling in the order of cap per weight gives what repeated resharing ends in.
    """
    n = len(weights)
    order = Window.orderBy("_key")
    sizes = sizes.withColumn("_i", (F.row_number().over(order) - 1) % n)
    sizes = sizes.withColumn("_w", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_i") + 1).cast("int")).cast("double"))
    sizes = sizes.withColumn("_cap", F.lit(most) * F.col("source_size"))
    fill = Window.orderBy(F.col("_cap") / F.col("_w"), "_key")
    before, everything = fill.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(0))
    level = (F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / (F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0.0)))
    sizes = sizes.withColumn("_level", level).withColumn("_open", F.when(F.col("_cap") > F.col("_level") * F.col("_w"), F.col("_level")))
    first_open = F.first("_open", ignorenulls=True).over(fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    sizes = sizes.withColumn("_fill", first_open)
    return sizes.withColumn("target", F.when(F.col("_open").isNull(), F.col("_cap")).otherwise(F.col("_fill") * F.col("_w"))).select("_key", "source_size", "target")


def uniform(key: Column, seed: str) -> Column:
    """A number strictly between 0 and 1 that depends on the key and the seed alone (52 bits of SHA-256)."""
    bits = F.conv(F.substring(F.sha2(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("null"))), 256), 1, 13), 16, 10)
    return (bits.cast("double") + 0.5) / F.lit(float(1 << 52))


def mix_sources(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: str = "mix", sorted_rows: int = SORTED_ROWS, keep: Column | None = None) -> DataFrame:
    """One row per input row: ``id_col, size, source_size, target, copies, taken``.

    Size is the number of words; null texts have 0, a null source is a source of its own, last in order. A document
    expects ``target / source_size`` copies: the whole part is allocated for certain, the rest is the inclusion
    probability of a Pareto order sample. Documents are ranked within their source by (u / (1-u)) / (p / (1-p)), u being
    a uniform number of the id, and the sample has a fixed size in words: ranks are taken up to the one that ends nearest
    the source's remaining target, so that a source misses its target by half a document at most.

    The cut is found without ordering a source: words are summed by source and bin of the rank, only the bin that holds
    the cut is opened, and a bin of more than ``sorted_rows`` rows is divided again. Equal ids have equal ranks and go by
    size. A source without words has target 0. An empty table gives an empty result; other columns are not read. ``keep``
    is a column that goes with each row into the result, as ``kept``.
    """
    key = F.when(F.col(source_col).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(source_col).cast("string")))
    rows = df.select(F.col(id_col).alias("_id"), key.alias("_key"), word_count(text_of(text_col)).alias("size"), uniform(F.col(id_col), seed).alias("_u"), (F.lit(None).cast("int") if keep is None else keep).alias("_keep"))
    rows = written(rows, "mix-rows")
    sizes = rows.groupBy("_key").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, share, most)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    targets = targets.withColumn("_whole", F.floor(ratio)).withColumn("_p", ratio - F.floor(ratio))
    targets = written(targets.withColumn("_rest", F.col("target") - F.col("_whole") * F.col("source_size")), "mix-targets")
    odds = (F.col("_u") / (1 - F.col("_u"))) / (F.col("_p") / (1 - F.col("_p")))
    ranked = rows.join(small(targets), "_key").withColumn("_q", F.when(F.col("_p") > 0, odds))
    drawn = ranked.where("_p > 0").select("_key", "_id", "size", "_keep", "_q", "_rest", (F.col("_q") / (1 + F.col("_q"))).alias("_v"))

    scale, left, base = 1, drawn, None  # base: words before the opened bin
    opened = None
    for _ in range(4):
        scale *= BINS
        bin_ = F.floor(F.col("_v") * F.lit(float(scale)))
        start = F.coalesce(F.col("_start"), F.lit(0)) if base is not None else F.lit(0).cast("long")
        sums = left.groupBy("_key", "_rest", bin_.alias("_bin"), *(["_start"] if base is not None else [])).agg(F.sum("size").alias("_words"), F.count(F.lit(1)).alias("_rows"))
        upto = F.sum("_words").over(Window.partitionBy("_key").orderBy("_bin")) + start
        cut = sums.withColumn("_to", upto).withColumn("_from", F.col("_to") - F.col("_words"))
        cut = written(cut.where("_from <= _rest AND _to > _rest").select("_key", "_bin", F.col("_from").alias("_start"), "_rows"), "mix-cut")
        opened = cut if opened is None else opened
        finest, base = cut, cut
        most_rows = cut.agg(F.max("_rows")).first()[0] or 0
        if most_rows <= sorted_rows:
            break
        left = left.drop("_start").withColumn("_bin", bin_).join(small(cut.drop("_rows")), ["_key", "_bin"]).drop("_bin")
    fine = F.floor(F.col("_v") * F.lit(float(scale)))
    placed = drawn.withColumn("_bin", fine).join(small(finest.select("_key", F.col("_bin").alias("_cut"), "_start")), "_key", "left")
    inside = placed.where("_bin = _cut")
    upto = F.sum("size").over(Window.partitionBy("_key").orderBy("_q", "_id", "size").rowsBetween(Window.unboundedPreceding, 0)) + F.col("_start")
    inside = inside.withColumn("_to", upto).withColumn("_pick", (2 * F.col("_to") - F.col("size") <= 2 * F.col("_rest")).cast("long"))
    outside = placed.where("_cut IS NULL OR _bin != _cut").withColumn("_pick", (F.col("_cut").isNull() | (F.col("_bin") < F.col("_cut"))).cast("long"))
    whole_only = ranked.where("_p <= 0").select("_key", "_id", "size", "_keep", F.lit(0).cast("long").alias("_pick"))
    picked = inside.select("_key", "_id", "size", "_keep", "_pick").unionByName(outside.select("_key", "_id", "size", "_keep", "_pick")).unionByName(whole_only)
    out = picked.join(small(targets), "_key").withColumn("copies", F.col("_whole") + F.col("_pick"))
    return out.select(F.col("_id").alias(id_col), "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"), *([] if keep is None else [F.col("_keep").alias("kept")]))


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce('0' || source, '1') AS k, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    (('0x' || substr(sha256('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM documents
), s AS (
  SELECT k, sum(size)::BIGINT AS source_size, CASE (row_number() OVER (ORDER BY k) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::DOUBLE AS w FROM d GROUP BY k
), f AS (
  SELECT *, 2::DOUBLE * source_size AS cap,
    (1.5::DOUBLE * sum(source_size) OVER ()::DOUBLE - coalesce(sum(2::DOUBLE * source_size) OVER (ORDER BY 2::DOUBLE * source_size / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY 2::DOUBLE * source_size / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lvl
  FROM s
), o AS (
  SELECT *, first_value(CASE WHEN cap > lvl * w THEN lvl END IGNORE NULLS) OVER (ORDER BY cap / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS fill FROM f
), t AS (
  SELECT k, source_size, CASE WHEN cap > lvl * w THEN fill * w ELSE cap END AS target FROM o
), r AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size::DOUBLE ELSE 0 END AS ratio FROM t
), q AS (
  SELECT d.doc_id, d.size, r.*, floor(ratio)::BIGINT AS whole, ratio - floor(ratio) AS p, target - floor(ratio) * source_size AS rest,
    CASE WHEN ratio > floor(ratio) THEN (u / (1 - u)) / ((ratio - floor(ratio)) / (1 - (ratio - floor(ratio)))) END AS q
  FROM d JOIN r USING (k)
), c AS (
  SELECT *, sum(size) OVER (PARTITION BY k ORDER BY q, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM q
), z AS (
  SELECT *, whole + CASE WHEN p > 0 AND 2 * upto - size <= 2 * rest THEN 1 ELSE 0 END AS copies FROM c
)
SELECT doc_id, size, source_size, target, copies::BIGINT AS copies, (size * copies)::BIGINT AS taken FROM z
"""
