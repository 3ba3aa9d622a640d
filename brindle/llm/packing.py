"""Packing into length buckets that minimise padding, and token-budget batches inside each bucket."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import text_of, word_count, written

BUCKETS, BUDGET, MAX_LENGTH = 16, 65_536, 8_192
#: Rows of one bucket that one task numbers.
SHARD_ROWS = 50_000


def bucket_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """The bounds (upper ends, inclusive) of at most ``buckets`` buckets with the least padding in total.

    ``lengths`` are distinct and sorted. Dynamic programming over the histogram: the best of k buckets up to length j
    extends the best of k-1 up to some i < j. For each j that is a minimum over lines in j's length with slopes in order,
    so a monotone queue finds it in linear time; all numbers are integers. Ties take the longest last bucket.
    """
    n = len(lengths)
    if not n:
        return []
    c = [0, *np.cumsum(counts).tolist()]
    s = [0, *np.cumsum(lengths * counts).tolist()]
    length = [0, *lengths.tolist()]
    best = [0] + [length[j] * c[j] - s[j] for j in range(1, n + 1)]
    choice = []
    for _ in range(1, min(buckets, n)):
        queue: list[int] = []
        value = lambda i, x: best[i] + s[i] - x * c[i]  # noqa: B023, E731
        after, own, head = list(best), [0] * (n + 1), 0
        for j in range(1, n + 1):
            i = j - 1
            # drop a line that never is lowest between its neighbours
            while len(queue) - head > 1:
                a, b = queue[-2], queue[-1]
                if (best[b] + s[b] - best[a] - s[a]) * (c[i] - c[b]) >= (best[i] + s[i] - best[b] - s[b]) * (c[b] - c[a]):
                    queue.pop()
                else:
                    break
            queue.append(i)
            while len(queue) - head > 1 and value(queue[head + 1], length[j]) < value(queue[head], length[j]):
                head += 1
            i = queue[head]
            after[j], own[j] = value(i, length[j]) + length[j] * c[j] - s[j], i
        best = after
        choice.append(own)
    bounds, j = [length[n]], n
    for own in reversed(choice):
        j = own[j]
        if not j:
            break
        bounds.append(length[j])
    return bounds[::-1]


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS, budget: int = BUDGET, max_length: int = MAX_LENGTH, length: Callable[[Column], Column] = word_count) -> DataFrame:
    """One row per piece: ``id_col, piece, start, n_tokens, bucket_id, bucket_len, batch, slot``.

    A text of more than ``max_length`` tokens is cut into consecutive pieces of that length and a rest; nothing is left
    out. The histogram of all pieces' lengths (at most ``max_length`` cells) goes to the driver, which chooses the
    buckets. A batch of a bucket holds ``budget // bucket_len`` pieces (one at least), padded to ``bucket_len``; only a
    bucket's last batch may hold fewer. Pieces are numbered within a bucket by shards with summed sizes before them, so
    that no task holds a bucket. Texts that are null or without tokens have one row with 0 tokens and nulls for bucket,
    batch and slot. An empty table gives an empty result; other columns are not read.
    """
    rows = df.select(F.col(id_col).alias("_id"), length(text_of(text_col)).cast("long").alias("_n"))
    pieces = F.transform(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("_n") / max_length) - 1, F.lit(0).cast("long"))), lambda p: F.struct(p.alias("piece"), (p * max_length).alias("start"), F.least(F.lit(max_length).cast("long"), F.col("_n") - p * max_length).alias("n_tokens")))
    rows = written(rows.select("_id", F.explode(pieces).alias("x")).select("_id", "x.*"), "pieces")
    histogram = rows.where("n_tokens > 0").groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).orderBy("n_tokens").toPandas()
    bounds = bucket_bounds(histogram["n_tokens"].to_numpy(dtype=np.int64), histogram["n"].to_numpy(dtype=np.int64), buckets)
    shards = int(-(-int(histogram["n"].sum()) // SHARD_ROWS)) or 1
    ends = F.array(*[F.lit(b).cast("long") for b in bounds]) if bounds else F.array().cast("array<long>")
    placed = rows.where("n_tokens > 0").withColumn("bucket_id", F.size(F.filter(ends, lambda b: b < F.col("n_tokens"))))
    placed = placed.withColumn("bucket_len", F.get(ends, F.col("bucket_id"))).withColumn("_shard", F.pmod(F.xxhash64("_id", "piece"), F.lit(shards)).cast("int"))
    sizes = placed.groupBy("bucket_id", "_shard").agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(Window.partitionBy("bucket_id").orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("bucket_id", "_shard", F.coalesce(before, F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("bucket_id", "_shard").orderBy("_id", "piece", "n_tokens")) - 1
    fits = F.greatest(F.floor(F.lit(budget) / F.col("bucket_len")), F.lit(1).cast("long"))
    numbered = placed.withColumn("_own", own).join(sizes, ["bucket_id", "_shard"]).withColumn("_at", F.col("_own") + F.col("_before"))
    packed = numbered.select(F.col("_id").alias(id_col), "piece", "start", "n_tokens", "bucket_id", "bucket_len", F.floor(F.col("_at") / fits).alias("batch"), (F.col("_at") % fits).alias("slot"))
    none = rows.where("n_tokens = 0").select(F.col("_id").alias(id_col), "piece", "start", "n_tokens", *[F.lit(None).cast(t).alias(c) for c, t in (("bucket_id", "int"), ("bucket_len", "long"), ("batch", "long"), ("slot", "long"))])
    return packed.unionByName(none)
