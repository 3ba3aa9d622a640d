"""Progress and throughput over a table of completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scores import share
from ..storage import written


def rolling(events: DataFrame, keys: list[str], order: list[str], value: str, rows: int = 100, block: int = 100_000) -> DataFrame:
    """With ``n, mean, low, high`` of the last ``rows`` values of the key, the row's own included.

    A key's rows are numbered and cut into blocks, each with the last rows of the one before, so that a key of any size
    is spread over tasks.
    """
    block = max(block, rows)
    at = running_sums(events, keys, order, {"_at": F.lit(1).cast("bigint")})
    own, into_next = F.floor(F.col("_at") / block), F.col("_at") % block > block - rows
    both = F.when(into_next, F.array(F.struct(own.alias("b"), F.lit(True).alias("own")), F.struct((own + 1).alias("b"), F.lit(False).alias("own")))).otherwise(F.array(F.struct(own.alias("b"), F.lit(True).alias("own"))))
    placed = at.withColumn("_block", F.explode(both))
    w = Window.partitionBy(*keys, "_block.b").orderBy("_at").rowsBetween(-(rows - 1), 0)
    out = placed.withColumns({"n": F.count(value).over(w), "mean": F.avg(value).over(w), "low": F.min(value).over(w), "high": F.max(value).over(w)})
    return out.where("_block.own").drop("_at", "_block")


def performance(events: DataFrame, value: str = "seconds") -> DataFrame:
    """Mean, least, most and items a minute; durations of 0 are not recorded, no duration gives 0."""
    real = F.when(F.col(value) > 0, F.col(value))
    out = events.agg(F.avg(real).alias("mean"), F.min(real).alias("low"), F.max(real).alias("high"), F.count(real).alias("n"), F.sum(real).alias("total"))
    return out.select(*[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("mean", "low", "high")], F.coalesce(F.try_divide(F.col("n"), F.col("total") / 60), F.lit(0.0)).alias("per_minute"))


def metrics(events: DataFrame, total: Column, failed: Column, keys: list[str] | None = None) -> DataFrame:
    """``processed, succeeded, failed, progress, success_rate``; percentages are 0 without a denominator."""
    out = events.groupBy(*(keys or [])).agg(F.count(F.lit(1)).alias("processed"), F.count_if(failed).alias("failed"), F.first(total).alias("_total"))
    out = out.withColumn("succeeded", F.col("processed") - F.col("failed"))
    return out.withColumns({"progress": share(F.col("processed"), F.col("_total")), "success_rate": share(F.col("succeeded"), F.col("processed"))}).drop("_total")


def running_estimate(events: DataFrame, keys: list[str], order: list[str], value: str, total: Column) -> DataFrame:
    """With the mean so far and the time that the remaining items take at that mean."""
    out = running_sums(events, keys, order, {"done": F.lit(1).cast("bigint"), "_n": F.col(value).isNotNull().cast("bigint"), "_sum": F.col(value)}, own=True)
    out = out.withColumn("mean", F.try_divide(F.col("_sum").cast("double"), F.col("_n"))).drop("_n", "_sum")
    return out.withColumn("remaining", F.col("mean") * F.greatest(total - F.col("done"), F.lit(0)))


def running_sums(df: DataFrame, keys: list[str], order: list[str], sums: dict[str, Column], own: bool = False) -> DataFrame:
    """``df`` with sums over a key's earlier rows, or up to the row itself with ``own``; nothing adds up to 0.

    Rows are ranged by key and order, and each range begins with the sums of the ranges before it, so that a key of any
    size, or no key at all, is spread over tasks.
    """
    values = {f"_v{k}": v for k, v in enumerate(sums.values())}
    # written once: ranges drawn anew for each use need not agree
    ranged = written(df.withColumns(values).repartitionByRange(*[F.col(c) for c in (*keys, *order)]).withColumn("_part", F.spark_partition_id()), "ranges")
    per = ranged.groupBy("_part", *keys).agg(*[F.sum(v).alias(v) for v in values])
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = per.select(F.col("_part").alias("_p"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)], *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"_b{v}") for v in values])
    same = F.col("_part") == F.col("_p")
    for i, c in enumerate(keys):
        same = same & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    inside = Window.partitionBy("_part", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if own else -1)
    summed = ranged.withColumns({f"_o{v}": F.coalesce(F.sum(v).over(inside), F.lit(0)) for v in values}).join(before, same)
    return summed.select(*df.columns, *[(F.col(f"_o{v}") + F.col(f"_b{v}")).alias(name) for name, v in zip(sums, values, strict=True)])


def admitted(calls: DataFrame, keys: list[str], order: list[str], cost: str, budget: Column) -> DataFrame:
    """Calls made before the budget is used up: the cost of all earlier ones decides, a call's own comes after."""
    return running_sums(calls, keys, order, {"spent": F.col(cost)}).where(F.col("spent") <= budget)


def batches(df: DataFrame, order: list[str], size: int) -> DataFrame:
    """With ``batch`` and ``position`` from 1 in the order given, numbered without one task for all rows: ranges are
    sorted apart, and each begins after the rows of those before it."""
    # written once: ranges drawn anew for each use need not agree
    ranged = written(df.repartitionByRange(*[F.col(c) for c in order]).withColumn("_part", F.spark_partition_id()), "ranges")
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # a row a partition
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_part", "_before")
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    placed = ranged.withColumn("_own", own).join(F.broadcast(before), "_part")
    return placed.withColumn("position", F.col("_own") + F.col("_before")).withColumn("batch", F.floor((F.col("position") - 1) / size) + 1).drop("_part", "_own", "_before")


def cost_report(events: DataFrame, value: str, cost: str) -> DataFrame:
    """Items, seconds an item, and money so far."""
    return events.agg(F.count(F.lit(1)).alias("items"), F.coalesce(F.avg(value), F.lit(0.0)).alias("seconds_per_item"), F.coalesce(F.sum(cost), F.lit(0)).alias("cost"))


def last_messages(events: DataFrame, order: str, n: int = 10) -> DataFrame:
    """The last messages of each kind, as rows."""
    w = Window.partitionBy("status").orderBy(F.desc(order))
    return events.where("message IS NOT NULL").withColumn("_i", F.row_number().over(w)).where(F.col("_i") <= n).drop("_i")


def status_line(done: Column, total: Column, rate: Column) -> Column:
    return F.format_string("%d of %d (%.1f %%), %.1f %% well", done, total, share(done, total), rate)
