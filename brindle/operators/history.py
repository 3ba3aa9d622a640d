"""Commit histories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.code import extension
from ..functions.scores import change_type, commit_impact
from ..storage import written

#: ``hash|author|date|subject`` before a commit's files, in the output of ``git log --numstat``.
COMMIT_LINE = r"^([0-9a-f]{7,40})\|([^|]*)\|([^|]*)\|(.*)$"


def parse_log(lines: DataFrame, block: int = 100_000) -> DataFrame:
    """``log, commit, author, date, subject, filename, additions, deletions`` of numbered lines (``log, n, value``).

    A line belongs to the last commit line above it in its log; binary files (``-``) have 0 lines changed.

    Lines are cut into ranges of about ``block`` by log and number, and each range begins with the last commit line of the
    ranges before it, so that a log of any size is spread over tasks, which grow in number and not in size.
    """
    parts = -(-lines.count() // block) or 1
    head = F.regexp_extract("value", COMMIT_LINE, 1) != ""
    part = lambda k: F.regexp_extract("value", COMMIT_LINE, k)
    marked = lines.withColumn("_head", F.when(head, F.struct(part(1).alias("commit"), part(2).alias("author"), part(3).alias("date"), part(4).alias("subject"))))
    # written once: ranges drawn anew for each use need not agree
    ranged = written(marked.repartitionByRange(parts, "log", "n").withColumn("_part", F.spark_partition_id()), "ranges")
    heads = ranged.where(F.col("_head").isNotNull()).groupBy("_part", "log").agg(F.max_by("_head", F.struct("n")).alias("_head"))
    ends = ranged.select("_part", "log").distinct().unionByName(heads, allowMissingColumns=True).groupBy("_part", "log").agg(F.first("_head", ignorenulls=True).alias("_head"))
    earlier = Window.partitionBy("log").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = ends.withColumn("_head", F.last("_head", ignorenulls=True).over(earlier)).where(F.col("_head").isNotNull())
    # a range's first line has the least number, so what is carried into it, without one, stands above it
    above = Window.partitionBy("_part", "log").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    placed = ranged.unionByName(before, allowMissingColumns=True).repartition(min(parts, 200), "_part", "log")  # up to 200 are shuffled without a buffer
    carried = placed.withColumn("_commit", F.last("_head", ignorenulls=True).over(above))
    files = F.split("value", "\t", 3)
    rows = carried.where(F.col("_commit").isNotNull() & F.col("_head").isNull() & (F.size(files) == 3))
    number = lambda k: F.coalesce(F.get(files, F.lit(k)).try_cast("bigint"), F.lit(0)).cast("bigint")
    return rows.select("log", "_commit.*", F.get(files, F.lit(2)).alias("filename"), number(0).alias("additions"), number(1).alias("deletions"))


def impact(changes: DataFrame, key: str = "commit") -> DataFrame:
    """Per commit: lines, files, files by extension, kind of change and score from 0 to 10."""
    per_type = changes.groupBy(key, extension(F.col("filename")).alias("ext")).agg(F.sum("additions").alias("a"), F.sum("deletions").alias("d"), F.count(F.lit(1)).alias("n"))
    total = per_type.groupBy(key).agg(F.sum("a").alias("total_additions"), F.sum("d").alias("total_deletions"), F.sum("n").alias("files_modified"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("ext", "n")))).alias("file_types"))
    a, d = F.col("total_additions"), F.col("total_deletions")
    return total.withColumns({"net_change": a - d, "change_type": change_type(a, d), "impact_score": commit_impact(a, d)})


def newest(commits: DataFrame, n: int = 50) -> DataFrame:
    return commits.orderBy(F.col("date").desc(), "commit").limit(n)


def directory_summary(files: DataFrame) -> DataFrame:
    """``ext, files`` of listed paths, with the number of directories in all."""
    by = files.groupBy(extension(F.col("path")).alias("ext")).agg(F.count(F.lit(1)).alias("files"))
    dirs = files.select(F.regexp_replace("path", "/[^/]*$", "").alias("d")).distinct().agg(F.count(F.lit(1)).alias("directories"))
    return by.join(F.broadcast(dirs))  # one row
