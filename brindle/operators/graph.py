"""Dependency edges, who depends on whom, and the most depended on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def edges_of(packages: DataFrame) -> DataFrame:
    """``src, dst, position``: every dependency of every package, duplicates and self edges included."""
    return packages.select(F.col("name").alias("src"), F.posexplode("dependencies").alias("position", "d")).select("src", F.col("d.crate_id").alias("dst"), "position").where("dst IS NOT NULL")


def known_edges(edges: DataFrame, known: DataFrame, key: str = "name") -> DataFrame:
    """Edges to packages that are themselves known; a left semi join, whose side Spark sizes at run time."""
    return edges.join(known.select(F.col(key).alias("dst")), "dst", "left_semi")


def dependency_lists(packages: DataFrame, edges: DataFrame) -> DataFrame:
    """``name, dependencies`` in order, an empty list for none."""
    lists = edges.groupBy(F.col("src").alias("name")).agg(F.transform(F.array_sort(F.collect_list(F.struct("position", "dst"))), lambda e: e["dst"]).alias("dependencies"))
    return packages.select("name").join(lists, "name", "left").withColumn("dependencies", F.coalesce("dependencies", F.array().cast("array<string>")))


def reverse_lists(edges: DataFrame) -> DataFrame:
    """``name, dependents, n``: each edge counts, so a package may depend twice."""
    return edges.groupBy(F.col("dst").alias("name")).agg(F.sort_array(F.collect_list("src")).alias("dependents"), F.count(F.lit(1)).alias("n"))


def most_depended(edges: DataFrame, n: int = 10, seen: str | None = None) -> DataFrame:
    """The ``n`` targets of most edges; ties to the one seen first, then the smaller name. Counts only, no lists."""
    first = F.min(seen) if seen else F.lit(0)
    counted = edges.groupBy(F.col("dst").alias("name")).agg(F.count(F.lit(1)).alias("n"), first.alias("_first"))
    return counted.orderBy(F.desc("n"), "_first", "name").limit(n).drop("_first")
