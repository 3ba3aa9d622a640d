"""Source-code measures and project structure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import LINE_END

COUNTED = {"functions": r"fn\s+[0-9A-Za-z_]+\s*\(", "structs": r"struct\s+[0-9A-Za-z_]+", "enums": r"enum\s+[0-9A-Za-z_]+", "traits": r"trait\s+[0-9A-Za-z_]+"}
BRANCHES = r"\b(if|for|while|match)\b"


def code_metrics(c: Column) -> Column:
    """Counters of one file: definitions by kind, branch words, and parts between line feeds (1 for an empty text)."""
    text = F.coalesce(c, F.lit(""))
    counts = [F.regexp_count(text, F.lit(p)).cast("bigint").alias(k) for k, p in COUNTED.items()]
    return F.struct(*counts, F.regexp_count(text, F.lit(BRANCHES)).cast("bigint").alias("complexity"), (F.regexp_count(text, F.lit("\n")) + 1).cast("bigint").alias("lines_of_code"))


def code_symbols(c: Column) -> Column:
    """Names defined in one file, and its lines (0 for an empty text)."""
    text = F.coalesce(c, F.lit(""))
    names = lambda word: F.regexp_extract_all(text, F.lit(rf"{word}\s+([0-9A-Za-z_]+)"), 1)
    lines = F.regexp_replace(text, LINE_END, "\n")
    loc = F.when(text == "", 0).otherwise(F.regexp_count(lines, F.lit("\n")) + F.when(lines.endswith("\n"), 0).otherwise(1))
    return F.struct(loc.cast("bigint").alias("loc"), names("fn").alias("functions"), names("struct").alias("types"), names("trait").alias("traits"))


def structure_flags(path: Column) -> list[Column]:
    """Aggregates over a project's paths; folders count between slashes only."""
    parts = {"has_cargo_toml": "Cargo.toml", "has_src": "/src/", "has_tests": "/tests/", "has_examples": "/examples/"}
    return [F.coalesce(F.bool_or(path.contains(p)), F.lit(False)).alias(k) for k, p in parts.items()]


def loose_flags(path: Column) -> list[Column]:
    """Aggregates over a project's paths by words anywhere in them, whatever their case."""
    return [F.coalesce(F.bool_or(F.lower(path).contains(p)), F.lit(False)).alias(k) for k, p in (("has_tests", "test"), ("has_examples", "example"), ("has_benchmarks", "bench"))]


def merged_metrics(files: DataFrame, keys: list[str], text: str = "text", path: str = "path") -> DataFrame:
    """Counters of all files of a project added up, with their number and the structure its paths show."""
    m = files.withColumn("_m", code_metrics(F.col(text)))
    sums = [F.coalesce(F.sum(f"_m.{c}"), F.lit(0)).alias(c) for c in (*COUNTED, "complexity", "lines_of_code")]
    return m.groupBy(*keys).agg(*sums, F.count(F.lit(1)).alias("file_count"), *structure_flags(F.col(path)))


def merged_symbols(files: DataFrame, keys: list[str], text: str = "text", path: str = "path") -> DataFrame:
    """The list variant: lines added up, names of all files one after another in order of path and content, flags by or."""
    s = files.withColumn("_s", code_symbols(F.col(text)))
    names = lambda c: lambda x: x["_s"][c]
    every = F.array_sort(F.collect_list(F.struct(F.col(path).alias("path"), F.col("_s"))))
    lists = [F.flatten(F.transform(every, names(c))).alias(c) for c in ("functions", "types", "traits")]
    return s.groupBy(*keys).agg(F.coalesce(F.sum("_s.loc"), F.lit(0)).alias("loc"), *lists, *loose_flags(F.col(path)))


def file_class(path: Column) -> Column:
    """What a file of a code base counts as; tests in scripts come before scripts in general."""
    name = F.element_at(F.split(path, "/"), -1)
    return (
        F.when(name.startswith("test_") | path.contains("/tests/"), "test")
        .when(path.endswith(".py"), "script")
        .when(path.endswith(".rs"), "source")
        .when(path.rlike(r"\.(md|rst|txt)$"), "document")
        .when(path.rlike(r"\.(toml|json|ya?ml|ini|cfg)$"), "configuration")
        .when(path.rlike(r"\.(sql|db)$"), "database")
        .otherwise("other")
    )


def extension(path: Column) -> Column:
    """The last name's extension with its dot; a leading dot starts a name, not an extension."""
    return F.regexp_extract(F.element_at(F.split(path, "/"), -1), r"[^.]([.][^.]*)$", 1)
