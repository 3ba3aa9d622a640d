"""Verification of records against a source of truth, and summaries of checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows by the digest of seed and key: the same rows in every run and engine, without a sort of all."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))), key).limit(n)


def same_set(a: Column, b: Column) -> Column:
    return F.array_sort(F.array_distinct(a)) == F.array_sort(F.array_distinct(b))


def verified(ours: DataFrame, theirs: DataFrame, key: str = "name", exact: tuple[str, ...] = ("downloads", "github_stars"), linked: tuple[str, ...] = ("repository",), soft: tuple[str, ...] = ("description",), sets: tuple[str, ...] = ("categories",)) -> DataFrame:
    """``key, verified, discrepancies, warnings, verified_fields``.

    Exact fields must be equal (null counts as 0); linked ones differ only if both are given; soft fields and sets give
    warnings. A record without a counterpart is verified with no fields; one without a key is not verified.
    """
    other = theirs.select(F.col(key).alias("_key"), F.struct(*[c for c in theirs.columns if c != key]).alias("_t"))
    joined = ours.join(other, F.col(key) == F.col("_key"), "left")
    has = F.col("_key").isNotNull()
    bad, warn, good = [], [], []
    mine = set(ours.columns)
    for f in (f for f in exact if f in mine):
        differ = F.coalesce(f, F.lit(0)) != F.coalesce(f"_t.{f}", F.lit(0))
        bad.append(F.when(has & differ, F.lit(f)))
        good.append(F.when(has & ~differ, F.lit(f)))
    for f in (f for f in (*linked, *soft) if f in mine):
        a, b = F.trim(F.coalesce(f, F.lit(""))), F.trim(F.coalesce(f"_t.{f}", F.lit("")))
        differ = (a != "") & (b != "") & (a != b)
        (bad if f in linked else warn).append(F.when(has & differ, F.lit(f)))
        good.append(F.when(has & ~differ & (a != ""), F.lit(f)))
    for f in (f for f in sets if f in mine):
        none = F.array().cast(ours.schema[f].dataType)
        a, b = F.coalesce(f, none), F.coalesce(f"_t.{f}", none)
        differ = (F.size(a) > 0) & (F.size(b) > 0) & ~same_set(a, b)
        warn.append(F.when(has & differ, F.lit(f)))
        good.append(F.when(has & ~differ & (F.size(a) > 0), F.lit(f)))
    packed = lambda xs: F.filter(F.array(*xs, F.lit(None).cast("string")), lambda x: x.isNotNull())
    out = joined.select(key, packed(bad).alias("discrepancies"), packed(warn).alias("warnings"), packed(good).alias("verified_fields"))
    return out.withColumn("verified", F.col(key).isNotNull() & (F.size("discrepancies") == 0))


def summary(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("verified").alias("verified"),
        F.count_if(~F.col("verified")).alias("failed"),
        F.coalesce(F.sum(F.size("discrepancies")), F.lit(0)).alias("discrepancies"),
        F.coalesce(F.sum(F.size("warnings")), F.lit(0)).alias("warnings"),
    )


def discrepancy_counts(results: DataFrame) -> DataFrame:
    return results.select(F.explode("discrepancies").alias("field")).groupBy("field").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "field")


def check_summary(checks: DataFrame) -> DataFrame:
    """Checks (``name, status``) counted by status, and the worst of them overall."""
    n = lambda s: F.count_if(F.col("status") == s)
    out = checks.agg(n("PASS").alias("passed"), n("FAIL").alias("failed"), n("WARN").alias("warned"), n("ERROR").alias("errors"))
    return out.withColumn("overall", F.when((F.col("failed") > 0) | (F.col("errors") > 0), "FAIL").when(F.col("warned") > 0, "WARN").otherwise("PASS"))


def run_summary(runs: DataFrame) -> DataFrame:
    """Script runs (``name, ok``): how many went well, and which did not."""
    return runs.agg(F.count_if("ok").alias("succeeded"), F.sort_array(F.collect_list(F.when(~F.col("ok"), F.col("name")))).alias("failed"))


def file_checks(files: DataFrame) -> DataFrame:
    """Files (``name, exists, hash``) as check rows: present, and a digest of 64 hex digits."""
    ok = F.col("exists") & F.coalesce(F.col("hash").rlike("^[0-9a-f]{64}$"), F.lit(False))
    return files.select("name", F.when(~F.col("exists"), "FAIL").when(ok, "PASS").otherwise("WARN").alias("status"))


def compliance_checks(traces: DataFrame, registry: DataFrame) -> DataFrame:
    """Check rows on traces and registry: id form, a registry that is not empty, scores within bounds."""
    well = F.col("execution_id").rlike("^exec-[0-9a-f]{8}-[0-9a-z]+-[0-9]+$")
    a = traces.agg(F.count_if(~well).alias("bad"), F.count_if(~F.col("score").between(0, 10)).alias("out"))
    rows = a.select(F.explode(F.array(F.struct(F.lit("id_format").alias("name"), (F.col("bad") == 0).alias("ok")), F.struct(F.lit("score_range").alias("name"), (F.col("out") == 0).alias("ok")))).alias("x")).select("x.*")
    filled = registry.agg((F.count(F.lit(1)) > 0).alias("ok")).select(F.lit("registry").alias("name"), "ok")
    return rows.unionByName(filled).select("name", F.when(F.col("ok"), "PASS").otherwise("FAIL").alias("status"))


def codebase_counts(files: DataFrame, file_class: Column) -> DataFrame:
    return files.groupBy(file_class.alias("class")).agg(F.count(F.lit(1)).alias("n"))
