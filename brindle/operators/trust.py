"""Authority registry, reasoning over signals, verdicts and their audit trail."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import trust as rules
from ..functions.text import canonical_name
from ..functions.values import content_hash, iso
from ..schemas import AUTHORITY

REGISTRY_VERSION = "1.3.0"
#: Key, place and authority of the sources known from the start.
DEFAULTS = (("crates_registry", "https://crates.io", 10), ("forge", "https://github.com", 8), ("directory", "https://lib.rs", 6), ("docs", "https://docs.rs", 7))
LEAST_AUTHORITY = 5


def default_registry(spark: SparkSession, when: str = "2024-01-01 00:00:00") -> DataFrame:
    rows = spark.createDataFrame(list(DEFAULTS), "key string, source string, authority_level int")
    return rows.select("key", "source", F.lit(REGISTRY_VERSION).alias("version"), "authority_level", content_hash(F.col("source")).alias("content_hash"), F.lit(when).cast("timestamp").alias("last_validated"), F.lit(None).cast("timestamp").alias("expiry")).select([f.name for f in AUTHORITY.fields])


def register(registry: DataFrame, entries: DataFrame, now: Column | None = None) -> DataFrame:
    """The registry with entries (``key, source, content, authority_level``): the last of a key holds, level 5 by default."""
    when = F.current_timestamp() if now is None else now
    new = entries.select("key", "source", F.lit(REGISTRY_VERSION).alias("version"), F.coalesce("authority_level", F.lit(5)).alias("authority_level"), content_hash(F.col("content")).alias("content_hash"), when.alias("last_validated"), F.lit(None).cast("timestamp").alias("expiry"))
    return registry.join(new.select("key").distinct(), "key", "left_anti").select(*registry.columns).unionByName(new)


def authority_chain(registry: DataFrame) -> DataFrame:
    """Registrations as ``time:key:level`` in order of time."""
    return registry.select("last_validated", F.concat_ws(":", iso(F.col("last_validated")), "key", F.col("authority_level").cast("string")).alias("entry")).orderBy("last_validated", "entry")


def valid_sources(registry: DataFrame, now: Column | None = None, least: int = LEAST_AUTHORITY) -> DataFrame:
    return registry.where(rules.still_valid(F.col("expiry"), now) & (F.col("authority_level") >= least))


def authority_levels(items: DataFrame, registry: DataFrame, column: str = "source") -> DataFrame:
    """With the level of the source's key, 0 for an unknown one."""
    levels = registry.select(F.col("key").alias("_key"), F.col("authority_level").alias("_level"))
    return items.join(levels, F.col(column) == F.col("_key"), "left").withColumn("authority_level", F.coalesce("_level", F.lit(0))).drop("_key", "_level")


def registry_summary(registry: DataFrame, now: Column | None = None) -> DataFrame:
    """One row: entries, valid ones, entries by level, the latest key."""
    valid = rules.still_valid(F.col("expiry"), now)
    by = registry.groupBy("authority_level").agg(F.count(F.lit(1)).alias("n"), F.count_if(valid).alias("v"), F.max(F.struct("last_validated", "key")).alias("l"))
    return by.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.coalesce(F.sum("v"), F.lit(0)).alias("valid"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("authority_level", "n")))).alias("levels"), F.max("l")["key"].alias("last_key"))


def analyse(items: DataFrame, registry: DataFrame, unique: Column | None = None, epoch: Column | None = None, now: Column | None = None, shifted: bool = False) -> DataFrame:
    """Traces of ``items`` (``name``, and optional ``docs_quality, sentiment, ecosystem``): canonical name, valid sources,
    reasoning steps, quality, suggestion, verdict with its reason, confidence.

    Signals that are missing have the placeholder values 7.0, positive and 7.5. ``shifted`` reproduces traces in which
    the verdict did not see the sentiment. Ids and times are given, so that two runs can agree.
    """
    have = set(items.columns)
    signal = lambda c, default: F.coalesce(F.col(c), F.lit(default)) if c in have else F.lit(default)
    ranked = valid_sources(registry, now).agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("authority_level")).alias("o"), "key"))), lambda x: x["key"]).alias("context_sources"), F.coalesce(F.sum("authority_level"), F.lit(0)).alias("_authority"))
    out = items.withColumns({"input_data": canonical_name(F.col("name")), "_docs": signal("docs_quality", 7.0), "_feeling": signal("sentiment", "positive"), "_eco": signal("ecosystem", 7.5)}).join(F.broadcast(ranked))  # one row
    out = out.withColumn("quality", rules.quality(F.lit(None).cast("double"), F.lit(None).cast("string"), F.col("_eco")) if shifted else rules.quality(F.col("_docs"), F.col("_feeling"), F.col("_eco")))
    steps = F.array(
        F.concat(F.lit("input: "), F.col("input_data")),
        F.concat(F.lit("sources: "), F.size("context_sources").cast("string")),
        F.lit("metadata read"),
        F.concat(F.lit("documentation score "), F.col("_docs").cast("string")),
        F.concat(F.lit("sentiment "), F.col("_feeling")),
        F.concat(F.lit("ecosystem score "), F.col("_eco").cast("string")),
        F.concat(F.lit("quality "), F.round("quality", 2).cast("string")),
        F.lit("synthesis done"),
    )
    out = out.withColumn("reasoning_steps", steps)
    out = out.withColumn("suggestion", rules.suggestion(F.col("reasoning_steps")))
    out = out.withColumn("_v", rules.verdict(F.col("quality"), F.lit(None).cast("string") if shifted else F.col("_feeling")))
    out = out.withColumn("score", rules.confidence(F.col("_authority"), F.size("reasoning_steps"), F.col("_v.verdict")))
    out = out.withColumn("reasoning_steps", F.concat("reasoning_steps", F.array(F.concat(F.lit("verdict "), F.col("_v.verdict")))))
    ident = rules.execution_id(F.col("input_data"), F.sha2(F.col("input_data"), 256) if unique is None else unique, F.lit(0) if epoch is None else epoch)
    return out.select("name", ident.alias("execution_id"), "input_data", "context_sources", "reasoning_steps", "suggestion", F.col("_v.verdict").alias("verdict"), F.col("_v.reason").alias("reason"), "quality", "score", F.lit(REGISTRY_VERSION).alias("registry_version"))


def with_errors(traces: DataFrame, failures: DataFrame) -> DataFrame:
    """Traces, and for each failed item (``name, error``) one that defers with score 0."""
    failed = failures.select("name", rules.execution_id(canonical_name(F.col("name")), F.sha2("name", 256), F.lit(0)).alias("execution_id"), canonical_name(F.col("name")).alias("input_data"), F.array(F.concat(F.lit("error: "), F.col("error"))).alias("reasoning_steps"), F.lit("DEFER: failed").alias("suggestion"), F.lit("DEFER").alias("verdict"), F.col("error").alias("reason"), F.lit(0.0).alias("score"))
    return traces.unionByName(failed, allowMissingColumns=True)


def audit_record(traces: DataFrame) -> DataFrame:
    """One JSON document a trace under its id."""
    return traces.select("execution_id", F.to_json(F.struct("*")).alias("record"), F.lit(True).alias("checked"))


def audit_summary(traces: DataFrame, ts: str | None = None) -> DataFrame:
    """One row: traces, traces by verdict, mean score, latest time; zeros for none. Grouped before it is gathered."""
    last = F.max(ts) if ts else F.max(F.lit(None).cast("timestamp"))
    by = traces.groupBy("verdict").agg(F.count(F.lit(1)).alias("n"), F.sum("score").alias("s"), last.alias("t"))
    return by.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("verdict", "n")))).alias("verdicts"), F.coalesce(F.try_divide(F.sum("s"), F.sum("n")), F.lit(0.0)).alias("mean_score"), F.max("t").alias("last"))


def security_placeholder(packages: DataFrame) -> DataFrame:
    """Zero counts for every package: nothing was measured."""
    return packages.select("name", *[F.lit(0).cast("bigint").alias(c) for c in ("advisories", "vulnerabilities", "unsafe_blocks")])
