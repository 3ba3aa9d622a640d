"""The end-to-end runs: a batch of packages, traces of trust, a searchable knowledge base, a verified dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..functions.redact import sanitise
from ..operators import enrich, graph, history, packages, search, trust, verify
from ..schemas import KNOWLEDGE
from ..sources import readers, sinks
from ..storage import written


def settings_of(config: Config) -> enrich.Settings:
    return enrich.Settings(config.provider, config.model, config.url, config.max_tokens, config.token_limit, config.max_retries, config.budget)


def batch_run(names: DataFrame, landed: DataFrame, config: Config, stats: DataFrame | None = None, scrapes: DataFrame | None = None, root: str | None = None) -> dict[str, DataFrame]:
    """``packages, dependencies, depended``: one plan from names to enriched packages, written if a root is given.

    A name without a landed record is dropped; stars, scraped pages and enrichment are joined where they exist.
    """
    known = packages.fetched(packages.with_defaults(packages.last_of(landed, "name", F.coalesce(F.col("version"), F.lit("")))))
    rows = known.join(names.select("name").distinct(), "name", "left_semi")
    if stats is not None:
        rows = packages.with_stars(rows, stats)
    if scrapes is not None:
        rows = packages.with_scrapes(rows, scrapes)
    # enrichment calls a model: its result is written, so that no other reader calls it again
    rows = packages.widened(rows) if config.skip_enrichment else written(enrich.enriched(rows, settings_of(config)), "enriched")
    edges = graph.known_edges(graph.edges_of(rows), rows)
    lists, depended = graph.dependency_lists(rows, edges), graph.most_depended(edges, seen="position")
    if root:
        sinks.final_output(rows, lists, root)
        sinks.summary_report(packages.widened(rows), depended, root)
        sinks.status(rows, f"{root}/packages", root)
    return {"packages": rows, "dependencies": lists, "depended": depended}


def trace_run(spark: SparkSession, scrapes: DataFrame, config: Config, root: str | None = None, redacted: bool = False) -> DataFrame:
    """A trace for every name among scraped pages; names without one good page defer with their error."""
    good, bad = packages.split_on_error(sanitise(scrapes, redacted, ["title", "content", "structured_data"]))
    items = good.groupBy("name").agg(F.max("quality_score").alias("docs_quality"))
    failed = bad.join(items.select("name"), "name", "left_anti").groupBy("name").agg(F.max("error").alias("error"))
    traces = trust.with_errors(trust.analyse(items, trust.default_registry(spark)), failed)
    if root:
        sinks.audit(traces, root)
        sinks.reports(traces, f"{root}/reports")
    return traces


def knowledge_run(spark: SparkSession, root: str, code_root: str | None = None, repo: str | None = None) -> dict[str, DataFrame]:
    """Creates the missing tables, indexes the files and changes that are new, and returns the tables."""
    search.create_tables(spark, root)
    if code_root:
        files = search.index_files(readers.code_files(spark, code_root))
        new = search.not_indexed(files, search.table(spark, root, "code_index"))
        search.append_rows(written(new.withColumn("timestamp", F.current_timestamp().cast("string")), "indexed"), root, "code_index")
    if repo:
        commits = history.parse_log(readers.git_log_lines(spark, repo))
        scored = commits.join(history.impact(commits).select("commit", "change_type", "impact_score"), "commit")
        rows = scored.select(F.col("filename").alias("file_path"), "change_type", F.col("commit").alias("commit_hash"), "author", F.col("date").alias("timestamp"), "impact_score", F.col("subject").alias("diff_summary"))
        seen = search.table(spark, root, "code_changes").select("file_path", "commit_hash")
        search.append_rows(written(rows.join(seen, ["file_path", "commit_hash"], "left_anti"), "changes"), root, "code_changes")
    return {name: search.table(spark, root, name) for name in KNOWLEDGE}


def verification_run(dataset: DataFrame, truth: DataFrame, n: int, root: str | None = None, seed: int = 42) -> dict[str, DataFrame]:
    """Checks of a seeded sample, their summary, and the fields that differ most."""
    results = written(verify.verified(verify.sample(dataset, "name", n, seed), truth), "verified")
    out = {"results": results, "summary": verify.summary(results), "fields": verify.discrepancy_counts(results)}
    if root:
        for name, df in out.items():
            df.write.mode("overwrite").json(f"{root}/{name}")
    return out


def system_summary(spark: SparkSession, config: Config) -> DataFrame:
    """One row on version, components and settings."""
    return spark.createDataFrame([("0.1.0", config.provider, config.model, config.batch_size, config.checkpoint_interval, config.max_tokens)], "version string, provider string, model string, batch_size int, checkpoint_interval int, max_tokens int")
