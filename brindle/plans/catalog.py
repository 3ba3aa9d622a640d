"""Every query of the engine's own operators over the test tables, by name, each with DuckDB SQL where SQL can say it.

Dependency edges are ``lineitem`` suppliers and parts, signals are ``labels``, completions are ``events``, turns are
``conversations``; the source of truth for ``orders`` are their lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import answers, code, redact, scores, text, trust, values
from ..operators import enrich, graph, history, html, packages, progress, search, verify
from ..operators import trust as trust_ops
from . import catalog_records, registry
from .registry import Query, query, t

__all__ = ["FLAGSHIP", "catalog_records", "oracle_sql", "queries"]

FLAGSHIP = "most_depended"
def _edges(spark: SparkSession, d: str) -> DataFrame:
    edges = t(spark, d, "lineitem").select(F.col("l_suppkey").alias("src"), (F.col("l_partkey") % 150).alias("dst"))
    return graph.known_edges(edges, t(spark, d, "supplier"), "s_suppkey")


def _cents(spark: SparkSession, d: str) -> DataFrame:
    """Events with whole cents, whose sums no order of adding can change."""
    return t(spark, d, "events").withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))


EDGES = "e AS (SELECT l_suppkey AS src, l_partkey % 150 AS dst FROM lineitem WHERE l_partkey % 150 IN (SELECT s_suppkey FROM supplier))"

# ---- dependency graph


@query(f"WITH {EDGES} SELECT src, dst, count(*) AS n FROM e GROUP BY ALL")
def dep_edges(spark, d):
    return _edges(spark, d).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {EDGES} SELECT dst AS name, count(*) AS n FROM e GROUP BY dst ORDER BY n DESC, name LIMIT 10")
def most_depended(spark, d):
    return graph.most_depended(_edges(spark, d))


@query(f"WITH {EDGES} SELECT dst AS name, string_agg(src, ',' ORDER BY src) AS dependents, count(*) AS n FROM e GROUP BY dst")
def reverse_dependencies(spark, d):
    return graph.reverse_lists(_edges(spark, d)).select("name", F.array_join(F.transform("dependents", lambda x: x.cast("string")), ",").alias("dependents"), "n")


@query(f"WITH {EDGES} SELECT s_suppkey AS name, coalesce((SELECT count(*) FROM e WHERE src = s_suppkey), 0) AS n FROM supplier")
def dependency_counts(spark, d):
    edges = _edges(spark, d).withColumn("position", F.lit(0))
    names = t(spark, d, "supplier").select(F.col("s_suppkey").alias("name"))
    return graph.dependency_lists(names, edges).select("name", F.size("dependencies").cast("bigint").alias("n"))


# ---- joins, sets, keys


@query("SELECT doc_id, CASE WHEN l.doc_id IS NOT NULL THEN coalesce(quality, 0) ELSE -1 END::BIGINT AS github_stars FROM documents LEFT JOIN labels l USING (doc_id)")
def stars_by_match(spark, d):
    docs = t(spark, d, "documents").select("doc_id", F.col("doc_id").cast("string").alias("repository"), F.lit(-1).cast("bigint").alias("github_stars"))
    stats = t(spark, d, "labels").select(F.col("doc_id").cast("string").alias("url"), F.col("quality").cast("bigint").alias("stars"))
    return packages.with_stars(docs, stats).select("doc_id", "github_stars")


@query("SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def semi_filter(spark, d):
    return t(spark, d, "documents").select("doc_id", "lang").join(t(spark, d, "labels").where("quality = 1"), "doc_id", "left_semi")


@query("SELECT doc_id AS file_path, sha256(coalesce(text, '')) AS content_hash FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def anti_new_rows(spark, d):
    files = t(spark, d, "documents").select(F.col("doc_id").alias("file_path"), values.content_hash(F.col("text")).alias("content_hash"))
    index = files.join(t(spark, d, "labels").select(F.col("doc_id").alias("file_path")), "file_path", "left_semi")
    return search.not_indexed(files, index)


@query("SELECT text_hash, min(doc_id) AS doc_id, count(*) AS n FROM (SELECT doc_id, sha256(coalesce(text, '')) AS text_hash FROM documents) GROUP BY 1")
def content_hashes(spark, d):
    return t(spark, d, "documents").groupBy(values.content_hash(F.col("text")).alias("text_hash")).agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n"))


@query("SELECT source, max(doc_id) AS doc_id FROM documents GROUP BY source")
def last_write_wins(spark, d):
    return packages.last_of(t(spark, d, "documents").select("source", "doc_id"), "source", F.col("doc_id"))


@query("SELECT l_orderkey, (list_sort(list(DISTINCT l_returnflag)) = list_sort(list(DISTINCT l_linestatus))) AS same FROM lineitem GROUP BY 1")
def category_set_equal(spark, d):
    g = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_returnflag").alias("a"), F.collect_set("l_linestatus").alias("b"))
    return g.select("l_orderkey", verify.same_set(F.col("a"), F.col("b")).alias("same"))


# ---- windows, top-k, sampling


@query("SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_per_key(spark, d):
    return search.latest(t(spark, d, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id", "event_type")


@query("SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 3")
def top_n_per_key(spark, d):
    return search.latest(t(spark, d, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")], 3).select("user_id", "event_id")


@query("SELECT event_id, count(value) OVER w AS n, round(avg(round(value * 100)::BIGINT) OVER w, 4) AS mean, min(round(value * 100)::BIGINT) OVER w AS low, max(round(value * 100)::BIGINT) OVER w AS high FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)")
def rolling_100_stats(spark, d):
    return progress.rolling(_cents(spark, d), ["event_type"], ["ts", "event_id"], "cents").select("event_id", "n", F.round("mean", 4).alias("mean"), "low", "high")


@query("SELECT event_id, count(*) OVER w AS done, floor(avg(round(value * 100)::BIGINT) OVER w * 1000)::BIGINT AS mean, floor(avg(round(value * 100)::BIGINT) OVER w * greatest(1000 - count(*) OVER w, 0))::BIGINT AS remaining FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)")
def running_estimate(spark, d):
    out = progress.running_estimate(_cents(spark, d), ["event_type"], ["ts", "event_id"], "cents", F.lit(1000))
    return out.select("event_id", "done", F.floor(F.col("mean") * 1000).alias("mean"), F.floor("remaining").alias("remaining"))


@query("SELECT event_id, spent::DOUBLE AS spent FROM (SELECT event_id, coalesce(sum(value::DECIMAL(18, 2)) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent FROM events) WHERE spent <= 900")
def running_budget_admission(spark, d):
    calls = t(spark, d, "events").withColumn("cost", F.col("value").cast("decimal(18,2)"))
    return progress.admitted(calls, ["event_type"], ["ts", "event_id"], "cost", F.lit(900)).select("event_id", F.col("spent").cast("double").alias("spent"))


@query("SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS position, (row_number() OVER (ORDER BY doc_id) - 1) // 10 + 1 AS batch FROM documents")
def batch_numbering(spark, d):
    return progress.batches(t(spark, d, "documents").select("doc_id"), ["doc_id"], 10).select("doc_id", F.col("position").cast("bigint").alias("position"), "batch")


@query("SELECT conv_id, turn, coalesce(string_agg(text, chr(10) ORDER BY turn) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), '') AS context FROM conversations")
def context_window(spark, d):
    return enrich.context(t(spark, d, "conversations"), ["conv_id"], "turn", "text", 3).select("conv_id", "turn", "context")


# ---- text


@query("SELECT doc_id, length(coalesce(text, '')) // 4 AS tokens FROM documents")
def token_estimate(spark, d):
    return t(spark, d, "documents").select("doc_id", text.estimate_tokens(F.col("text")).alias("tokens"))


@query(
    r"""SELECT doc_id, regexp_replace(coalesce(string_agg(p, chr(10) ORDER BY i) FILTER (WHERE used <= 200), ''), '^[ \t\n\r]+|[ \t\n\r]+$', '', 'g') AS text FROM (
      SELECT doc_id, p, i, sum(length(p) // 4) OVER (PARTITION BY doc_id ORDER BY i) AS used FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS p, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)
    ) GROUP BY doc_id"""
)
def truncate_prefix(spark, d):
    return t(spark, d, "documents").select("doc_id", text.truncate_prefix(F.col("text"), 200, "\n").alias("text"))


@query("SELECT doc_id, CASE WHEN length(coalesce(text, '')) = 0 THEN 0.0 ELSE CASE WHEN length(text) > 1000 THEN 3.0 WHEN length(text) > 500 THEN 2.0 WHEN length(text) > 100 THEN 1.0 ELSE 0.0 END + CASE WHEN lower(text) LIKE '%title%' OR lower(text) LIKE '%description%' THEN 1.0 ELSE 0.0 END END::DOUBLE AS score FROM documents")
def quality_score(spark, d):
    return t(spark, d, "documents").select("doc_id", text.quality_score(F.col("text")).alias("score"))


@query("SELECT doc_id, coalesce(trim(substr(list_filter(list_slice(string_split(text, chr(10)), 1, 5), lambda x: starts_with(x, '# '))[1], 3)), 'Untitled') AS title FROM documents")
def title_extract(spark, d):
    return t(spark, d, "documents").select("doc_id", text.title_of(F.col("text")).alias("title"))


@query(r"SELECT page_id, coalesce(regexp_extract(url, '^[a-z]+://([^/]+)', 1), '') AS host, coalesce(regexp_extract(url, 'github\.com/([^/]+)/', 1), '') AS owner FROM pages")
def repo_owner_extract(spark, d):
    found = text.repository_of(F.col("url"))
    return t(spark, d, "pages").select("page_id", F.regexp_extract("url", "^[a-z]+://([^/]+)", 1).alias("host"), F.coalesce(found["owner"], F.lit("")).alias("owner"))


@query(r"SELECT doc_id, len(regexp_extract_all(text, 'fn\s+[0-9A-Za-z_]+\s*\('))::BIGINT AS functions, len(regexp_extract_all(text, '\b(if|for|while|match)\b'))::BIGINT AS complexity, (length(text) - length(replace(text, chr(10), '')) + 1) AS lines_of_code FROM documents")
def code_metrics(spark, d):
    m = t(spark, d, "documents").select("doc_id", code.code_metrics(F.col("text")).alias("m"))
    return m.select("doc_id", "m.functions", "m.complexity", "m.lines_of_code")


@query("SELECT doc_id, regexp_replace(regexp_replace(text, 'AKIA[A-Z0-9]{16}', '[AWS_ACCESS_KEY_REDACTED]', 'g'), '[0-9A-Za-z+/=]{40}', '[AWS_SECRET_KEY_REDACTED]', 'g') AS text FROM documents")
def redact_keys(spark, d):
    c = F.col("text")
    for name, pattern in redact.SECRETS[1:3]:
        c = F.regexp_replace(c, pattern, f"[{name}_REDACTED]")
    return t(spark, d, "documents").select("doc_id", c.alias("text"))


def _replaced(patterns, suffix: str) -> str:
    out = "text"
    for name, pattern in patterns:
        out = f"regexp_replace({out}, '{pattern.replace(chr(39), chr(39) * 2)}', '[{name}{suffix}]', 'g')"
    return out


@query(f"SELECT doc_id, {_replaced(redact.SECRETS, '_REDACTED')} AS text FROM documents")
def redact_secrets(spark, d):
    return t(spark, d, "documents").select("doc_id", redact.redact_secrets(F.col("text")).alias("text"))


@query(f"SELECT doc_id, {_replaced(redact.PERSONAL, '')} AS text FROM documents")
def redact_personal(spark, d):
    return t(spark, d, "documents").select("doc_id", redact.redact_personal(F.col("text")).alias("text"))


@query(r"SELECT conv_id, turn, least(greatest(coalesce(try_cast(nullif(regexp_extract(text, '([0-9]+\.?[0-9]*)', 1), '') AS DOUBLE), 5.0), 0.0), 10.0) AS score FROM conversations")
def score_parse(spark, d):
    return t(spark, d, "conversations").select("conv_id", "turn", answers.score_of(F.col("text")).alias("score"))


def _category_sql() -> str:
    return "CASE WHEN coalesce(text, '') = '' THEN '' " + " ".join(rf"WHEN regexp_matches(text, '(?i)(^|[^\p{{L}}\p{{N}}_]){c}($|[^\p{{L}}\p{{N}}_])') THEN '{c}'" for c in answers.CATEGORIES) + " ELSE 'Unknown' END"


@query(f"SELECT conv_id, turn, {_category_sql()} AS category FROM conversations")
def classify_clean(spark, d):
    return t(spark, d, "conversations").select("conv_id", "turn", answers.category_of(F.col("text")).alias("category"))


@query("SELECT doc_id, CASE WHEN starts_with(s, 'rust:') THEN substr(s, 6) ELSE s END AS name FROM (SELECT doc_id, lower(source) AS s FROM documents)")
def canonical_names(spark, d):
    return t(spark, d, "documents").select("doc_id", text.canonical_name(F.concat(F.lit("  crate:"), F.col("source"), F.lit(" "))).alias("name"))


@query("SELECT event_id, coalesce(json_extract_string(props, '$.k'), '') AS k FROM events")
def json_fields(spark, d):
    return t(spark, d, "events").select("event_id", F.coalesce(F.get_json_object(values.extracted_json(F.col("props")), "$.k"), F.lit("")).alias("k"))


# ---- scores and changes


@query("SELECT p_partkey, round((10 * coalesce(n, 0))::DOUBLE / 1000::DOUBLE + (10 * p_size)::DOUBLE + (10 * length(p_name))::DOUBLE / 500::DOUBLE, 2) AS score FROM part LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_partkey = p_partkey")
def popularity_score(spark, d):
    n = t(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count(F.lit(1)).alias("n"))
    parts = t(spark, d, "part").join(n, "p_partkey", "left")
    return parts.select("p_partkey", scores.popularity(F.col("n") * 10, F.col("p_size"), F.char_length("p_name") * 10).alias("score"))


@query(
    """SELECT commit, total_additions, total_deletions, total_additions - total_deletions AS net_change, files_modified,
      CASE WHEN total_additions > 2 * total_deletions THEN 'feature_addition' WHEN total_deletions > 2 * total_additions THEN 'cleanup_removal' WHEN total_additions > 100 OR total_deletions > 100 THEN 'major_refactor' ELSE 'minor_change' END AS change_type,
      least(10, (total_additions + total_deletions) / 10)::DOUBLE AS impact_score
    FROM (SELECT l_orderkey AS commit, sum(l_quantity::BIGINT)::BIGINT AS total_additions, sum(l_linenumber * 5)::BIGINT AS total_deletions, count(*) AS files_modified FROM lineitem GROUP BY 1)"""
)
def commit_impact(spark, d):
    changes = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("commit"), F.concat(F.col("l_returnflag"), F.lit(".rs")).alias("filename"), F.round("l_quantity").cast("bigint").alias("additions"), (F.col("l_linenumber") * 5).cast("bigint").alias("deletions"))
    return history.impact(changes).select("commit", "total_additions", "total_deletions", "net_change", "files_modified", "change_type", "impact_score")


@query(
    """WITH p AS (SELECT doc_id, text AS new, lag(text) OVER (ORDER BY doc_id) AS old FROM documents), l AS (
      SELECT doc_id, CASE WHEN coalesce(old, '') = '' THEN 0 ELSE length(old) - length(replace(old, chr(10), '')) + 1 END AS a, CASE WHEN coalesce(new, '') = '' THEN 0 ELSE length(new) - length(replace(new, chr(10), '')) + 1 END AS b FROM p
    ), i AS (SELECT doc_id, CASE WHEN a = 0 AND b = 0 THEN 0.0 WHEN a = 0 OR b = 0 THEN 1.0 ELSE least(1.0::DOUBLE, abs(a - b)::DOUBLE / greatest(a, b)::DOUBLE) END::DOUBLE AS impact FROM l)
    SELECT doc_id, round(impact, 6) AS impact, CASE WHEN impact > 0.5 THEN 'high_impact' WHEN impact > 0.2 THEN 'medium_impact' ELSE 'low_impact' END AS tag FROM i"""
)
def change_impact(spark, d):
    docs = t(spark, d, "documents").select("doc_id", "text")
    numbered = progress.batches(docs, ["doc_id"], 1).select("doc_id", "text", "position")
    old = numbered.select((F.col("position") + 1).alias("position"), F.col("text").alias("old"))
    impact = scores.change_impact(F.col("old"), F.col("text"))
    return numbered.join(old, "position", "left").select("doc_id", F.round(impact, 6).alias("impact"), scores.impact_tag(impact).alias("tag"))


# ---- trust


def _signals(spark: SparkSession, d: str) -> DataFrame:
    joined = t(spark, d, "documents").select("doc_id", "n_chars").join(t(spark, d, "labels"), "doc_id", "left")
    feeling = F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive")
    return joined.select("doc_id", F.col("doc_id").cast("string").alias("name"), F.least(F.col("n_chars") / 500, F.lit(10.0)).alias("docs_quality"), feeling.alias("feeling"))


SIGNALS = """s AS (SELECT doc_id, least(n_chars / 500.0, 10.0)::DOUBLE AS docs, CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' END AS feeling FROM documents LEFT JOIN labels USING (doc_id)),
q AS (SELECT doc_id, feeling, (docs + CASE feeling WHEN 'positive' THEN 8.0 WHEN 'negative' THEN 3.0 ELSE 5.0 END::DOUBLE + 5.0::DOUBLE) / 3 AS quality FROM s),
v AS (SELECT doc_id, feeling, quality, CASE WHEN quality >= 8 THEN 'ALLOW' WHEN quality >= 6 AND feeling = 'positive' THEN 'ALLOW' WHEN quality < 4 THEN 'DENY' WHEN feeling = 'negative' THEN 'FLAG' ELSE 'DEFER' END AS verdict FROM q),
c AS (SELECT doc_id, verdict, quality, least(5.0 + 2.0 + 1.6 + CASE verdict WHEN 'ALLOW' THEN 1.0 WHEN 'DENY' THEN 0.5 ELSE 0.0 END, 10.0)::DOUBLE AS score FROM v)"""


def _verdicts(spark: SparkSession, d: str) -> DataFrame:
    q = _signals(spark, d).withColumn("quality", trust.quality(F.col("docs_quality"), F.col("feeling"), F.lit(None).cast("double")))
    v = q.withColumn("verdict", trust.verdict(F.col("quality"), F.col("feeling"))["verdict"])
    return v.withColumn("score", trust.confidence(F.lit(31), F.lit(8), F.col("verdict")))


@query(f"WITH {SIGNALS} SELECT doc_id, round(quality, 6) AS quality, verdict, round(score, 6) AS score FROM c")
def verdict(spark, d):
    return _verdicts(spark, d).select("doc_id", F.round("quality", 6).alias("quality"), "verdict", F.round("score", 6).alias("score"))


@query("SELECT doc_id, 'exec-' || substr(sha256(source), 1, 8) || '-' || substr(sha256(doc_id::VARCHAR), 1, 8) || '-0' AS execution_id FROM documents")
def execution_ids(spark, d):
    return t(spark, d, "documents").select("doc_id", trust.execution_id(F.col("source"), F.sha2(F.col("doc_id").cast("string"), 256), F.lit(0)).alias("execution_id"))


@query("SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 10 WHEN 'MACHINERY' THEN 8 ELSE 0 END AS authority_level FROM customer")
def authority_lookup(spark, d):
    levels = spark.createDataFrame([("BUILDING", 10), ("MACHINERY", 8)], "key string, authority_level int")
    return trust_ops.authority_levels(t(spark, d, "customer"), levels, "c_mktsegment").select("c_custkey", "authority_level")


# ---- search, verification, progress


@query(
    """WITH d AS (SELECT 'documents' AS source, doc_id AS id, (n_chars % 100)::DOUBLE AS relevance, doc_id AS ts FROM documents WHERE text ILIKE '%tion%' ORDER BY relevance DESC, doc_id LIMIT 10),
    b AS (SELECT 'benchmark' AS source, item_id AS id, (length(text) % 100)::DOUBLE AS relevance, item_id AS ts FROM benchmark WHERE text ILIKE '%tion%' ORDER BY relevance DESC, item_id LIMIT 10),
    c AS (SELECT 'conversations' AS source, conv_id * 1000 + turn AS id, (length(text) % 100)::DOUBLE AS relevance, conv_id AS ts FROM conversations WHERE text ILIKE '%tion%' ORDER BY ts DESC, id LIMIT 10)
    SELECT * FROM (SELECT * FROM d UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c) ORDER BY relevance DESC, ts DESC, source, id LIMIT 10"""
)
def search_topk(spark, d):
    view = lambda df, i, r, ts: df.select(i.alias("id"), F.lit("").alias("title"), r.cast("double").alias("relevance"), ts.alias("ts"), "text")
    docs = view(t(spark, d, "documents"), F.col("doc_id"), F.col("n_chars") % 100, F.col("doc_id"))
    bench = view(t(spark, d, "benchmark"), F.col("item_id"), F.char_length("text") % 100, F.col("item_id"))
    turns = view(t(spark, d, "conversations"), F.col("conv_id") * 1000 + F.col("turn"), F.char_length("text") % 100, F.col("conv_id"))
    by_relevance: list[Column] = [F.desc_nulls_last("relevance"), F.col("id")]
    found = search.search([("documents", docs, ["text"], by_relevance), ("benchmark", bench, ["text"], by_relevance), ("conversations", turns, ["text"], [F.desc_nulls_last("ts"), F.col("id")])], "tion")
    return found.select("source", "id", "relevance", "ts")


ORDERS = """o AS (SELECT o_orderkey, round(o_totalprice)::BIGINT AS price, n FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, round(sum(l_extendedprice::DECIMAL(18, 2)))::BIGINT AS total FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey)"""


def _verified(spark: SparkSession, d: str) -> DataFrame:
    ours = t(spark, d, "orders").select(F.col("o_orderkey").alias("name"), (F.col("o_orderkey") % 7).alias("downloads"), F.col("o_orderstatus").alias("repository"), F.col("o_orderpriority").alias("description"))
    theirs = t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("name")).agg(F.count(F.lit(1)).alias("downloads"), F.max("l_linestatus").alias("repository"), F.lit("1-URGENT").alias("description"))
    return verify.verified(ours, theirs)


VERIFIED = """j AS (SELECT o_orderkey, l.n IS NOT NULL AS has, o_orderkey % 7 AS d1, coalesce(l.n, 0) AS d2, o_orderstatus AS r1, l.s AS r2, o_orderpriority AS p FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, max(l_linestatus) AS s FROM lineitem GROUP BY 1) l ON l_orderkey = o_orderkey),
r AS (SELECT o_orderkey, has AND d1 <> d2 AS bad_downloads, has AND r1 <> '' AND r2 <> '' AND r1 <> r2 AS bad_repository, has AND p <> '' AND p <> '1-URGENT' AS warn FROM j)"""


@query(f"WITH {VERIFIED} SELECT count(*) AS total, count(*) FILTER (NOT bad_downloads AND NOT bad_repository) AS verified, count(*) FILTER (bad_downloads OR bad_repository) AS failed, sum(bad_downloads::INT + bad_repository::INT)::BIGINT AS discrepancies, sum(warn::INT)::BIGINT AS warnings FROM r")
def verify_summary(spark, d):
    return verify.summary(_verified(spark, d))


@query(f"WITH {VERIFIED} SELECT * FROM (SELECT 'downloads' AS field, count(*) FILTER (bad_downloads) AS n FROM r UNION ALL SELECT 'repository', count(*) FILTER (bad_repository) FROM r) WHERE n > 0")
def discrepancy_counts(spark, d):
    return verify.discrepancy_counts(_verified(spark, d))


@query("SELECT event_type, count(*) AS processed, count(*) FILTER (value < 10) AS failed, count(*) - count(*) FILTER (value < 10) AS succeeded, round(count(*) * 100.0 / 10000, 6)::DOUBLE AS progress, round((count(*) - count(*) FILTER (value < 10)) * 100.0 / count(*), 6)::DOUBLE AS success_rate FROM events GROUP BY 1")
def progress_metrics(spark, d):
    out = progress.metrics(t(spark, d, "events"), F.lit(10000), F.col("value") < 10, ["event_type"])
    return out.select("event_type", "processed", "failed", "succeeded", F.round("progress", 6).alias("progress"), F.round("success_rate", 6).alias("success_rate"))


@query("SELECT round(avg(value) FILTER (value > 0), 4) AS mean, min(value) FILTER (value > 0) AS low, max(value) FILTER (value > 0) AS high, round(count(*) FILTER (value > 0) / (sum(value) FILTER (value > 0) / 60), 4) AS per_minute FROM events")
def performance_stats(spark, d):
    return progress.performance(t(spark, d, "events"), "value").select(F.round("mean", 4).alias("mean"), "low", "high", F.round("per_minute", 4).alias("per_minute"))


@query("WITH c AS (SELECT CASE event_type WHEN 'error' THEN 'FAIL' WHEN 'signup' THEN 'WARN' ELSE 'PASS' END AS s FROM events) SELECT count(*) FILTER (s = 'PASS') AS passed, count(*) FILTER (s = 'FAIL') AS failed, count(*) FILTER (s = 'WARN') AS warned, 0::BIGINT AS errors, CASE WHEN count(*) FILTER (s = 'FAIL') > 0 THEN 'FAIL' WHEN count(*) FILTER (s = 'WARN') > 0 THEN 'WARN' ELSE 'PASS' END AS overall FROM c")
def validation_summary(spark, d):
    status = F.when(F.col("event_type") == "error", "FAIL").when(F.col("event_type") == "signup", "WARN").otherwise("PASS")
    return verify.check_summary(t(spark, d, "events").select(F.col("event_id").alias("name"), status.alias("status")))


@query("SELECT count(*) AS items, round(avg(value), 4) AS seconds_per_item, sum(value::DECIMAL(18, 2))::DOUBLE AS cost FROM events")
def cost_report(spark, d):
    out = progress.cost_report(t(spark, d, "events").withColumn("cost", F.col("value").cast("decimal(18,2)")), "value", "cost")
    return out.select("items", F.round("seconds_per_item", 4).alias("seconds_per_item"), F.col("cost").cast("double").alias("cost"))


@query("SELECT event_type AS status, event_id FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) <= 10")
def last_messages(spark, d):
    rows = t(spark, d, "events").select(F.col("event_type").alias("status"), "event_id", F.col("props").alias("message"))
    return progress.last_messages(rows, "event_id").select("status", "event_id")


# ---- pages and enrichment


@query("SELECT count(*) AS n, count(*) FILTER (source = 'docs' ) AS docs, count(*) FILTER (failed) AS failed FROM (SELECT s AS source, s <> 'docs' OR text IS NULL AS failed FROM documents, (SELECT unnest(['crates_io', 'docs', 'lib_rs']) AS s))")
def scrape_rows(spark, d):
    names = t(spark, d, "documents").select(F.col("doc_id").cast("string").alias("name"))
    pages = t(spark, d, "documents").select(F.col("doc_id").cast("string").alias("name"), F.lit("docs").alias("source"), F.col("text").alias("content"), F.lit("page").alias("extraction_method"), F.lit("").alias("structured_data"), F.lit(None).cast("string").alias("error"))
    got = packages.scrape_results(names, pages)
    return got.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("source") == "docs").alias("docs"), F.count_if(F.col("extraction_method") == "failed").alias("failed"))


@query("SELECT user_id, min(event_id) AS first_event, max(event_id) AS last_event, round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0, 3)::DOUBLE AS seconds FROM events GROUP BY 1")
def elapsed_times(spark, d):
    g = t(spark, d, "events").groupBy("user_id").agg(F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event"), F.min("ts").alias("a"), F.max("ts").alias("b"))
    return g.select("user_id", "first_event", "last_event", F.round(values.elapsed(F.col("a"), F.col("b")), 3).alias("seconds"))


def queries() -> dict[str, Query]:
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(registry.SQL)
