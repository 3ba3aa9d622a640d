"""The knowledge base: writing, indexing, searching, histories."""

from __future__ import annotations

import ast
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scores import change_impact, diff_summary, impact_tag
from ..functions.values import content_hash
from ..schemas import KNOWLEDGE

INDEXED = "file_path string, file_name string, file_extension string, function_name string, class_name string, module_name string, code_snippet string, docstring string, imports string, complexity_score double, lines_of_code bigint, content_hash string"


def create_tables(spark: SparkSession, root: str) -> list[str]:
    """Makes the tables that are missing, empty; existing ones stay. Returns the names made."""
    made = []
    for name, schema in KNOWLEDGE.items():
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
        if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            spark.createDataFrame([], schema).write.parquet(f"{root}/{name}")
            made.append(name)
    return made


def missing_tables(existing: list[str]) -> list[str]:
    return sorted(set(KNOWLEDGE) - set(existing))


def append_rows(rows: DataFrame, root: str, name: str) -> None:
    """Rows under the table's schema; columns it has not are dropped, ones the rows have not are null."""
    have = set(rows.columns)
    rows.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in KNOWLEDGE[name].fields]).write.mode("append").parquet(f"{root}/{name}")


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(KNOWLEDGE[name]).parquet(f"{root}/{name}")


def upserted(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Old rows whose key no new row has, and the new rows."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def not_indexed(files: DataFrame, index: DataFrame) -> DataFrame:
    """Files whose path and content the index lacks."""
    return files.join(index.select("file_path", "content_hash"), ["file_path", "content_hash"], "left_anti")


def _structure(path: str | None, text: str) -> tuple:
    name = None if path is None else path.rpartition("/")[2]
    stem, _, ext = (name or "").rpartition(".")
    function = klass = doc = None
    imports: list[str] = []
    branches = 0
    if ext == "py":
        try:
            tree = ast.parse(text)
        except (SyntaxError, ValueError, RecursionError, MemoryError):  # the parser's stack overflows as MemoryError
            tree = None
        if tree is not None:
            doc = ast.get_docstring(tree)
            for node in ast.walk(tree):
                if isinstance(node, (ast.FunctionDef, ast.AsyncFunctionDef)) and function is None:
                    function = node.name
                elif isinstance(node, ast.ClassDef) and klass is None:
                    klass = node.name
                elif isinstance(node, ast.Import):
                    imports += [a.name for a in node.names]
                elif isinstance(node, ast.ImportFrom):
                    imports.append(node.module or "")
                branches += isinstance(node, (ast.If, ast.For, ast.While, ast.Try))
    listed = "[" + ", ".join('"' + i.replace("\\", "\\\\").replace('"', '\\"') + '"' for i in imports) + "]"
    return path, name, ("." + ext) if stem else "", function, klass, stem or name, text[:1000], doc, listed, float(branches), len(text.splitlines())


def index_files(files: DataFrame) -> DataFrame:
    """``files`` (``path, text``) as rows of the code index, one a file; broken sources keep their text columns."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in INDEXED.split(", ")]
        for batch in batches:
            rows = [(*_structure(p, t or ""), h) for p, t, h in zip(batch["path"], batch["text"], batch["hash"], strict=True)]
            yield pd.DataFrame(rows, columns=names)

    return files.select("path", "text", content_hash(F.col("text")).alias("hash")).mapInPandas(run, INDEXED)


def record_change(changes: DataFrame) -> DataFrame:
    """Changes (``file_path, change_type, old_content, new_content, ...``) with summary, impact and tags."""
    impact = change_impact(F.col("old_content"), F.col("new_content"))
    return changes.withColumns({"diff_summary": diff_summary(F.col("old_content"), F.col("new_content")), "impact_score": impact, "tags": F.concat_ws(",", F.col("change_type"), impact_tag(impact)), "affected_functions": F.lit("[]"), "breaking_changes": F.lit(False)})


def cache_documents(docs: DataFrame, root: str) -> None:
    """Documents (``doc_type, title, content, package_name, tags``) appended to the cache with their digest, and to the
    searchable texts."""
    rows = docs.withColumns({"content_hash": content_hash(F.col("content")), "relevance_score": F.lit(1.0), "timestamp": F.current_timestamp().cast("string"), "tags": F.to_json("tags")})
    append_rows(rows, root, "documentation_cache")
    append_rows(rows.withColumn("source", F.lit("documentation_cache")), root, "search_index")


def combined(*tables: DataFrame) -> DataFrame:
    """All rows of all tables; what a table lacks is null."""
    out = tables[0]
    for other in tables[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def matches(query: str, *columns: Column) -> Column:
    """Is the query part of any column, whatever the case? Wildcards in it are ordinary characters."""
    pattern = "%" + query.replace("\\", "\\\\").replace("%", r"\%").replace("_", r"\_") + "%"
    found = F.lit(False)
    for c in columns:
        found = found | F.coalesce(F.ilike(c, F.lit(pattern)), F.lit(False))
    return found


def search(sources: list[tuple[str, DataFrame, list[str], list[Column]]], query: str, limit: int = 10) -> DataFrame:
    """``source, id, title, relevance, ts``: each source (``id, title, relevance, ts`` and the columns searched) ordered and
    cut by itself, then all ranked by relevance and time. Not a global top-k: a source gives ``limit`` rows at most.

    Order and cut are one ``TakeOrderedAndProject`` a source: every task keeps ``limit`` rows.
    """
    out = None
    for name, df, columns, order in sources:
        part = df.where(matches(query, *map(F.col, columns))).orderBy(*order).limit(limit).select(F.lit(name).alias("source"), "id", "title", "relevance", "ts")
        out = part if out is None else out.unionByName(part)
    return out.orderBy(F.col("relevance").desc_nulls_last(), F.col("ts").desc_nulls_last(), "source", "id").limit(limit)


def from_source(found: DataFrame, source: str) -> DataFrame:
    """Only rows of one source among those found; it filters after the limit."""
    return found.where(F.col("source") == source)


def latest(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The last ``n`` rows of each key; the bound is applied before the shuffle as well."""
    return df.withColumn("_i", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_i") <= n).drop("_i")


def active_context(context: DataFrame, key: str | None = None) -> DataFrame:
    found = context.where(F.col("active"))
    return found if key is None else found.where(F.col("context_key") == key)


def inverted_index(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``term, n, ids``-free postings ``term, id, n``: an index by term instead of full-text rows."""
    terms = F.explode(F.regexp_extract_all(F.lower(text_col), F.lit(r"[0-9a-z_]+"), 0))
    return docs.select(F.col(id_col).alias("id"), terms.alias("term")).groupBy("term", "id").agg(F.count(F.lit(1)).alias("n"))


def lookup_document(policies: DataFrame, context: DataFrame) -> DataFrame:
    """Two ordered tables as one JSON document: policies by rank and time, context by key."""
    a = policies.agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("rank")).alias("k"), F.col("policy_name").alias("name"), F.col("description")))), lambda p: F.struct(p["name"].alias("name"), p["description"].alias("description")))).alias("policies"))
    b = context.agg(F.to_json(F.array_sort(F.collect_list(F.struct("context_key", "context_value")))).alias("context"))
    return a.join(F.broadcast(b))  # one row each


def system_profile(profiles: DataFrame) -> DataFrame:
    """Nested view of the newest hardware profile, model paths cut to their names."""
    newest = latest(profiles, ["profile_name"], [F.col("timestamp").desc_nulls_last()])
    models = F.transform(F.from_json("models", "array<string>"), lambda m: F.element_at(F.split(m, "/"), -1))
    return newest.select("profile_name", F.struct(F.coalesce("cpu", F.lit("Unknown")).alias("cpu"), F.coalesce("memory_gb", F.lit(0.0)).alias("memory_gb"), F.coalesce("gpu", F.lit("Unknown")).alias("gpu")).alias("hardware"), models.alias("models"))
