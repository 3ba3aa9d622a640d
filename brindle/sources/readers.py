"""Readers of landed data. No task opens a network connection: what is fetched is landed first."""

from __future__ import annotations

import io
import json
import os
import subprocess
import tarfile
import time
import tomllib
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def names_of(spark: SparkSession, path: str, required: bool = False) -> DataFrame:
    """``name`` of each line that isn't blank, stripped; a missing file gives none, or an error where it is required."""
    if not exists(spark, path):
        if required:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], "name string")
    return spark.read.text(path).select(F.trim(F.regexp_replace("value", r"[\r\t]", " ")).alias("name")).where("name != ''")


def names_in(spark: SparkSession, names: list[str] | None, path: str) -> DataFrame:
    """Names given override the file."""
    return spark.createDataFrame([(n,) for n in names], "name string") if names else names_of(spark, path)


def json_lines(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Lines of JSON under a schema; malformed ones are left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def json_document(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """One JSON document a file; a missing one gives no row."""
    return spark.read.schema(schema).option("multiLine", "true").json(path) if exists(spark, path) else spark.createDataFrame([], schema)


def newest_file(spark: SparkSession, pattern: str) -> str | None:
    """The file of the latest change under a glob."""
    try:
        files = spark.read.format("binaryFile").load(pattern).select("path", "modificationTime")
        row = files.agg(F.max(F.struct("modificationTime", "path")).alias("x")).first()
    except Exception as error:  # a glob that matches nothing
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise
    return row["x"]["path"] if row["x"] else None


def source_tree(spark: SparkSession, root: str, suffix: str = ".rs", pruned: tuple[str, ...] = ("target", ".git")) -> DataFrame:
    """``path, text`` of the files below a folder, outside pruned folders; undecodable bytes are replaced."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*" + suffix).load(root)
    inside = "|".join(p.replace(".", r"\.") for p in pruned)
    return files.where(~F.col("path").rlike(f"/({inside})/")).select("path", F.decode("content", "UTF-8").alias("text"))


def code_files(spark: SparkSession, root: str, pattern: str = "*.{py,rs,toml,md,json,sql,yml}") -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return files.select("path", F.decode("content", "UTF-8").alias("text"))


def file_info(spark: SparkSession, pattern: str) -> DataFrame:
    files = spark.read.format("binaryFile").load(pattern)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"), F.regexp_extract("path", r"(\.[^./]+)$", 1).alias("extension"), F.sha2("content", 256).alias("hash"))


def archives(spark: SparkSession, pattern: str, suffix: str = ".rs") -> DataFrame:
    """``archive, path, text, error``: the text members of tar.gz files; members that aren't UTF-8 have no text, a broken
    archive is one row with its error. One archive is held at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                rows = []
                try:
                    with tarfile.open(fileobj=io.BytesIO(content), mode="r:gz") as tar:
                        for member in tar:
                            if not member.isfile():
                                continue
                            text = None
                            if member.name.endswith(suffix):
                                try:
                                    text = tar.extractfile(member).read().decode()
                                except UnicodeDecodeError:
                                    text = None
                            rows.append((name, member.name, text, None))
                except (tarfile.TarError, OSError, EOFError) as error:
                    rows.append((name, None, None, str(error)))
                yield pd.DataFrame(rows, columns=["archive", "path", "text", "error"])

    return spark.read.format("binaryFile").load(pattern).select("path", "content").mapInPandas(run, "archive string, path string, text string, error string")


def manifests(files: DataFrame) -> DataFrame:
    """``path, manifest, error``: TOML texts as JSON."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for path, text in zip(batch["path"], batch["text"], strict=True):
                try:
                    out.append((path, json.dumps(tomllib.loads(text or ""), default=str, sort_keys=True), None))
                except tomllib.TOMLDecodeError as error:
                    out.append((path, None, str(error)))
            yield pd.DataFrame(out, columns=["path", "manifest", "error"])

    return files.select("path", "text").mapInPandas(run, "path string, manifest string, error string")


def command_messages(spark: SparkSession, path: str) -> DataFrame:
    """Captured newline JSON of a build tool: ``reason, package_id, level, message``; other lines are left out."""
    return json_lines(spark, path, "reason string, package_id string, message struct<level:string,message:string>").where("reason IS NOT NULL").select("reason", "package_id", "message.level", "message.message")


def sqlite_tables(path: str) -> dict[str, list[str]]:
    """Tables and columns of a SQLite file, read on the driver."""
    import sqlite3

    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
        names = [r[0] for r in db.execute("SELECT name FROM sqlite_master WHERE type = 'table' ORDER BY name")]
        return {n: [c[1] for c in db.execute(f'PRAGMA table_info("{n}")')] for n in names}


def sqlite_table(spark: SparkSession, path: str, name: str, schema: str, chunk: int = 100_000) -> DataFrame:
    """A table of a SQLite file by ranges of row numbers, each read by one task; the file must be on a shared path."""
    import sqlite3

    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
        last = db.execute(f'SELECT coalesce(max(rowid), 0) FROM "{name}"').fetchone()[0]
    columns = [c.split()[0] for c in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k in batch["id"]:
                with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
                    rows = db.execute(f'SELECT {", ".join(columns)} FROM "{name}" WHERE rowid > ? AND rowid <= ?', (int(k) * chunk, (int(k) + 1) * chunk)).fetchall()
                yield pd.DataFrame(rows, columns=columns)

    return spark.range(-(-last // chunk) or 1).mapInPandas(run, schema)


def waits(retries: int, base: float = 2.0, first: float = 1.0) -> list[float]:
    return [first * base**k for k in range(retries)]


def with_retry(work: Callable[[], object], retries: int = 3, sleep: Callable[[float], None] = time.sleep, after_last: bool = False) -> object:
    """The first result that isn't an OS error or None; None when the attempts are used up."""
    for k, wait in enumerate(waits(retries)):
        try:
            if (found := work()) is not None:
                return found
        except OSError:
            pass
        if after_last or k < retries - 1:
            sleep(wait)
    return None


def land(urls: dict[str, str], folder: str, ttl: float = 3600.0, fetch: Callable[[str], bytes] | None = None, retries: int = 3) -> list[str]:
    """Fetches URLs to files on the driver unless a file is younger than ``ttl`` seconds; returns names that failed."""
    os.makedirs(folder, exist_ok=True)
    get = fetch or (lambda u: urllib.request.urlopen(u, timeout=30).read())
    failed = []
    for name, url in urls.items():
        path = f"{folder}/{name}"
        if os.path.exists(path) and time.time() - os.path.getmtime(path) < ttl:
            continue
        content = with_retry(lambda url=url: get(url), retries)
        if content is None:
            failed.append(name)
        else:
            with open(path, "wb") as f:
                f.write(content)
    return failed


def git_log_lines(spark: SparkSession, repo: str, most: int = 50) -> DataFrame:
    """``log, n, value`` of a repository's newest commits, for :func:`brindle.operators.history.parse_log`."""
    done = subprocess.run(["git", "-C", repo, "log", f"-{most}", "--numstat", "--date=iso", "--format=%h|%an|%ad|%s"], capture_output=True, text=True)
    lines = done.stdout.splitlines() if done.returncode == 0 else []
    return spark.createDataFrame([(repo, n, v) for n, v in enumerate(lines)], "log string, n bigint, value string")
