"""What the operators of this subpackage share: the shared folder, written tables, text helpers."""

from __future__ import annotations

import gc
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import new_path, shared_dir, written

__all__ = ["bounded_batches", "drop_written", "heavy_join", "local_path", "lower_ascii", "new_path", "release_shuffles", "shared_dir", "small", "squeezed", "text_of", "word_count", "written"]

#: The characters of ``[\x20\x09-\x0D]``: what separates words.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows up to which a small dimension may be broadcast; it is counted first.
BROADCAST_ROWS = 20_000
#: Bytes of rows that a Python worker is sent at once.
BATCH_BYTES = 4 << 20
#: A key is heavy if it has more than this part of all rows: there are fewer heavy keys than this.
HEAVY = 1000


def local_path(url: str) -> str:
    """A path that workers can open and map; the shared folder must be a mounted file system for that."""
    if url.startswith("file:"):
        return "/" + url[5:].lstrip("/")
    if "://" in url:
        raise RuntimeError(f"memory-mapped files need a mounted shared folder, not {url}")
    return url


def drop_written(df: DataFrame) -> None:
    """Deletes a table made by :func:`written` that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_of(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def squeezed(text: Column) -> Column:
    """The text without its separating characters."""
    return F.translate(text, SPACES, "")


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows stay under the bound, else as it is for a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def bounded_batches(spark: SparkSession) -> None:
    """Bounds Arrow batches by bytes in this session, unless a lower bound is set: rows of whole texts have no usual size."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key).rstrip("b")
    if now.lstrip("-").isdigit() and not 0 < int(now) <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def release_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of steps whose results are written: it does so when the driver collects its
    garbage, which may be long after."""
    for _ in range(2):  # what Python lets go of reaches the driver a moment later
        gc.collect()
        time.sleep(0.1)
        spark._jvm.System.gc()


def heavy_join(rows: DataFrame, lookup: DataFrame, key: str | list[str], weight: str, salts: int = 64) -> DataFrame:
    """``rows`` joined with ``lookup``, which has a row for every ``key``, without nulls, and, as ``weight``, how many of ``rows`` have it.

    Rows of a heavy key are spread over ``salts`` tasks, and its row of ``lookup`` goes to each of them. Fewer than
    ``HEAVY`` keys can be heavy, so that their list is broadcast at any size. ``lookup`` is read three times.
    """
    key = [key] if isinstance(key, str) else key
    total = lookup.agg(F.sum(weight)).first()[0] or 0
    heavy = F.col(weight) > max(int(total) // HEAVY, 1)
    listed = F.broadcast(lookup.where(heavy).select(*key, F.lit(True).alias("_heavy")))
    salt = F.when(F.col("_heavy"), F.pmod(F.xxhash64(F.spark_partition_id(), *rows.columns), F.lit(salts))).otherwise(F.lit(0)).cast("int")
    spread = F.when(heavy, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return rows.join(listed, key, "left").withColumn("_salt", salt).drop("_heavy").join(lookup.withColumn("_salt", F.explode(spread)), [*key, "_salt"]).drop("_salt")
