"""Writers: checkpoints, reports, audit tables."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.packages import most_popular
from ..operators.progress import last_messages


def checkpoint(df: DataFrame, root: str, batch: int, prefix: str = "checkpoint") -> None:
    """A batch as its own partition; writing it again replaces it, all batches together are the cumulative state."""
    df.drop("batch").write.mode("overwrite").json(f"{root}/{prefix}/batch={batch}")


def checkpointed(spark: SparkSession, root: str, schema: StructType, prefix: str = "checkpoint") -> DataFrame:
    """All batches so far, ready to go on from."""
    fields = [f for f in schema.fields if f.name != "batch"] + [StructField("batch", LongType())]
    return spark.read.schema(StructType(fields)).json(f"{root}/{prefix}")


def status(df: DataFrame, path: str, root: str) -> None:
    """A row on a finished checkpoint: time, number of rows, place."""
    df.agg(F.count(F.lit(1)).alias("total")).select(F.current_timestamp().alias("timestamp"), "total", F.lit(path).alias("file")).write.mode("append").json(f"{root}/status")


def status_messages(events: DataFrame, order: str, root: str, n: int = 10) -> None:
    """The last errors and warnings (``status, message``), one JSON row a kind, newest last."""
    kept = last_messages(events, order, n).groupBy("status").agg(F.array_sort(F.collect_list(F.struct(order, "message"))).alias("m"))
    kept.select("status", F.transform("m", lambda x: x["message"]).alias("messages")).write.mode("overwrite").json(root)


def final_output(packages: DataFrame, dependencies: DataFrame, root: str) -> None:
    packages.write.mode("overwrite").json(f"{root}/packages")
    dependencies.write.mode("overwrite").json(f"{root}/dependencies")


def summary_report(packages: DataFrame, depended: DataFrame, root: str, n: int = 10) -> DataFrame:
    """One JSON row: totals, the most popular and the most depended on."""
    popular = most_popular(packages, n).agg(F.array_sort(F.collect_list(F.struct((-F.coalesce("score", F.lit(0.0))).alias("o"), "name"))).alias("p"))
    top = depended.limit(n).agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), "name"))).alias("d"))
    total = packages.agg(F.count(F.lit(1)).alias("total"))
    out = total.join(F.broadcast(popular)).join(F.broadcast(top)).select("total", F.transform("p", lambda x: x["name"]).alias("most_popular"), F.transform("d", lambda x: x["name"]).alias("most_depended"))  # one row each
    out.write.mode("overwrite").json(f"{root}/summary")
    return out


def reports(df: DataFrame, root: str, key: str = "name") -> None:
    """A folder of JSON for every key."""
    df.withColumn("_key", F.col(key)).write.mode("overwrite").partitionBy("_key").json(root)


def audit(traces: DataFrame, root: str) -> bool:
    """Appends traces; an empty log writes nothing."""
    if traces.isEmpty():
        return False
    traces.write.mode("append").parquet(f"{root}/audit")
    return True


def serialised(df: DataFrame) -> DataFrame:
    """Each row as one JSON text."""
    return df.select(F.to_json(F.struct("*")).alias("value"))


def lookup_export(df: DataFrame, order: list[Column], path: str) -> None:
    df.orderBy(*order).coalesce(1).write.mode("overwrite").json(path)  # a lookup table of policies


def _files(spark: SparkSession, path: str):
    """The file system that holds a path, wherever it is, and the path on it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def output_dir(spark: SparkSession, root: str, prefix: str = "output", when: float | None = None) -> str:
    path = f"{root}/{prefix}_{time.strftime('%Y%m%d_%H%M%S', time.gmtime(when))}"
    files, p = _files(spark, path)
    files.mkdirs(p)
    return path


def removed(spark: SparkSession, path: str) -> bool:
    """Deletes a file or folder; False where there is none."""
    files, p = _files(spark, path)
    return files.delete(p, True)


def space_left(spark: SparkSession, path: str, least_gb: float = 1.0) -> bool:
    files, p = _files(spark, path)
    return files.getStatus(p).getRemaining() >= least_gb * 1e9
