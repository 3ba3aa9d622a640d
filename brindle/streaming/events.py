"""The batch loop as a stream: new files in, checkpoints and progress out, resumable."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def arriving(spark: SparkSession, path: str, schema: StructType, files: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def processed(stream: DataFrame, work: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Everything there is now, in batches; a batch that is run again replaces its own folder, so none is doubled."""

    def one(batch: DataFrame, number: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def throughput(stream: DataFrame, ts: str = "ts", value: str = "value", window: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Items, failures and mean duration by time window; state is dropped once the watermark has passed it."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, window)).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "error").alias("failed"), F.avg(value).alias("mean")).select(F.col("window.start").alias("start"), "n", "failed", "mean")
