"""The append-only event log as a stream.

The catalog itself has no streams; this reads its log as one. State is bounded by the watermark for
repeats and by the number of requests for latest states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from loomcat.operators.workflow import latest


def event_stream(spark: SparkSession, folder: str, schema: StructType, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def once(events: DataFrame, time: str = "occurred_at", event: str = "event_id", delay: str = "1 day") -> DataFrame:
    """Each event once, within the watermark."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark([event])


def windowed(events: DataFrame, time: str, key: str, width: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """(start, key, count) in tumbling windows, final once the watermark has passed."""
    counted = events.withWatermark(time, delay).groupBy(F.window(time, width), key).agg(F.count("*").alias("count"))
    return counted.select(F.col("window.start").alias("start"), key, "count")


def keep_latest(events: DataFrame, table: str, checkpoint: str, **columns: str) -> StreamingQuery:
    """Keeps (request, last_event_at, status) in a parquet table, a version for each batch; a repeated batch writes its version again."""

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        request = columns.get("request", "request_id")
        new = latest(batch, **columns)
        if number:
            old = spark.read.parquet(f"{table}/version={number - 1}")
            order = F.struct("last_event_at", "status")
            new = old.unionByName(new).groupBy(request).agg(F.max(order).alias("x")).select(request, "x.*")
        new.write.mode("overwrite").parquet(f"{table}/version={number}")

    return events.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
