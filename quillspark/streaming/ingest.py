"""Streams of documents: files as they arrive, first deliveries only, windowed counts, chunks by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def document_stream(spark: SparkSession, folder: str, schema: StructType, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def first_deliveries(stream: DataFrame, text: str = "text", time: str = "crawl_ts", delay: str = "1 hour") -> DataFrame:
    """One row for each text seen within the delay; state older than that is dropped."""
    hashed = stream.withColumn("content_sha1", F.sha1(F.coalesce(F.col(text), F.lit(""))))
    return hashed.withWatermark(time, delay).dropDuplicatesWithinWatermark(["content_sha1"])


def arrivals(stream: DataFrame, time: str = "crawl_ts", window: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """``window_start, domain, n``: arrivals by window; what is later than the delay no longer counts."""
    counted = stream.withWatermark(time, delay).groupBy(F.window(time, window).alias("_w"), "domain").agg(F.count("*").alias("n"))
    return counted.select(F.col("_w.start").alias("window_start"), "domain", "n")


def run_available(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Works through what is there in batches, then ends; a restart goes on where the last run ended."""
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
