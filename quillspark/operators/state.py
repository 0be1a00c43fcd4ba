"""Incremental work: what is already known is found by joins with kept tables, never by files of keys."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def settings_hash(settings: dict) -> str:
    """16 hex digits of the settings, whatever their order."""
    return hashlib.sha256(json.dumps(settings, sort_keys=True).encode()).hexdigest()[:16]


def component_version(components: dict[str, str]) -> str:
    """12 hex digits of the versions of a pipeline's parts."""
    return hashlib.sha256(json.dumps(components, sort_keys=True).encode()).hexdigest()[:12]


def source_hash(*columns: str) -> Column:
    """Hash of a source row; a changed row is worked on again, others are not."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def url_key(url: Column) -> Column:
    return F.md5(url)


def not_yet_known(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in ``known``; rows with a null key are never known."""
    return rows.join(known.select(F.col(key).alias("_known")).distinct(), F.col(key) == F.col("_known"), "left_anti")


def already_known(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    return rows.join(known.select(F.col(key).alias("_known")).distinct(), F.col(key) == F.col("_known"), "left_semi")


def reuse_embeddings(chunks: DataFrame, embeddings: DataFrame, model: str) -> DataFrame:
    """``id, embedding``: vectors of ``model`` that are kept for these chunks, null for those to compute.

    A chunk has one row however often its vector is kept; empty vectors are none.
    """
    kept = embeddings.where((F.col("embedding_model") == model) & (F.size("embedding") > 0)).groupBy(F.col("id").alias("_id")).agg(F.max("embedding").alias("embedding"))
    return chunks.where("id is not null").select("id").distinct().join(kept, F.col("id") == F.col("_id"), "left").select("id", "embedding")


def sources_hash(sources: DataFrame) -> str:
    """Hash of a whole source list, whatever its order: any added, changed or dropped row gives another one."""
    each = F.conv(F.substring(source_hash("id", "url", "title", "tags"), 1, 12), 16, 10).cast("decimal(20,0)")
    row = sources.select("id", "url", "title", "tags").agg(F.count("*").alias("n"), F.sum(each).alias("s"), F.sum((each * each) % 1_000_000_007).alias("q")).first()
    return hashlib.sha256(f"{row.n} {row.s} {row.q}".encode()).hexdigest()[:16]


def still_valid(manifest: DataFrame, settings: str, at: Column, seconds: int = 86_400, sources: str | None = None) -> DataFrame:
    """Rows of a manifest for these settings, and these sources if given, that are not older than a day (or ``seconds``)."""
    age = F.unix_timestamp(at.cast("timestamp")) - F.unix_timestamp(F.col("created_at").cast("timestamp"))
    kept = manifest.where((F.col("settings") == settings) & age.between(0, seconds))
    return kept if sources is None else kept.where(F.col("sources") == sources)


def keep_chunks(chunks: DataFrame, folder: str, settings: str, sources: str, at: Column) -> None:
    """Chunks without vectors kept for a run's settings and sources; an earlier run of the same is replaced."""
    named = chunks.drop("embedding").withColumns({"settings": F.lit(settings), "sources": F.lit(sources), "created_at": at})
    named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("settings", "sources").parquet(folder)


def kept_chunks(spark, folder: str, settings: str, sources: str, at: Column, seconds: int = 86_400) -> DataFrame:
    """What ``keep_chunks`` kept for these settings and sources, without rows if it is too old; only that partition is read."""
    rows = spark.read.option("basePath", folder).schema(spark.read.parquet(folder).schema).parquet(folder)
    return still_valid(rows, settings, at, seconds, sources).drop("settings", "sources", "created_at")


def keep_embeddings(chunks: DataFrame, folder: str) -> None:
    """Vectors added to the kept ones, by model; of a repeated id the reader takes one."""
    rows = chunks.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0)).select("id", "embedding", "embedding_model")
    rows.write.mode("append").partitionBy("embedding_model").parquet(folder)


def without_old(manifest: DataFrame, at: Column, hours: int = 168) -> DataFrame:
    return manifest.where(F.unix_timestamp(at.cast("timestamp")) - F.unix_timestamp(F.col("created_at").cast("timestamp")) <= hours * 3600)


def cache_info(table: DataFrame, when: str) -> DataFrame:
    """``n, oldest, newest`` of a kept table."""
    return table.agg(F.count("*").alias("n"), F.min(when).alias("oldest"), F.max(when).alias("newest"))


def invalidate(spark, *paths: str) -> None:
    """Deletes kept tables; those that aren't there are no error."""
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
