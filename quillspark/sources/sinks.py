"""Partitioned JSON and Parquet outputs, replaced partition by partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def placed(chunks: DataFrame) -> DataFrame:
    """With ``category`` in lower case (``general`` without one) and ``subcategory`` (``documents`` without one)."""
    some = lambda name, x: F.when(F.coalesce(F.col(name), F.lit("")) != "", F.col(name)).otherwise(x) if name in chunks.columns else F.lit(x)
    return chunks.withColumn("category", F.lower(some("category", "general"))).withColumn("subcategory", some("subcategory", "documents"))


def chunk_record(chunks: DataFrame) -> DataFrame:
    return chunks.drop("embedding")


def embedding_record(chunks: DataFrame) -> DataFrame:
    return chunks.where(F.col("embedding").isNotNull()).select("id", "embedding", "embedding_model", "embedding_dim")


def write_chunks(chunks: DataFrame, folder: str, format: str = "json", per: str | None = None) -> None:
    """Chunks under ``chunks/`` and vectors under ``embeds/``, by category and subcategory.

    Only partitions that have rows are replaced, so sources can be written one after another. With ``per``
    (a column such as ``doc_id`` or the source's id) each of its values has a folder of its own with one
    file; null or empty values are ``unknown``.
    """
    rows = placed(chunks)
    parts = ["category", "subcategory"]
    if per:
        rows = rows.withColumn("file", F.when(F.coalesce(F.col(per).cast("string"), F.lit("")) != "", F.col(per)).otherwise("unknown"))
        parts.append("file")
    outputs = {"chunks": chunk_record(rows)}
    if "embedding" in chunks.columns:
        outputs["embeds"] = rows.where(F.col("embedding").isNotNull()).select("id", "embedding", "embedding_model", "embedding_dim", *parts)
    for name, out in outputs.items():
        out = out.repartition(*parts) if per else out
        writer = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).format(format)
        (writer.option("ignoreNullFields", "false") if format == "json" else writer).save(f"{folder}/{name}")


def read_chunks(spark: SparkSession, folder: str, format: str = "json") -> DataFrame:
    """Written chunks with their vectors again; a chunk without a vector has a null one."""
    chunks, embeds = (spark.read.format(format).load(f"{folder}/{name}") for name in ("chunks", "embeds"))
    one = embeds.groupBy(F.col("id").alias("_id")).agg(F.max(F.struct("embedding", "embedding_model", "embedding_dim")).alias("_e"))
    known = [c for c in chunks.columns if c not in ("embedding_model", "embedding_dim")]
    return chunks.join(one, F.col("id") == F.col("_id"), "left").select(*known, "_e.*")


def output_file(category: Column, subcategory: Column, source: Column) -> Column:
    """Place of a source's chunks in a layout of one file each."""
    some = lambda c, x: F.when(F.coalesce(c, F.lit("")) != "", c).otherwise(x)
    return F.concat_ws("/", F.lower(some(category, "general")), some(subcategory, "documents"), F.concat(source, F.lit(".jsonl")))


def write_summary(summary: DataFrame, path: str) -> None:
    """A row for each category and document, in as many files as there are tasks."""
    summary.write.mode("overwrite").json(path)
