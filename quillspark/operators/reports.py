"""Counts and reports over sources, checks and chunks; all aggregate partially before they shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.signals import validation


def validated(chunks: DataFrame, text: str = "text") -> DataFrame:
    """Chunks with the columns of :func:`validation`; a ``section_type`` that is there may be replaced."""
    given = F.col("section_type") if "section_type" in chunks.columns else None
    out = chunks.withColumn("_v", validation(F.col(text), given))
    for name in ("is_valid", "issues", "warnings", "section_type", "is_low_signal"):
        out = out.withColumn(name, F.col(f"_v.{name}"))
    return out.drop("_v")


def only_valid(chunks: DataFrame) -> DataFrame:
    return chunks.where("is_valid")


def section_types(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("section_type").agg(F.count("*").alias("n"))


def quality_report(chunks: DataFrame) -> DataFrame:
    """One row: numbers of chunks, average length in whole characters and the kinds of problems."""
    flat = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_set(c))))
    return chunks.agg(
        F.count("*").alias("total"), F.count_if("is_valid").alias("valid"), F.count_if("is_low_signal").alias("low_signal"),
        F.expr("sum(length(text)) div count(*)").alias("avg_length"), flat("issues").alias("issues"), flat("warnings").alias("warnings"),
    )


def organised(category: Column, doc_id: Column) -> tuple[Column, Column]:
    """Lower-case category, ``general`` without one, and document, ``unknown`` without one."""
    some = lambda c, x: F.when(F.coalesce(c, F.lit("")) != "", c).otherwise(x)
    return F.lower(some(category, "general")), some(doc_id, "unknown")


def summary(chunks: DataFrame) -> DataFrame:
    """``category, doc_id, n_chunks, n_chars``: per document, per category and (both null) over all."""
    category, doc = organised(F.col("category"), F.col("doc_id"))
    rows = chunks.select(category.alias("category"), doc.alias("doc_id"), F.length("text").alias("_n"))
    grouped = rows.rollup("category", "doc_id").agg(F.count("*").alias("n_chunks"), F.sum("_n").alias("n_chars"), F.grouping_id().alias("level"))
    return grouped.select("category", "doc_id", F.col("level").cast("bigint").alias("level"), "n_chunks", "n_chars")


def tag_counts(chunks: DataFrame, tags: str) -> DataFrame:
    return chunks.select(F.explode(tags).alias("tag")).groupBy("tag").agg(F.count("*").alias("n"))


def shares(chunks: DataFrame, by: str) -> DataFrame:
    """Counts by a column and their per cent of all, to two digits."""
    counted = chunks.groupBy(by).agg(F.count("*").alias("n"))
    total = counted.agg(F.sum("n").alias("_all"))
    return counted.join(F.broadcast(total)).select(by, "n", F.round(F.col("n") * 100.0 / F.col("_all"), 2).alias("pct"))  # the other side is one row


def latest_checks(checks: DataFrame) -> DataFrame:
    """The last check of every source by time of checking, then of arrival; repeated rows count once."""
    fields = ["checked_at", "arrived_at", "accessible", "status_code", "content_type", "error"]
    last = checks.where("id is not null").groupBy("id").agg(F.max(F.struct(*fields)).alias("_c"))
    return last.select("id", "_c.*")


def tag(tags: Column, name: str) -> Column:
    """A text value of a JSON object of tags; null if the object is broken."""
    return F.get_json_object(tags, f"$.{name}")


def one_per_source(sources: DataFrame) -> DataFrame:
    """Sources with an id, repeated rows once."""
    return sources.where("id is not null").groupBy("id").agg(F.max(F.struct("url", "title", "tags")).alias("_s")).select("id", "_s.*")


def accessibility(sources: DataFrame, checks: DataFrame) -> DataFrame:
    """``category, sources, accessible, success_rate``: by the last check of each source."""
    category = F.coalesce(tag(F.col("tags"), "category"), F.lit("general"))
    listed = one_per_source(sources).select("id", category.alias("category"))
    joined = listed.join(latest_checks(checks), "id")
    grouped = joined.groupBy("category").agg(F.count("*").alias("sources"), F.count_if("accessible").alias("accessible"))
    return grouped.withColumn("success_rate", F.round(F.col("accessible") * 100.0 / F.col("sources"), 2))


def failure_reasons(checks: DataFrame) -> DataFrame:
    """``reason, n`` of failed last checks: the error up to 100 characters, else the status code."""
    failed = latest_checks(checks).where("not coalesce(accessible, false)")
    reason = F.coalesce(F.substring("error", 1, 100), F.concat(F.lit("HTTP "), F.col("status_code").cast("int").cast("string")), F.lit("unknown"))
    return failed.groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


def run_statistics(sources: DataFrame, chunks: DataFrame) -> DataFrame:
    """One row: sources, how many have chunks, and chunks per successful source."""
    per = chunks.groupBy("source_id").agg(F.count("*").alias("_n"))
    joined = sources.join(per, sources["id"] == per["source_id"], "left")
    return joined.agg(
        F.count("*").alias("sources"), F.count("_n").alias("successful"), F.coalesce(F.sum("_n"), F.lit(0)).alias("chunks"),
        F.round(F.count("_n") * 100.0 / F.greatest(F.count("*"), F.lit(1)), 2).alias("success_rate"), F.round(F.coalesce(F.sum("_n"), F.lit(0)) / F.greatest(F.count("_n"), F.lit(1)), 2).alias("chunks_per_source"),
    )


def failed_sources(attempts: DataFrame, most: int = 5) -> DataFrame:
    """The first failed sources by id, with why: nothing came, or nothing was left."""
    why = F.when(F.col("fetched"), "empty").otherwise("failed")
    return attempts.where("coalesce(n_chunks, 0) = 0").select("id", why.alias("why")).orderBy("id").limit(most)
