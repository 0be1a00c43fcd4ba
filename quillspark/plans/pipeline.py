"""The whole way from fetched files to validated, annotated chunks: one lazy DataFrame for each arrow."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions import chunk_model, cleaning, hashing, pii, rights, semantics, signals, urls
from quillspark.operators import chunking, extraction, reports, routing


def to_documents(files: DataFrame, ocr: bool = False) -> DataFrame:
    """Routed, extracted and cleaned documents of rows ``id, url, content, content_type``; invalid ones are left out.

    Types that can't be processed go before any bytes are read.
    """
    routed = routing.routed(files, "url", "content_type", ocr)
    texts = extraction.with_text(routed).where("text is not null")
    cleaned = cleaning.cleaned(texts, "text", F.col("processing"))
    return cleaned.where("_clean.is_valid").select("id", "url", F.col("_clean.text").alias("text"), "kind")


def to_chunks(documents: DataFrame, at: datetime | Column, options: chunking.ChunkOptions | None = None, enrich: str = "core", title: str | None = None) -> DataFrame:
    """Chunks of documents ``url, text`` with identity, quality and hash columns.

    ``enrich='full'`` adds topics, entities, personal data, licence and the like. ``at`` is the time of
    the crawl, given so that runs can be repeated. What a chunk needs of its document goes through the
    chunker beside the key, so repeated URLs and rows each have their own chunks and nothing is joined.
    """
    now = at if isinstance(at, Column) else F.lit(at).cast("timestamp_ntz")
    named = documents.withColumn("_title", F.col(title) if title else F.lit(""))
    prepared = named.withColumn("text", cleaning.strip_frontmatter(F.col("text"))).withColumn("doc_id", urls.doc_id(F.col("url"), 16)).withColumn("doc_sha1", hashing.doc_sha1(F.col("text")))
    keyed = prepared.select(F.struct("doc_id", "url", "doc_sha1", urls.source_type(F.col("url"), F.col("text")).alias("source_type")).alias("_key"), "text", "_title")
    rows = chunking.structure_chunks(keyed, "_key", "text", "_title", options).select("_key.*", "*").drop("_key")
    features = signals.content_features(F.col("text"))
    parts = urls.url_components(F.col("url"))
    rows = rows.withColumn("_f", features).withColumn("_u", parts)
    rows = rows.select(
        hashing.chunk_id(F.col("doc_id"), F.col("chunk_index"), F.col("text")).alias("id"), "doc_id", F.col("url").alias("source_url"), F.col("_u.canonical_url").alias("canonical_url"),
        F.col("_u.domain").alias("domain"), F.col("_u.path").alias("path"), "source_type", signals.modality(F.col("text"), F.col("_f.has_table"), F.col("_f.has_code")).alias("modality"),
        urls.detect_format(F.col("url")).alias("format"), chunk_model.detect_language(F.col("text")).alias("lang"), chunk_model.detection_confidence(F.col("text")).alias("language_confidence"),
        "text", "tokens", F.col("title").alias("page_title"), F.col("headings").alias("title_hierarchy"), "chunk_index", "total_chunks", "section_type",
        F.col("_f.links_out").alias("links_out"), signals.retrieval_weight(F.col("text"), F.col("title"), F.lit("structured")).alias("retrieval_weight"),
        urls.source_confidence(F.col("_u.domain"), F.col("source_type")).alias("source_confidence"), hashing.content_sha1(F.col("text")).alias("content_sha1"), "doc_sha1",
        hashing.simhash(F.col("text")).cast("string").alias("simhash"), now.alias("crawl_ts"),
    )
    if enrich == "full":
        flags = pii.pii_flags(F.col("text"))
        rows = rows.withColumn("topics", semantics.topics(F.col("text"))).withColumn("entities", semantics.entities(F.col("text"))).withColumn("citations", semantics.citations(F.col("text")))
        rows = rows.withColumn("units", semantics.units(F.col("text"))).withColumn("code_langs", semantics.code_languages(F.col("text"))).withColumn("table_schema", semantics.table_schema(F.col("text")))
        rows = rows.withColumn("math_latex", semantics.math_expressions(F.col("text"))).withColumn("content_warnings", signals.content_warnings(F.col("text")))
        rows = rows.withColumn("_p", flags).withColumn("pii_types", F.array_compact(F.array(*[F.when(F.col(f"_p.{k}"), F.lit(k)) for k in pii.FLAGS]))).withColumn("pii", F.size("pii_types") > 0).drop("_p")
        rows = rows.withColumn("license", rights.detect_license(F.col("text"))["license"])
    return reports.only_valid(reports.validated(rows)).drop("issues")
