"""Content types of sources and how each is extracted."""

from __future__ import annotations

import mimetypes

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Content types of MIME types and of URL suffixes, extraction methods, processing types.
MIME = {
    "text/html": "html", "application/xhtml+xml": "html", "text/xml": "html", "application/xml": "html", "application/pdf": "pdf", "application/x-pdf": "pdf",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document": "docx", "application/msword": "doc",
    "application/vnd.openxmlformats-officedocument.presentationml.presentation": "pptx", "application/vnd.ms-powerpoint": "ppt",
    "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet": "xlsx", "application/vnd.ms-excel": "xls",
    "text/plain": "text", "text/markdown": "markdown", "text/x-markdown": "markdown", "application/json": "json", "text/csv": "csv",
    "image/jpeg": "image", "image/jpg": "image", "image/png": "image", "image/tiff": "image", "image/bmp": "image", "image/gif": "image", "image/webp": "image",
}
METHODS = ["html", "pdf", "docx", "doc", "pptx", "ppt", "xlsx", "xls", "text", "markdown", "json", "csv"]
PROCESSING = {
    "pdf": "pdf", "html": "html", "docx": "document", "doc": "document", "pptx": "document", "ppt": "document", "xlsx": "spreadsheet", "xls": "spreadsheet",
    "csv": "spreadsheet", "json": "data", "markdown": "markdown", "text": "text", "image": "image",
}
EXTRA_SUFFIXES = {".pdf": "application/pdf", ".html": "text/html", ".htm": "text/html", ".docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document", ".md": "text/markdown", ".markdown": "text/markdown"}


def _mapping(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def suffix_types() -> dict[str, str]:
    """MIME types of suffixes that have a content type."""
    known = {s: m for s, m in mimetypes.types_map.items() if m in MIME}
    return known | EXTRA_SUFFIXES


def mime_type(url: Column, header: Column) -> Column:
    """The header's type without parameters, else the URL's suffix's, else octet-stream."""
    told = F.lower(F.trim(F.split_part(F.coalesce(header, F.lit("")), F.lit(";"), F.lit(1))))
    suffix = F.lower(F.regexp_extract(url, r"^[^?#]*(\.[A-Za-z0-9]+)(?:[?#].*)?$", 1))
    return F.when(told != "", told).otherwise(F.coalesce(_mapping(suffix_types())[suffix], F.lit("application/octet-stream")))


def content_type(url: Column, header: Column) -> Column:
    """Content type, ``unknown`` if nothing tells it; URLs that speak of pdf count as such then."""
    known = _mapping(MIME)[mime_type(url, header)]
    low = F.lower(F.coalesce(url, F.lit("")))
    pdf = low.contains("/pdf/") | low.contains("format=pdf") | low.contains(".pdf")
    return F.coalesce(known, F.when(pdf, "pdf").otherwise("unknown"))


def extraction_method(kind: Column, ocr: bool = False) -> Column:
    methods = {k: f"extract_{k}" for k in METHODS} | {"image": "extract_image_ocr" if ocr else "skip_image"}
    return F.coalesce(_mapping(methods)[kind], F.lit("extract_fallback"))


def should_process(kind: Column, ocr: bool = False) -> Column:
    return (kind != "unknown") & ((kind != "image") | F.lit(ocr))


def processing_type(kind: Column) -> Column:
    return F.coalesce(_mapping(PROCESSING)[kind], F.lit("general"))


def routed(sources: DataFrame, url: str = "url", header: str = "content_type", ocr: bool = False) -> DataFrame:
    """``sources`` with ``kind, method, processing``, without those that can't be processed."""
    kind = content_type(F.col(url), F.col(header))
    out = sources.withColumn("kind", kind).withColumn("method", extraction_method(F.col("kind"), ocr)).withColumn("processing", processing_type(F.col("kind")))
    return out.where(should_process(F.col("kind"), ocr))
