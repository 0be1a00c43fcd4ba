"""Rules of the chunk record: completeness, quality score, language labels and the wire form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quillspark.functions.binding import let

# Allowed values of enumerated columns.
SOURCE_TYPES = ["official_docs", "community", "internal", "legal", "code", "academic", "news", "dataset", "log"]
MODALITIES = ["text", "table", "code", "equation", "figure", "metadata"]
FORMATS = ["pdf", "html", "md", "docx", "txt", "latex", "json", "csv", "parquet", "rst", "other"]
SENSITIVITIES = ["public", "internal", "confidential", "restricted"]


def chunk_issues(has: set[str]) -> Column:
    """Array of what is wrong with a chunk row; ``has`` are the columns that are there.

    Null numbers pass their range test, as a missing optional value does; null ids and types don't.
    """
    c = F.col
    blank = lambda x: F.coalesce(c(x), F.lit("")) == ""
    outside = lambda x, top: ~c(x).between(0.0, top)
    rules = [
        ({"id"}, lambda: blank("id"), "missing_id"), ({"doc_id"}, lambda: blank("doc_id"), "missing_doc_id"),
        ({"text", "modality"}, lambda: blank("text") & (c("modality") == "text"), "missing_text"),
        ({"id"}, lambda: ~blank("id") & ~(c("id").contains("#") & c("id").contains("-")), "id_format"),
        ({"retrieval_weight"}, lambda: outside("retrieval_weight", 1.5), "retrieval_weight"), ({"source_confidence"}, lambda: outside("source_confidence", 1.0), "source_confidence"),
        ({"quality_score"}, lambda: outside("quality_score", 1.0), "quality_score"), ({"language_confidence"}, lambda: outside("language_confidence", 1.0), "language_confidence"),
        ({"ocr_confidence"}, lambda: outside("ocr_confidence", 1.0), "ocr_confidence"), ({"chunk_index", "total_chunks"}, lambda: (c("chunk_index") >= c("total_chunks")) & (c("total_chunks") > 0), "chunk_index"),
        ({"char_start", "char_end"}, lambda: c("char_start") >= c("char_end"), "char_range"), ({"source_type"}, lambda: ~F.coalesce(c("source_type").isin(SOURCE_TYPES), F.lit(False)), "source_type"),
        ({"modality"}, lambda: ~F.coalesce(c("modality").isin(MODALITIES), F.lit(False)), "modality"), ({"format"}, lambda: ~F.coalesce(c("format").isin(FORMATS), F.lit(False)), "format"),
        ({"sensitivity"}, lambda: ~F.coalesce(c("sensitivity").isin(SENSITIVITIES), F.lit(False)), "sensitivity"), ({"content_sha1"}, lambda: F.coalesce(F.length("content_sha1"), F.lit(0)).isin(0, 40) == F.lit(False), "content_sha1"),
    ]
    return F.array_compact(F.array(*[F.when(rule(), F.lit(name)) for needs, rule, name in rules if needs <= has]))


def quality_score(text: Column, tokens: Column, confidence: Column, modality: Column, ocr: Column, low_signal: Column, entities: Column, keyphrases: Column, citations: Column) -> Column:
    """Score in 0..1, a product of factors in this order; nulls leave their factor at 1."""
    f = lambda cond, x: F.when(cond, F.lit(x)).otherwise(F.lit(1.0))
    score = f(low_signal, 0.5) * f(F.length(F.coalesce(text, F.lit(""))) < 50, 0.7) * f(F.coalesce(tokens, F.lit(0)) < 10, 0.6) * F.coalesce(confidence, F.lit(1.0))
    score = score * F.when(modality == "metadata", F.lit(0.8)).when(modality.isin("table", "code", "equation"), F.lit(1.1)).otherwise(F.lit(1.0)) * F.coalesce(ocr, F.lit(1.0))
    score = score * f(F.size(entities) > 0, 1.05) * f(F.size(keyphrases) > 0, 1.05) * f(F.size(citations) > 0, 1.1)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))


def declared_language(label: Column, detected: Column) -> Column:
    """A declared label of two letters or more wins, cut to two in lower case."""
    return F.when(F.length(label) >= 2, F.lower(F.substring(label, 1, 2))).otherwise(detected)


def detection_confidence(text: Column) -> Column:
    return F.when(F.coalesce(text, F.lit("")) == "", 0.5).when(F.length(text) > 100, 0.99).otherwise(0.79)


# Function words that tell the five languages apart.
FUNCTION_WORDS = {
    "en": ["the", "and", "of", "in", "is", "that", "for", "with", "on", "to"], "fr": ["le", "la", "les", "des", "est", "une", "dans", "pour", "que", "du"],
    "de": ["der", "die", "das", "und", "ist", "von", "mit", "den", "nicht", "auf"], "es": ["el", "los", "las", "una", "por", "con", "para", "del", "se", "que"],
    "pt": ["o", "os", "uma", "não", "para", "com", "dos", "ao", "na", "da"],
}


def detect_language(text: Column, default: str = "en") -> Column:
    """Language with the most function words among the first 1000 characters; ties go in order, none to ``default``."""
    names = F.array(*[F.lit(name) for name in FUNCTION_WORDS])

    def counts(w: Column) -> Column:
        return F.array(*[F.size(F.filter(w, lambda x: x.isin(terms))) for terms in FUNCTION_WORDS.values()])

    def pick(n: Column) -> Column:
        return F.when(F.array_max(n) == 0, default).otherwise(F.element_at(names, F.array_position(n, F.array_max(n)).cast("int")))

    words = F.split(F.lower(F.substring(F.coalesce(text, F.lit("")), 1, 1000)), r"[^\p{L}]+")
    return let(let(words, counts), pick)


# Times of the record keep their microseconds.
_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def chunk_record(columns: list[str]) -> Column:
    """JSON of a chunk without its vector, nulls kept."""
    return F.to_json(F.struct(*[c for c in columns if c != "embedding"]), {"ignoreNullFields": "false"} | _TIMES)


def from_record(record: Column, schema: StructType) -> Column:
    """Struct of a chunk from its JSON, with the columns of ``schema``; what the JSON lacks is null."""
    return F.from_json(record, schema, _TIMES)
