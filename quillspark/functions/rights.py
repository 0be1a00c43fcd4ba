"""Licences, attribution, robots directives and dates from metadata."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark.functions.batched import batched
from quillspark.functions.urls import has_any

# Metadata fields read for dates, in order.
PUBLISHED = ["datePublished", "published_time", "publish_date", "created_at", "publication_date"]
MODIFIED = ["dateModified", "modified_time", "updated_at", "lastmod", "last_updated"]
VALID_FROM = ["validFrom", "effective_date", "start_date"]
VALID_TO = ["validTo", "expiry_date", "end_date"]
# Licence families named in metadata, in order, and whether they ask for attribution.
FAMILIES = [(["creative commons", "cc-by"], "CC-BY-4.0", True), (["cc0", "public domain"], "CC0-1.0", False), (["mit"], "MIT", True), (["apache"], "Apache-2.0", True), (["gpl"], "GPL-3.0", True)]


def detect_license(text: Column, metadata: Column | None = None) -> Column:
    """Struct ``license, attribution_required`` from a metadata text, else from the first 5000 characters."""
    t = F.substring(F.lower(F.coalesce(text, F.lit(""))), 1, 5000)
    row = lambda name, must: F.struct(F.lit(name).alias("license"), F.lit(must).alias("attribution_required"))
    out = F.when(F.lit(False), row("", False))
    if metadata is not None:
        m = F.lower(F.coalesce(metadata, F.lit("")))
        for terms, name, must in FAMILIES:
            out = out.when(has_any(m, terms), row(name, must))
    return (
        out.when(t.contains("creative commons") & has_any(t, ["attribution", "cc-by"]), row("CC-BY-4.0", True))
        .when(t.contains("creative commons") & t.contains("cc0"), row("CC0-1.0", False)).when(t.contains("all rights reserved"), row("proprietary", True))
        .when(t.contains("public domain"), row("public-domain", False)).otherwise(row("", False))
    )


def requires_attribution(license: Column) -> Column:
    return F.coalesce(license.startswith("CC-BY"), F.lit(False))


def attribution_text(license: Column, authors: Column, organizations: Column, url: Column) -> Column:
    """Attribution of what needs one, else null; missing parts are left out."""
    part = lambda xs, a, b: F.when(F.size(xs) > 0, F.concat(F.lit(a), F.array_join(xs, ", "), F.lit(b)))
    sentence = F.concat_ws(
        " ", part(authors, "By ", ""), part(organizations, "(", ")"), F.concat(F.lit("Licensed under "), license), F.when(url != "", F.concat(F.lit("Source: "), url))
    )
    return F.when(requires_attribution(license), sentence)


def robots(html: Column) -> Column:
    """Struct ``noindex, nofollow`` of a page's robots tags."""
    pattern = r"(?i)<meta\s+name=[\"']robots[\"'][^>]*content=[\"']([^\"']*)[\"'][^>]*>"
    contents = F.transform(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(pattern), F.lit(1)), lambda x: F.lower(x))
    return F.struct(F.exists(contents, lambda c: c.contains("noindex")).alias("noindex"), F.exists(contents, lambda c: c.contains("nofollow")).alias("nofollow"))


@batched("timestamp_ntz")
def free_form_date(text: pd.Series) -> pd.Series:
    """A date in any common writing, null if there is none; time zones are dropped."""
    from dateutil import parser

    def one(value):
        try:
            return parser.parse(value).replace(tzinfo=None) if value else None
        except (ValueError, OverflowError, TypeError):
            return None

    return pd.Series([one(x) for x in text], dtype="datetime64[us]")


def metadata_date(metadata: Column, fields: list[str]) -> Column:
    """First date of ``fields`` that can be read, of a map of strings."""
    iso = lambda f: F.coalesce(F.try_to_timestamp(metadata[f]).cast("timestamp_ntz"), free_form_date(metadata[f]))
    return F.coalesce(*[iso(f) for f in fields])


def temporal(metadata: Column) -> Column:
    """Struct ``published_at, modified_at, valid_from, valid_to`` of a map of strings; null where no date can be read."""
    fields = {"published_at": PUBLISHED, "modified_at": MODIFIED, "valid_from": VALID_FROM, "valid_to": VALID_TO}
    return F.struct(*[metadata_date(metadata, names).alias(name) for name, names in fields.items()])


def expired(valid_from: Column, valid_to: Column, at: Column) -> Column:
    """Whether ``at`` lies outside a chunk's validity; open ends don't expire."""
    return F.coalesce(at > valid_to, F.lit(False)) | F.coalesce(at < valid_from, F.lit(False))


def page_spans(pages: Column, text: Column, format: Column) -> Column:
    """Structs ``page, char_start, char_end``: of given page numbers, else one span for a pdf."""
    span = lambda p: F.struct(p.cast("int").alias("page"), F.lit(0).alias("char_start"), F.length(text).alias("char_end"))
    return F.when(F.size(pages) > 0, F.transform(pages, span)).when(format == "pdf", F.array(span(F.lit(1)))).otherwise(F.array().cast("array<struct<page:int,char_start:int,char_end:int>>"))
