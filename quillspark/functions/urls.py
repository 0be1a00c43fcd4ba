"""URL columns: canonical form, parts, identifiers and what a URL says about its content.

Every function gives null for a null URL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# scheme, authority, path and query of any string, valid URL or not
_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"

# Suffixes of formats, in the order they are tried.
SUFFIXES = [(".pdf", "pdf"), (".html", "html"), (".htm", "html"), (".md", "md"), (".markdown", "md"), (".docx", "docx"), (".txt", "txt"), (".tex", "latex"), (".json", "json"), (".csv", "csv"), (".parquet", "parquet"), (".rst", "rst")]
# Parts of URLs that tell a source's type, in order.
URL_TYPES = [
    ("code", ["github.com", "gitlab.com"]),
    ("academic", [".edu", "arxiv.org", "scholar.google", "pubmed"]),
    ("news", ["news", "bbc.com", "cnn.com", "reuters.com"]),
    ("community", ["stackoverflow.com", "reddit.com"]),
    ("legal", ["legal", "law", "regulation", "compliance"]),
    ("official_docs", ["/docs/", "/documentation/", "/api/"]),
]
# Base confidence of source types, and parts of domains that raise or lower it.
TYPE_CONFIDENCE = {"official_docs": 1.0, "academic": 0.95, "legal": 0.95, "code": 0.9, "dataset": 0.9, "news": 0.8, "community": 0.7, "internal": 1.0, "log": 0.6, "other": 0.8}
TRUSTED = [".gov", ".edu", ".org", "wikipedia.org", "documentation"]
UNTRUSTED = ["blogspot", "wordpress.com", "medium.com", "forum"]


def has_any(text: Column, terms: list[str]) -> Column:
    """Whether ``text`` contains one of ``terms`` as it stands."""
    hit = text.contains(terms[0])
    for t in terms[1:]:
        hit = hit | text.contains(t)
    return hit


def url_part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, _PARTS, group)


def canonical_url(url: Column) -> Column:
    """Lower case, no fragment, no slash at the end, parameters sorted, default port dropped."""
    low = F.lower(url)
    scheme, host, path, query = (url_part(low, i) for i in (1, 2, 3, 4))
    host = F.when((scheme == "http") & host.contains(":80"), F.replace(host, F.lit(":80"))).when((scheme == "https") & host.contains(":443"), F.replace(host, F.lit(":443"))).otherwise(host)
    path = F.regexp_replace(path, "/+$", "")
    path = F.when(path == "", "/").otherwise(path)
    ordered = F.array_join(F.array_sort(F.split(query, "&", -1)), "&")
    return F.concat(
        F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""), F.when(host != "", F.concat(F.lit("//"), host)).otherwise(""),
        path, F.when(query != "", F.concat(F.lit("?"), ordered)).otherwise(""),
    )


def normal_domain(host: Column) -> Column:
    return F.regexp_replace(host, r"^www\.", "")


def url_components(url: Column) -> Column:
    """Struct ``canonical_url, domain, path, ref_fragment``."""
    path = url_part(url, 3)
    return F.struct(
        canonical_url(url).alias("canonical_url"), normal_domain(url_part(url, 2)).alias("domain"),
        F.when(path == "", "/").otherwise(path).alias("path"), F.nullif(url_part(url, 5), F.lit("")).alias("ref_fragment"),
    )


def doc_id(url: Column, digits: int = 6) -> Column:
    """Identifier from the canonical URL; more ``digits`` make collisions rarer."""
    return F.concat(F.lit("doc_"), F.substring(F.sha2(canonical_url(url), 256), 1, digits))


def detect_format(url: Column, content_type: Column | None = None) -> Column:
    low, out = F.lower(url), F.when(url.isNull(), None)
    for suffix, name in SUFFIXES:
        out = out.when(low.endswith(suffix), name)
    if content_type is not None:
        for part, name in (("pdf", "pdf"), ("html", "html"), ("json", "json"), ("text/plain", "txt")):
            out = out.when(content_type.contains(part), name)
    return out.otherwise("html")


def override_content_type(url: Column, tagged: Column) -> Column:
    """Content type of a source: a suffix of the URL goes before its tag, which defaults to html."""
    return F.when(url.endswith(".pdf"), "pdf").when(url.endswith(".md"), "md").when(url.endswith(".docx"), "docx").otherwise(F.coalesce(tagged, F.lit("html")))


def source_type(url: Column, text: Column) -> Column:
    """Type of a source by its URL, else by the first 1000 characters; null texts count as empty."""
    low, all_text = F.lower(url), F.coalesce(text, F.lit(""))
    head = F.substring(F.lower(all_text), 1, 1000)
    out = F.when(url.isNull(), None)
    for name, parts in URL_TYPES:
        out = out.when(has_any(low, parts), name)
    out = out.when(head.contains("copyright") & head.contains("terms"), "legal").when(head.contains("abstract") & head.contains("methodology"), "academic")
    lines = F.length(all_text) - F.length(F.replace(all_text, F.lit("\n")))
    return out.when(has_any(head, ["error", "warning", "debug", "info"]) & (lines > 20), "log").otherwise("official_docs")


def source_confidence(domain: Column, kind: Column) -> Column:
    """Confidence of a source in 0..1: its type's, raised for trusted and lowered for other domains."""
    base = F.create_map(*[F.lit(x) for pair in TYPE_CONFIDENCE.items() for x in pair])[kind]
    host = F.coalesce(domain, F.lit(""))
    factor = F.when(has_any(host, TRUSTED), 1.1).when(has_any(host, UNTRUSTED), 0.8).otherwise(1.0)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce(base, F.lit(0.8)) * factor))


def acquisition_type(url: Column, upload_path: Column) -> Column:
    """How a source came in: upload, file, api or crawl."""
    low = F.lower(url)
    return F.when(F.coalesce(upload_path, F.lit("")) != "", "upload").when(url.startswith("file://"), "file").when(has_any(low, ["/api/", "/v1/", "/v2/", "/graphql", ".json", "/rest/"]), "api").otherwise("crawl")


def anchor_url(canonical: Column, anchor: Column, page: Column) -> Column:
    """Link to a place in a document: an anchor goes before a page number."""
    return F.when(F.coalesce(anchor, F.lit("")) != "", F.concat(canonical, F.lit("#"), anchor)).when(page > 0, F.concat(canonical, F.lit("#page="), page.cast("string"))).otherwise(canonical)
