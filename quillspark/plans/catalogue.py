"""The catalogue of queries over the supplied tables, with SQL equivalents.

Queries read whole tables. Those without SQL need places of matches, order-dependent folds or decoding
of files, which SQL doesn't offer; tests hold them against plain statements of their rules.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import chunk_model, cleaning, hashing, pii, rights, semantics, signals, urls
from quillspark.operators import chunking, dedup, extraction, html, reports, routing, state, vectors
from quillspark.plans import pipeline
from quillspark.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

_BIG = "bigint"


def _query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# --- pieces of SQL shared by several statements -----------------------------------------------------


def _any(expression: str, terms: list[str]) -> str:
    return "(" + " OR ".join(f"contains({expression}, '{t}')" for t in terms) + ")"


def _count(expression: str, terms: list[str]) -> str:
    return "(" + " + ".join(f"CAST(contains({expression}, '{t}') AS INT)" for t in terms) + ")"


def _listed(rules: list[tuple[str, str]]) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for c, n in rules) + "], lambda x: x IS NOT NULL)"


# White space, word characters and digits of any script, as the dialects' classes differ.
_SP = r"\s\x0B\x1C-\x1F\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_WORD_CHARS = r"\p{L}\p{M}\p{N}\p{Pc}"


def _unicode(pattern: str) -> str:
    """A pattern whose classes are of all scripts."""
    return pattern.replace("[\\w\\s,]", f"[{_WORD_CHARS}{_SP},]").replace("\\s", f"[{_SP}]").replace("\\w", f"[{_WORD_CHARS}]").replace("\\d", r"\p{Nd}")


def _replaced(expression: str, *steps: tuple[str, str]) -> str:
    """Replacements one after another; ``~n`` in a replacement is a line end."""
    for pattern, new in steps:
        quoted = " || chr(10) || ".join(f"'{x}'" for x in new.replace("'", "''").split("~n"))
        expression = f"regexp_replace({expression}, '{pattern.replace(chr(39), chr(39) * 2)}', {quoted}, 'g')"
    return expression


_TRIM = (rf"^[{_SP}]+|[{_SP}]+$", "")
_WINDOW_OPTIONS = chunking.ChunkOptions(100, 20, 10)
_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\r\f]+'), lambda w: w <> '')"
_WINDOWS = f"""
WITH t AS (SELECT doc_id, lang, {_WORDS} AS w FROM documents),
n AS (SELECT *, len(w) AS k FROM t),
p AS (SELECT *, CASE WHEN k > 100 THEN CAST(ceil((k - 100) / 80.0) AS INT) ELSE 0 END AS last FROM n),
x AS (SELECT doc_id, lang, list_filter(list_transform(range(0, last + 1), lambda i: list_slice(w, i * 80 + 1, i * 80 + 100)), lambda c: len(c) >= 10) AS cs FROM p),
c AS (SELECT doc_id, lang, len(cs) AS total_chunks, unnest(range(0, len(cs))) AS chunk_index, cs FROM x),
chunks_of AS (SELECT doc_id, lang, chunk_index, total_chunks, len(cs[chunk_index + 1]) AS tokens, array_to_string(cs[chunk_index + 1], ' ') AS text FROM c)
"""
_CANON_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def _canonical(url: str) -> str:
    part = lambda i: f"regexp_extract(lower({url}), '{_CANON_PARTS}', {i})"
    host = f"CASE WHEN {part(1)} = 'http' AND contains({part(2)}, ':80') THEN replace({part(2)}, ':80', '') WHEN {part(1)} = 'https' AND contains({part(2)}, ':443') THEN replace({part(2)}, ':443', '') ELSE {part(2)} END"
    path = f"CASE WHEN regexp_replace({part(3)}, '/+$', '') = '' THEN '/' ELSE regexp_replace({part(3)}, '/+$', '') END"
    return (
        f"CASE WHEN {url} IS NULL THEN NULL ELSE concat(CASE WHEN {part(1)} <> '' THEN {part(1)} || ':' ELSE '' END, CASE WHEN ({host}) <> '' THEN '//' || ({host}) ELSE '' END, {path}, "
        f"CASE WHEN {part(4)} <> '' THEN '?' || array_to_string(list_sort(string_split({part(4)}, '&')), '&') ELSE '' END) END"
    )


_TYPE_RULES = " ".join(f"WHEN {_any('lower(source_url)', parts)} THEN '{name}'" for name, parts in urls.URL_TYPES)
_HEAD = "substr(lower(coalesce(text, '')), 1, 1000)"
_SOURCE_TYPE = (
    f"CASE WHEN source_url IS NULL THEN NULL {_TYPE_RULES} WHEN contains({_HEAD}, 'copyright') AND contains({_HEAD}, 'terms') THEN 'legal' "
    f"WHEN contains({_HEAD}, 'abstract') AND contains({_HEAD}, 'methodology') THEN 'academic' "
    f"WHEN {_any(_HEAD, ['error', 'warning', 'debug', 'info'])} AND length(coalesce(text, '')) - length(replace(coalesce(text, ''), chr(10), '')) > 20 THEN 'log' ELSE 'official_docs' END"
)


# --- documents: hashes, duplicates, windows, reports -------------------------------------------------


@_query(_WINDOWS + "SELECT lang, count(*) AS n_chunks, count(*) FILTER (length(text) >= 50) AS n_valid, sum(tokens)::BIGINT AS n_tokens FROM chunks_of GROUP BY lang")
def window_chunk_report(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    cut = chunking.window_chunks(documents.select("doc_id", "text", "lang").withColumn("_key", F.struct("doc_id", "lang")), "_key", "text", _WINDOW_OPTIONS)
    checked = reports.validated(cut.select(F.col("_key.lang").alias("lang"), "tokens", "text"))
    return checked.groupBy("lang").agg(F.count("*").alias("n_chunks"), F.count_if("is_valid").alias("n_valid"), F.sum("tokens").alias("n_tokens"))


@_query(_WINDOWS + "SELECT doc_id, chunk_index, total_chunks, tokens, sha1(text) AS text_sha1 FROM chunks_of")
def token_window_chunks(spark: SparkSession, folder: str) -> DataFrame:
    cut = chunking.window_chunks(table(spark, folder, "documents"), options=_WINDOW_OPTIONS)
    return cut.select("doc_id", "chunk_index", "total_chunks", "tokens", hashing.content_sha1(F.col("text")).alias("text_sha1"))


@_query(_WINDOWS + "SELECT doc_id, chunk_index, concat(doc_id, '#', CASE WHEN chunk_index < 100000 THEN lpad(chunk_index::VARCHAR, 5, '0') ELSE chunk_index::VARCHAR END, '-', substr(sha1(text), 1, 8)) AS id FROM chunks_of")
def chunk_ids(spark: SparkSession, folder: str) -> DataFrame:
    cut = chunking.window_chunks(table(spark, folder, "documents"), options=_WINDOW_OPTIONS)
    return chunking.with_chunk_ids(cut).select("doc_id", "chunk_index", "id")


@_query(
    _WINDOWS + """, o AS (SELECT doc_id, chunk_index, length(text) AS n, coalesce(sum(length(text)) OVER (PARTITION BY doc_id ORDER BY chunk_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) - 80 * chunk_index AS s FROM chunks_of)
SELECT doc_id, chunk_index, s::BIGINT AS char_start, (s + n)::BIGINT AS char_end FROM o"""
)
def char_offsets(spark: SparkSession, folder: str) -> DataFrame:
    cut = chunking.window_chunks(table(spark, folder, "documents"), options=_WINDOW_OPTIONS)
    return chunking.with_char_offsets(cut, 20).select("doc_id", "chunk_index", "char_start", "char_end")


@_query("SELECT doc_id, sha1(text) AS content_sha1, substr(sha1(text), 1, 16) AS doc_sha1 FROM documents")
def doc_content_sha1(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", hashing.content_sha1(F.col("text")).alias("content_sha1"), hashing.doc_sha1(F.col("text")).alias("doc_sha1"))


@_query("SELECT min(doc_id) AS doc_id FROM documents GROUP BY coalesce(text, '')")
def exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.first_of_each(table(spark, folder, "documents"), "text", "doc_id").select("doc_id")


@_query("SELECT doc_id, md5(substr(text, 1, 100) || '0') AS full_md5, substr(md5(substr(text, 1, 100) || '0'), 1, 16) AS structure_id FROM documents")
def structure_ids(spark: SparkSession, folder: str) -> DataFrame:
    named = hashing.structure_chunk_id(F.col("text"), F.lit(0))
    return table(spark, folder, "documents").select("doc_id", F.md5(F.concat(F.substring("text", 1, 100), F.lit("0"))).alias("full_md5"), named.alias("structure_id"))


@_query("SELECT lang, source, count(*) AS n, coalesce(sum(n_chars), 0)::BIGINT AS n_chars FROM documents GROUP BY lang, source")
def count_by_lang_source(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").groupBy("lang", "source").agg(F.count("*").alias("n"), F.coalesce(F.sum("n_chars"), F.lit(0)).alias("n_chars"))


@_query(
    """SELECT CASE WHEN grouping(c) = 1 THEN NULL ELSE c END AS category, CASE WHEN grouping(d) = 1 THEN NULL ELSE d END AS doc_id, (grouping(c) * 2 + grouping(d))::BIGINT AS level, count(*) AS n_chunks, sum(n)::BIGINT AS n_chars
FROM (SELECT lower(CASE WHEN coalesce(category, '') <> '' THEN category ELSE 'general' END) AS c, CASE WHEN coalesce(doc_id, '') <> '' THEN doc_id ELSE 'unknown' END AS d, length(text) AS n FROM chunks) GROUP BY ROLLUP (c, d)"""
)
def quality_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return reports.summary(table(spark, folder, "chunks"))


_VALID = r"""SELECT id, crawl_ts, length(t) >= 50 AND regexp_matches(t, '[^ \t\n\r\f\x0B]') AS is_valid,
  CASE WHEN NOT regexp_matches(t, '[^ \t\n\r\f\x0B]') THEN NULL
       WHEN coalesce(list_sum(list_transform(regexp_extract_all(t, '(?s)\[CODE\].*?\[/CODE\]'), lambda x: length(x))), 0) > length(t) * 0.8 THEN 'code'
       WHEN regexp_matches(t, '(\.[ \t\n\r\f]*){3,}[0-9]+') THEN 'toc'
       WHEN len(regexp_extract_all(t, 'https?://')) > 10 THEN 'references' END AS section_type,
  regexp_matches(t, '[^ \t\n\r\f\x0B]') AND len(regexp_extract_all(t, 'https?://')) > 10 AS is_low_signal, t
FROM (SELECT id, crawl_ts, coalesce(text, '') AS t FROM chunks)"""


@_query(f"SELECT id, crawl_ts, is_valid, section_type, is_low_signal FROM ({_VALID})")
def validate_rules(spark: SparkSession, folder: str) -> DataFrame:
    return reports.validated(table(spark, folder, "chunks").drop("section_type")).select("id", "crawl_ts", "is_valid", "section_type", "is_low_signal")


@_query(f"SELECT section_type, count(*) AS n FROM ({_VALID}) WHERE is_valid GROUP BY section_type")
def section_type_counts(spark: SparkSession, folder: str) -> DataFrame:
    return reports.section_types(reports.only_valid(reports.validated(table(spark, folder, "chunks"))))


@_query(f"SELECT count(*) AS total, count(*) FILTER (is_valid) AS valid, count(*) FILTER (is_low_signal) AS low_signal, sum(length(t))::BIGINT // count(t) AS avg_length FROM ({_VALID})")
def avg_len_report(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "chunks").withColumn("text", F.coalesce("text", F.lit("")))
    return reports.quality_report(reports.validated(rows)).drop("issues", "warnings")


@_query("SELECT category, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM documents), 2) AS pct FROM documents GROUP BY category")
def category_shares(spark: SparkSession, folder: str) -> DataFrame:
    return reports.shares(table(spark, folder, "documents"), "category")


@_query("SELECT tag, count(*) AS n FROM (SELECT unnest(keyphrases) AS tag FROM chunks) GROUP BY tag")
def tag_counts(spark: SparkSession, folder: str) -> DataFrame:
    return reports.tag_counts(table(spark, folder, "chunks"), "keyphrases")


_LINES = r"list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_replace(x, '^[ \t\r\f]+|[ \t\r\f]+$', '', 'g'))"


@_query(
    f"""WITH l AS (SELECT doc_id, {_LINES} AS ls FROM documents),
o AS (SELECT doc_id, ls, list_filter(list_distinct(ls), lambda x: length(x) > 10 AND len(list_filter(ls, lambda y: y = x)) > 3) AS often FROM l)
SELECT doc_id, regexp_replace(array_to_string(list_filter(ls, lambda x: NOT list_contains(often, x)), chr(10)), '\\n{{3,}}', chr(10) || chr(10), 'g') AS text FROM o"""
)
def repeated_lines(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.repeated_lines(table(spark, folder, "documents"))


@_query()
def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.near_duplicate_classes(table(spark, folder, "documents"))


# --- chunks: URLs, sources ---------------------------------------------------------------------------


@_query(f"SELECT DISTINCT source_url, {_canonical('source_url')} AS canonical_url FROM chunks")
def canonical_url(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "chunks").select("source_url").distinct().select("source_url", urls.canonical_url(F.col("source_url")).alias("canonical_url"))


@_query(
    f"""SELECT DISTINCT url, regexp_replace(regexp_extract(url, '{_CANON_PARTS}', 2), '^www\\.', '') AS domain,
CASE WHEN regexp_extract(url, '{_CANON_PARTS}', 3) = '' AND url IS NOT NULL THEN '/' ELSE regexp_extract(url, '{_CANON_PARTS}', 3) END AS path, {_canonical('url')} AS canonical_url FROM sources"""
)
def domain_path(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "sources").select("url").distinct().withColumn("_u", urls.url_components(F.col("url")))
    return rows.select("url", F.col("_u.domain").alias("domain"), F.col("_u.path").alias("path"), F.col("_u.canonical_url").alias("canonical_url"))


@_query(f"SELECT DISTINCT url, 'doc_' || substr(sha256({_canonical('url')}), 1, 6) AS doc_id FROM sources")
def doc_id(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "sources").select("url").distinct().select("url", urls.doc_id(F.col("url")).alias("doc_id"))


@_query(f"SELECT id, crawl_ts, {_SOURCE_TYPE} AS detected FROM chunks")
def source_type(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "chunks").select("id", "crawl_ts", urls.source_type(F.col("source_url"), F.col("text")).alias("detected"))


_BASE = " ".join(f"WHEN '{k}' THEN {v}" for k, v in urls.TYPE_CONFIDENCE.items())


@_query(
    f"""SELECT DISTINCT domain, source_type, round(least(1.0, greatest(0.0, CAST(CASE source_type {_BASE} ELSE 0.8 END AS DOUBLE) *
CAST(CASE WHEN {_any("coalesce(domain, '')", urls.TRUSTED)} THEN 1.1 WHEN {_any("coalesce(domain, '')", urls.UNTRUSTED)} THEN 0.8 ELSE 1.0 END AS DOUBLE))), 6) AS confidence FROM chunks"""
)
def source_confidence(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "chunks").select("domain", "source_type").distinct()
    return rows.select("domain", "source_type", F.round(urls.source_confidence(F.col("domain"), F.col("source_type")), 6).alias("confidence"))


_FORMAT = "CASE WHEN source_url IS NULL THEN NULL " + " ".join(f"WHEN ends_with(lower(source_url), '{s}') THEN '{n}'" for s, n in urls.SUFFIXES) + " ELSE 'html' END"


@_query(f"SELECT {_FORMAT} AS detected, count(DISTINCT source_url) AS n_urls FROM chunks GROUP BY 1")
def format_detect(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "chunks").groupBy(urls.detect_format(F.col("source_url")).alias("detected")).agg(F.countDistinct("source_url").alias("n_urls"))


@_query("SELECT source_url, CASE WHEN ends_with(source_url, '.pdf') THEN 'pdf' WHEN ends_with(source_url, '.md') THEN 'md' WHEN ends_with(source_url, '.docx') THEN 'docx' ELSE coalesce(format, 'html') END AS content_type FROM chunks")
def content_type_override(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "chunks").select("source_url", urls.override_content_type(F.col("source_url"), F.col("format")).alias("content_type"))


@_query(f"SELECT c AS canonical_url, count(*) AS n FROM (SELECT DISTINCT url, {_canonical('url')} AS c FROM sources WHERE url IS NOT NULL) GROUP BY c HAVING count(*) > 1")
def dup_by_canonical(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "sources").where("url is not null").select("url").distinct()
    return rows.groupBy(urls.canonical_url(F.col("url")).alias("canonical_url")).agg(F.count("*").alias("n")).where("n > 1")


@_query("SELECT source_url, CASE WHEN starts_with(source_url, 'file://') THEN 'file' WHEN regexp_matches(lower(source_url), '/api/|/v1/|/v2/|/graphql|\\.json|/rest/') THEN 'api' ELSE 'crawl' END AS acquired, coalesce(source_url || '#page=' || (chunk_index + 1), source_url) AS anchor FROM chunks")
def acquisition(spark: SparkSession, folder: str) -> DataFrame:
    url = F.col("source_url")
    return table(spark, folder, "chunks").select("source_url", urls.acquisition_type(url, F.lit(None)).alias("acquired"), urls.anchor_url(url, F.lit(""), F.col("chunk_index") + 1).alias("anchor"))


_LAST = "SELECT id, accessible, status_code, content_type, error FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY checked_at DESC NULLS LAST, arrived_at DESC NULLS LAST, accessible DESC NULLS LAST, status_code DESC NULLS LAST, content_type DESC NULLS LAST, error DESC NULLS LAST) AS r FROM source_checks WHERE id IS NOT NULL) WHERE r = 1"
_SOURCES = "SELECT id, url, title, tags FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY url DESC NULLS LAST, title DESC NULLS LAST, tags DESC NULLS LAST) AS r FROM sources WHERE id IS NOT NULL) WHERE r = 1"


@_query(f"SELECT id, accessible, status_code::INT::VARCHAR AS status_code, content_type, error FROM ({_LAST})")
def latest_checks(spark: SparkSession, folder: str) -> DataFrame:
    last = reports.latest_checks(table(spark, folder, "source_checks")).drop("checked_at", "arrived_at")
    return last.withColumn("status_code", F.col("status_code").cast("int").cast("string"))


@_query(
    f"""SELECT category, count(*) AS sources, count(*) FILTER (accessible) AS accessible, round(count(*) FILTER (accessible) * 100.0 / count(*), 2) AS success_rate
FROM (SELECT s.id, coalesce(CASE WHEN json_valid(tags) THEN json_extract_string(tags, '$.category') END, 'general') AS category, accessible FROM ({_SOURCES}) s JOIN ({_LAST}) c ON s.id = c.id) GROUP BY category"""
)
def accessibility_report(spark: SparkSession, folder: str) -> DataFrame:
    return reports.accessibility(table(spark, folder, "sources"), table(spark, folder, "source_checks"))


@_query(f"SELECT coalesce(substr(error, 1, 100), 'HTTP ' || CAST(status_code AS INT), 'unknown') AS reason, count(*) AS n FROM ({_LAST}) WHERE NOT coalesce(accessible, false) GROUP BY 1")
def failure_reasons(spark: SparkSession, folder: str) -> DataFrame:
    return reports.failure_reasons(table(spark, folder, "source_checks"))


@_query(
    f"""SELECT count(*) AS sources, count(n) AS successful, coalesce(sum(n), 0)::BIGINT AS chunks, round(count(n) * 100.0 / greatest(count(*), 1), 2) AS success_rate, round(coalesce(sum(n), 0)::BIGINT / greatest(count(n), 1), 2) AS chunks_per_source
FROM ({_SOURCES}) s LEFT JOIN (SELECT source AS source_id, count(*) AS n FROM documents GROUP BY 1) d ON s.id = d.source_id"""
)
def run_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return reports.run_statistics(reports.one_per_source(table(spark, folder, "sources")), table(spark, folder, "documents").withColumnRenamed("source", "source_id"))


@_query(
    f"SELECT s.id, CASE WHEN coalesce(accessible, false) THEN 'empty' ELSE 'failed' END AS why FROM ({_SOURCES}) s LEFT JOIN ({_LAST}) c ON s.id = c.id WHERE s.id NOT IN (SELECT source FROM documents WHERE source IS NOT NULL) ORDER BY s.id LIMIT 5"
)
def failed_sources(spark: SparkSession, folder: str) -> DataFrame:
    sources = reports.one_per_source(table(spark, folder, "sources")).select("id")
    checks = reports.latest_checks(table(spark, folder, "source_checks")).select(F.col("id").alias("_id"), F.coalesce("accessible", F.lit(False)).alias("fetched"))
    chunks = table(spark, folder, "documents").groupBy(F.col("source").alias("_source")).agg(F.count("*").alias("n_chunks"))
    return reports.failed_sources(sources.join(checks, F.col("id") == F.col("_id"), "left").join(chunks, F.col("id") == F.col("_source"), "left"))


_MIME = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in routing.MIME.items()) + "}"
_METHODS = "MAP {" + ", ".join(f"'{k}': 'extract_{k}'" for k in routing.METHODS) + ", 'image': 'skip_image'}"
_PROCESSING = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in routing.PROCESSING.items()) + "}"
_SUFFIX = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in routing.suffix_types().items()) + "}"


@_query(
    f"""WITH m AS (SELECT c.id, s.url, CASE WHEN trim(lower(split_part(coalesce(content_type, ''), ';', 1))) <> '' THEN trim(lower(split_part(content_type, ';', 1)))
  ELSE coalesce({_SUFFIX}[lower(regexp_extract(url, '^[^?#]*(\\.[A-Za-z0-9]+)(?:[?#].*)?$', 1))], 'application/octet-stream') END AS mime FROM ({_LAST}) c JOIN ({_SOURCES}) s ON c.id = s.id),
k AS (SELECT id, coalesce({_MIME}[mime], CASE WHEN regexp_matches(lower(coalesce(url, '')), '/pdf/|format=pdf|\\.pdf') THEN 'pdf' ELSE 'unknown' END) AS kind FROM m)
SELECT id, kind, coalesce({_METHODS}[kind], 'extract_fallback') AS method, coalesce({_PROCESSING}[kind], 'general') AS processing FROM k WHERE kind <> 'unknown' AND kind <> 'image'"""
)
def routed_sources(spark: SparkSession, folder: str) -> DataFrame:
    checks = reports.latest_checks(table(spark, folder, "source_checks")).select(F.col("id").alias("_id"), "content_type")
    rows = reports.one_per_source(table(spark, folder, "sources")).join(checks, F.col("id") == F.col("_id"))
    return routing.routed(rows).select("id", "kind", "method", "processing")


# --- detectors ---------------------------------------------------------------------------------------

_T = "coalesce(text, '')"
_LOW = f"lower({_T})"
_SIGNAL = rf"""
WITH w AS (SELECT doc_id, {_T} AS t, {_WORDS} AS ws FROM documents),
m AS (SELECT doc_id, t, len(ws) AS n, len(list_filter(regexp_split_to_array(t, '[.!?]+'), lambda s: regexp_matches(s, '[^ \t\n\r\f]'))) AS s,
  len(regexp_extract_all(t, 'https?://[^ \t\n\r\f]+')) AS u, string_split(t, chr(10)) AS ls FROM w),
q AS (SELECT *, len(list_filter(ls, lambda l: len(list_filter(regexp_split_to_array(l, '[ \t\n\r\f]+'), lambda x: x <> '')) < 3)) AS short FROM m)
SELECT doc_id, CASE WHEN t = '' THEN 'empty' WHEN n < 50 THEN 'too_short' WHEN s < 3 THEN 'few_sentences' WHEN n / s < 5 THEN 'short_sentences' WHEN u * 3 / n > 0.15 THEN 'urls'
  WHEN regexp_matches(t, '(\.[ \t\n\r\f]*){{3,}}[0-9]+') THEN 'toc' WHEN len(ls) > 10 AND short / len(ls) > 0.7 THEN 'menu'
  WHEN len(regexp_extract_all(t, '[^a-zA-Z \t\n\r\f]')) / length(t) > 0.4 AND NOT regexp_matches(t, '(?i)```|<code>|function|class|def|import') THEN 'special_characters'
  WHEN {_count('lower(t)', ['copyright', 'all rights reserved', 'terms of service', 'privacy policy'])} >= 3 AND n < 200 THEN 'boilerplate' ELSE '' END AS reason FROM q
"""


@_query(_SIGNAL)
def low_signal_doc(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", signals.document_signal(F.col("text"))["reason"].alias("reason"))


@_query(
    rf"""SELECT id, crawl_ts, CASE WHEN {_any(_LOW, ['navigation', 'menu', 'breadcrumb', 'skip to content'])} THEN 'nav'
WHEN {_count(_LOW, ['copyright', 'all rights reserved', 'privacy policy', 'terms of use'])} >= 2 THEN 'footer' WHEN {_count(_LOW, ['disclaimer', 'limitation of liability', 'indemnification', 'governing law'])} >= 2 THEN 'legal'
WHEN starts_with({_LOW}, 'table of contents') OR starts_with({_LOW}, 'contents') THEN 'toc' WHEN {_any(_LOW, ['sponsored', 'advertisement', 'promoted content', 'affiliate'])} THEN 'ads'
WHEN length({_LOW}) < 50 THEN 'too_short' WHEN regexp_matches({_LOW}, '^[ \t\n\r\f0-9\p{{P}}\p{{S}}]+$') THEN 'non_text' ELSE '' END AS reason FROM chunks"""
)
def low_signal_chunk(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "chunks").select("id", "crawl_ts", signals.chunk_signal(F.col("text"))["reason"].alias("reason"))


_TITLE = "lower(coalesce(page_title, ''))"


@_query(
    rf"""SELECT id, crawl_ts, round(greatest(0.0, least(1.5, CAST(CASE WHEN {_any(_TITLE, ['overview', 'introduction', 'summary'])} THEN 1.2 WHEN {_any(_TITLE, ['faq', 'frequently asked', 'q&a', 'questions'])} THEN 1.3
WHEN {_any(_TITLE, ['example', 'tutorial', 'how to'])} THEN 1.15 ELSE 1.0 END AS DOUBLE) * CAST(CASE WHEN contains(substr({_LOW}, 1, 200), 'abstract') THEN 1.1 WHEN {_any(_LOW, ['copyright', 'all rights reserved', 'terms of service'])} THEN 0.5
WHEN regexp_matches({_LOW}, '^[ \t\n\r\f]*(?:table of contents|index)') THEN 0.4 ELSE 1.0 END AS DOUBLE) * CAST(CASE WHEN length({_T}) < 100 THEN 0.7 WHEN length({_T}) > 2000 THEN 1.05 ELSE 1.0 END AS DOUBLE) * CAST(1.1 AS DOUBLE))), 6) AS weight FROM chunks"""
)
def retrieval_weight(spark: SparkSession, folder: str) -> DataFrame:
    weight = signals.retrieval_weight(F.col("text"), F.col("page_title"), F.lit("structured"))
    return table(spark, folder, "chunks").select("id", "crawl_ts", F.round(weight, 6).alias("weight"))


@_query(
    rf"""SELECT id, crawl_ts, list_slice(list_transform(list_filter(list_transform(range(1, len(h) + 1), lambda i: CASE WHEN list_position(h, h[i]) = i THEN h[i] END), lambda x: x IS NOT NULL), lambda x: x), 1, 10) AS headings,
 regexp_matches(t, '(?s)```.*?```|<code>.*?</code>|<pre>.*?</pre>') AS has_code, regexp_matches(t, '(?s)\|.*\||<table.*?</table>') AS has_table,
 regexp_matches(t, '(?sm)^[ \t\n\r\f]*[-*+][ \t\n\r\f]+|^[ \t\n\r\f]*[0-9]+\.[ \t\n\r\f]+|<[uo]l>.*?</[uo]l>') AS has_list, len(regexp_extract_all(t, 'https?://[^ \t\n\r\f<>"]+|www\.[^ \t\n\r\f<>"]+')) AS links_out
FROM (SELECT id, crawl_ts, {_T} AS t, list_transform(list_concat(regexp_extract_all({_T}, '(?m)^#+[ \t]+([^\n]+)$', 1), regexp_extract_all({_T}, '(?i)<h[1-6][^>]*>([^\n]*?)</h[1-6]>', 1)), lambda x: regexp_replace(x, '^[ \t\r\f]+|[ \t\r\f]+$', '', 'g')) AS h FROM chunks)"""
)
def features(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "chunks").select("id", "crawl_ts", signals.content_features(F.col("text")).alias("_f")).select("id", "crawl_ts", "_f.*")


_TOPICS = _listed([(f"{_count(_LOW, terms)} >= 2", name) for name, terms in (semantics.DOMAIN_TERMS | semantics.TOPIC_TERMS).items()])


@_query(f"SELECT doc_id, list_slice({_TOPICS}, 1, 5) AS topics FROM documents")
def topics(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", semantics.topics(F.col("text")).alias("topics"))


@_query(f"SELECT doc_id, {_listed([(f'{_count(_LOW, terms)} >= 3', name) for name, terms in signals.WARNINGS.items()])} AS warnings FROM documents")
def content_warnings(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", signals.content_warnings(F.col("text")).alias("warnings"))


_SUBJECTS = [
    (_any(_LOW, ["patient", "medical record"]), "patients"), (_any(_LOW, ["employee", "staff"]), "employees"), (_any(_LOW, ["customer", "client"]), "customers"), (_any(_LOW, ["student", "pupil"]), "students"),
    (f"contains({_LOW}, 'user') AND {_any(_LOW, ['personal', 'data'])}", "users"), ("coalesce(len(list_filter(entities, lambda e: e.type = 'PERSON')), 0) > 5", "individuals"),
]


@_query(f"SELECT id, crawl_ts, {_listed(_SUBJECTS)} AS subjects FROM chunks")
def data_subjects(spark: SparkSession, folder: str) -> DataFrame:
    persons = F.size(F.filter("entities", lambda e: e["type"] == "PERSON"))
    return table(spark, folder, "chunks").select("id", "crawl_ts", signals.data_subjects(F.col("text"), persons).alias("subjects"))


_5000 = f"substr({_LOW}, 1, 5000)"
_LICENSE = f"CASE WHEN contains({_5000}, 'creative commons') AND {_any(_5000, ['attribution', 'cc-by'])} THEN 'CC-BY-4.0' WHEN contains({_5000}, 'creative commons') AND contains({_5000}, 'cc0') THEN 'CC0-1.0' WHEN contains({_5000}, 'all rights reserved') THEN 'proprietary' WHEN contains({_5000}, 'public domain') THEN 'public-domain' ELSE '' END"


@_query(f"SELECT doc_id, license, license IN ('CC-BY-4.0', 'proprietary') AS attribution_required FROM (SELECT doc_id, {_LICENSE} AS license FROM documents)")
def license_detect(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", rights.detect_license(F.col("text")).alias("_l")).select("doc_id", "_l.*")


@_query(
    f"""SELECT id, crawl_ts, round(greatest(0.0, least(1.0, CAST(CASE WHEN length({_T}) < 50 THEN 0.7 ELSE 1.0 END AS DOUBLE) * CAST(CASE WHEN coalesce(tokens, 0) < 10 THEN 0.6 ELSE 1.0 END AS DOUBLE) * coalesce(source_confidence, 1.0)
* CAST(CASE WHEN modality = 'metadata' THEN 0.8 WHEN modality IN ('table', 'code', 'equation') THEN 1.1 ELSE 1.0 END AS DOUBLE) * coalesce(ocr_confidence, 1.0) * CAST(CASE WHEN len(entities) > 0 THEN 1.05 ELSE 1.0 END AS DOUBLE)
* CAST(CASE WHEN len(keyphrases) > 0 THEN 1.05 ELSE 1.0 END AS DOUBLE) * CAST(CASE WHEN len(citations) > 0 THEN 1.1 ELSE 1.0 END AS DOUBLE))), 6) AS quality FROM chunks"""
)
def quality_score(spark: SparkSession, folder: str) -> DataFrame:
    c = F.col
    score = chunk_model.quality_score(c("text"), c("tokens"), c("source_confidence"), c("modality"), c("ocr_confidence"), F.lit(False), c("entities"), c("keyphrases"), c("citations"))
    return table(spark, folder, "chunks").select("id", "crawl_ts", F.round(score, 6).alias("quality"))


def _in(column: str, values: list[str]) -> str:
    return f"coalesce({column} IN ({', '.join(repr(v) for v in values)}), false)"


_ISSUES = [
    ("coalesce(id, '') = ''", "missing_id"), ("coalesce(doc_id, '') = ''", "missing_doc_id"), ("coalesce(text, '') = '' AND modality = 'text'", "missing_text"),
    ("coalesce(id, '') <> '' AND NOT (contains(id, '#') AND contains(id, '-'))", "id_format"), ("NOT retrieval_weight BETWEEN 0 AND 1.5", "retrieval_weight"), ("NOT source_confidence BETWEEN 0 AND 1", "source_confidence"),
    ("NOT quality_score BETWEEN 0 AND 1", "quality_score"), ("NOT language_confidence BETWEEN 0 AND 1", "language_confidence"), ("NOT ocr_confidence BETWEEN 0 AND 1", "ocr_confidence"),
    ("chunk_index >= total_chunks AND total_chunks > 0", "chunk_index"), (f"NOT {_in('source_type', chunk_model.SOURCE_TYPES)}", "source_type"), (f"NOT {_in('modality', chunk_model.MODALITIES)}", "modality"),
    (f"NOT {_in('format', chunk_model.FORMATS)}", "format"), ("coalesce(length(content_sha1), 0) NOT IN (0, 40)", "content_sha1"),
]


@_query(f"SELECT id, crawl_ts, {_listed(_ISSUES)} AS issues FROM chunks")
def chunk_issues(spark: SparkSession, folder: str) -> DataFrame:
    chunks = table(spark, folder, "chunks")
    return chunks.select("id", "crawl_ts", chunk_model.chunk_issues(set(chunks.columns)).alias("issues"))


@_query("SELECT id, crawl_ts, coalesce(TIMESTAMP '2024-06-30 00:00:00' > valid_to, false) OR coalesce(TIMESTAMP '2024-06-30 00:00:00' < valid_from, false) AS expired FROM chunks")
def expired_chunks(spark: SparkSession, folder: str) -> DataFrame:
    at = F.lit("2024-06-30 00:00:00").cast("timestamp_ntz")
    return table(spark, folder, "chunks").select("id", "crawl_ts", rights.expired(F.col("valid_from"), F.col("valid_to"), at).alias("expired"))


@_query("SELECT id, crawl_ts, CASE WHEN starts_with(coalesce(license, ''), 'CC-BY') THEN concat_ws(' ', 'Licensed under ' || license, CASE WHEN source_url <> '' THEN 'Source: ' || source_url END) END AS attribution FROM chunks")
def attribution(spark: SparkSession, folder: str) -> DataFrame:
    none = F.array().cast("array<string>")
    return table(spark, folder, "chunks").select("id", "crawl_ts", rights.attribution_text(F.col("license"), none, none, F.col("source_url")).alias("attribution"))


@_query("SELECT id, crawl_ts, CASE WHEN length(lang) >= 2 THEN lower(substr(lang, 1, 2)) ELSE 'en' END AS lang, CASE WHEN coalesce(text, '') = '' THEN 0.5 WHEN length(text) > 100 THEN 0.99 ELSE 0.79 END::DOUBLE AS confidence FROM chunks")
def declared_language(spark: SparkSession, folder: str) -> DataFrame:
    confidence = chunk_model.detection_confidence(F.col("text")).cast("double")
    return table(spark, folder, "chunks").select("id", "crawl_ts", chunk_model.declared_language(F.col("lang"), F.lit("en")).alias("lang"), confidence.alias("confidence"))


_FUNCTION = {k: "len(list_filter(w, lambda x: x IN (" + ", ".join(repr(t) for t in v) + ")))" for k, v in chunk_model.FUNCTION_WORDS.items()}
_PICK = " ".join(f"WHEN n_{k} = top THEN '{k}'" for k in _FUNCTION)


@_query(
    rf"""WITH w AS (SELECT doc_id, regexp_split_to_array(lower(substr({_T}, 1, 1000)), '[^\p{{L}}]+') AS w FROM documents),
n AS (SELECT doc_id, {', '.join(f'{e} AS n_{k}' for k, e in _FUNCTION.items())} FROM w), g AS (SELECT *, greatest({', '.join(f'n_{k}' for k in _FUNCTION)}) AS top FROM n)
SELECT doc_id, CASE WHEN top = 0 THEN 'en' {_PICK} END AS lang FROM g"""
)
def detect_language(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", chunk_model.detect_language(F.col("text")).alias("lang"))


# --- personal data -----------------------------------------------------------------------------------

_PHONE, _CARD, _IP = (pii.PATTERNS[k] for k in ("phone", "credit_card", "ip_address"))
# Words between marks, so that a boundary beside accented letters is the same in both dialects.
_MARKED = rf"regexp_replace({_T}, '([{_WORD_CHARS}]+)', chr(2) || '\1' || chr(3), 'g')"
_NAMES = rf"regexp_extract_all({_MARKED}, '\x02[A-Z][a-z]+\x03 \x02[A-Z][a-z]+\x03(?:\s\x02[A-Z][a-z]+\x03)?')"


def _found(kind: str) -> str:
    if kind in pii.NO_DATA:
        return f"len(list_filter(regexp_extract_all({_T}, '{pii.PATTERNS[kind]}'), lambda m: NOT {_any('m', pii.NO_DATA[kind])})) > 0"
    if kind == "person_name":
        return f"len(list_filter({_NAMES}, lambda m: NOT regexp_replace(m, '[\\x02\\x03]', '', 'g') IN ({', '.join(repr(n) for n in pii.NO_NAMES)}))) > 2"
    return f"regexp_matches({_T}, '{pii.STREET if kind == 'address' else pii.PATTERNS[kind]}')"


_FLAGS = ", ".join(f"{_found(k)} AS {k}" for k in pii.FLAGS)


@_query(f"SELECT doc_id, {_FLAGS} FROM documents")
def pii_flags(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", pii.pii_flags(F.col("text")).alias("_p")).select("doc_id", "_p.*")


_NAMED = "list_filter([" + ", ".join(f"CASE WHEN {k} THEN '{k}' END" for k in pii.FLAGS) + "], lambda x: x IS NOT NULL)"


@_query(f"SELECT *, CASE WHEN len({_NAMED}) > 0 THEN array_to_string({_NAMED}, ', ') ELSE 'No PII detected' END AS summary FROM (SELECT id, crawl_ts, {_FLAGS} FROM chunks)")
def pii_all_flags(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "chunks").select("id", "crawl_ts", pii.pii_flags(F.col("text")).alias("_p")).select("id", "crawl_ts", "_p.*", pii.pii_summary(F.col("_p")).alias("summary"))


# local addresses are marked before, and unmarked after the others are masked


def _masked(kinds: dict[str, str], flagged: bool) -> str:
    out = "text"
    for kind, mask in kinds.items():
        out = f"CASE WHEN {_found(kind)} THEN {_replaced(out, (pii.PATTERNS[kind], mask))} ELSE {out} END" if flagged else _replaced(out, (pii.PATTERNS[kind], mask))
    local = out
    for start, rest in (("127", r"\.0\.0\.1\b"), ("0", r"\.0\.0\.0\b"), ("192", r"\.168\."), ("10", r"\.0\."), ("172", r"\.16\.")):
        local = f"regexp_replace({local}, '\\b({start})({rest})', '\\1' || chr(1) || '\\2', 'g')"
    masked = f"replace({_replaced(local, (_IP, '[IP_REDACTED]'))}, chr(1), '')"
    return f"CASE WHEN {_found('ip_address')} THEN {masked} ELSE {out} END" if flagged else masked


@_query(f"SELECT id, crawl_ts, {_masked(pii.MASKS, False)} AS text FROM chunks")
def pii_redact(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "chunks").select("id", "crawl_ts", pii.redact_pii(F.col("text")).alias("text"))


@_query()
def pii_redact_all(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "chunks").select("id", "crawl_ts", pii.redact_pii(F.col("text"), pii.pii_flags(F.col("text"))).alias("text"))


# --- cleaning ----------------------------------------------------------------------------------------


@_query(r"SELECT id, crawl_ts, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '```(?:[0-9A-Za-z_]+)?\n', chr(10) || '[CODE]' || chr(10), 'g'), '```\n?', chr(10) || '[/CODE]' || chr(10), 'g'), '\|{2,}', '|', 'g'), '(?m)^\||\|$', '', 'g'), '(?m)^[-=_*]{3,}$', '', 'g') AS text FROM chunks")
def special_sections(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "chunks").select("id", "crawl_ts", cleaning.clean_special_sections(F.col("text")).alias("text"))


_HEADED = "CASE " + " ".join(f"WHEN regexp_matches(x, '(?i)^(?:{p})') THEN {_replaced(f"regexp_replace(x, '(?i)^(?:{p})', '')", _TRIM)}" for p in map(_unicode, cleaning.HEADERS)) + " ELSE x END"


@_query(
    rf"""SELECT id, crawl_ts, CASE WHEN text IS NOT NULL THEN array_to_string(list_filter(list_transform(list_transform(regexp_split_to_array(regexp_replace(text, '\r\n?|[\x0b\x0c\x1c-\x1e\x85\x{{2028}}\x{{2029}}]', chr(10), 'g'), '\n'),
lambda x: {_replaced("x", _TRIM)}), lambda x: {_HEADED}), lambda x: x <> '' AND NOT regexp_matches(x, '^[0-9]{{1,4}}$')), chr(10)) END AS text FROM chunks"""
)
def headers_footers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "chunks").select("id", "crawl_ts", cleaning.strip_headers_footers(F.col("text")).alias("text"))


_FRONT = _replaced(
    "text", (_unicode(r"(?s)^---\s*\n.*?\n---\s*\n"), ""), (_unicode(r"(?s)^-\s+-\s+-.*?-\s+-\s+-\s*\n"), ""), (_unicode(r"-\s+-\s+-\s+(?:title|url|hostname|description|sitename|date):[^-]*-\s+-\s+-"), ""),
    (r"(?i)<meta[^>]*>", ""), (r"(?is)<title[^>]*>.*?</title>", ""), *[(f"(?i){_unicode(p)}", "") for p in cleaning.CHROME],
    *[(_unicode(rf"(?im)^{k}:\s*[^\n]*\n"), "") for k in cleaning.LINE_KEYS], (_unicode(r"\n\s*\n\s*\n"), "~n~n"), _TRIM,
)


@_query(f"SELECT doc_id, {_FRONT} AS text FROM documents")
def frontmatter(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", cleaning.strip_frontmatter(F.col("text")).alias("text"))


# rules about word boundaries work on words between marks, all others on the text
_BOUNDED = _replaced(
    rf"regexp_replace(regexp_replace(text, '[\xAD\x{{2027}}]', '', 'g'), '([{_WORD_CHARS}]+)', chr(2) || '\1' || chr(3), 'g')",
    (_unicode(r"\x02([a-z]+)\x03-\s*\n\s*\x02([a-z]+)\x03"), r"\1\2"), *[(_unicode(rf"(?i)\x02{a}\x03\s+-\s+\x02{b}\x03"), f"{a}-{b}") for a, b in cleaning.COMPOUNDS],
    *[(rf"(?i)\x02({a})({b})\x03", r"\1 \2") for a, b in cleaning.SPLIT_WORDS], (r"\x02([a-z]+)([A-Z][a-z]+)\x03", r"\1 \2"),
    *[(_unicode(rf"(?i)\x02{a}\x03\s+\x02{b}\x03"), to) for a, b, to in [("for", "example", "for example"), *[(a, b, a + b) for a, b in cleaning.JOINED_WORDS]]], (r"[\x02\x03]", ""),
)
_UNHYPHENED = _replaced(
    _BOUNDED, (f"[{cleaning.BULLETS}‒]", "-"), ("[—–―⸺⸻]", " - "), (rf"[{_SP}]+([,;!?])", r"\1"), (":([A-Za-z])", r": \1"), (r"\.([A-Z])", r". \1"), ("([,;])([A-Za-z])", r"\1 \2"),
    (_unicode(r"([0-9]+)\.\s+([0-9]+)"), r"\1.\2"), ("([.!?])([A-Z])", r"\1 \2"), (r"[ \t]+", " "), (r" +\n", "~n"), (r"\n +", "~n"), (_unicode(r"([.!?])\s*\n\s*([a-z])"), r"\1 \2"),
    (r"\n\n", "§PARA§"), (rf"[{_SP}]+", " "), ("§PARA§", "~n~n"),
)


@_query(f"SELECT id, crawl_ts, {_UNHYPHENED} AS text FROM chunks")
def hyphenation(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "chunks").select("id", "crawl_ts", cleaning.fix_hyphenation(F.col("text")).alias("text"))


_NORMAL = _replaced("nfc_normalize(text)", *cleaning.LIGATURES.items(), ("[–—]", "-"), (r"[ \t]+", " "), (_unicode(r"\s*\n\s*"), "~n"), _TRIM)


@_query(f"SELECT doc_id, {_NORMAL} AS text FROM documents")
def normal_text(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", cleaning.normalize_text(F.col("text")).alias("text"))


_POLISHED = _replaced(
    "text", (r"\.([A-Z])", r". \1"), (_unicode(r"\be\.g\.") + r"\s*", "e.g., "), (_unicode(r"\bi\.e\.") + r"\s*", "i.e., "), (rf"[{_SP}]+([,;:])", r"\1"), (rf"([,;:])[{_SP}]*", r"\1 "), (rf"[{_SP}]+", " "), _TRIM
)


@_query(f"SELECT id, crawl_ts, {_POLISHED} AS text FROM chunks")
def polished(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "chunks").select("id", "crawl_ts", cleaning.polish_sentences(F.col("text")).alias("text"))


# a dash that stands first in its line because a list mark before took the line end is left as it is
_LISTED_ITEMS = _replaced(
    "text", (rf"[{cleaning.LIST_MARKS}][{_SP}]*", "- "), (rf"[{_SP}]*-(?:[{_SP}]*\n(-)|[{_SP}]*)", r"~n- \1"), (rf"(^|[^\n])([0-9]+\.)[{_SP}]+", r"\1~n\2 "), (r"\n{2,}([-0-9])", r"~n\1")
)


@_query(f"SELECT id, crawl_ts, {_LISTED_ITEMS} AS text FROM chunks")
def bullets(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "chunks").select("id", "crawl_ts", cleaning.normalize_bullets(F.col("text")).alias("text"))


# what is taken out comes back as it was; web addresses are the first to be taken out
@_query(rf"""SELECT id, crawl_ts, {_T} AS text, regexp_extract_all({_T}, '(?:https?|ftp|s3|ssh|git)://[^{_SP}<>"{{}}|\\^`\[\]]+') AS addresses FROM chunks""")
def technical_content(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "chunks").withColumn("_h", cleaning.preserve_technical(F.coalesce("text", F.lit(""))))
    addresses = F.transform(F.filter("_h.kept", lambda k: k["placeholder"].startswith("__PRESERVED_URL_")), lambda k: k["original"])
    return rows.select("id", "crawl_ts", cleaning.restore_technical(F.col("_h.text"), F.col("_h.kept")).alias("text"), addresses.alias("addresses"))


@_query()
def clean_text(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.cleaned(table(spark, folder, "chunks").select("id", "crawl_ts", "text", "format"), "text", F.col("format")).select("id", "crawl_ts", "_clean.*")


@_query()
def structure_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return chunking.structure_chunks(table(spark, folder, "documents"), options=chunking.ChunkOptions(200, 40, 20))


@_query()
def document_pipeline(spark: SparkSession, folder: str) -> DataFrame:
    from datetime import datetime

    documents = table(spark, folder, "documents")
    rows = documents.select(F.concat(F.lit("https://docs.example/"), F.coalesce("source", F.lit("none")), F.lit("/"), F.col("doc_id").cast("string")).alias("url"), "text", "title")
    return pipeline.to_chunks(rows, datetime(2024, 6, 30), chunking.ChunkOptions(200, 40, 20), "full", "title").drop("warnings")


# --- pages: the chunks' texts put into pages, as the tables have no HTML ------------------------------


# Six shapes of pages by document: other robots tags, places of the main content, furniture and metadata.
_ROBOTS = ['<meta name="robots" content="NOINDEX, follow">', '<meta name="robots" content="nofollow">', "<META NAME='ROBOTS' CONTENT='noindex,nofollow'>", '<meta name="robots" content="all">', "", '<meta name="googlebot" content="noindex">']
_HEADS = ['<meta name="author" content="@S">', '<meta property="article:author" content="@S"><meta property="og:site_name" content="Site @S">', '<meta name="description" content="About @S">', '<meta name="keywords" content="a, b"><meta name="twitter:creator" content="@S">', "",
          '<meta property="article:published_time" content="2024-05-06"><script type="application/ld+json">{"@type": "Article", "headline": "@S"}</script>']
_OPEN = ["<nav><p>Menu of pages</p></nav><article>", '<div class="sidebar"><p>Side</p></div><main>', '<div role="main">', '<div id="content"><div class="ad-container"><p>Buy</p></div>', '<div class="post"><p>Advertisement</p>', '<div aria-hidden="true"><p>Hidden</p></div>']
_CLOSE = ["</article><footer><p>end</p></footer>", "</main><p>after the main part</p>", "</div>", "</div>", '</div><p id="cookie-note">Cookies</p>', '<p class="cookie">We use cookies</p>']


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    pick = lambda parts: F.element_at(F.array(*[F.lit(x) for x in parts]), (F.col("doc_id") % len(parts)).cast("int") + 1)
    source = F.coalesce("source", F.lit(""))
    escaped = F.replace(F.replace(F.coalesce("text", F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    head = F.concat(F.lit('<html lang="'), F.coalesce("lang", F.lit("")), F.lit('"><head><title>'), F.coalesce("title", F.lit("")), F.lit("</title>"), pick(_ROBOTS), F.replace(pick(_HEADS), F.lit("@S"), source), F.lit("</head><body>"))
    body = F.concat(pick(_OPEN), F.lit("<p>"), F.replace(escaped, F.lit("\n"), F.lit("</p><p>")), F.lit("</p>"), pick(_CLOSE), F.lit("</body></html>"))
    return table(spark, folder, "documents").select("doc_id", F.concat(head, body).alias("html"))


@_query("SELECT doc_id, doc_id % 6 IN (0, 2) AS noindex, doc_id % 6 IN (1, 2) AS nofollow FROM documents")
def robots(spark: SparkSession, folder: str) -> DataFrame:
    return _pages(spark, folder).select("doc_id", rights.robots(F.col("html")).alias("_r")).select("doc_id", "_r.*")


@_query(
    """SELECT doc_id, nullif(trim(title), '') AS title, nullif(lang, '') AS language, CASE WHEN k IN (0, 1, 3) THEN nullif(source, '') END AS author, CASE WHEN k = 1 THEN 'Site ' || coalesce(source, '') END AS site_name,
CASE WHEN k = 2 THEN 'About ' || coalesce(source, '') END AS description, CASE WHEN k = 3 THEN 'a, b' END AS keywords, CASE WHEN k = 5 THEN '2024-05-06' END AS published_time, CASE WHEN k = 5 THEN coalesce(source, '') END AS headline,
CASE WHEN k = 1 THEN 'Site ' || coalesce(source, '') END AS og_site_name FROM (SELECT *, doc_id % 6 AS k FROM documents)"""
)
def html_metadata(spark: SparkSession, folder: str) -> DataFrame:
    m = F.col("_x.metadata")
    fields = [m[f].alias(f) for f in ("title", "language", "author", "site_name", "description", "keywords", "published_time")]
    rows = _pages(spark, folder).select("doc_id", extraction.page(F.col("html")).alias("_x"))
    return rows.select("doc_id", *fields, m["schema_org"]["headline"].alias("headline"), m["open_graph"]["og_site_name"].alias("og_site_name"))


_PAGE_LINES = f"list_transform(string_split({_T}, chr(10)), lambda x: {_replaced('x', _TRIM)})"


@_query(
    f"""SELECT doc_id, {_replaced("array_to_string(ls, ' ')", (f"[{_SP}]+", " "), _TRIM)} AS text
FROM (SELECT doc_id, list_filter({_PAGE_LINES}, lambda x: x <> '' AND NOT regexp_full_match(x, '(?i){_unicode(html.LOW_VALUE.pattern)}')) AS ls FROM documents)"""
)
def html_text(spark: SparkSession, folder: str) -> DataFrame:
    return _pages(spark, folder).select("doc_id", extraction.page(F.col("html"))["text"].alias("text"))


# --- semantics ---------------------------------------------------------------------------------------

_BIGRAMS = "|".join(sorted({t for terms in semantics.DOMAIN_TERMS.values() for t in terms}))


@_query(
    f"""WITH w AS (SELECT doc_id, {_WORDS.replace("coalesce(text, '')", "lower(coalesce(text, ''))")} AS w FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(w))) AS i, w FROM w), b AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] AS phrase FROM p),
c AS (SELECT doc_id, phrase, count(*) AS n, min(i) AS f FROM b WHERE regexp_matches(phrase, '{_BIGRAMS}') GROUP BY doc_id, phrase),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, f) AS rank FROM c) SELECT doc_id, phrase, n, rank FROM r WHERE rank <= 10"""
)
def domain_bigrams(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.top_phrases(table(spark, folder, "documents"), semantics.domain_bigrams(F.col("text")))


_MARKED_DOCUMENT = rf"regexp_replace({_T}, '([{_WORD_CHARS}]+)', chr(2) || '\1' || chr(3), 'g')"
_TITLES = rf"list_transform(regexp_extract_all({_MARKED_DOCUMENT}, '(?:\x02[A-Z][a-z]+\x03\s+){{1,3}}\x02[A-Z][a-z]+\x03'), lambda x: regexp_replace(x, '[\x02\x03]', '', 'g'))"


@_query(
    f"""WITH w AS (SELECT doc_id, {_TITLES} AS ts, {_WORDS.replace("coalesce(text, '')", "lower(coalesce(text, ''))")} AS w FROM documents),
b AS (SELECT doc_id, list_concat(ts, list_filter(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]), lambda p: regexp_matches(p, '{_BIGRAMS}'))) AS ps FROM w),
p AS (SELECT doc_id, unnest(range(1, len(ps) + 1)) AS i, ps FROM b), c AS (SELECT doc_id, ps[i] AS phrase, count(*) AS n, min(i) AS f FROM p GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, f) AS rank FROM c) SELECT doc_id, phrase, n, rank FROM r WHERE rank <= 10"""
)
def keyphrases(spark: SparkSession, folder: str) -> DataFrame:
    phrases = F.concat(semantics.title_phrases(F.col("text")), semantics.domain_bigrams(F.col("text")))
    return dedup.top_phrases(table(spark, folder, "documents"), phrases)


@_query()
def entities(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", F.explode(semantics.entities(F.col("text"))).alias("e")).select("doc_id", "e.*")


@_query()
def citations_of_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "chunks").select("id", "crawl_ts", semantics.citations(F.col("text")).alias("found_citations"))


_ROWS = f"list_filter(string_split({_T}, chr(10)), lambda x: contains(x, '|'))"
_HEADS_OF = r"list_filter(list_transform(string_split(rs[1], '|'), lambda h: regexp_replace(h, '^\s+|\s+$', '', 'g')), lambda h: h <> '')"
_CELLS = f"list_transform(regexp_extract_all({_T}, '(?is)<th[^>]*>(.*?)</th>', 1), lambda h: trim(h))"


@_query(
    f"""SELECT id, crawl_ts, CASE WHEN pipes > 4 AND len(rs) >= 2 AND len({_HEADS_OF}) > 0 THEN {_HEADS_OF} WHEN contains({_LOW}, '<table') AND len({_CELLS}) > 0 THEN {_CELLS} END AS names,
CASE WHEN pipes > 4 AND len(rs) >= 2 AND len({_HEADS_OF}) > 0 THEN len(rs) - 2 WHEN contains({_LOW}, '<table') AND len({_CELLS}) > 0 THEN greatest(0, len(regexp_extract_all({_LOW}, '<tr')) - 1) END::INT AS n_rows
FROM (SELECT id, crawl_ts, text, length({_T}) - length(replace({_T}, '|', '')) AS pipes, {_ROWS} AS rs FROM chunks)"""
)
def table_schemas(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "chunks").select("id", "crawl_ts", semantics.table_schema(F.col("text")).alias("_t"))
    return rows.select("id", "crawl_ts", F.transform("_t.columns", lambda c: c["name"]).alias("names"), F.col("_t.rows").alias("n_rows"))


_MATH = ["[$][$]?[^$]+[$][$]?", r"(?s)\\begin\{equation\}.*?\\end\{equation\}", r"(?s)\\begin\{align\}.*?\\end\{align\}", r"[A-Za-z]+\s*=\s*[^=]+[+\-*/][^=]+"]
_FORMULAS = "list_transform(list_concat(" + ", ".join(f"regexp_extract_all({_T}, '{p}')" for p in _MATH) + "), lambda x: trim(x))"
_FORMULAS = f"list_slice(list_filter(list_transform(range(1, len(fs) + 1), lambda i: CASE WHEN list_position(fs, fs[i]) = i THEN fs[i] END), lambda x: x IS NOT NULL), 1, 10) AS math FROM (SELECT *, {_FORMULAS} AS fs FROM chunks)"


@_query(
    rf"""SELECT id, crawl_ts, CASE WHEN regexp_matches({_T}, '(?s)\|.*\||<table.*?</table>') THEN 'table' WHEN regexp_matches({_T}, '(?s)```.*?```|<code>.*?</code>|<pre>.*?</pre>') THEN 'code' WHEN len(math) > 2 THEN 'equation'
WHEN regexp_matches({_T}, '^[ \t\n\r\f]*[{{\[]') AND json_valid({_T}) THEN 'metadata' ELSE 'text' END AS modality FROM (SELECT *, {_FORMULAS})"""
)
def modality(spark: SparkSession, folder: str) -> DataFrame:
    f = signals.content_features(F.col("text"))
    return table(spark, folder, "chunks").select("id", "crawl_ts", signals.modality(F.col("text"), f["has_table"], f["has_code"]).alias("modality"))


@_query(f"SELECT id, crawl_ts, {_FORMULAS}")
def formulas(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "chunks").select("id", "crawl_ts", semantics.math_expressions(F.col("text")).alias("math"))


_BLOCKS = f"list_concat(regexp_extract_all({_T}, '(?s)```\\w*\\n(.*?)```', 1), regexp_extract_all({_T}, '(?s)<code>(.*?)</code>', 1), regexp_extract_all({_T}, '(?s)<pre>(.*?)</pre>', 1))"
_CODE = _listed([(f"len(list_filter(bs, lambda b: regexp_matches(b, '(?im){p.replace(chr(39), chr(39) * 2)}'))) > 0", n) for n, p in semantics.CODE_PATTERNS.items()])


@_query(f"SELECT id, crawl_ts, {_CODE} AS code_langs FROM (SELECT id, crawl_ts, CASE WHEN len({_BLOCKS}) > 0 THEN {_BLOCKS} ELSE [{_T}] END AS bs FROM chunks)")
def code_languages(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "chunks").select("id", "crawl_ts", semantics.code_languages(F.col("text")).alias("code_langs"))


_UNITS = "list_transform(list_concat(" + ", ".join(f"regexp_extract_all({_T}, '(?i)\\b[0-9]+\\s*(?:{u})\\b')" for u in semantics.UNITS) + "), lambda x: trim(regexp_replace(x, '^[0-9\\s.,]+', '')))"


@_query(f"SELECT id, crawl_ts, list_slice(list_filter(list_transform(range(1, len(us) + 1), lambda i: CASE WHEN list_position(us, us[i]) = i THEN us[i] END), lambda x: x <> ''), 1, 20) AS units FROM (SELECT id, crawl_ts, {_UNITS} AS us FROM chunks)")
def units(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "chunks").select("id", "crawl_ts", semantics.units(F.col("text")).alias("units"))


_POOR = f"len(list_filter(string_split({_T}, chr(10)), lambda x: regexp_matches(regexp_replace(x, '^[ \\t\\r\\f]+|[ \\t\\r\\f]+$', '', 'g'), '{signals.LOW_SIGNAL_LINES}'))) / len(string_split({_T}, chr(10)))"
_SHARE = lambda p: f"len(regexp_extract_all({_T}, '{p}')) / greatest(length({_T}), 1)"
_LINK = r"\[([^\]]+)\]\(([^)]+)\)"
_LINKED = rf"regexp_matches({_T}, '{_LINK}') AND length(regexp_replace(regexp_replace({_T}, '{_LINK}', '', 'g'), '^[ \t\n\r\f]+|[ \t\n\r\f]+$', '', 'g')) < 50"
_MARKS_SHARE = _SHARE("[.,;:!?()\\[\\]{}/<>@#$%^&*+=|\\\\`~\"'']")


@_query(
    f"""SELECT id, crawl_ts, round(CASE WHEN n < 40 THEN 0.3 ELSE CASE WHEN poor > 0.5 THEN 0.4 ELSE 1.0 END::DOUBLE * CASE WHEN marks > 0.3 THEN 0.6 ELSE 1.0 END::DOUBLE * CASE WHEN digits > 0.3 THEN 0.6 ELSE 1.0 END::DOUBLE * CASE WHEN links THEN 0.3 ELSE 1.0 END::DOUBLE END::DOUBLE, 6) AS quality,
n < 40 OR poor > 0.5 OR marks > 0.5 OR digits > 0.5 OR links AS is_low_signal FROM (SELECT id, crawl_ts, len({_WORDS}) AS n, {_POOR} AS poor, {_MARKS_SHARE} AS marks, {_SHARE('[0-9]')} AS digits, {_LINKED} AS links FROM chunks)"""
)
def line_quality(spark: SparkSession, folder: str) -> DataFrame:
    t = F.col("text")
    rows = table(spark, folder, "chunks").select("id", "crawl_ts", signals.line_quality(t, F.size(signals.words(t))).alias("_q"))
    return rows.select("id", "crawl_ts", F.round("_q.quality", 6).alias("quality"), F.col("_q.is_low_signal").alias("is_low_signal"))


# --- vectors and incremental work --------------------------------------------------------------------

_QUERY_VECTOR = [((i * 7919) % 101 - 50) / 50.0 for i in range(64)]


@_query(
    r"""WITH w AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[' || chr(28) || chr(29) || chr(30) || chr(31) || '\s\x0B\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+'), lambda x: x <> '')) AS w FROM documents),
h AS (SELECT doc_id, ('0x' || substr(md5(w), 1, 16))::UBIGINT AS h FROM w), b AS (SELECT doc_id, (h % 64)::INT AS b, sum(CASE WHEN h >= 9223372036854775808 THEN 1 ELSE -1 END) AS v FROM h GROUP BY ALL),
n AS (SELECT doc_id, map_from_entries(list((b, v))) AS m, sqrt(sum(v * v)) AS norm FROM b GROUP BY doc_id HAVING sum(v * v) > 0)
SELECT doc_id, list_transform(range(0, 64), lambda i: round(coalesce(m[i::INT], 0) / norm, 4)::DOUBLE) AS embedding, 'hashing-64' AS embedding_model, 64 AS embedding_dim FROM n"""
)
def text_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    made = vectors.with_embeddings(table(spark, folder, "documents").select("doc_id", "text"), vectors.hashing_embedder(64), "hashing-64")
    rounded = F.transform("embedding", lambda x: F.round(x.cast("double"), 4) + 0.0)
    return vectors.only_embedded(made).select("doc_id", rounded.alias("embedding"), "embedding_model", "embedding_dim")


@_query(
    f"SELECT id, round(list_cosine_similarity(embedding::DOUBLE[], {_QUERY_VECTOR}::DOUBLE[]), 6) AS similarity FROM (SELECT DISTINCT id, embedding FROM chunk_vectors WHERE len(embedding) = 64 AND id IS NOT NULL AND list_sum(list_transform(embedding, lambda x: x * x)) > 0) ORDER BY list_cosine_similarity(embedding::DOUBLE[], {_QUERY_VECTOR}::DOUBLE[]) DESC, id LIMIT 10"
)
def cosine_topk(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "chunk_vectors").where("id is not null").select("id", "embedding").distinct()
    return vectors.most_similar(rows, _QUERY_VECTOR, "id").select("id", F.round("similarity", 6).alias("similarity"))


@_query("SELECT id, n IS NOT NULL AS reused FROM (SELECT DISTINCT id FROM chunks WHERE id IS NOT NULL) c LEFT JOIN (SELECT id AS k, count(*) AS n FROM chunk_vectors WHERE embedding_model = 'vec-small-2' AND len(embedding) > 0 GROUP BY id) v ON c.id = v.k")
def embedding_reuse(spark: SparkSession, folder: str) -> DataFrame:
    joined = state.reuse_embeddings(table(spark, folder, "chunks"), table(spark, folder, "chunk_vectors"), "vec-small-2")
    return joined.select("id", F.col("embedding").isNotNull().alias("reused"))


@_query("SELECT doc_id FROM documents WHERE source IS NULL OR source NOT IN (SELECT id FROM sources WHERE id IS NOT NULL)")
def unlisted_documents(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").select("doc_id", F.col("source").alias("id"))
    return state.not_yet_known(rows, table(spark, folder, "sources").where("id is not null"), "id").select("doc_id")


@_query("SELECT id, md5(url) AS url_key FROM (SELECT DISTINCT id, url FROM sources WHERE id IS NOT NULL AND url IS NOT NULL) s WHERE id IN (SELECT source FROM documents)")
def fetched_sources(spark: SparkSession, folder: str) -> DataFrame:
    sources = table(spark, folder, "sources").where("id is not null and url is not null").select("id", "url").distinct()
    known = state.already_known(sources, table(spark, folder, "documents").withColumnRenamed("source", "id").where("id is not null"), "id")
    return known.select("id", state.url_key(F.col("url")).alias("url_key"))


@_query("SELECT DISTINCT id, crawl_ts FROM chunks WHERE category = 'legal' AND crawl_ts <= TIMESTAMP '2024-06-30 00:00:00' AND crawl_ts >= TIMESTAMP '2024-06-23 00:00:00'")
def valid_cache_rows(spark: SparkSession, folder: str) -> DataFrame:
    manifest = table(spark, folder, "chunks").select("id", "crawl_ts", F.col("category").alias("settings"), F.col("crawl_ts").alias("created_at")).distinct()
    return state.still_valid(manifest, "legal", F.lit("2024-06-30 00:00:00").cast("timestamp_ntz"), 7 * 86_400).select("id", "crawl_ts")


@_query("SELECT count(*) AS n, min(crawl_ts) AS oldest, max(crawl_ts) AS newest FROM chunks")
def cache_info(spark: SparkSession, folder: str) -> DataFrame:
    return state.cache_info(table(spark, folder, "chunks"), "crawl_ts")


@_query("SELECT id, concat_ws('/', lower(CASE WHEN coalesce(category, '') <> '' THEN category ELSE 'general' END), 'documents', id || '.jsonl') AS file FROM (SELECT DISTINCT id, category FROM chunks WHERE id IS NOT NULL)")
def output_files(spark: SparkSession, folder: str) -> DataFrame:
    from quillspark.sources.sinks import output_file

    rows = table(spark, folder, "chunks").where("id is not null").select("id", "category").distinct()
    return rows.select("id", output_file(F.col("category"), F.lit(""), F.col("id")).alias("file"))


_RECORD = ["id", "doc_id", "text", "domain", "modality", "lang", "tokens", "title_hierarchy", "chunk_index", "entities", "citations", "table_schema", "quality_score", "pii", "pii_types", "published_at", "crawl_ts"]


@_query(f"SELECT {', '.join(_RECORD)} FROM chunks WHERE id IS NOT NULL")
def chunk_records(spark: SparkSession, folder: str) -> DataFrame:
    chunks = table(spark, folder, "chunks").where("id is not null")
    records = chunks.select(chunk_model.chunk_record(chunks.columns).alias("record"))
    return records.select(chunk_model.from_record(F.col("record"), chunks.schema).alias("_c")).select("_c.*").select(*_RECORD)
