"""Quality signals of texts: low-signal rules, features, weights and validation.

All are expressions inside code generation. Null texts count as empty unless stated.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark.functions.binding import let
from quillspark.functions.urls import has_any

SPACE = r"[ \t\n\r\f]+"
_TOC = r"(\.[ \t\n\r\f]*){3,}[0-9]+"
# Thresholds of the low-signal test of documents.
MIN_WORDS, MIN_SENTENCES, MIN_SENTENCE_WORDS, MAX_URL_SHARE, MAX_SPECIAL_SHARE = 50, 3, 5, 0.15, 0.4
# Lines that carry no content.
LOW_SIGNAL_LINES = (
    r"(?i)^(?:\[.*\]\(.*\)|[0-9]+\.|[•·▪▫◦‣⁃]|(?:Advertisement|Sponsored|Ad)|(?:Read more|Continue reading|Click here)|Page [0-9]+ of [0-9]+|Copyright ©.*|All rights reserved)$"
)


def words(text: Column) -> Column:
    """Words between ASCII white space."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def count_words(text: Column) -> Column:
    return F.size(words(text)).cast("bigint")


def terms_in(text: Column, terms: list[str]) -> Column:
    """How many of ``terms`` a text in lower case contains."""
    return sum((text.contains(t).cast("int") for t in terms[1:]), text.contains(terms[0]).cast("int"))


def document_signal(text: Column) -> Column:
    """Struct ``is_low_signal, reason``: the first rule that makes a document low in signal."""
    return let(F.coalesce(text, F.lit("")), lambda t: let(_document_counts(t), lambda m: _document_rules(t, m)))


def _document_counts(t: Column) -> Column:
    sentences = F.size(F.filter(F.split(t, "[.!?]+"), lambda s: F.regexp_like(s, F.lit(r"[^ \t\n\r\f]"))))
    urls = F.regexp_count(t, F.lit(r"https?://[^ \t\n\r\f]+"))
    lines = F.split(t, "\n")
    short = F.size(F.filter(lines, lambda line: F.size(words(line)) < 3))
    special = F.regexp_count(t, F.lit(r"[^a-zA-Z \t\n\r\f]"))
    return F.struct(count_words(t).alias("n"), sentences.alias("sentences"), urls.alias("urls"), F.size(lines).alias("lines"), short.alias("short"), special.alias("special"))


def _document_rules(t: Column, m: Column) -> Column:
    n, sentences, urls = m["n"], m["sentences"], m["urls"]
    special = m["special"] / F.length(t)
    code = F.regexp_like(t, F.lit(r"(?i)```|<code>|function|class|def|import"))
    boiler = terms_in(F.lower(t), ["copyright", "all rights reserved", "terms of service", "privacy policy"])
    reason = (
        F.when(t == "", "empty").when(n < MIN_WORDS, "too_short").when(sentences < MIN_SENTENCES, "few_sentences").when(n / sentences < MIN_SENTENCE_WORDS, "short_sentences")
        .when(urls * 3 / n > MAX_URL_SHARE, "urls").when(F.regexp_like(t, F.lit(_TOC)), "toc").when((m["lines"] > 10) & (m["short"] / m["lines"] > 0.7), "menu")
        .when((special > MAX_SPECIAL_SHARE) & ~code, "special_characters").when((boiler >= 3) & (n < 200), "boilerplate").otherwise("")
    )
    return let(reason, _signal)


def _signal(reason: Column) -> Column:
    return F.struct((reason != "").alias("is_low_signal"), reason.alias("reason"))


def chunk_signal(text: Column) -> Column:
    """Struct ``is_low_signal, reason`` of a chunk, by its wording."""
    return let(let(F.lower(F.coalesce(text, F.lit(""))), _chunk_reason), _signal)


def _chunk_reason(t: Column) -> Column:
    return (
        F.when(has_any(t, ["navigation", "menu", "breadcrumb", "skip to content"]), "nav")
        .when(terms_in(t, ["copyright", "all rights reserved", "privacy policy", "terms of use"]) >= 2, "footer")
        .when(terms_in(t, ["disclaimer", "limitation of liability", "indemnification", "governing law"]) >= 2, "legal")
        .when(t.startswith("table of contents") | t.startswith("contents"), "toc")
        .when(has_any(t, ["sponsored", "advertisement", "promoted content", "affiliate"]), "ads")
        .when(F.length(t) < 50, "too_short").when(F.regexp_like(t, F.lit(r"^[ \t\n\r\f0-9\p{P}\p{S}]+$")), "non_text").otherwise("")
    )


def low_signal_reason(text: Column, flag: Column) -> Column:
    return F.when(flag, chunk_signal(text)["reason"]).otherwise("")


def retrieval_weight(text: Column, title: Column, section_type: Column) -> Column:
    """Weight in 0..1.5 by title, wording, length and structure."""
    t, head = F.lower(F.coalesce(text, F.lit(""))), F.lower(F.coalesce(title, F.lit("")))
    stripped = F.regexp_replace(t, r"^[ \t\n\r\f]+", "")
    titled = (
        F.when(has_any(head, ["overview", "introduction", "summary"]), 1.2).when(has_any(head, ["faq", "frequently asked", "q&a", "questions"]), 1.3)
        .when(has_any(head, ["example", "tutorial", "how to"]), 1.15).otherwise(1.0)
    )
    worded = (
        F.when(F.substring(t, 1, 200).contains("abstract"), 1.1).when(has_any(t, ["copyright", "all rights reserved", "terms of service"]), 0.5)
        .when(stripped.startswith("table of contents") | stripped.startswith("index"), 0.4).otherwise(1.0)
    )
    sized = F.when(F.length(t) < 100, 0.7).when(F.length(t) > 2000, 1.05).otherwise(1.0)
    structured = F.when(section_type == "structured", 1.1).otherwise(1.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.5), titled * worded * sized * structured))


def content_features(text: Column) -> Column:
    """Struct ``headings, has_code, has_table, has_list, links_out``; headings in order, at most ten."""
    t = F.coalesce(text, F.lit(""))
    clean = lambda xs: F.transform(xs, lambda x: F.regexp_replace(x, r"^[ \t\r\f]+|[ \t\r\f]+$", ""))
    headings = F.concat(F.regexp_extract_all(t, F.lit(r"(?m)^#+[ \t]+([^\n]+)$"), F.lit(1)), F.regexp_extract_all(t, F.lit(r"(?i)<h[1-6][^>]*>([^\n]*?)</h[1-6]>"), F.lit(1)))
    return F.struct(
        F.slice(F.array_distinct(clean(headings)), 1, 10).alias("headings"),
        F.regexp_like(t, F.lit(r"(?s)```.*?```|<code>.*?</code>|<pre>.*?</pre>")).alias("has_code"),
        F.regexp_like(t, F.lit(r"(?s)\|.*\||<table.*?</table>")).alias("has_table"),
        F.regexp_like(t, F.lit(r"(?sm)^[ \t\n\r\f]*[-*+][ \t\n\r\f]+|^[ \t\n\r\f]*[0-9]+\.[ \t\n\r\f]+|<[uo]l>.*?</[uo]l>")).alias("has_list"),
        F.regexp_count(t, F.lit(r"https?://[^ \t\n\r\f<>\"]+|www\.[^ \t\n\r\f<>\"]+")).cast("bigint").alias("links_out"),
    )


def modality(text: Column, has_table: Column, has_code: Column) -> Column:
    """table, code, equation (more than two expressions), metadata (JSON) or text."""
    from quillspark.functions.semantics import math_expressions

    t = F.coalesce(text, F.lit(""))
    first = F.substring(F.regexp_replace(t, r"^[ \t\n\r\f]+", ""), 1, 1)
    # readers pass over what follows a first value, so the text must be one value in an array and in an object
    alone = (F.json_array_length(F.concat(F.lit("["), t, F.lit("]"))) == 1) & F.json_object_keys(F.concat(F.lit('{"a":'), t, F.lit("}"))).isNotNull()
    parsed = F.when(first.isin("{", "["), F.coalesce(alone, F.lit(False))).otherwise(F.lit(False))
    return F.when(has_table, "table").when(has_code, "code").when(F.size(math_expressions(t)) > 2, "equation").when(parsed, "metadata").otherwise("text")


def line_quality(text: Column, tokens: Column, language_matches: Column | None = None, min_tokens: int = 40) -> Column:
    """Struct ``quality, is_low_signal`` of a chunk by its length, lines, characters and links."""
    t = F.coalesce(text, F.lit(""))
    lines = F.split(t, "\n")
    poor = F.size(F.filter(lines, lambda x: F.regexp_like(F.regexp_replace(x, r"^[ \t\r\f]+|[ \t\r\f]+$", ""), F.lit(LOW_SIGNAL_LINES)))) / F.size(lines)
    size = F.greatest(F.length(t), F.lit(1))
    marks = F.regexp_count(t, F.lit("[.,;:!?()\\[\\]{}/<>@#$%^&*+=|\\\\`~\"']")) / size
    digits = F.regexp_count(t, F.lit(r"[0-9]")) / size
    link = r"\[([^\]]+)\]\(([^)]+)\)"
    bare = F.length(F.regexp_replace(F.regexp_replace(t, link, ""), r"^[ \t\n\r\f]+|[ \t\n\r\f]+$", ""))
    links = F.regexp_like(t, F.lit(link)) & (bare < 50)
    factor = lambda c, x: F.when(c, F.lit(x)).otherwise(F.lit(1.0))
    score = factor(poor > 0.5, 0.4) * factor(marks > 0.3, 0.6) * factor(digits > 0.3, 0.6) * factor(links, 0.3)
    if language_matches is not None:
        score = score * factor(~language_matches, 0.7)
    few = tokens < min_tokens
    return F.struct(F.when(few, 0.3).otherwise(score).alias("quality"), (few | (poor > 0.5) | (marks > 0.5) | (digits > 0.5) | links).alias("is_low_signal"))


def validation(text: Column, section_type: Column | None = None) -> Column:
    """Struct ``is_valid, issues, warnings, section_type, is_low_signal``; a later rule names the section."""
    t = F.coalesce(text, F.lit(""))
    blank = ~F.regexp_like(t, F.lit(r"[^ \t\n\r\f\x0B]"))
    lines = F.split(F.regexp_replace(F.regexp_replace(t, "\r\n", "\n"), "\n$", ""), "\n")
    repeated = (F.size(lines) > 5) & (F.size(F.array_distinct(lines)) < F.size(lines) * 0.5)
    urls = F.regexp_count(t, F.lit("https?://"))
    toc = F.regexp_like(t, F.lit(_TOC))
    code = F.aggregate(F.regexp_extract_all(t, F.lit(r"(?s)\[CODE\].*?\[/CODE\]"), F.lit(0)), F.lit(0), lambda n, x: n + F.length(x)) > F.length(t) * 0.8
    given = section_type if section_type is not None else F.lit(None).cast("string")
    some = lambda c, x: F.when(c & ~blank, x)
    short = F.length(t) < 50
    return F.struct(
        (~blank & ~short).alias("is_valid"),
        F.array_compact(F.array(F.when(blank, F.lit("empty")), some(short, F.lit("too_short")))).alias("issues"),
        F.array_compact(F.array(some(repeated, F.lit("line_repetition")), some(urls > 10, F.lit("many_urls")), some(toc, F.lit("toc")))).alias("warnings"),
        F.when(blank, given).when(code, "code").when(toc, "toc").when(urls > 10, "references").otherwise(given).alias("section_type"),
        (~blank & (urls > 10)).alias("is_low_signal"),
    )


# Terms of content warnings and rules of data subjects.
WARNINGS = {
    "medical": ["diagnosis", "treatment", "medication", "symptom", "patient", "clinical"],
    "legal": ["legal", "lawsuit", "liability", "jurisdiction", "statute", "regulation"],
    "financial": ["investment", "portfolio", "trading", "financial advice", "risk"],
}


def content_warnings(text: Column) -> Column:
    """Names of the areas of which a text has three terms or more."""
    return let(F.lower(F.coalesce(text, F.lit(""))), lambda t: F.array_compact(F.array(*[F.when(terms_in(t, terms) >= 3, F.lit(name)) for name, terms in WARNINGS.items()])))


def data_subjects(text: Column, persons: Column) -> Column:
    """Groups of people a text is about; ``persons`` is how many names of persons were found in it."""
    t = F.lower(F.coalesce(text, F.lit("")))
    rules = [
        (has_any(t, ["patient", "medical record"]), "patients"), (has_any(t, ["employee", "staff"]), "employees"), (has_any(t, ["customer", "client"]), "customers"),
        (has_any(t, ["student", "pupil"]), "students"), (t.contains("user") & has_any(t, ["personal", "data"]), "users"), (F.coalesce(persons, F.lit(0)) > 5, "individuals"),
    ]
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for c, n in rules]))
