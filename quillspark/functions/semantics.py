"""What a text speaks of: topics, phrases, entities, code, units, citations, formulas and tables."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark.functions.batched import batched
from quillspark.functions.binding import let
from quillspark.functions.signals import terms_in

# Terms of domains and topics, in order.
DOMAIN_TERMS = {
    "medical": ["patient", "diagnosis", "treatment", "symptom", "medication", "clinical", "trial", "therapy"],
    "legal": ["plaintiff", "defendant", "jurisdiction", "statute", "regulation", "compliance", "liability"],
    "financial": ["revenue", "profit", "investment", "portfolio", "asset", "liability", "equity", "dividend"],
    "technical": ["algorithm", "database", "api", "framework", "deployment", "architecture", "optimization"],
    "academic": ["hypothesis", "methodology", "analysis", "conclusion", "abstract", "citation", "peer-review"],
}
TOPIC_TERMS = {
    "cloud_computing": ["aws", "azure", "gcp", "kubernetes", "docker", "serverless"],
    "machine_learning": ["neural", "training", "model", "dataset", "accuracy", "prediction"],
    "security": ["vulnerability", "encryption", "authentication", "firewall", "breach"],
    "database": ["sql", "query", "index", "transaction", "normalization", "schema"],
    "web_development": ["html", "css", "javascript", "react", "api", "frontend", "backend"],
}
# What code of each language looks like.
CODE_PATTERNS = {
    "python": r"def\s+\w+\s*\(|import\s+\w+|from\s+\w+\s+import|if\s+__name__\s*==",
    "javascript": r"function\s+\w+\s*\(|const\s+\w+\s*=|let\s+\w+\s*=|=>|async\s+function",
    "java": r"public\s+class|private\s+void|public\s+static\s+void\s+main|@Override",
    "sql": r"SELECT\s+.*\s+FROM|INSERT\s+INTO|UPDATE\s+.*\s+SET|CREATE\s+TABLE",
    "html": r"<html>|<div\s+.*>|<span\s+.*>|<body>",
    "css": r"\.[\w-]+\s*\{|#[\w-]+\s*\{|@media\s+|color:\s*#?\w+",
    "cpp": r"#include\s*<|using\s+namespace|int\s+main\s*\(|std::",
    "go": r"func\s+\w+\s*\(|package\s+\w+|import\s+\(|defer\s+",
    "rust": r"fn\s+\w+\s*\(|impl\s+\w+|use\s+\w+|pub\s+fn",
    "yaml": r"^\s*-\s+\w+:|^\s*\w+:\s*$|^\s*\w+:\s+['\"]",
    "json": r"^\s*\{|^\s*\"\w+\"\s*:|^\s*\[",
}
# Units after a number.
UNITS = [
    r"mg|g|kg|ml|l|cm|m|km/hr|km|mm|°C|°F|K|Hz|kHz|MHz|GHz|MB|GB|TB|ms|s|min|hr|hrs|days?|weeks?|months?|years?",
    r"USD|EUR|GBP|JPY|\$|€|£|¥",
    r"%|percent|pct",
]
# Capitalised pairs that are no persons.
NO_PERSONS = ["United States", "New York", "Web Services", "Machine Learning"]


def topics(text: Column, most: int = 5) -> Column:
    """Domains, then topics, of which a text has two terms or more; at most ``most``."""
    rules = lambda t: F.array_compact(F.array(*[F.when(terms_in(t, terms) >= 2, F.lit(name)) for name, terms in (DOMAIN_TERMS | TOPIC_TERMS).items()]))
    return F.slice(let(F.lower(F.coalesce(text, F.lit(""))), rules), 1, most)


def code_languages(text: Column) -> Column:
    """Languages of code in a text's marked blocks, or in all of it if none is marked."""
    t = F.coalesce(text, F.lit(""))
    blocks = F.concat(*[F.regexp_extract_all(t, F.lit(p), F.lit(1)) for p in (r"(?s)```\w*\n(.*?)```", r"(?s)<code>(.*?)</code>", r"(?s)<pre>(.*?)</pre>")])
    searched = F.when(F.size(blocks) > 0, blocks).otherwise(F.array(t))
    shows = lambda p: F.exists(searched, lambda b: F.regexp_like(b, F.lit(f"(?im){p}")))
    return F.array_compact(F.array(*[F.when(shows(p), F.lit(name)) for name, p in CODE_PATTERNS.items()]))


def units(text: Column, most: int = 20) -> Column:
    """Distinct units that follow numbers, in order of the kinds above, at most ``most``."""
    t = F.coalesce(text, F.lit(""))
    found = F.concat(*[F.regexp_extract_all(t, F.lit(rf"(?i)\b[0-9]+\s*(?:{u})\b"), F.lit(0)) for u in UNITS])
    bare = F.transform(found, lambda x: F.trim(F.regexp_replace(x, r"^[0-9\s.,]+", "")))
    return F.slice(F.array_distinct(F.filter(bare, lambda x: x != "")), 1, most)


def math_expressions(text: Column, most: int = 10) -> Column:
    """Distinct formulas in order, at most ``most``."""
    t = F.coalesce(text, F.lit(""))
    patterns = [r"\$\$?[^$]+\$\$?", r"(?s)\\begin\{equation\}.*?\\end\{equation\}", r"(?s)\\begin\{align\}.*?\\end\{align\}", r"[A-Za-z]+\s*=\s*[^=]+[+\-*/][^=]+"]
    found = F.concat(*[F.regexp_extract_all(t, F.lit(p), F.lit(0)) for p in patterns])
    return F.slice(F.array_distinct(F.transform(found, lambda x: F.trim(x))), 1, most)


def citations(text: Column, most: int = 30) -> Column:
    """Structs ``doi, title, authors, year, url, citation_text``: DOIs, [Author, year] and listed references."""
    t = F.coalesce(text, F.lit(""))
    none = F.lit(None).cast("string")
    row = lambda doi=none, title=none, authors=None, year=None, cited=none: F.struct(
        doi.alias("doi"), title.alias("title"), (authors if authors is not None else F.array().cast("array<string>")).alias("authors"),
        (year if year is not None else F.lit(None)).cast("int").alias("year"), none.alias("url"), cited.alias("citation_text"),
    )
    # Patterns of DOIs, bracketed citations, years and titles.
    dois = F.transform(F.regexp_extract_all(t, F.lit(r"(?i)(?:doi:|https?://doi\.org/)([0-9.]+/[-._;()/:\w]+)"), F.lit(1)), lambda x: row(doi=x))
    bracket = r"\[([A-Z][a-z]+(?:\s+et\s+al\.)?),?\s+([0-9]{4})\]"
    named = F.transform(F.regexp_extract_all(t, F.lit(bracket), F.lit(0)), lambda x: row(authors=F.array(F.regexp_extract(x, bracket, 1)), year=F.regexp_extract(x, bracket, 2), cited=x))
    at = F.when(F.instr(t, "References") > 0, F.instr(t, "References")).otherwise(F.instr(t, "Bibliography"))
    lines = F.when(at > 0, F.slice(F.split(F.substring(t, at, F.length(t)), "\n"), 1, 20)).otherwise(F.array().cast("array<string>"))
    year, title = r"\(([0-9]{4})\)", "\"([^\"]+)\""
    kept = F.filter(lines, lambda x: (F.length(x) > 20) & ~x.startswith("References") & ~x.startswith("Bibliography") & (F.regexp_like(x, F.lit(year)) | F.regexp_like(x, F.lit(title))))
    empty = lambda x: F.nullif(x, F.lit(""))
    listed = F.transform(kept, lambda x: row(title=empty(F.regexp_extract(x, title, 1)), year=empty(F.regexp_extract(x, year, 1)), cited=F.substring(x, 1, 200)))
    return F.slice(F.concat(dois, named, listed), 1, most)


def table_schema(text: Column) -> Column:
    """Struct ``columns, rows, has_header, caption`` of the first table, or null without one."""
    t = F.coalesce(text, F.lit(""))
    pipes = F.length(t) - F.length(F.replace(t, F.lit("|")))
    rows = F.filter(F.split(t, "\n"), lambda x: x.contains("|"))
    trimmed = lambda xs: F.filter(F.transform(xs, lambda h: F.regexp_replace(h, r"^\s+|\s+$", "")), lambda h: h != "")
    named = lambda xs: F.transform(xs, lambda h: F.struct(h.alias("name"), F.lit("string").alias("type")))
    heads = F.when(F.size(rows) >= 2, trimmed(F.split(F.get(rows, F.lit(0)), r"\|")))
    low = F.lower(t)
    cells = F.regexp_extract_all(t, F.lit(r"(?is)<th[^>]*>(.*?)</th>"), F.lit(1))
    html_rows = F.regexp_count(low, F.lit("<tr"))
    shaped = lambda names, n: F.struct(named(names).alias("columns"), n.cast("int").alias("rows"), F.lit(True).alias("has_header"), F.lit(None).cast("string").alias("caption"))
    return F.when((pipes > 4) & (F.size(heads) > 0), shaped(heads, F.size(rows) - 2)).when(low.contains("<table") & (F.size(cells) > 0), shaped(F.transform(cells, lambda h: F.trim(h)), F.greatest(F.lit(0), html_rows - 1)))


def domain_bigrams(text: Column) -> Column:
    """Lower-case pairs of neighbouring words that hold a domain's term."""
    w = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[ \t\n\r\f]+"), lambda x: x != "")
    pairs = F.when(F.size(w) > 1, F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w) - 1), lambda a, b: F.concat(a, F.lit(" "), b))).otherwise(F.array().cast("array<string>"))
    every = sorted({t for terms in DOMAIN_TERMS.values() for t in terms})
    return F.filter(pairs, lambda p: F.regexp_like(p, F.lit("|".join(every))))


def title_phrases(text: Column) -> Column:
    """Runs of two to four capitalised words."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"\b(?:[A-Z][a-z]+\s+){1,3}[A-Z][a-z]+\b"), F.lit(0))


# What entities look like and how sure they are.
_ENTITIES = [
    ("PERSON", re.compile(r"\b([A-Z][a-z]+ (?:[A-Z]\. )?[A-Z][a-z]+)\b"), 0.7),
    ("ORG", re.compile(r"\b([\w\s]+(?:Inc|Corp|Corporation|LLC|Ltd|GmbH|AG|SA|Co|Company|Foundation|Institute|University)\.?)\b"), 0.8),
    ("DATE", re.compile(r"\b(\d{1,2}[/-]\d{1,2}[/-]\d{2,4}|\d{4}[/-]\d{1,2}[/-]\d{1,2}|(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]* \d{1,2},? \d{4})\b", re.IGNORECASE), 0.9),
    ("MONEY", re.compile(r"\b(\$[\d,]+(?:\.\d{2})?|[\d,]+\s*(?:USD|EUR|GBP))\b"), 0.9),
    ("PERCENT", re.compile(r"\b(\d+(?:\.\d+)?%)\b"), 0.95),
]


def entities_of(text: str | None) -> list[dict]:
    """Entities of one text; of overlapping ones the first stays, of those at one place the surest."""
    found = []
    for kind, pattern, sure in _ENTITIES:
        # the organisations' open start would walk the text again and again: only where a suffix is
        for m in pattern.finditer(text or "") if kind != "ORG" or re.search(r"Inc|Corp|LLC|Ltd|GmbH|AG|SA|Co|Company|Foundation|Institute|University", text or "") else ():
            if m.group(1) not in NO_PERSONS:
                found.append({"text": m.group(1), "type": kind, "start": m.start(), "end": m.end(), "confidence": sure})
    kept: list[dict] = []
    end = -1
    for e in sorted(found, key=lambda e: (e["start"], -e["confidence"])):
        if e["start"] >= end:
            kept.append(e)
            end = e["end"]
    return kept


@batched("array<struct<text:string,type:string,start:int,end:int,confidence:double>>")
def entities(text: pd.Series) -> pd.Series:
    """Entities with their places, which no built-in function gives."""
    return text.map(entities_of)
