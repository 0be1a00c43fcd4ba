"""Cleaning steps as columns where expressions suffice, and the whole chain as one batched function.

``(?U)`` gives Java's classes the meaning they have for Unicode text.
"""

from __future__ import annotations

import re
import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.batched import batched

# Page chrome, line keys, headers, bullets, dashes, compounds and ligatures.
CHROME = [
    r"Skip to (?:main )?content", r"Navigation menu", r"Main menu", r"Breadcrumbs?", r"You are here:", r"Home\s*>\s*", r"Back to top", r"Print this page",
    r"Share this (?:page|article)", r"Last updated:?\s*\d+", r"Published:?\s*\d+", r"Tags?:\s*[\w\s,]+", r"Categories?:\s*[\w\s,]+",
]
LINE_KEYS = ["title", "url", "author", "date", "tags", "category"]
HEADERS = [
    r"Page [0-9]+ of [0-9]+$", r"[0-9]{1,4}$", r"Table of Contents$", r"Contents$", r"Copyright.*[0-9]{4}", r"©.*[0-9]{4}", r"All Rights Reserved", r"Confidential", r"Proprietary", r"Draft",
    r"Version [0-9]+(?:\.[0-9]+)*\s+[A-Z]{2,5}-[A-Z0-9]+\s+[0-9]+\s*\|\s*PAGE",
]
BULLETS = "•●○◦▪▫■□▸▹►▻‣⁃"
LIST_MARKS = "•·◦▪▫■□◆◇※→➤➢"
COMPOUNDS = [("cross", "account"), ("multi", "factor"), ("single", "sign"), ("read", "only"), ("write", "only"), ("built", "in"), ("plug", "in"), ("add", "on"), ("follow", "up")]
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl"}
SPLIT_WORDS = [("you", "can"), ("complete", "lab"), ("can", "not")]
JOINED_WORDS = [("how", "ever"), ("there", "fore"), ("with", "out")]


def _chain(text: Column, steps: list[tuple[str, str]]) -> Column:
    return reduce(lambda t, s: F.regexp_replace(t, *s), steps, text)


def trim_space(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def strip_frontmatter(text: Column) -> Column:
    """Without front matter, meta tags and page chrome; null stays null."""
    steps = [
        (r"(?sU)^---\s*\n.*?\n---\s*\n", ""), (r"(?sU)^-\s+-\s+-.*?-\s+-\s+-\s*\n", ""), (r"(?U)-\s+-\s+-\s+(?:title|url|hostname|description|sitename|date):[^-]*-\s+-\s+-", ""),
        (r"(?i)<meta[^>]*>", ""), (r"(?is)<title[^>]*>.*?</title>", ""),
        *[(f"(?iU){p}", "") for p in CHROME], *[(rf"(?imU)^{k}:\s*[^\n]*\n", "") for k in LINE_KEYS], (r"(?U)\n\s*\n\s*\n", "\n\n"),
    ]
    return trim_space(_chain(text, steps))


def fix_hyphenation(text: Column) -> Column:
    """Joins words cut at line ends, mends spacing and keeps only blank lines as breaks."""
    steps = [("[­‧]", ""), (r"(?U)\b([a-z]+)-\s*\n\s*([a-z]+)\b", "$1$2")]
    steps += [(rf"(?iU)\b{a}\s+-\s+{b}\b", f"{a}-{b}") for a, b in COMPOUNDS]
    steps += [(rf"(?iU)\b({a})({b})\b", "$1 $2") for a, b in SPLIT_WORDS]
    steps += [(r"(?U)\b([a-z]+)([A-Z][a-z]+)\b", "$1 $2")]
    steps += [(rf"(?iU)\b{a}\s+{b}\b", to) for a, b, to in [("for", "example", "for example"), *[(a, b, a + b) for a, b in JOINED_WORDS]]]
    steps += [(f"[{BULLETS}‒]", "-"), ("[—–―⸺⸻]", " - ")]
    steps += [
        (r"(?U)\s+([,;!?])", "$1"), (r":(?!//)(?=[A-Za-z])", ": "), (r"\.(?=[A-Z])", ". "), (r"([,;])(?=[A-Za-z])", "$1 "), (r"(?U)([0-9]+)\.\s+([0-9]+)", "$1.$2"), (r"([.!?])([A-Z])", "$1 $2"),
        (r"[ \t]+", " "), (r" +\n", "\n"), (r"\n +", "\n"), (r"(?U)([.!?])\s*\n\s*([a-z])", "$1 $2"), ("\n\n", "§PARA§"), (r"(?U)\s+", " "), ("§PARA§", "\n\n"),
    ]
    return _chain(text, steps)


def normal_spacing(text: Column) -> Column:
    """Ligatures, dashes and white space of a text whose code points are composed already."""
    t = reduce(lambda t, p: F.replace(t, F.lit(p[0]), F.lit(p[1])), LIGATURES.items(), text)
    return trim_space(_chain(t, [("[–—]", "-"), (r"[ \t]+", " "), (r"(?U)\s*\n\s*", "\n")]))


@batched("string")
def composed(text: pd.Series) -> pd.Series:
    """Canonical composition (NFC), which no built-in function does."""
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


def normalize_text(text: Column) -> Column:
    return normal_spacing(composed(text))


def strip_headers_footers(text: Column) -> Column:
    """Lines without a header's wording at their start; lines of nothing else, page numbers and blanks go."""
    lines = F.split(F.regexp_replace(text, "\r\n?|[\x0b\x0c\x1c-\x1e\x85  ]", "\n"), "\n")
    bare = F.transform(lines, trim_space)
    # the first rule that fits takes its wording off
    cut = F.transform(bare, lambda x: trim_space(reduce(lambda rest, p: F.when(F.regexp_like(x, F.lit(f"(?i)^(?:{p})")), F.regexp_replace(x, f"(?i)^(?:{p})", "")).otherwise(rest), reversed(HEADERS), x)))
    return F.array_join(F.filter(cut, lambda x: (x != "") & ~F.regexp_like(x, F.lit("^[0-9]{1,4}$"))), "\n")


def normalize_bullets(text: Column) -> Column:
    """List marks and numbers at the start of lines of their own."""
    return _chain(text, [(rf"(?U)[{LIST_MARKS}]\s*", "- "), (r"(?U)(?<!\n)\s*-\s*", "\n- "), (r"(?U)(?<!\n)([0-9]+\.)\s+", "\n$1 "), (r"\n{2,}(?=[-0-9])", "\n")])


def clean_special_sections(text: Column) -> Column:
    """Code fences as markers, single pipes, no pipes at line edges and no rules."""
    return _chain(text, [(r"```(?:\w+)?\n", "\n[CODE]\n"), (r"```\n?", "\n[/CODE]\n"), (r"\|{2,}", "|"), (r"(?m)^\||\|$", ""), (r"(?m)^[-=_*]{3,}$", "")])


def polish_sentences(text: Column) -> Column:
    """Spacing around sentence and clause marks; all white space becomes one space."""
    steps = [(r"\.(?=[A-Z])", ". "), (r"\be\.g\.\s*", "e.g., "), (r"\bi\.e\.\s*", "i.e., "), (r"(?U)\s+([,;:])", "$1"), (r"(?U)([,;:])\s*", "$1 "), (r"(?U)\s+", " ")]
    return trim_space(_chain(text, steps))


# What must pass the cleaning unchanged, in the order it is taken out, with signs that it always has.
_KEPT = [
    ("URL", re.compile(r"(?:https?|ftp|s3|ssh|git)://[^\s<>\"{}|\\^`\[\]]+"), ("://",)),
    ("AWS", re.compile(r"\b[a-z0-9][a-z0-9.\-]{1,61}[a-z0-9]\.s3[.-][a-z0-9\-]+\.amazonaws\.com(?:/\S*)?|\barn:[a-z0-9\-]+:[a-z0-9\-]+:[a-z0-9\-]*:[0-9]*:[a-zA-Z0-9\-_:/]*"), (".s3", "arn:")),
    ("EMAIL", re.compile(r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"), ("@",)),
    ("PATH", re.compile(r"(?:/[a-zA-Z0-9_\-.]+){2,}/?|[A-Z]:\\(?:[a-zA-Z0-9_\-. ]+\\)*[a-zA-Z0-9_\-. ]*"), ("/", "\\")),
    ("KEBAB", re.compile(r"\b[a-z0-9]+(?:-[a-z0-9]+){2,}\b"), ("-",)),
]


def preserved(text: str) -> tuple[str, list[tuple[str, str]]]:
    """A text with placeholders for technical content, and what they stand for in order."""
    kept: list[tuple[str, str]] = []

    def put(kind: str):
        def replace(match: re.Match) -> str:
            kept.append((f"__PRESERVED_{kind}_{len(kept)}__", match.group()))
            return kept[-1][0]

        return replace

    for kind, pattern, signs in _KEPT:
        if any(s in text for s in signs):  # most texts have nothing to look for
            text = pattern.sub(put(kind), text)
    return text, kept


def restored(text: str, kept: list[tuple[str, str]]) -> str:
    """Placeholders replaced from the last to the first, so that one inside another comes back too."""
    for placeholder, original in reversed(kept):
        text = text.replace(placeholder, original)
    return text


@batched("struct<text:string,kept:array<struct<placeholder:string,original:string>>>")
def preserve_technical(text: pd.Series) -> pd.DataFrame:
    rows = [preserved(t) if t is not None else (None, []) for t in text]
    return pd.DataFrame({"text": [r[0] for r in rows], "kept": [[{"placeholder": p, "original": o} for p, o in r[1]] for r in rows]})


def restore_technical(text: Column, kept: Column) -> Column:
    return F.aggregate(F.reverse(kept), text, lambda t, k: F.replace(t, k["placeholder"], k["original"]))


def cleaned(rows: DataFrame, text: str = "text", content_type: Column | None = None) -> DataFrame:
    """``rows`` with a struct ``_clean`` of ``text, is_valid, is_low_signal, low_signal_reason, content_type, text_length, word_count, line_count``.

    Python only takes technical content out and composes code points; all rules run in the JVM, step by
    step, so that no step is worked out twice. Empty and null texts give an empty, invalid one.
    """
    from quillspark.functions.signals import document_signal

    kind = content_type if content_type is not None else F.lit("general")
    step = rows.withColumn("_kind", F.coalesce(kind, F.lit("general"))).withColumn("_held", preserve_technical(F.coalesce(F.col(text), F.lit(""))))
    step = step.withColumn("_t", fix_hyphenation(F.col("_held.text"))).withColumn("_t", normal_spacing(composed(F.col("_t"))))
    step = step.withColumn("_t", F.when(F.col("_kind") == "pdf", strip_headers_footers(F.col("_t"))).otherwise(F.col("_t")))
    step = step.withColumn("_m", clean_special_sections(normalize_bullets(F.col("_t"))))
    step = step.withColumn("_s", document_signal(F.col("_m"))).withColumn("_done", restore_technical(normal_spacing(polish_sentences(F.col("_m"))), F.col("_held.kept")))
    step = step.withColumn("_n", F.size(F.filter(F.split("_done", r"(?U)\s+"), lambda w: w != "")))
    long = F.length("_done")
    valid = F.when(F.col("_kind") == "pdf", (long > 50) | (F.col("_n") > 20)).otherwise((long > 100) | (F.col("_n") > 50))
    made = F.struct(
        F.col("_done").alias("text"), valid.alias("is_valid"), F.col("_s.is_low_signal").alias("is_low_signal"), F.col("_s.reason").alias("low_signal_reason"), F.col("_kind").alias("content_type"),
        long.alias("text_length"), F.col("_n").alias("word_count"), F.when(F.col("_done") == "", 0).otherwise(F.size(F.split("_done", "\n"))).alias("line_count"),
    )
    return step.withColumn("_clean", made).drop("_kind", "_held", "_t", "_m", "_s", "_done", "_n")
