"""From documents to chunks: token windows as expressions, structure-aware packing as a batched function."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions.binding import let
from quillspark.functions.hashing import chunk_id
from quillspark.functions.signals import words


@dataclass(frozen=True)
class ChunkOptions:
    """Sizes in tokens. ``strict_parity`` drops chunks that overlap pushed over the limit instead of splitting them."""

    max_tokens: int = 700
    overlap_tokens: int = 80
    min_tokens: int = 40
    strict_parity: bool = False

    def __post_init__(self):
        if not 0 <= self.overlap_tokens < self.max_tokens or self.min_tokens < 0:
            raise ValueError("overlap must be smaller than the maximum, and no size negative")


def token_windows(tokens: Column, options: ChunkOptions) -> Column:
    """Array of token arrays: one window if all fits, else windows that overlap; short last ones go."""
    stride = options.max_tokens - options.overlap_tokens

    def cut(t: Column) -> Column:
        # windows start every stride until one reaches the end
        more = F.when(F.size(t) > options.max_tokens, F.ceil((F.size(t) - options.max_tokens) / F.lit(float(stride))).cast("int")).otherwise(0)
        return F.transform(F.sequence(F.lit(0), more), lambda i: F.slice(t, i * stride + 1, options.max_tokens))

    return F.filter(let(tokens, cut), lambda w: F.size(w) >= F.lit(max(1, options.min_tokens)))


def window_chunks(documents: DataFrame, key: str = "doc_id", text: str = "text", options: ChunkOptions | None = None) -> DataFrame:
    """``key, chunk_index, total_chunks, tokens, text``: windows over white-space tokens, without Python.

    Null and empty texts, and texts shorter than the minimum, have no chunk.
    """
    cut = documents.select(F.col(key), token_windows(words(F.col(text)), options or ChunkOptions()).alias("_w"))
    rows = cut.select(F.col(key), F.size("_w").alias("total_chunks"), F.posexplode("_w").alias("chunk_index", "_t"))
    return rows.select(key, F.col("chunk_index").cast("bigint").alias("chunk_index"), F.col("total_chunks").cast("bigint").alias("total_chunks"), F.size("_t").cast("bigint").alias("tokens"), F.array_join("_t", " ").alias("text"))


def with_chunk_ids(chunks: DataFrame, key: str = "doc_id") -> DataFrame:
    return chunks.withColumn("id", chunk_id(F.col(key).cast("string"), F.col("chunk_index"), F.col("text")))


def with_char_offsets(chunks: DataFrame, overlap_tokens: int, key: str = "doc_id") -> DataFrame:
    """Estimated ``char_start, char_end``: lengths so far less four characters for each overlapping token.

    An estimate that can be negative, kept for compatibility.
    """
    order = Window.partitionBy(key).orderBy("chunk_index").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("text")).over(order), F.lit(0)) - 4 * overlap_tokens * F.col("chunk_index")
    return chunks.withColumn("char_start", start.cast("bigint")).withColumn("char_end", (start + F.length("text")).cast("bigint"))


def section_type(headings: Column) -> Column:
    return F.when(F.size(headings) > 0, "structured").otherwise("simple")


@dataclass
class Section:
    """A stretch of a document under a heading."""

    content: str
    level: int = 0
    heading: str = ""
    parents: list[str] = field(default_factory=list)

    @property
    def whole(self) -> str:
        return f"{self.heading}\n{self.content}" if self.heading else self.content


_HEADING = re.compile(r"(#{1,6})\s+(.+)$")
_SENTENCE = re.compile(r"(?<![A-Z][a-z])\. (?=[A-Z])|(?<=[^A-FI-PSUa-ip-vz.|()?:])\. |[?!] ")


def count_words(text: str) -> int:
    return len(text.split())


def sections_of(text: str, title: str = "") -> list[Section]:
    """Title, headings and paragraphs in order; a heading clears the deeper ones before it."""
    out = [Section("", 0, title)] if title else []
    path: list[str] = ["", "", "", ""]
    paragraph: list[str] = []

    def flush() -> None:
        if paragraph:
            out.append(Section("\n".join(paragraph), 4, "", [h for h in path[:3] if h]))
            paragraph.clear()

    for line in map(str.strip, text.split("\n")):
        found = _HEADING.match(line)
        if not line:
            flush()
        elif found:
            flush()
            level = min(len(found.group(1)), 4)
            path[level - 1 :] = [found.group(2), *[""] * (4 - level)]
            out.append(Section("", level, found.group(2), [h for h in path[: level - 1] if h]))
        else:
            paragraph.append(line)
    flush()
    return out


def sentences_of(text: str) -> list[str]:
    """Sentences without their ends; very short ones stay with the one before."""
    out: list[str] = []
    for s in filter(None, map(str.strip, _SENTENCE.split(text))):
        if out and len(s.split()) < 5:
            out[-1] += ". " + s
        else:
            out.append(s)
    return out


class StructureChunker:
    """Packs sections into chunks; the order of sections makes it a fold over one document."""

    def __init__(self, options: ChunkOptions, count: Callable[[str], int] = count_words):
        self.options, self.count = options, count

    def pieces(self, section: Section) -> list[Section]:
        """A section that is too large, in parts of at most nine tenths of the maximum."""
        room = int(self.options.max_tokens * 0.9)

        def packed(units: list[str], glue: str, finer: Callable[[str], list[str]]) -> list[str]:
            out, held, size = [], [], 0
            for u in units:
                n = self.count(u)
                if held and size + n > room:
                    out.append(glue.join(held))
                    held, size = [], 0
                if n > room:
                    out += finer(u)
                else:
                    held.append(u)
                    size += n
            return out + ([glue.join(held)] if held else [])

        by_word = lambda t: packed(t.split(), " ", lambda w: [w])
        by_sentence = lambda t: packed(s, " ", by_word) if len(s := sentences_of(t)) > 1 else by_word(t)
        paragraphs = [p.strip() for p in re.split(r"\n\n+|</?p>", section.content) if p.strip()]
        parts = packed(paragraphs, "\n\n", by_sentence) if len(paragraphs) > 1 else by_sentence(section.content)
        return [Section(p, section.level, section.heading + (f" (part {i + 1})" if i and section.heading else ""), section.parents) for i, p in enumerate(parts)]

    def overlap(self, sections: list[Section]) -> list[Section]:
        """The longest run of whole sections at the end that fits the overlap."""
        kept, size = [], 0
        for s in reversed(sections):
            size += self.count(s.whole)
            if size > self.options.overlap_tokens:
                break
            kept.insert(0, s)
        return kept

    def texts(self, sections: list[Section]) -> Iterator[str]:
        """The text of a chunk; more than one only if overlap made it too long and parity isn't asked for."""
        blocks = [b for s in sections for b in (f"{'#' * s.level} {s.heading}".strip() if s.heading and s.level <= 3 else "", s.content) if b]
        text = "\n\n".join(blocks).strip()
        if self.count(text) <= self.options.max_tokens:
            yield text
        elif not self.options.strict_parity:
            for part in self.pieces(Section(text)):
                yield part.content

    def chunks(self, text: str | None, title: str | None) -> list[dict]:
        """Structs ``text, title, headings, tokens``; those low in signal are left out."""
        out: list[dict] = []
        held: list[Section] = []
        size, headings = 0, []

        def emit() -> None:
            for body in self.texts(held):
                n = self.count(body)
                if body and n >= self.options.min_tokens:
                    path = [title, *headings[:3]] if title else headings[:3]
                    out.append({"text": body, "title": " > ".join(path), "headings": list(headings), "tokens": n})

        for section in sections_of(text or "", title or "") if (text or "").strip() else []:
            if section.heading and section.level <= 3:
                headings = [*section.parents, section.heading]
            for s in self.pieces(section) if self.count(section.whole) > self.options.max_tokens else [section]:
                n = self.count(s.whole)
                if held and size + n > self.options.max_tokens:
                    emit()
                    held = self.overlap(held)
                    size = sum(self.count(x.whole) for x in held)
                held.append(s)
                size += n
        emit()
        return out


_CHUNK = "array<struct<text:string,title:string,headings:array<string>,tokens:int>>"


def structure_chunks(documents: DataFrame, key: str = "doc_id", text: str = "text", title: str | None = "title", options: ChunkOptions | None = None) -> DataFrame:
    """``key, chunk_index, total_chunks, tokens, title, headings, section_type, text``.

    Structure-aware chunks, free of those low in signal; a document that has none falls back to token
    windows, of which repeated ones count once. Null and blank texts have no chunk. One document is one
    call, so tasks differ by their longest documents only.
    """
    from quillspark.functions.signals import line_quality

    options = options or ChunkOptions()
    chunker = StructureChunker(options)

    @F.pandas_udf(_CHUNK)
    def split(texts: pd.Series, titles: pd.Series) -> pd.Series:
        return pd.Series([chunker.chunks(a, b) for a, b in zip(texts, titles)])

    named = F.col(title) if title else F.lit("")
    rows = documents.where(F.regexp_like(F.coalesce(F.col(text), F.lit("")), F.lit(r"\S"))).select(F.col(key), F.col(text).alias("_text"), F.coalesce(named, F.lit("")).alias("_title"))
    cut = rows.withColumn("_c", split("_text", "_title"))
    good = F.filter("_c", lambda c: ~line_quality(c["text"], c["tokens"], min_tokens=options.min_tokens)["is_low_signal"])
    plain = F.transform(F.array_distinct(F.transform(token_windows(words(F.col("_text")), options), lambda w: F.array_join(w, " "))), lambda t: F.struct(t.alias("text"), F.col("_title").alias("title"), F.array().cast("array<string>").alias("headings"), F.size(words(t)).alias("tokens")))
    chosen = cut.withColumn("_g", good).select(key, F.when(F.size("_g") > 0, F.col("_g")).otherwise(plain).alias("_g"))
    at = chosen.select(key, F.size("_g").alias("total_chunks"), F.posexplode("_g").alias("chunk_index", "_c"))
    return at.select(key, "chunk_index", "total_chunks", F.col("_c.tokens").alias("tokens"), F.col("_c.title").alias("title"), F.col("_c.headings").alias("headings"), section_type(F.col("_c.headings")).alias("section_type"), F.col("_c.text").alias("text"))
