"""Token counts of documents through partitioned prefix tries, and their totals by slice."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.pieces import TOKENIZERS, coded_blocks, distinct_words, encoding, ranks, sums_by_position


class PrefixCounter:
    """Exact number of tokens of sorted pieces, with the tokenization states of shared prefixes kept.

    The state of a prefix is its last token and its number of tokens. A list of tokens is what the
    vocabulary's merges produce exactly if every two neighbours stay apart when merged on their own,
    so one more byte needs only the tokens that end there and the state where such a token starts.
    """

    def __init__(self, tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS):
        self.ranks = ranks(tokenizer, folder)
        self.encode = encoding(tokenizer, folder)._encode_single_piece
        self.longest = max(map(len, self.ranks))
        self.apart: dict[tuple[bytes, bytes], bool] = {}
        self.piece = b""
        self.last: list[bytes] = [b""]
        self.count = [0]

    def _stay_apart(self, left: bytes, right: bytes) -> bool:
        known = self.apart.get((left, right))
        if known is None:
            if len(self.apart) > 2_000_000:
                self.apart.clear()
            known = self.apart[left, right] = self.encode(left + right) == [self.ranks[left], self.ranks[right]]
        return known

    def tokens(self, piece: bytes) -> int:
        """Number of tokens of ``piece``; cheap if it shares a long prefix with the piece before."""
        before, last, count, known = self.piece, self.last, self.count, self.ranks
        shared = 0
        for a, b in zip(before, piece):
            if a != b:
                break
            shared += 1
        del last[shared + 1 :], count[shared + 1 :]
        for end in range(shared + 1, len(piece) + 1):
            for start in range(max(0, end - self.longest), end):
                token = piece[start:end]
                if token in known and (not start or self._stay_apart(last[start], token)) and (start or end == 1 or len(self.encode(token)) == 1):
                    last.append(token)
                    count.append(count[start] + 1)
                    break
        self.piece = piece
        return count[-1]


def trie_counts(words: DataFrame, tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """``word, n_tokens`` for distinct pieces: each task walks the trie of one range of prefixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PrefixCounter(tokenizer, folder)
        for batch in batches:
            counts = [counter.tokens(w.encode()) for w in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_pydict({"word": batch.column("word"), "n_tokens": pa.array(counts, pa.int64())})

    return words.repartitionByRange("word").sortWithinPartitions("word").mapInArrow(run, "word string, n_tokens bigint")


def token_counts(df: DataFrame, keys: Iterable[str], text: str = "text", tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """``keys, n_tokens`` for every row of ``df``; null and empty texts have 0 tokens."""
    keys = list(keys)
    documents, dictionary = coded_blocks(df, keys, text)
    return sums_by_position(documents, dictionary, trie_counts(distinct_words(dictionary), tokenizer, folder), keys)


def settled_tokens(chunks: DataFrame, tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """One row per chunk id, of its latest delivery, with the number of tokens settled.

    Columns ``id, source_type, lang, domain, stated, n_chars, n_tokens``; ``stated`` is the unreliable
    number. Rows without an id are left out. Of repeated rows one counts; ties of the crawl time are
    broken by the other columns. Null and blank texts keep their 0 or few tokens.
    """
    narrow = chunks.where(F.col("id").isNotNull()).select(
        "id", "source_type", "lang", "domain", "crawl_ts", F.col("tokens").cast("long").alias("stated"),
        F.length("text").cast("long").alias("n_chars"), "text",
        F.coalesce(F.regexp_like("text", F.lit(r"(?U)\S")), F.lit(False)).alias("filled"),
    )
    keys = [c for c in narrow.columns if c != "text"]
    counted = token_counts(narrow, keys, "text", tokenizer, folder)
    fields = [c for c in (*keys, "n_tokens") if c not in ("id", "crawl_ts")]
    latest = counted.groupBy("id").agg(F.max(F.struct("crawl_ts", *fields)).alias("_row"))
    return latest.select("id", *[F.col(f"_row.{c}").alias(c) for c in fields])


def badly_stated(settled: DataFrame, least_chars: int = 100) -> DataFrame:
    """``id`` of chunks whose stated number is missing or off by more than a factor of two."""
    wrong = F.col("stated").isNull() | (F.col("stated") * 2 < F.col("n_tokens")) | (F.col("stated") > F.col("n_tokens") * 2)
    return settled.where((F.col("n_chars") >= least_chars) & F.col("filled") & wrong).select("id")


def token_totals(settled: DataFrame, language: Column | None = None) -> DataFrame:
    """Chunks and tokens by source type, language and domain, each chunk counted once.

    Source types are compared in lower case; missing values are ``unknown``. ``language`` defaults to
    the first two letters of the label.
    """
    label = F.lower(F.regexp_extract(F.coalesce("lang", F.lit("")), "^([A-Za-z]{2})", 1))
    named = lambda c: F.when(F.coalesce(c, F.lit("")) == "", "unknown").otherwise(c)
    return settled.groupBy(
        named(F.lower("source_type")).alias("source_type"), named(language if language is not None else label).alias("lang"), named(F.col("domain")).alias("domain")
    ).agg(F.count("*").alias("n_chunks"), F.sum("n_tokens").alias("n_tokens"))
