"""Distinct-word tables of a byte-level BPE vocabulary.

A text is split by the vocabulary's pattern inside Spark's JVM. Every *block* of documents (an
Arrow batch or a part of one) is then dictionary-coded in C++ by pyarrow, so that no Python object is made for a piece.
What moves between executors is the blocks' dictionaries, joined to a table that holds every distinct
piece once, and the coded documents; both meet again in their block and are put together by position.
"""

from __future__ import annotations

import base64
import functools
import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.llm.staging import staged

# Fixed value: the splitting pattern published with the vocabulary, with Unicode classes for Java.
SPLIT = r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The folder of the vocabulary files; an environment variable or a parameter names another.
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")


@functools.lru_cache(maxsize=4)
def ranks(name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> dict[bytes, int]:
    with open(os.path.join(folder, f"{name}.tiktoken"), "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


@functools.lru_cache(maxsize=4)
def encoding(name: str = "byte_bpe_50k", folder: str = TOKENIZERS):
    import tiktoken

    return tiktoken.Encoding(name, pat_str=SPLIT.removeprefix("(?U)"), mergeable_ranks=ranks(name, folder), special_tokens={})


def _of_bounded_size(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that their lists have about ``most`` entries in all; a row that has more is a batch of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.list_value_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        number = np.cumsum(sizes) // most
        large = sizes > most
        cuts = [0, *(np.flatnonzero((np.diff(number) != 0) | large[1:] | large[:-1]) + 1), batch.num_rows]
        for low, high in zip(cuts, cuts[1:]):
            if high > low:
                yield batch.slice(low, high - low)


def _code_blocks(keys: list[str], most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _of_bounded_size(batches, "_pieces", most):
            n = batch.num_rows
            block = uuid.uuid4().hex[:16]
            pieces = batch.column("_pieces")
            flat = pieces.flatten().dictionary_encode()
            sizes = pc.fill_null(pc.list_value_length(pieces), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(sizes)
            codes = flat.indices.to_numpy(zero_copy_only=False).astype(np.uint32)
            if len(flat.dictionary) <= 1 << 16:
                codes, wide = codes.astype(np.uint16), False
            else:
                wide = True
            data = codes.tobytes()
            width = 4 if wide else 2
            offsets = np.concatenate([[0], ends * width])
            coded = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())
            out = {"_block": pa.array([block] * n), "_wide": pa.array([wide] * n)}
            out |= {k: batch.column(k) for k in keys}
            yield pa.RecordBatch.from_pydict(out | {"_codes": coded, "_words": pa.nulls(n, pa.list_(pa.string()))})
            words = flat.dictionary.cast(pa.string())
            lists = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)
            yield pa.RecordBatch.from_pydict({"_block": pa.array([block]), "_wide": pa.array([wide])} | {k: pa.nulls(1, batch.schema.field(k).type) for k in keys} | {"_codes": pa.nulls(1, pa.binary()), "_words": lists})

    return run


def coded_blocks(df: DataFrame, keys: list[str], text: str, most: int = 1_000_000) -> tuple[DataFrame, DataFrame]:
    """``(documents, dictionary)``: rows ``keys, _block, _wide, _codes`` and rows ``_block, _code, word``.

    A block has about ``most`` pieces however long its documents are, so what a task holds is bounded.

    Every input row gives one document row; a null or empty text has no codes. The coded table is
    written to the shared folder once, so the texts are read and split a single time.
    """
    picked = df.select(*keys, F.regexp_extract_all(F.col(text), F.lit(SPLIT), F.lit(0)).alias("_pieces"))
    schema = T.StructType(
        [T.StructField("_block", T.StringType()), T.StructField("_wide", T.BooleanType())]
        + [picked.schema[k] for k in keys]
        + [T.StructField("_codes", T.BinaryType()), T.StructField("_words", T.ArrayType(T.StringType()))]
    )
    for field in schema:
        field.nullable = True
    table = staged(picked.mapInArrow(_code_blocks(keys, most), schema), "pieces")
    documents = table.where(F.col("_words").isNull()).select(*keys, "_block", "_wide", "_codes")
    dictionary = table.where(F.col("_words").isNotNull()).select("_block", F.posexplode("_words").alias("_code", "word"))
    return documents, dictionary


def distinct_words(dictionary: DataFrame) -> DataFrame:
    """The distinct pieces of all blocks, each once."""
    return dictionary.select("word").distinct()


def encoded_words(words: DataFrame, tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """``word, ids``: every distinct piece encoded once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = encoding(tokenizer, folder)._encode_single_piece
        for batch in batches:
            ids = [one(w.encode()) for w in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_pydict({"word": batch.column("word"), "ids": pa.array(ids, pa.list_(pa.int32()))})

    return words.mapInArrow(run, "word string, ids array<int>")


def _codes_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """All codes of a block's documents in a row, and how many each document has."""
    column = table.column("_codes").combine_chunks()
    wide = table.column("_wide")[0].as_py()
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, np.uint32 if wide else np.uint16), sizes // (4 if wide else 2)


def ids_by_position(documents: DataFrame, dictionary: DataFrame, words: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, ids``: the ids of every document's pieces, joined back by position."""
    resolved = dictionary.join(words, "word").select(F.col("_block").alias("_of"), "_code", "ids")
    schema = T.StructType([documents.schema[k] for k in keys] + [T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        codes, per_document = _codes_of(left)
        order = np.argsort(right.column("_code").to_numpy())
        lists = right.column("ids").combine_chunks().take(pa.array(order))
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        starts = np.concatenate([[0], np.cumsum(counts)])
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int32) if len(lists) else np.zeros(0, np.int32)
        lengths = counts[codes] if len(codes) else np.zeros(0, np.int64)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        take = np.arange(ends[-1], dtype=np.int64) + np.repeat((starts[codes] if len(codes) else lengths) - ends[:-1], lengths)
        bounds = ends[np.concatenate([[0], np.cumsum(per_document)])]
        ids = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat[take], pa.int32()))
        return pa.table({k: left.column(k) for k in keys} | {"ids": ids})

    return documents.groupBy("_block").cogroup(resolved.groupBy("_of")).applyInArrow(run, schema)


def sums_by_position(documents: DataFrame, dictionary: DataFrame, words: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, n_tokens``: the summed ``n_tokens`` (of ``words``) of every document's pieces."""
    resolved = dictionary.join(words, "word").select(F.col("_block").alias("_of"), "_code", "n_tokens")
    schema = T.StructType([documents.schema[k] for k in keys] + [T.StructField("n_tokens", T.LongType())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        codes, per_document = _codes_of(left)
        counts = np.zeros(right.num_rows + 1, np.int64)
        counts[right.column("_code").to_numpy()] = right.column("n_tokens").to_numpy()
        sums = np.concatenate([[0], np.cumsum(counts[codes])])
        bounds = np.concatenate([[0], np.cumsum(per_document)])
        return pa.table({k: left.column(k) for k in keys} | {"n_tokens": sums[bounds[1:]] - sums[bounds[:-1]]})

    return documents.groupBy("_block").cogroup(resolved.groupBy("_of")).applyInArrow(run, schema)
