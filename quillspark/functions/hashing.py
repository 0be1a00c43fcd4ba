"""Content hashes and identifiers; null in, null out unless stated."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark.functions.batched import batched


def content_sha1(text: Column) -> Column:
    return F.sha1(text)


def doc_sha1(text: Column) -> Column:
    return F.substring(F.sha1(text), 1, 16)


def content_hashes(text: Column, doc_text: Column | None = None) -> Column:
    """Struct ``content_sha1, doc_sha1, simhash``; without a document's text the chunk's own counts."""
    whole = text if doc_text is None else F.coalesce(doc_text, text)
    return F.struct(content_sha1(text).alias("content_sha1"), doc_sha1(whole).alias("doc_sha1"), simhash(text).cast("string").alias("simhash"))


def chunk_id(doc: Column, index: Column, text: Column) -> Column:
    """``doc#00007-1a2b3c4d``; indices of six and more digits are kept whole."""
    return F.concat(doc, F.lit("#"), F.format_string("%05d", index), F.lit("-"), F.substring(F.sha1(text), 1, 8))


def structure_chunk_id(text: Column, index: Column) -> Column:
    return F.substring(F.md5(F.concat(F.substring(text, 1, 100), index.cast("string"))), 1, 16)


@batched("bigint")
def _majority(hashes: pd.Series) -> pd.Series:
    """For each list of hashes, the bits that more than half of them have set."""
    sizes = hashes.map(len).to_numpy()
    out = np.zeros(len(sizes), np.int64)
    filled = np.flatnonzero(sizes)
    if len(filled):
        flat = np.concatenate([np.asarray(h, np.int64) for h in hashes.iloc[filled]])
        starts = np.concatenate([[0], np.cumsum(sizes[filled])[:-1]])
        sums = np.stack([np.add.reduceat((flat >> np.int64(b)) & 1, starts) for b in range(64)], axis=1)
        bits = (sums * 2 > sizes[filled][:, None]).astype(np.uint64)
        out[filled] = (bits << np.arange(64, dtype=np.uint64)).sum(1, dtype=np.uint64).view(np.int64)
    return pd.Series(out)


def simhash(text: Column) -> Column:
    """64-bit fingerprint of a text's lower-case words, as a signed bigint; a text without words has 0.

    A bit is set if more word hashes have it set than not (Charikar 2002). Words are hashed in the JVM;
    only their hashes go to Python, where a whole batch is counted bit by bit.
    """
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return _majority(F.transform(words, lambda w: F.xxhash64(w)))


def original_hash(content: Column) -> Column:
    """Hash of raw bytes."""
    return F.sha1(content)


def should_recrawl(old_sha1: Column, content: Column) -> Column:
    """True if there is no old hash or the bytes have changed."""
    return old_sha1.isNull() | (old_sha1 != F.sha1(content))
