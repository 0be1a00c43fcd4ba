"""Embedding of chunks in batches, and ranking by similarity."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sizes of known models; others have 1536 numbers.
DIMENSIONS = {"text-embedding-3-small": 1536, "text-embedding-3-large": 3072, "text-embedding-ada-002": 1536}


def hashing_embedder(dim: int = 64) -> Callable[[list[str]], list[list[float] | None]]:
    """A deterministic embedder for tests: signed sums of hashed words, of unit length."""

    def embed(texts: list[str]) -> list[list[float] | None]:
        out: list[list[float] | None] = []
        for text in texts:
            v = np.zeros(dim)
            hashes = [int.from_bytes(hashlib.md5(w.encode()).digest()[:8], "big") for w in text.lower().split()]
            for h in hashes:
                v[h % dim] += 1 if h >> 63 else -1
            if hashes and not v.any():  # all words cancelled out
                v[hashes[0] % dim] = 1
            norm = np.linalg.norm(v)
            out.append((v / norm).tolist() if norm else None)
        return out

    return embed


def with_embeddings(chunks: DataFrame, embed: Callable[[list[str]], list[list[float] | None]], model: str, batch: int = 64, text: str = "text", delay: float = 0.0) -> DataFrame:
    """``chunks`` with ``embedding, embedding_model, embedding_dim``.

    Texts go out ``batch`` at a time with ``delay`` seconds between two batches of a task; a batch that
    fails has nulls, and so have null texts.
    """

    @F.pandas_udf("array<float>")
    def vectors(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            out: list = []
            for at in range(0, len(texts), batch):
                some = [t or "" for t in texts[at : at + batch]]
                try:
                    out += embed(some)
                except Exception:  # noqa: BLE001 - a remote batch may fail in any way
                    out += [None] * len(some)
                time.sleep(delay)
            yield pd.Series(out, dtype=object)

    made = chunks.withColumn("embedding", vectors(F.col(text)))
    some = F.col("embedding").isNotNull()
    return made.withColumn("embedding_model", F.when(some, F.lit(model))).withColumn("embedding_dim", F.when(some, F.size("embedding")))


def only_embedded(chunks: DataFrame) -> DataFrame:
    return chunks.where(F.col("embedding").isNotNull())


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity, null for vectors of other lengths, null or zero ones."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when((F.size(a) == F.size(b)) & (norms > 0), dot(a, b) / norms)


def most_similar(vectors: DataFrame, query: list[float], key: str, embedding: str = "embedding", k: int = 10) -> DataFrame:
    """``key, similarity`` of the ``k`` vectors most similar to ``query``; ties go by key."""
    q = F.array(*[F.lit(float(x)) for x in query])
    scored = vectors.select(key, cosine(F.col(embedding), q).alias("similarity")).where("similarity is not null")
    return scored.orderBy(F.desc("similarity"), key).limit(k)
