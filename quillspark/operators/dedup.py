"""Exact and near duplicates."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions.hashing import simhash


def first_of_each(df: DataFrame, text: str, order: str, within: str | None = None) -> DataFrame:
    """The first row (by ``order``, nulls last) of every different text, over all rows or within a column's groups.

    Null texts are one text. Digests are grouped with partial aggregation, so a text that a third of the
    rows has is no task's alone; of ties of ``order`` within a text one row stays. The input is read once.
    """
    digest = F.sha1(F.coalesce(F.col(text), F.lit(""))).alias("_digest")
    keys = [digest] if within is None else [digest, F.col(within).alias("_within")]
    rank = F.struct(F.col(order).isNull(), F.col(order))
    firsts = df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in df.columns]), rank).alias("_row"))
    return firsts.select("_row.*")


def repeated_lines(documents: DataFrame, key: str = "doc_id", text: str = "text", most: int = 3, longer_than: int = 10) -> DataFrame:
    """``key, text``: lines that a document has more than ``most`` times are removed, blank runs squeezed.

    Counting stays within the row; nothing is shuffled. Sorted lines show repeats as runs, so a document
    of n lines takes n log n steps.
    """
    lines = F.transform(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: F.regexp_replace(x, r"^[ \t\r\f]+|[ \t\r\f]+$", ""))
    numbered = F.array_sort(F.transform(lines, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    at = lambda i: F.when(i >= 0, F.get("_lines", i)["x"])
    in_run = lambda i: reduce(lambda a, b: a | b, [F.coalesce(at(i - k) == at(i - k + most), F.lit(False)) for k in range(most + 1)])
    kept = F.filter("_lines", lambda line, i: (F.length(line["x"]) <= longer_than) | ~in_run(i))
    ordered = F.array_sort(F.transform(kept, lambda line: F.struct(line["i"].alias("i"), line["x"].alias("x"))))
    joined = F.array_join(F.transform(ordered, lambda line: line["x"]), "\n")
    return documents.select(key, numbered.alias("_lines")).select(key, F.regexp_replace(joined, r"\n{3,}", "\n\n").alias("text"))


# Where each of six slices of a fingerprint begins and ends.
_SLICES = [(0, 11), (11, 22), (22, 33), (33, 44), (44, 54), (54, 64)]


def near_duplicate_classes(documents: DataFrame, key: str = "doc_id", text: str = "text", distance: int = 3) -> DataFrame:
    """``key_a, key_b, distance``: representatives of texts whose fingerprints differ in few bits.

    Equal fingerprints are one class, named by its smallest key, so copies are never paired. Three
    differing bits leave three of six slices equal, so classes meet in a join on any three slices: twenty
    keys of 31 to 33 bits, each shared by few classes however many there are. Texts without a word have
    no fingerprint.
    """
    if distance > 3:
        raise ValueError("three of six slices find at most three differing bits")
    prints = documents.where(F.col(key).isNotNull()).select(F.col(key).alias("_key"), simhash(F.coalesce(F.col(text), F.lit(""))).alias("_print")).where("_print <> 0")
    classes = prints.groupBy("_print").agg(F.min("_key").alias("_key"))

    def mask(chosen: tuple) -> int:
        bits = sum(((1 << (high - low)) - 1) << low for low, high in chosen)
        return bits - (1 << 64) if bits >> 63 else bits

    parts = F.array(*[F.struct(F.lit(i).alias("slices"), F.col("_print").bitwiseAND(F.lit(mask(c))).alias("bits")) for i, c in enumerate(combinations(_SLICES, 3))])
    banded = classes.select("_key", "_print", F.explode(parts).alias("_band"))
    other = banded.select(F.col("_key").alias("_k2"), F.col("_print").alias("_p2"), F.col("_band").alias("_b2"))
    differing = F.bit_count(F.col("_print").bitwiseXOR(F.col("_p2")))
    pairs = banded.join(other, (F.col("_band") == F.col("_b2")) & (F.col("_key") < F.col("_k2"))).where(differing <= distance)
    return pairs.select(F.col("_key").alias(f"{key}_a"), F.col("_k2").alias(f"{key}_b"), differing.cast("bigint").alias("distance")).distinct()


def top_phrases(documents: DataFrame, phrases, key: str = "doc_id", most: int = 10) -> DataFrame:
    """``key, phrase, n, rank``: a document's most frequent phrases, ties by first appearance."""
    placed = documents.select(key, F.posexplode(phrases).alias("_at", "phrase"))
    counted = placed.groupBy(key, "phrase").agg(F.count("*").alias("n"), F.min("_at").alias("_first"))
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), "_first"))
    return counted.withColumn("rank", rank.cast("bigint")).where(F.col("rank") <= most).select(key, "phrase", "n", "rank")
