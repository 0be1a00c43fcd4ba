"""Long exact spans that documents share, by compaction of a de Bruijn graph of content-picked k-mers.

Of every run of ``least`` characters the smallest of its k-mers (by hash) is picked, so two documents
that share such a run have a picked k-mer in common, wherever the run lies in them. Picked k-mers are
the nodes of the graph, neighbours in a text its edges; neighbours overlap, so a path spells its text
without gaps. Joins with the nodes' aggregated neighbours compact paths that never branch into one
span each, and keys made from the source at the spans' coordinates verify what is shared.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.staging import staged

_BASE = np.uint64(0x9E3779B97F4A7C15)
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def window_hashes(points: np.ndarray, length: int) -> np.ndarray:
    """Hash of every window of ``length`` code points, from hashes of windows of powers of two."""
    if len(points) < length:
        return np.zeros(0, np.uint64)
    power, at, result, done = _mixed(points.astype(np.uint64) + np.uint64(1)), 1, None, 0
    with np.errstate(over="ignore"):
        while True:
            if length & at:
                # what is done so far stands to the left of the next, longer part
                result = power if result is None else result[: len(power) - done] * np.uint64(pow(int(_BASE), at, 1 << 64)) + power[done : done + len(result)][: len(power) - done]
                done += at
            if at * 2 > length:
                return _mixed(result)[: len(points) - length + 1]
            power = power[:-at] * np.uint64(pow(int(_BASE), at, 1 << 64)) + power[at:]
            at *= 2


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``width`` neighbours."""
    at, power = 1, values
    while at * 2 <= width:
        power = pick(power[:-at], power[at:])
        at *= 2
    rest = width - at
    return pick(power[: len(power) - rest], power[rest:]) if rest else power


def picked_kmers(points: np.ndarray, least: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the k-mers that are smallest in some run of ``least`` code points.

    Inside a stretch of one repeated character only its ends are kept.
    """
    if len(points) < least:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashes = window_hashes(points, k)
    width = least - k + 1
    smallest = _sliding(hashes, width, np.minimum)
    edge = np.zeros(width - 1, np.uint64)
    reached = _sliding(np.concatenate([edge, smallest, edge]), width, np.maximum)
    chosen = reached == hashes
    same = hashes[1:] == hashes[:-1]
    inside = np.zeros(len(hashes), bool)
    inside[1:-1] = same[:-1] & same[1:]
    at = np.flatnonzero(chosen & ~inside)
    return at, hashes[at]


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _kmer_rows(least: int, k: int, key: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            found = [picked_kmers(_points(column[i].as_py()), least, k) for i in range(batch.num_rows)]
            ends = pa.array(np.concatenate([[0], np.cumsum([len(at) for at, _ in found])]), pa.int32())
            places = pa.array(np.concatenate([at for at, _ in found]).astype(np.int32))
            hashes = pa.array(np.concatenate([h for _, h in found]).view(np.int64))
            lists = {"p": pa.ListArray.from_arrays(ends, places), "h": pa.ListArray.from_arrays(ends, hashes)}
            yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in (key, "same", "number")} | lists)

    return run


def _span_keys(least: int, k: int, edges: bool):
    """Spans of a document's repeated nodes and the keys under which others may share them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"doc": [], "key": [], "start": [], "length": []}
            for i in range(batch.num_rows):
                nodes = sorted({n["p"]: n for n in batch.column("nodes")[i].as_py()}.values(), key=lambda n: n["p"])
                points = _points(batch.column("text")[i].as_py())
                kmers, full = window_hashes(points, k).view(np.int64), None
                nodes = [n for n in nodes if n["p"] < len(kmers) and kmers[n["p"]] == n["h"]]
                spans, last = [], None
                for n in nodes:
                    if last is not None and last["one_after"] and last["a"] == n["h"] and last["n"] == n["n"]:
                        spans[-1][1] = n["p"] + k
                    else:
                        spans.append([n["p"], n["p"] + k, n["h"]])
                    last = n
                for last, n in zip(nodes, nodes[1:]) if edges else ():
                    # between the ends of a stretch of one character all windows are the same
                    long = n["p"] + k - last["p"]
                    if n["h"] == last["h"] and long >= least and (kmers[last["p"] : n["p"] + 1] == n["h"]).all():
                        full = window_hashes(points, least).view(np.int64) if full is None else full
                        out["doc"].append(i), out["key"].append(int(full[last["p"]])), out["start"].append(last["p"]), out["length"].append(long)
                for start, end, head in spans:
                    whole = end - start >= least
                    ranges = []
                    if whole:  # a span that never branches is the same text wherever its head occurs
                        out["doc"].append(i), out["key"].append(head ^ 0x5DEECE66D), out["start"].append(start), out["length"].append(end - start)
                    else:  # windows that hold all of it
                        ranges.append((end - least, start + 1))
                    if edges:  # and those that hold its first or last k-mer only
                        ranges += [(start - (least - k), start if whole else end - least), (end - least + 1 if whole else start + 1, end - k + 1)]
                    if ranges and full is None:
                        full = window_hashes(points, least).view(np.int64)
                    for low, high in ranges:
                        at = np.arange(max(0, low), min(len(full), high))
                        out["doc"].extend([i] * len(at)), out["key"].extend(full[at].tolist()), out["start"].extend(at.tolist()), out["length"].extend([least] * len(at))
            rows = pa.array(out["doc"], pa.int64())
            yield pa.RecordBatch.from_pydict({"doc": batch.column("same").take(rows), "span": pa.array(out["key"], pa.int64()), "start": pa.array(out["start"], pa.int32()), "length": pa.array(out["length"], pa.int32())})

    return run


def _hot_nodes(nodes: DataFrame, share: int = 4096, sample: int = 64) -> list[int]:
    """Hashes of nodes that more than one in ``share`` is, judged by one text in ``sample``; at most ``share`` of them.

    They decide how nodes travel, not what comes out.
    """
    some = nodes.where(F.pmod(F.xxhash64("number"), F.lit(sample)) == 0).groupBy("h").count()
    total = some.agg(F.sum("count")).first()[0] or 0
    return [r.h for r in some.where((F.col("count") * share > total) & (F.col("count") > 100)).select("h").collect()]


def _repeated_spans(df: DataFrame, key: str, text: str, least: int, k: int, edges: bool) -> tuple[DataFrame, DataFrame]:
    """``(doc, span, start, length)`` of every different text, named by its digest, and ``(doc, key)`` of all rows.

    Nodes are grouped by a short number of their text; what two texts of one number had in common by
    chance falls away when the nodes are held against the source.
    """
    source = df.where(F.col(key).isNotNull() & (F.length(text) >= least)).select(F.col(key).alias("_key"), F.md5(text).alias("same"), F.xxhash64(text).alias("number"), F.col(text).alias("text"))
    kind = source.schema["_key"].dataType.simpleString()
    picked = staged(source.mapInArrow(_kmer_rows(least, k, "_key"), f"_key {kind}, same string, number bigint, p array<int>, h array<bigint>"), "kmers")
    members = picked.select(F.col("same").alias("doc"), F.col("_key").alias("key")).distinct()
    n = F.size("h")
    after = F.concat(F.slice("h", 2, n - 1), F.array(F.lit(0).cast("bigint"))).alias("a")
    nodes = picked.where(n > 0).select("number", F.explode(F.arrays_zip("h", after, "p")).alias("n")).select("number", F.col("n.h").alias("h"), F.col("n.a").alias("a"), F.col("n.p").alias("p"))
    hot = _hot_nodes(nodes)
    often = F.col("h").isin(hot) if hot else F.lit(False)
    found = []
    # most nodes are shuffled once by their hash; the few that very many texts have stay where they are
    for some, few in [(nodes.where(~often).repartition("h"), False), *([(nodes.where(often), True)] if hot else [])]:
        # a path goes on without a branch if one node always follows and is met as often as the node before it
        stats = some.groupBy(F.col("h").alias("_h")).agg(F.min("number").alias("_low"), F.max("number").alias("_high"), (F.min("a") == F.max("a")).alias("one_after"), F.count("*").alias("n"))
        stats = stats.where("_low < _high").select("_h", "one_after", "n")
        found.append(some.join(F.broadcast(stats) if few else stats, F.col("h") == F.col("_h")))
    repeated = reduce(DataFrame.unionByName, found).groupBy("number").agg(F.collect_list(F.struct("p", "h", "a", "one_after", "n")).alias("nodes"))
    texts = source.select(F.col("number").alias("_number"), "same", "text")
    placed = repeated.join(texts, F.col("number") == F.col("_number")).select("same", "nodes", "text")
    spans = placed.mapInArrow(_span_keys(least, k, edges), "doc string, span bigint, start int, length int")
    return spans, members


def shared_pairs(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = 240, k: int = 121) -> DataFrame:
    """``<key>_a, <key>_b`` with a < b: pairs of rows that share ``least`` or more identical characters.

    Texts that are null or shorter have no pair. Rows with the very same text are one node of the graph;
    they come out as pairs at the end, as the result demands. Repeated rows count once; a key has one text. A span that very
    many documents share is one key to join on, never a list in one task.
    """
    spans, members = _repeated_spans(df, key, text, least, k, edges=False)
    owners = staged(spans.select("doc", "span").distinct(), "spans")
    several = owners.groupBy("span").agg(F.min("doc").alias("_low"), F.max("doc").alias("_high")).where("_low < _high").select("span")
    owners = owners.join(several, "span")
    other = owners.select(F.col("span").alias("_span"), F.col("doc").alias("other"))
    linked = owners.join(other, (F.col("span") == F.col("_span")) & (F.col("doc") < F.col("other"))).select("doc", "other").distinct()
    a, b = members.select(F.col("doc").alias("_a"), F.col("key").alias("_ka")), members.select(F.col("doc").alias("_b"), F.col("key").alias("_kb"))
    across = linked.join(a, F.col("doc") == F.col("_a")).join(b, F.col("other") == F.col("_b")).select("_ka", "_kb")
    copies = a.join(b, (F.col("_a") == F.col("_b")) & (F.col("_ka") < F.col("_kb"))).select("_ka", "_kb")
    every = across.unionByName(copies)
    return every.select(F.least("_ka", "_kb").alias(f"{key}_a"), F.greatest("_ka", "_kb").alias(f"{key}_b")).where(F.col(f"{key}_a") < F.col(f"{key}_b")).distinct()


def span_members(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = 240, k: int = 121) -> DataFrame:
    """``class_id, span, char_start, n_chars, n_classes``: the shared spans of every different text, without pairs.

    Texts of one ``span`` share the ``n_chars`` characters at ``char_start``; ``class_id`` is the smallest
    key with the text, whose other keys are in ``text_classes``. A span that very many texts share is as
    many rows as it has texts.
    """
    spans, members = _repeated_spans(df, key, text, least, k, edges=False)
    spans = staged(spans.groupBy("doc", "span").agg(F.min_by(F.struct("start", "length"), "start").alias("_at")), "spans")
    several = spans.groupBy(F.col("span").alias("_span")).agg(F.count("*").alias("n_classes")).where("n_classes > 1")
    first = members.groupBy(F.col("doc").alias("_doc")).agg(F.min("key").alias("class_id"))
    rows = spans.join(several, F.col("span") == F.col("_span")).join(first, F.col("doc") == F.col("_doc"))
    return rows.select("class_id", "span", F.col("_at.start").alias("char_start"), F.col("_at.length").alias("n_chars"), "n_classes")


def text_classes(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = 240) -> DataFrame:
    """``<key>, class_id, n_members``: keys of the very same text of at least ``least`` characters are one class."""
    rows = df.where(F.col(key).isNotNull() & (F.length(text) >= least)).select(F.md5(text).alias("_doc"), F.col(key).alias("_key")).distinct()
    classes = rows.groupBy(F.col("_doc").alias("_of")).agg(F.min("_key").alias("class_id"), F.count("*").alias("n_members"))
    return rows.join(classes, F.col("_doc") == F.col("_of")).select(F.col("_key").alias(key), "class_id", "n_members")


def shared_share(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = 240, k: int = 121) -> DataFrame:
    """``key, n_chars, shared_chars, shared_share``: how much of every row's text others have too.

    A character counts if it lies in a run of ``least`` or more characters that another row has as
    well. Every key comes out once; null and shorter texts share nothing, and the share of an empty
    text is 0.
    """
    spans, members = _repeated_spans(df, key, text, least, k, edges=True)
    spans = staged(spans, "spans")
    several = spans.groupBy("span").agg(F.min("doc").alias("_low"), F.max("doc").alias("_high")).where("_low < _high").select("span")
    shared = spans.join(several, "span").groupBy("doc").agg(F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("end")))).alias("_spans"))
    covered = F.aggregate(
        "_spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda s, x: F.struct((s["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["start"], s["end"]))).alias("n"), F.greatest(s["end"], x["end"]).alias("end")),
    )["n"]
    by_class = shared.select("doc", covered.alias("_covered"))
    copies = members.groupBy("doc").agg(F.count("*").alias("_n"))
    by_key = members.join(copies, "doc").join(by_class, "doc", "left").select(F.col("key").alias("_k"), "_n", "_covered")
    rows = df.where(F.col(key).isNotNull()).select(F.col(key), F.length(text).alias("_len")).groupBy(key).agg(F.coalesce(F.max("_len"), F.lit(0)).cast("long").alias("n_chars"))
    by_key = by_key.groupBy("_k").agg(F.max("_n").alias("_n"), F.max("_covered").alias("_covered"))
    joined = rows.join(by_key, F.col(key) == F.col("_k"), "left")
    n = F.when(F.col("_n") > 1, F.col("n_chars")).otherwise(F.coalesce("_covered", F.lit(0))).cast("long")
    return joined.select(key, "n_chars", n.alias("shared_chars"), F.when(F.col("n_chars") > 0, n / F.col("n_chars")).otherwise(F.lit(0.0)).alias("shared_share"))
