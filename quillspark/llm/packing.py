"""Best-fit packing of texts into containers of fixed capacity."""

from __future__ import annotations

import heapq
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def best_fit_rounds(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int]], int]:
    """Best-fit decreasing on size classes: ``(size, first rank, first container, items a container)``.

    Items of one size are alike, so a round moves all it can at once: the class at hand goes to the
    smallest gap that holds it, as many items as fit into each container of that gap, and gaps are
    updated. Containers of one gap and history are one interval of numbers. The state is bounded by
    the capacity (sizes and gaps are integers up to it) whatever the number of items: a class adds at
    most three intervals, and whatever is put into an interval leaves less than half of its gap, so there
    are at most ``3 * capacity * log2(capacity)`` slots. Also given: how many containers there are.
    """
    slots: list[tuple[int, int, int, int]] = []
    gaps: list[int] = []  # sorted gaps that some container has
    groups: dict[int, list[tuple[int, int]]] = {}  # gap -> intervals (first, number); a heap by number of the first
    opened = 0

    def put(gap: int, first: int, number: int) -> None:
        if gap and number:
            if gap not in groups:
                insort(gaps, gap)
                groups[gap] = []
            heapq.heappush(groups[gap], (first, number))

    for size in sorted(counts, reverse=True):
        left, rank = counts[size], 0
        while left:
            at = bisect_left(gaps, size)
            if at < len(gaps):
                gap = gaps[at]
                first, number = heapq.heappop(groups[gap])
                if not groups[gap]:
                    del groups[gap], gaps[at]
            else:
                gap, first = capacity, opened
                number = -(-left // (capacity // size))
                opened += number
            each = gap // size
            full = min(number, left // each)
            if full:
                slots.append((size, rank, first, each))
                rank, left = rank + full * each, left - full * each
                put(gap - each * size, first, full)
            if full < number and left and left < each:
                slots.append((size, rank, first + full, left))
                put(gap - left * size, first + full, 1)
                full, rank, left = full + 1, rank + left, 0
            put(gap, first + full, number - full)
    return slots, opened


def pack(sizes: DataFrame, kinds: dict[str, int], key: str = "doc_id", size: str = "n_tokens", salts: int | None = None) -> DataFrame:
    """Containers for the items of ``sizes`` under every capacity of ``kinds``.

    Columns ``pack_kind, container_id, key, part, first_token, n_tokens``. An item larger than the
    capacity is cut into full containers and a rest, else none is split. Items of size null or 0 need
    no room: they come out once per kind with a null container. Repeated and null keys are items of
    their own. Ranks within a size are counted per salt and summed up, so a size that a third of all
    items have is spread over ``salts`` tasks, by default as many as a shuffle has partitions. What
    comes to the driver is the number of items of each size, at most ``capacity`` rows a kind.
    """
    salts = salts or int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if any(c < 1 for c in kinds.values()):
        raise ValueError("capacities must be positive")
    kind = F.array(*[F.struct(F.lit(k).alias("pack_kind"), F.lit(c).cast("long").alias("capacity")) for k, c in sorted(kinds.items())])
    items = sizes.select(F.col(key).alias("_key"), F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("_size")).select("_key", "_size", F.explode(kind).alias("_kind"))
    items = items.select("_key", "_size", "_kind.*", F.expr("_size div _kind.capacity").alias("_full"), F.expr("_size % _kind.capacity").alias("_rest"))
    whole = items.where("_full > 0").select("pack_kind", "_key", F.posexplode(F.expr("sequence(0L, (_full - 1) * capacity, capacity)")).alias("part", "first_token"), F.col("capacity").alias("n_tokens"))
    nothing = items.where("_size = 0").select("pack_kind", F.lit(None).cast("string").alias("container_id"), "_key", F.lit(0).alias("part"), F.lit(0).cast("long").alias("first_token"), F.lit(0).cast("long").alias("n_tokens"))

    rests = items.where("_rest > 0").select("pack_kind", "_key", F.col("_full").cast("int").alias("part"), (F.col("_full") * F.col("capacity")).alias("first_token"), F.col("_rest").alias("n_tokens"))
    # full containers are packed like all other items, so no two share one whatever their keys are
    rests = rests.unionByName(whole).withColumn("_salt", F.pmod(F.xxhash64("_key", "part", "n_tokens"), F.lit(salts)))
    per_salt = rests.groupBy("pack_kind", "n_tokens", "_salt").agg(F.count("*").alias("_n"))
    classes = Window.partitionBy("pack_kind", "n_tokens")
    offsets = per_salt.select("pack_kind", "n_tokens", "_salt", (F.sum("_n").over(classes.orderBy("_salt")) - F.col("_n")).alias("_before"))
    histogram: dict[str, dict[int, int]] = {k: {} for k in kinds}
    for row in per_salt.groupBy("pack_kind", "n_tokens").agg(F.sum("_n").alias("n")).collect():  # at most the sum of the capacities
        histogram[row.pack_kind][row.n_tokens] = row.n
    names = sorted(kinds)
    plan = {k: best_fit_rounds(histogram[k], kinds[k])[0] for k in names}
    # one sorted table of slots: a slot's place is (kind and size, first rank)
    wide = max(kinds.values()) + 1
    flat = sorted((names.index(k) * wide + s, rank, first, each) for k in names for s, rank, first, each in plan[k])
    slots = np.array(flat or [(0, 0, 0, 1)], np.int64)
    high = slots[:, 0] << 40

    ranked = rests.select("*", F.row_number().over(Window.partitionBy("pack_kind", "n_tokens", "_salt").orderBy("_key", "part")).alias("_rank"))
    ranked = ranked.join(offsets, ["pack_kind", "n_tokens", "_salt"]).select("pack_kind", "_key", "part", "first_token", "n_tokens", (F.col("_before") + F.col("_rank") - 1).alias("_rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = np.array([names.index(k) for k in batch.column("pack_kind").to_pylist()], np.int64)
            group = number * wide + batch.column("n_tokens").to_numpy()
            rank = batch.column("_rank").to_numpy().astype(np.int64)
            at = np.searchsorted(high + slots[:, 1], (group << 40) + rank, "right") - 1
            container = slots[at, 2] + (rank - slots[at, 1]) // slots[at, 3]
            ids = [f"{names[k]}-{c}" for k, c in zip(number, container)]
            yield pa.RecordBatch.from_pydict({"pack_kind": batch.column("pack_kind"), "container_id": pa.array(ids, pa.string())} | {c: batch.column(c) for c in ("_key", "part", "first_token", "n_tokens")})

    placed = ranked.mapInArrow(place, nothing.schema)
    return placed.unionByName(nothing).withColumnRenamed("_key", key)


def fill(packed: DataFrame, kinds: dict[str, int]) -> DataFrame:
    """``pack_kind, capacity_tokens, n_containers, n_tokens, fill_share`` of what ``pack`` gave."""
    capacity = F.create_map(*[x for k, c in kinds.items() for x in (F.lit(k), F.lit(c).cast("long"))])
    used = packed.where(F.col("container_id").isNotNull()).groupBy("pack_kind", "container_id").agg(F.sum("n_tokens").alias("n_tokens"))
    total = used.groupBy("pack_kind").agg(F.count("*").alias("n_containers"), F.sum("n_tokens").alias("n_tokens"))
    return total.select("pack_kind", capacity[F.col("pack_kind")].alias("capacity_tokens"), "n_containers", "n_tokens", (F.col("n_tokens") / (F.col("n_containers") * capacity[F.col("pack_kind")])).alias("fill_share"))


def faults(packed: DataFrame, sizes: DataFrame, kinds: dict[str, int], key: str = "doc_id", size: str = "n_tokens") -> DataFrame:
    """``pack_kind, n_items, n_overfull, n_misplaced``: containers above capacity, and keys whose tokens are not all placed exactly once."""
    capacity = F.create_map(*[x for k, c in kinds.items() for x in (F.lit(k), F.lit(c).cast("long"))])
    over = packed.where(F.col("container_id").isNotNull()).groupBy("pack_kind", "container_id").agg(F.sum("n_tokens").alias("n"))
    over = over.groupBy("pack_kind").agg(F.count_if(F.col("n") > capacity[F.col("pack_kind")]).alias("_over")).select(F.col("pack_kind").alias("_k"), "_over")
    given = sizes.groupBy(F.col(key).alias("_key")).agg(F.sum(F.coalesce(F.col(size).cast("long"), F.lit(0))).alias("_given"), F.count("*").alias("_rows"))
    put = packed.groupBy("pack_kind", F.col(key).alias("_put")).agg(F.sum("n_tokens").alias("_n"), F.sum(F.when(F.col("part") == 0, 1).otherwise(0)).alias("_firsts"))
    wanted = given.select("*", F.explode(F.array(*[F.lit(k) for k in kinds])).alias("pack_kind"))
    both = wanted.join(put.withColumnRenamed("pack_kind", "_kind"), (F.col("pack_kind") == F.col("_kind")) & F.col("_key").eqNullSafe(F.col("_put")), "full_outer")
    wrong = ~(F.col("_given").eqNullSafe(F.col("_n")) & F.col("_rows").eqNullSafe(F.col("_firsts")))
    counted = both.groupBy(F.coalesce("pack_kind", "_kind").alias("pack_kind")).agg(F.sum("_rows").alias("n_items"), F.count_if(wrong).alias("n_misplaced"))
    return counted.join(over, F.col("pack_kind") == F.col("_k"), "left").select("pack_kind", "n_items", F.coalesce("_over", F.lit(0)).alias("n_overfull"), "n_misplaced")
