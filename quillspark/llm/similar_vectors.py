"""The most similar vectors of every vector, by randomly rotated one-bit codes inside overlapping cells.

Every vector goes to its few nearest cells of a coarse quantizer. In a cell, each vector is kept as one
bit for each rotated coordinate of its residual and two correction scalars. Inner products are estimated
from the bits and the query's four-bit coordinates; with the estimate comes an error bound, and only
vectors whose upper bound reaches the k-th best similarity found so far are reranked exactly.

Equal vectors are one class: a class lies in the cells once however many records it has, and results are
links between classes, with the records of each class in a table of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.staging import staged

PLANES = 4


def _vectors(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the usable vectors, and these as unit vectors."""
    sizes = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(sizes == dim)
    if not len(rows):
        return rows, np.zeros((0, dim))
    values = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    norms = np.sqrt((values * values).sum(1))
    good = np.isfinite(norms) & (norms > 0)
    return rows[good], values[good] / norms[good, None]


def rotation(dim: int, seed: int = 7) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def fit_cells(sample: np.ndarray, cells: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Unit centroids of spherical k-means over a bounded sample."""
    rng = np.random.default_rng(seed)
    centroids = sample[np.sort(rng.choice(len(sample), min(cells, len(sample)), replace=False))].astype(np.float32)
    points = sample.astype(np.float32)
    for _ in range(rounds):
        nearest = np.concatenate([np.argmax(points[i : i + 4096] @ centroids.T, 1) for i in range(0, len(points), 4096)])
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, points)
        norms = np.linalg.norm(sums, axis=1)
        centroids = np.where(norms[:, None] > 0, sums / np.maximum(norms, 1e-9)[:, None], centroids)
    return np.unique(centroids, axis=0)  # equal ones would share out equal vectors by chance


class Codes:
    """One-bit codes of unit vectors relative to ``centre``."""

    def __init__(self, vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray):
        self.dim = vectors.shape[1]
        residual = vectors - centre
        self.radius = np.linalg.norm(residual, axis=1)
        unit = residual / np.maximum(self.radius, 1e-12)[:, None]
        self.turned = unit @ turn
        bits = self.turned > 0
        self.factor = np.maximum(np.abs(self.turned).sum(1) / np.sqrt(self.dim), 1e-6)
        self.slack = np.sqrt(np.maximum(1 - self.factor**2, 0)) / self.factor / np.sqrt(max(self.dim - 1, 1))
        # the bits as signs, with the correction scalars: an estimate is one product in single precision
        self.signs = np.where(bits, 1, -1).astype(np.float32) * (self.radius / self.factor / np.sqrt(self.dim)).astype(np.float32)[:, None]
        self.along = vectors @ centre
        self.centre2 = float(centre @ centre)

    def quantized(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Four-bit coordinates of some vectors as queries, and their step."""
        turned = self.turned[rows]
        low = turned.min(1)
        step = np.maximum((turned.max(1) - low) / (2**PLANES - 1), 1e-12)
        return low[:, None] + step[:, None] * np.rint((turned - low[:, None]) / step[:, None]), step

    def bounds(self, queries: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray]:
        """Estimated similarities of some vectors to all, and how far off they may be."""
        values, step = self.quantized(queries)
        radius = self.radius[queries]
        estimate = (values * radius[:, None]).astype(np.float32) @ self.signs.T
        estimate += (self.along[queries, None] - self.centre2).astype(np.float32)
        estimate += self.along.astype(np.float32)
        mine = np.stack([radius, radius * step * 0.05], 1).astype(np.float32)
        return estimate, mine @ np.stack([self.radius * width * self.slack, self.radius]).astype(np.float32)


def _cell_neighbours(cell: pa.Table, centroids: np.ndarray, turn: np.ndarray, k: int, least: float, width: float, tie: float) -> pa.Table:
    """Near classes of one block of a cell's classes among those of another block of it (or the same)."""
    dim = centroids.shape[1]
    names, roles = cell.column("class").to_pylist(), cell.column("role").to_numpy(zero_copy_only=False)
    places: dict[bytes, int] = {}
    role = np.zeros(len(names), np.int64)
    first = []
    for i, name in enumerate(names):  # tasks before this one merged equal vectors of a batch, not of different batches
        at = places.setdefault(name, len(first))
        if at == len(first):
            first.append(i)
        role[at] |= roles[i]
    role, names = role[: len(first)], pa.array(list(places), pa.binary())
    vectors = np.frombuffer(b"".join(cell.column("vector").take(pa.array(first)).to_pylist()), np.float32).reshape(-1, dim)
    exact = vectors.astype(np.float64)
    exact /= np.linalg.norm(exact, axis=1)[:, None]
    codes = Codes(exact, centroids[cell.column("cell")[0].as_py()].astype(np.float64), turn)
    queries, hidden = np.flatnonzero(role & 1), np.flatnonzero(~role & 2)
    ask, near, sims = [], [], []
    for begin in range(0, len(queries), 256):
        rows = queries[begin : begin + 256]
        at = np.arange(len(rows))
        estimate, off = codes.bounds(rows, width)
        estimate[:, hidden] = off[:, hidden] = -2
        # the best by estimate, reranked: their k-th similarity is what others must reach
        estimate[at, rows] = -9
        most = min(4 * k, estimate.shape[1])
        likely = np.argpartition(estimate, -most, axis=1)[:, -most:]
        reached = np.einsum("id,ijd->ij", exact[rows], exact[likely])
        reached[np.take_along_axis(estimate, likely, 1) <= -2] = -9
        kth = -np.partition(-reached, min(k, most) - 1, axis=1)[:, min(k, most) - 1]
        upper = estimate + off
        upper[at, rows] = -9
        floor = np.maximum(np.minimum(kth, 1) - 2 * tie, least)[:, None]
        open_ = upper >= floor.astype(np.float32) - np.float32(1e-6)
        if np.count_nonzero(open_) > open_.size // 200:  # so many that one product is cheaper than taking them out
            all_ = exact[rows] @ exact.T
            q, c = np.nonzero(open_ & (all_ >= floor))
            s = all_[q, c]
        else:
            q, c = np.nonzero(open_)
            s = np.einsum("ij,ij->i", exact[rows[q]], exact[c]) if len(q) else np.zeros(0)
        keep = s >= least
        q, c, s = q[keep], c[keep], s[keep]
        order = np.lexsort((-s, q))
        q, c, s = q[order], c[order], s[order]
        place = q * 4.0 - s  # queries apart, each from its most similar
        better = np.searchsorted(place, place - tie, "left") - np.searchsorted(q, q, "left")
        keep = better < k
        ask.append(rows[q[keep]]), near.append(c[keep]), sims.append(s[keep])
    join = lambda x, kind: np.concatenate(x).astype(kind) if x else np.zeros(0, kind)
    return pa.table({"class": names.take(pa.array(join(ask, np.int64))), "neighbour": names.take(pa.array(join(near, np.int64))), "similarity": pa.array(join(sims, np.float64))})


def _usable(df: DataFrame, key: str, embedding: str, dim: int) -> DataFrame:
    return df.where(F.col(key).isNotNull() & (F.size(embedding) == dim)).select(F.col(key).cast("string").alias("id"), F.col(embedding).cast("array<float>").alias("embedding"))


def members(df: DataFrame, key: str = "id", embedding: str = "embedding", dim: int = 128) -> DataFrame:
    """``id, class``: each record with the digest of its vector; records of equal vectors are one class.

    Vectors that are null, of another length, all zero or not finite have no class; null ids are left out.
    Repeated rows are one record; an id with several vectors is in a class for each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, raw = _raw(batch.column("embedding"), dim)
            yield pa.RecordBatch.from_pydict({"id": batch.column("id").take(pa.array(at)), "class": pa.array([digest_of(r) for r in raw], pa.binary())})

    return _usable(df, key, embedding, dim).mapInArrow(run, "id string, class binary").distinct()


def _raw(column: pa.Array, dim: int) -> tuple[np.ndarray, list[bytes]]:
    """Row numbers and bytes of the usable vectors as they are."""
    at, _ = _vectors(column, dim)
    flat = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float32) + np.float32(0)  # no minus zero
    return at, [r.tobytes() for r in flat.reshape(-1, dim)]


def nearest(
    df: DataFrame, key: str = "id", embedding: str = "embedding", dim: int = 128, k: int = 5, least: float = -1.0, cells: int | None = None, overlap: int | None = 3,
    coarser: int = 1, block: int = 16_384, width: float = 2.5, tie: float = 1e-6, broadcast_rows: int = 500_000,
) -> DataFrame:
    """``class, neighbour, similarity, n_records``: for every class of records the classes that fewer than ``k`` other records beat.

    ``class`` and ``neighbour`` are those of ``members``, ``n_records`` how many records the neighbour has;
    a class of several records has itself as a neighbour, with one record less. Similarities are cosines,
    those under ``least`` are left out, and one other is more similar only if it is so by more than
    ``tie``; ties therefore all come out.

    Only a sample of 40 rows a cell fits the coarse quantizer, which has as many centroids as the root of
    the row count (or ``cells``; ``coarser`` times fewer if asked for), so a cell's rows grow with the
    root too. Every vector is indexed in its ``overlap`` nearest cells; without an ``overlap`` it is 3 up
    to 15 cells and grows with more, as neighbours of little similarity would share ever fewer cells. A
    task merges equal vectors before they move. A cell that the sample shows to be larger than ``block``
    is cut into blocks; a task has one block's classes as queries against one block's classes. The sizes
    of classes of several records are broadcast if there are at most ``broadcast_rows`` (of 24 bytes).
    """
    spark = df.sparkSession
    source = _usable(df, key, embedding, dim)
    rows = df.where(F.col(key).isNotNull()).select(key).count()
    cells = cells or max(1, round(rows**0.5 / coarser))
    sample = max(1000, 40 * cells)
    every = max(1, rows // sample)
    picked = source.where(F.pmod(F.xxhash64("id"), F.lit(every)) == 0).select("embedding").limit(2 * sample).toArrow()
    _, points = _vectors(picked.column("embedding").combine_chunks() if picked.num_rows else pa.array([], pa.list_(pa.float32())), dim)
    if not len(points):
        return spark.createDataFrame([], "class binary, neighbour binary, similarity double, n_records bigint")
    centroids = fit_cells(np.unique(points, axis=0), cells)
    overlap = min(overlap or max(3, round(3 * (len(centroids) / 15) ** 0.35)), len(centroids))

    def closest(vectors: np.ndarray) -> np.ndarray:
        small = vectors.astype(np.float32)
        return np.concatenate([np.argpartition(-(small[i : i + 2048] @ centroids.T), overlap - 1, axis=1)[:, :overlap] for i in range(0, len(small), 2048)] or [np.zeros((0, overlap), np.int64)])

    sizes = np.bincount(closest(points).reshape(-1), minlength=len(centroids)) * (rows / len(points))
    blocks = np.maximum(1, np.ceil(sizes / block)).astype(np.int64)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, raw = _raw(batch.column("embedding"), dim)
            raw = list(dict.fromkeys(raw))
            if not raw:
                continue
            names = [digest_of(r) for r in raw]
            vectors = np.frombuffer(b"".join(raw), np.float32).reshape(-1, dim).astype(np.float64)
            cell = closest(vectors / np.sqrt((vectors * vectors).sum(1))[:, None]).reshape(-1)
            row = np.repeat(np.arange(len(raw)), overlap)
            home = np.array([int.from_bytes(n[:7], "big") for n in names], np.int64)[row] % blocks[cell]
            # as a query (role 1) a vector meets every block, as one to be found (role 2) every block's queries
            times = 2 * blocks[cell] - 1
            row, cell, home, n = (np.repeat(x, times) for x in (row, cell, home, blocks[cell]))
            step = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            other = np.where(step < n, step, step - n)
            other = np.where(step < n, other, np.where(other >= home, other + 1, other))  # all blocks, then all but its own
            asks = step < n
            yield pa.RecordBatch.from_pydict({
                "cell": pa.array(cell, pa.int32()), "query_block": pa.array(np.where(asks, home, other), pa.int32()), "block": pa.array(np.where(asks, other, home), pa.int32()),
                "role": pa.array(np.where(asks, np.where(other == home, 3, 1), 2), pa.int8()),
                "class": pa.array(names, pa.binary()).take(pa.array(row)), "vector": pa.array(raw, pa.binary()).take(pa.array(row)),
            })

    turn = rotation(dim)
    in_cells = source.mapInArrow(spread, "cell int, query_block int, block int, role byte, class binary, vector binary")
    found = in_cells.groupBy("cell", "query_block", "block").applyInArrow(lambda t: _cell_neighbours(t, centroids, turn, k, least, width, tie), "class binary, neighbour binary, similarity double")
    several = staged(members(df, key, embedding, dim).groupBy("class").agg(F.count("*").alias("_n")).where("_n > 1"), "classes")
    few = several.count() <= broadcast_rows  # from the files' footers

    def sizes(of: str, n: str) -> DataFrame:
        rows = several.select(F.col("class").alias(of), F.col("_n").alias(n))
        return F.broadcast(rows) if few else rows

    # one shuffle by class serves the best similarity of each pair and the ranks
    best = found.repartition("class").groupBy("class", "neighbour").agg(F.max("similarity").alias("similarity"))
    sized = best.join(sizes("_a", "_na"), F.col("class") == F.col("_a"), "left").join(sizes("_b", "_nb"), F.col("neighbour") == F.col("_b"), "left")
    sized = sized.select("class", "neighbour", "similarity", F.coalesce("_nb", F.lit(1)).alias("n_records"), (F.coalesce("_na", F.lit(1)) - 1).alias("_own"))
    nearer = F.sum("n_records").over(Window.partitionBy("class").orderBy(F.col("similarity") * (-1.0 / tie)).rangeBetween(Window.unboundedPreceding, -1))
    better = F.coalesce(nearer, F.lit(0)) + F.when(F.col("similarity") < 1 - tie, F.col("_own")).otherwise(0)
    others = sized.withColumn("_better", better).where(F.col("_better") < k).drop("_better", "_own")
    own = several.where(F.lit(least <= 1)).select("class", F.col("class").alias("neighbour"), F.lit(1.0).alias("similarity"), (F.col("_n") - 1).alias("n_records"))
    return others.unionByName(own)


def digest_of(vector: bytes) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(vector)


def similar_pairs(links: DataFrame, records: DataFrame, least: float) -> DataFrame:
    """``id_a, id_b``: pairs of records, at least ``least`` similar, of which one is among the other's nearest.

    Written out from ``links`` between classes (of ``nearest``) and their ``records`` (of ``members``).
    """
    a, b = records.select(F.col("class").alias("_a"), F.col("id").alias("_ia")), records.select(F.col("class").alias("_b"), F.col("id").alias("_ib"))
    near = links.where(F.col("similarity") >= least)
    pairs = near.join(a, F.col("class") == F.col("_a")).join(b, F.col("neighbour") == F.col("_b")).where("_ia <> _ib")
    return pairs.select(F.least("_ia", "_ib").alias("id_a"), F.greatest("_ia", "_ib").alias("id_b")).distinct()


def named_links(links: DataFrame, records: DataFrame) -> DataFrame:
    """``id, neighbour, similarity, n_records`` between the classes' first records, which stand for all of them."""
    first = records.groupBy("class").agg(F.min("id").alias("_id"))
    a, b = first.select(F.col("class").alias("_a"), F.col("_id").alias("_ia")), first.select(F.col("class").alias("_b"), F.col("_id").alias("_ib"))
    named = links.join(a, F.col("class") == F.col("_a")).join(b, F.col("neighbour") == F.col("_b"))
    return named.select(F.col("_ia").alias("id"), F.col("_ib").alias("neighbour"), "similarity", "n_records")


def class_links(links: DataFrame, records: DataFrame) -> DataFrame:
    """``class_id, n_members, n_links``: a row for each class of equal vectors, named by its first record.

    ``n_links`` counts the links from all its records to the records among their nearest.
    """
    counted = links.groupBy(F.col("class").alias("_of")).agg(F.sum("n_records").alias("_n"))
    sized = records.groupBy("class").agg(F.min("id").alias("class_id"), F.count("*").alias("n_members"))
    joined = sized.join(counted, F.col("class") == F.col("_of"), "left")
    return joined.select("class_id", "n_members", (F.col("n_members") * F.coalesce("_n", F.lit(0))).alias("n_links"))


def class_members(records: DataFrame) -> DataFrame:
    """``id, class_id``: the class of every record."""
    first = records.groupBy(F.col("class").alias("_of")).agg(F.min("id").alias("class_id"))
    return records.join(first, F.col("class") == F.col("_of")).select("id", "class_id")
