"""Clustering around centroids with ball-tree filtering (operator 11).

Vectors become whole numbers. Each task groups what it reads into blocks and
builds a metric tree over each: a node is a ball with its centre, radius, count
and integer sum, and its vectors stand side by side. In a round a tree is walked
from its root with the centroids that can still be nearest; by the triangle
inequality a centroid goes when it is farther from the centre than the nearest
one by more than twice the radius. A ball with one centroid left counts as a
whole, by its count and sum; leaves are decided by exact distances. Sums per
centroid and dimension are all that is shuffled, and k x d of them come to the
driver, which makes the next centroids by exact division.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.storage import Batches, bound_batches, lean, stored
from tallyforge.llm.vectors import finite_rows, whole_numbers

#: vectors of a tree, and of a leaf
BLOCK, LEAF = 4096, 32
LONGEST = (1 << 63) - 1
#: share by which a computed distance may be wrong
SLACK = 1e-9
TREE = "ids binary, known binary, points binary, first binary, last binary, radius binary, left binary, right binary"


@dataclass
class Tree:
    """Nodes as arrays, parents before children; node ``k`` holds points ``first[k]`` to ``last[k]``, leaves have ``left`` -1."""

    ids: np.ndarray
    known: np.ndarray
    points: np.ndarray
    first: np.ndarray
    last: np.ndarray
    radius: np.ndarray
    left: np.ndarray
    right: np.ndarray

    KINDS = ("<i8", "?", "<i8", "<i4", "<i4", "<f8", "<i4", "<i4")

    @classmethod
    def built(cls, ids: np.ndarray, known: np.ndarray, points: np.ndarray, leaf: int = LEAF) -> Tree:
        """A node is parted by the nearer of two points far from each other; one of radius 0 (copies) is a leaf."""
        p = points.astype(np.float64)
        order, nodes = np.arange(len(p)), []

        def node(first: int, last: int) -> tuple[int, int]:
            own = p[order[first:last]]
            far = np.sqrt(((own - own.mean(axis=0)) ** 2).sum(axis=1))
            nodes.append([first, last, float(far.max()) * (1 + SLACK), -1, -1])
            return len(nodes) - 1, int(far.argmax())

        root, far = node(0, len(p))
        waiting = [(root, far)]
        while waiting:
            k, far = waiting.pop()
            first, last, radius = nodes[k][:3]
            if last - first <= leaf or not radius:
                continue
            own = p[order[first:last]]
            a = ((own - own[far]) ** 2).sum(axis=1)
            b = ((own - own[a.argmax()]) ** 2).sum(axis=1)
            nearer = a <= b
            if nearer.all() or not nearer.any():
                continue
            order[first:last] = np.concatenate([order[first:last][nearer], order[first:last][~nearer]])
            middle = first + int(nearer.sum())
            for side, (x, y) in ((3, (first, middle)), (4, (middle, last))):
                waiting.append(node(x, y))
                nodes[k][side] = waiting[-1][0]
        columns = zip(*nodes, strict=True)
        return cls(ids[order], known[order], points[order], *(np.array(c, t) for c, t in zip(columns, cls.KINDS[3:], strict=True)))

    def row(self) -> dict[str, bytes]:
        return {n.split()[0]: np.ascontiguousarray(getattr(self, n.split()[0]), t).tobytes() for n, t in zip(TREE.split(", "), self.KINDS, strict=True)}

    @classmethod
    def read(cls, row: dict[str, bytes], size: int) -> Tree:
        parts = [np.frombuffer(row[n.split()[0]], t) for n, t in zip(TREE.split(", "), cls.KINDS, strict=True)]
        parts[2] = parts[2].reshape(-1, size)
        return cls(*parts)


class Filter:
    """Assigns the vectors of trees to centroids; equal distances go to the smaller number."""

    def __init__(self, centroids: list[list[int]]):
        self.exact = centroids
        self.whole = np.array(centroids, object)
        self.most = int(np.abs(self.whole).max(initial=0))
        self.near = np.array(centroids, np.float64)
        self.near_squares = (self.near**2).sum(axis=1)

    def distances(self, points: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Exact squared distances of points to the centroids ``at``: 64-bit integers, or Python's where those may not do."""
        most = max(int(np.abs(points).max(initial=0)), self.most)
        if 4 * points.shape[1] * most**2 < 1 << 53:  # every term and sum is exact in doubles
            p, c = points.astype(np.float64), self.near[at]
            return ((p * p).sum(axis=1)[:, None] - 2 * (p @ c.T) + self.near_squares[at][None, :]).astype(np.int64)
        p = points.astype(object)
        return np.stack([((p - self.whole[c]) ** 2).sum(axis=1) for c in at], axis=1)

    def parts(self, tree: Tree) -> Iterator[tuple[int, int, int | np.ndarray]]:
        """(first, last, cluster of all of them), or of each, for runs of the tree's points."""
        if not len(tree.points):
            return
        points = tree.points.astype(np.float64)
        sums = np.concatenate([np.zeros((1, points.shape[1])), np.cumsum(points, axis=0)])
        centres = (sums[tree.last] - sums[tree.first]) / (tree.last - tree.first)[:, None]
        # centres come from running sums here, so a centre is a little off; the radius takes that up
        scale = max(float(np.abs(sums).max(initial=0)), float(np.abs(self.near).max(initial=0)), 1.0)
        off = scale * np.sqrt(points.shape[1]) * 1e-14
        far = np.stack([np.sqrt(((centres - c) ** 2).sum(axis=1)) for c in self.near], axis=1)
        waiting = [(0, np.arange(len(self.exact)))]
        while waiting:
            k, at = waiting.pop()
            d = far[k, at]
            bound = (d.min() + 2 * (tree.radius[k] + off)) * (1 + SLACK)
            at = at[d <= bound]
            first, last = int(tree.first[k]), int(tree.last[k])
            if len(at) == 1:
                yield first, last, int(at[0])
            elif tree.left[k] < 0:
                yield first, last, at[self.distances(tree.points[first:last], at).argmin(axis=1)]
            else:
                waiting += [(int(tree.left[k]), at), (int(tree.right[k]), at)]


def _trees(size: int, scale: float, block: int, leaf: int):
    def run(batches: Batches) -> Batches:
        waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        have = 0

        def built() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([Tree.built(*(np.concatenate(c) for c in zip(*waiting, strict=True)), leaf).row()])

        for batch in batches:
            rows, c = finite_rows(batch[1], size)
            found = batch[0].take(pa.array(rows))
            ids, known = found.fill_null(0).to_numpy(zero_copy_only=False), found.is_valid().to_numpy(zero_copy_only=False)
            points = whole_numbers(scale * c)
            for a in range(0, len(rows), block):
                waiting.append((ids[a : a + block], known[a : a + block], points[a : a + block]))
                have += len(waiting[-1][0])
                if have >= block:
                    yield built()
                    waiting, have = [], 0
        if have:
            yield built()

    return lean(run)


def trees(vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", size: int = 64, scale: float = 256.0, block: int = BLOCK, leaf: int = LEAF) -> DataFrame:
    """The stored trees over all vectors of ``size`` finite entries; a tree is built within a task, nothing is shuffled."""
    bound_batches(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).cast("long"), F.col(vec_col).cast("array<double>"))
    return stored(rows.mapInArrow(_trees(size, scale, block, leaf), TREE), "ball-trees", **{"parquet.block.size": 8 << 20})


def _each_tree(batches: Batches, size: int) -> Iterator[Tree]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield Tree.read({n: batch[n][k].as_py() for n in batch.schema.names}, size)


def _sums(centroids: list[list[int]], size: int):
    def run(batches: Batches) -> Batches:
        nearest = Filter(centroids)
        counts, sums = [0] * len(centroids), np.zeros((len(centroids), size), object)
        for tree in _each_tree(batches, size):
            small = int(np.abs(tree.points).max(initial=0)) < 1 << 50 and len(tree.points) < 1 << 12 | 1
            points = tree.points if small else tree.points.astype(object)
            running = np.concatenate([np.zeros((1, size), points.dtype), np.cumsum(points, axis=0)])
            for first, last, cluster in nearest.parts(tree):
                if isinstance(cluster, int):
                    counts[cluster] += last - first
                    sums[cluster] += (running[last] - running[first]).astype(object)
                    continue
                for c in np.unique(cluster).tolist():
                    own = points[first:last][cluster == c]
                    counts[c] += len(own)
                    sums[c] += own.sum(axis=0).astype(object)
        rows = [(c, i, Decimal(int(v))) for c, n in enumerate(counts) if n for i, v in enumerate([n, *sums[c].tolist()], -1)]
        columns = list(zip(*rows, strict=True)) or [()] * 3
        kinds = pa.int32(), pa.int32(), pa.decimal128(38, 0)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["cluster", "i", "total"])

    return lean(run)


def moved(stored_trees: DataFrame, centroids: list[list[int]], size: int) -> list[list[int]]:
    """Centroids after one round: floors of the exact means of their vectors; one without vectors stays."""
    sums = stored_trees.mapInArrow(_sums(centroids, size), "cluster int, i int, total decimal(38,0)")
    total = {(r["cluster"], r["i"]): int(r["total"]) for r in sums.groupBy("cluster", "i").agg(F.sum("total").cast("decimal(38,0)").alias("total")).collect()}
    return [[total[c, i] // total[c, -1] for i in range(size)] if (c, -1) in total else old for c, old in enumerate(centroids)]


def _assigned(centroids: list[list[int]], size: int):
    def run(batches: Batches) -> Batches:
        nearest = Filter(centroids)
        for tree in _each_tree(batches, size):
            clusters, far = np.zeros(len(tree.points), np.int32), np.zeros(len(tree.points), object)
            for first, last, cluster in nearest.parts(tree):
                clusters[first:last] = cluster
            for c in np.unique(clusters).tolist():
                own = clusters == c
                far[own] = nearest.distances(tree.points[own], np.array([c]))[:, 0].tolist()
            ids = pa.array(tree.ids, mask=~tree.known)
            distance = pa.array([d if d <= LONGEST else None for d in far.tolist()], pa.int64())
            yield pa.RecordBatch.from_arrays([ids, pa.array(clusters), distance], names=["vec_id", "cluster", "distance"])

    return lean(run)


def first_centroids(vectors: DataFrame, *, id_col: str, vec_col: str, size: int, scale: float, k: int, seed: int) -> list[list[int]]:
    """The usable vectors with the ``k`` smallest sha256 of ``seed:id`` (null ids last, equal ids by vector), as whole numbers."""
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where((F.size("v") == size) & whole)
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    found = rows.orderBy(hashed.asc_nulls_last(), "v").limit(k).collect()
    return whole_numbers(scale * np.array([r["v"] for r in found], np.float64).reshape(-1, size)).tolist()


def cluster(vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", size: int = 64, scale: float = 256.0, k: int = 40, rounds: int = 5, seed: int = 2, block: int = BLOCK, leaf: int = LEAF) -> DataFrame:
    """A row per usable vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Usable are vectors of exactly ``size`` entries, none null or not finite;
    others have no row. Entries become floor(scale * x), held within +-2^62.
    Repeated rows count and are returned each time; with fewer than ``k`` usable
    vectors there are as many centroids, and an empty table gives no rows. Ids
    may be null. A distance or sum of distances beyond 64 bits is null. Other
    columns are not read.
    """
    options = {"id_col": id_col, "vec_col": vec_col, "size": size, "scale": scale}
    centroids = first_centroids(vectors, **options, k=k, seed=seed)
    if not centroids:
        return vectors.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    own = trees(vectors, **options, block=block, leaf=leaf)
    for _ in range(rounds):
        centroids = moved(own, centroids, size)
    found = stored(own.mapInArrow(_assigned(centroids, size), "vec_id long, cluster int, distance long"), "ball-assigned")
    total = {r["cluster"]: r["total"] for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total"), F.count_if(F.col("distance").isNull()).alias("lost")).where("lost = 0").collect()}
    within = [_long(total.get(c)) for c in range(len(centroids))]
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    occupied = {r["cluster"] for r in found.select("cluster").distinct().collect()}
    whole = _long(sum(total.values())) if occupied <= set(total) else None
    lookup = lambda values, kind: F.element_at(F.array(*(F.lit(v).cast(kind) for v in values)), F.col("cluster") + 1)
    return found.select("vec_id", "cluster", "distance", lookup(within, "long").alias("cluster_inertia"), F.lit(whole).cast("long").alias("inertia"), lookup(hashes, "string").alias("centroid_sha256"))


def _long(value: Decimal | int | None) -> int | None:
    return None if value is None or value > LONGEST else int(value)
