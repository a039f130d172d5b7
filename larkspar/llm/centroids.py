"""Clusters of vectors around centroids, found with a vantage-point tree in exact integers.

Vectors become integers, floor(scale * x). The first centroids are the vectors with the least
hashes of their ids. Each round builds a vantage-point tree over the centroids on the driver (it has
k times d numbers, whatever the size of the table), broadcasts it, and lets each task search it for its vectors:
nodes are opened in ascending order of their lower bounds, for as long as the bound is not above
the distance of the best centroid so far. The pruning radius is inclusive, so a centroid
at the same distance is always met and the smaller number wins. Bounds are floating point with a
margin; distances of centroids, in inner nodes and leaves, are exact integers. Each task adds
up its vectors by centroid, Spark sums these partial sums as decimals, and k times d sums come
back for the next centroids, floor(sum / count). Centroids without vectors stay.

The table is read once per round; the last assignment is stored, and totals are taken from there.

Rows: vectors that are null, have another length or hold null, NaN or infinite components take no part.
Repeated rows, and different vectors of one id, are vectors of their own; equal hashes are ordered by
components, and rows without id, which have no hash, follow all others. With fewer vectors than k
there are fewer centroids. An empty table gives an empty result. A floor beyond 2**62 on either side is held there,
and sums of squares that a long cannot hold are returned as the greatest long. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larkspar.session import new_folder

#: Centroids of a leaf; vectors searched at once.
LEAF = 4
BLOCK_ROWS = 4096
_MOST = 2**63 - 1
_WIDE = Decimal(_MOST)


def whole_numbers(values: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x) of finite doubles as 64-bit integers."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * values), -(2.0**62), 2.0**62).astype(np.int64)


class VantageTree:
    """A vantage-point tree over the rows of ``points``; nodes are numbered from the root."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points = points
        #: Per node the points it compares: the vantage point of an inner node, all points of a leaf.
        self.held: list[np.ndarray] = []
        #: Per node its children as (node, least and greatest distance from the vantage point).
        self.children: list[list[tuple[int, float, float]]] = []
        self._largest = int(np.abs(points.astype(object)).max(initial=0))
        self._grow(np.arange(len(points)), leaf)

    def _grow(self, rows: np.ndarray, leaf: int) -> int:
        node = len(self.held)
        self.held.append(rows)
        self.children.append([])
        if len(rows) <= leaf:
            return node
        between = np.sqrt(self.squares(self.exact(self.points[rows]), rows).astype(float))
        vantage = int(between.std(axis=1).argmax())
        away = np.delete(between[vantage], vantage)
        others = np.delete(rows, vantage)
        self.held[node] = rows[vantage : vantage + 1]
        order = np.argsort(away, kind="stable")
        for part in np.array_split(order, 2):
            child = self._grow(others[part], leaf)
            self.children[node].append((child, float(away[part].min()), float(away[part].max())))
        return node

    def squares(self, vectors: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Exact squared distances of vectors and the points ``rows``: doubles that hold integers, or Python integers."""
        x, c = vectors, self.points[rows].astype(vectors.dtype)
        if x.dtype == object:
            return np.array([((x - row) ** 2).sum(axis=1) for row in c], dtype=object).T.reshape(len(x), len(c))
        return (x**2).sum(axis=1)[:, None] + (c**2).sum(axis=1) - 2 * (x @ c.T)

    def exact(self, vectors: np.ndarray) -> np.ndarray:
        """The vectors as doubles where all sums of squares stay below 2**53, else as Python integers."""
        largest = max(self._largest, int(np.abs(vectors.astype(float)).max(initial=0)))
        return vectors.astype(float if vectors.shape[1] * 4 * largest**2 < 2**53 else object)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest point of each vector; ties go to the smaller number."""
        vectors = self.exact(vectors)
        bounds = np.full((len(vectors), len(self.held)), np.inf)
        bounds[:, 0] = 0
        label = np.full(len(vectors), len(self.points))
        best = np.full(len(vectors), np.inf, dtype=vectors.dtype)
        radius = np.full(len(vectors), np.inf)
        active = np.arange(len(vectors))
        while True:
            node = bounds[active].argmin(axis=1)
            low = bounds[active, node]
            going = np.isfinite(low) & (low <= radius[active])
            active, node, low = active[going], node[going], low[going]
            if not len(active):
                return label, best
            order = np.argsort(node, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(node[order])) + 1):
                self._open(int(node[part[0]]), vectors, active[part], low[part], bounds, label, best, radius)

    def _open(self, node: int, vectors, rows, low, bounds, label, best, radius) -> None:
        """Compare the points of a node with its vectors and set the bounds of its children."""
        squares = self.squares(vectors[rows], self.held[node])
        bounds[rows, node] = np.inf
        for number, away in zip(self.held[node].tolist(), squares.T):
            closer = (away < best[rows]) | ((away == best[rows]) & (number < label[rows]))
            best[rows[closer]] = away[closer]
            label[rows[closer]] = number
        radius[rows] = np.sqrt(best[rows].astype(float)) * (1 + 1e-9) + 1e-9
        if self.children[node]:
            away = np.sqrt(squares[:, 0].astype(float))
            for child, least, most in self.children[node]:
                bound = np.maximum(least - away, away - most) - 1e-9 * (1 + away + most)
                bounds[rows, child] = np.maximum(low, bound)


def _blocks(batches: Iterator[pa.RecordBatch], dims: int, scale: float) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            piece = batch.slice(start, BLOCK_ROWS)
            values = piece.column("vector").flatten().to_numpy(zero_copy_only=False)
            yield piece, whole_numbers(values, scale).reshape(-1, dims)


def _partial_sums(tree: Broadcast, dims: int, scale: float):
    """One row per centroid of a task: its number, vectors and the sums of their components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = tree.value
        counts = np.zeros(len(found.points), dtype=np.int64)
        sums = np.zeros((len(found.points), dims), dtype=object)
        for _, vectors in _blocks(batches, dims, scale):
            label, _ = found.nearest(vectors)
            exact = vectors if np.abs(vectors.astype(float)).max() < 2**50 else vectors.astype(object)
            order = np.argsort(label, kind="stable")
            cuts = np.flatnonzero(np.diff(label[order], prepend=-1))
            sums[label[order][cuts]] += np.add.reduceat(exact[order], cuts, axis=0).astype(object)
            counts += np.bincount(label, minlength=len(counts))
        seen = np.flatnonzero(counts)
        if len(seen):
            totals = [[Decimal(int(x)) for x in row] for row in sums[seen]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(seen, pa.int32()), pa.array(counts[seen]), pa.array(totals, pa.list_(pa.decimal128(38, 0)))],
                ["cluster", "n", "sums"],
            )

    return run


def _assigned(tree: Broadcast, dims: int, scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, vectors in _blocks(batches, dims, scale):
            label, best = tree.value.nearest(vectors)
            distance = pa.array([min(int(x), _MOST) for x in best], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [piece.column("id"), pa.array(label, pa.int32()), distance], ["id", "cluster", "distance"]
            )

    return run


def _next_points(spark: SparkSession, rows: DataFrame, points: np.ndarray, scale: float) -> np.ndarray:
    dims = points.shape[1]
    tree = spark.sparkContext.broadcast(VantageTree(points))
    partial = rows.select("vector").mapInArrow(
        _partial_sums(tree, dims, scale), "cluster int, n long, sums array<decimal(38,0)>"
    )
    sums = partial.select("cluster", "n", F.posexplode("sums").alias("at", "value")).groupBy("cluster", "at").agg(
        F.sum("n").alias("n"), F.sum("value").alias("value")
    )
    moved = points.copy()
    for cluster, at, n, value in sums.collect():  # k times d rows
        moved[cluster, at] = int(value) // n
    tree.unpersist()
    return moved


def cluster_vectors(
    vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: float = 256.0, salt: str = "2:",
    key: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """Per vector its key, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia`` and ``centroid_sha256``."""
    spark = vectors.sparkSession
    numbers = F.transform(vectors[vector], lambda x: x.cast("double"))
    rows = vectors.select(vectors[key].alias("id"), numbers.alias("vector"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = rows.where((F.size("vector") == dims) & F.forall("vector", finite))
    named = F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256)
    first = [r[0] for r in rows.orderBy(named.asc_nulls_last(), "vector").select("vector").limit(k).collect()]
    points = whole_numbers(np.array(first, dtype=float).reshape(len(first), dims), scale)
    for _ in range(rounds if len(points) else 0):
        points = _next_points(spark, rows, points, scale)
    tree = spark.sparkContext.broadcast(VantageTree(points))
    folder = new_folder(spark, "clusters")
    kind = rows.schema["id"].dataType.simpleString()
    rows.mapInArrow(_assigned(tree, dims, scale), f"id {kind}, cluster int, distance long").write.parquet(folder)
    tree.unpersist()
    stored = spark.read.parquet(folder)
    names = [(i, hashlib.sha256(",".join(map(str, p)).encode()).hexdigest()) for i, p in enumerate(points.tolist())]
    held = lambda total: F.least(total, F.lit(_WIDE)).cast("long")
    sums = stored.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum"))
    whole = F.sum("sum").over(Window.partitionBy(F.lit(1)))  # k rows
    facts = sums.join(spark.createDataFrame(names, "cluster int, centroid_sha256 string"), "cluster").select(
        "cluster", held(F.col("sum")).alias("cluster_inertia"), held(whole).alias("inertia"), "centroid_sha256"
    )
    return stored.join(F.broadcast(facts), "cluster").select(
        F.col("id").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
