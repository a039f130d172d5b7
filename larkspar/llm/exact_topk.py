"""Exact top-k search by inner product with ball trees, one per shard of vectors.

Vectors become integers, floor(scale * x). Queries are stored in the shared folder with a
lower bound of their k-th score, from a bounded sample of vectors; the bound only saves
work. Each task builds a ball tree over its shard and takes the queries block by block:
going down the tree, a node is dropped for a query when the upper bound of its inner
products, q.c + |q| r, is below the query's current k-th score; the leaves left are visited
in descending order of their bounds, and each visit raises the k-th score that all later
visits share. Scores within 2**53 are exact; larger ones are computed as Python integers.

Rows: vectors that are null or hold null, NaN or infinite components, and rows without id,
take no part. Only vectors of equal length are compared. A row never finds its own id. Repeated
rows count once; different vectors under one id are candidates and queries of their own. Ties
go to the smaller id. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Vectors of one tree, vectors of a leaf, queries handled at once, vectors sampled for the first bounds.
SHARD_ROWS = 65_536
LEAF_ROWS = 128
QUERY_ROWS = 2048
SAMPLE_ROWS = 2048


def integers(column: pa.Array, scale: float) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Rows that take part, by vector length: row numbers and integer components as doubles."""
    column = column.cast(pa.list_(column.type.value_type))
    lengths = np.diff(column.offsets.to_numpy())
    valid = np.asarray(column.is_valid())
    values = column.values.cast(pa.float64())
    holes = np.asarray(values.is_null())
    values = np.floor(scale * values.fill_null(np.nan).to_numpy(zero_copy_only=False))
    bad = np.concatenate([[0], np.cumsum(holes | ~np.isfinite(values))])
    offsets = column.offsets.to_numpy()
    valid &= bad[offsets[1:]] == bad[offsets[:-1]]
    found = {}
    for d in np.unique(lengths[valid]):
        rows = np.flatnonzero(valid & (lengths == d))
        found[int(d)] = rows, values[offsets[rows][:, None] + np.arange(d)].reshape(len(rows), d)
    return found


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    most = (np.abs(a).max(initial=0) * np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2.0**53:
        return a @ b.T
    whole = lambda x: np.array([[int(v) for v in row] for row in x], dtype=object).reshape(x.shape)
    return whole(a) @ whole(b).T


class BallTree:
    """Balls over rows of ``vectors``, level by level; children of node i of a level are 2i and 2i + 1 of the next."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf_rows: int = LEAF_ROWS):
        order = np.arange(len(vectors))
        parts = [order]
        self.levels = []
        while True:
            self.levels.append(self._balls(vectors, parts))
            if max(map(len, parts)) <= leaf_rows or vectors.shape[1] == 0:
                break
            parts = [half for part in parts for half in self._halves(vectors, part)]
        self.leaves = [(ids[p], vectors[p]) for p in parts]

    @staticmethod
    def _balls(vectors: np.ndarray, parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        centres = np.array([vectors[p].mean(axis=0) for p in parts])
        radii = np.array([np.sqrt(((vectors[p] - c) ** 2).sum(axis=1).max()) for p, c in zip(parts, centres)])
        return centres, radii

    @staticmethod
    def _halves(vectors: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(part) < 2:  # a leaf already; its second child is the same row and finds nothing new
            return part, part
        rows = vectors[part]
        axis = int((rows.max(axis=0) - rows.min(axis=0)).argmax())
        order = np.argpartition(rows[:, axis], len(part) // 2)
        return part[order[: len(part) // 2]], part[order[len(part) // 2 :]]

    def bounds(self, queries: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Upper bounds of all leaves per query; minus infinity below nodes that cannot reach ``least``."""
        norms = np.sqrt((queries**2).sum(axis=1))[:, None]
        alive = None
        for centres, radii in self.levels:
            reach = np.sqrt((centres**2).sum(axis=1)) + radii
            bound = queries @ centres.T + norms * radii + 1e-9 * norms * reach + 1e-6
            if alive is not None:
                bound[~np.repeat(alive, 2, axis=1)] = -np.inf
            alive = bound >= least[:, None]
            bound[~alive] = -np.inf
        return bound


class Best:
    """The k best (score, id) of each query so far."""

    def __init__(self, queries: int, k: int, least: np.ndarray):
        self.k = k
        self.least = least.astype(float).copy()
        self.found: list[list[tuple]] = [[] for _ in range(queries)]

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, own: np.ndarray) -> None:
        good = (scores >= self.least[rows][:, None]) & (ids[None, :] != own[rows][:, None])
        for i in np.flatnonzero(good.any(axis=1)):
            at = np.flatnonzero(good[i])
            if len(at) > self.k:
                at = at[np.lexsort((ids[at], -scores[i, at]))[: self.k]]
            row = rows[i]
            kept = sorted(self.found[row] + [(-int(scores[i, j]), int(ids[j])) for j in at])[: self.k]
            self.found[row] = kept
            if len(kept) == self.k:
                self.least[row] = max(self.least[row], -kept[-1][0])


def search(tree: BallTree, queries: np.ndarray, own: np.ndarray, best: Best) -> None:
    """Visit the leaves of each query in descending order of their bounds while they can reach its k-th score."""
    bounds = tree.bounds(queries, best.least)
    order = np.argsort(-bounds, axis=1)
    active = np.arange(len(queries))
    for turn in range(bounds.shape[1]):
        leaf = order[active, turn]
        bound = bounds[active, leaf]
        going = np.isfinite(bound) & (bound >= best.least[active])
        active, leaf = active[going], leaf[going]
        if not len(active):
            break
        by = np.argsort(leaf, kind="stable")
        cuts = np.flatnonzero(np.diff(leaf[by])) + 1
        for part in np.split(by, cuts):
            ids, vectors = tree.leaves[leaf[part[0]]]
            rows = active[part]
            best.add(rows, products(queries[rows], vectors), ids, own)


def _sample_bounds(sample: list[tuple[int, list[float]]], k: int, scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = integers(pa.array([v for _, v in sample], pa.list_(pa.float64())), scale) if sample else {}
        names = np.array([i for i, _ in sample], dtype=np.int64)
        for batch in batches:
            ids = batch.column("id").to_numpy()
            least = np.full(len(ids), -np.inf)
            for d, (rows, vectors) in integers(batch.column("vector"), scale).items():
                if d in held:
                    best = Best(len(rows), k, np.full(len(rows), -np.inf))
                    best.add(np.arange(len(rows)), products(vectors, held[d][1]), names[held[d][0]], ids[rows])
                    least[rows] = best.least
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(least)], [*batch.schema.names, "least"])

    return run


def _shards(folder: str, k: int, scale: float):
    def flush(shard: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(shard).combine_chunks()
        ids = table.column("id").to_numpy()
        column = table.column("vector").combine_chunks()
        trees = {d: BallTree(ids[rows], x) for d, (rows, x) in integers(column, scale).items()}
        files, root = pafs.FileSystem.from_uri(folder)
        paths = [f.path for f in files.get_file_info(pafs.FileSelector(root)) if f.path.endswith(".parquet")]
        for path in sorted(paths):
            with files.open_input_file(path) as opened:
                for block in pq.ParquetFile(opened).iter_batches(QUERY_ROWS):
                    query, own = block.column("query").to_numpy(), block.column("id").to_numpy()
                    least = block.column("least").to_numpy()
                    out = []
                    for d, (rows, x) in integers(block.column("vector"), scale).items():
                        if d in trees:
                            best = Best(len(rows), k, least[rows])
                            search(trees[d], x, own[rows], best)
                            out += [
                                (int(query[r]), int(own[r]), i, -s) for r, f in zip(rows, best.found) for s, i in f
                            ]
                    if out:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, pa.int64()) for c in zip(*out)], ["query", "query_id", "vec_id", "score"]
                        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, rows = [], 0
        for batch in batches:
            shard.append(batch)
            rows += batch.num_rows
            if rows >= SHARD_ROWS:
                yield from flush(shard)
                shard, rows = [], 0
        if rows:
            yield from flush(shard)

    return run


def top_k(
    vectors: DataFrame, is_query: Column, folder: str, k: int = 5, scale: float = 256.0, key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the k best rows for each query row; queries go to ``folder``."""
    numbers = F.transform(vectors[vector], lambda x: x.cast("double"))
    chosen = is_query & vectors[key].isNotNull()
    rows = vectors.where(vectors[key].isNotNull() & vectors[vector].isNotNull()).select(
        vectors[key].cast("long").alias("id"), numbers.alias("vector"), F.coalesce(chosen, F.lit(False)).alias("asks")
    ).dropDuplicates(["id", "vector"])
    sample = [tuple(r) for r in rows.orderBy(F.xxhash64("id"), "id").select("id", "vector").limit(SAMPLE_ROWS).collect()]
    asked = rows.where("asks").select(F.monotonically_increasing_id().alias("query"), "id", "vector")
    asked.mapInArrow(
        _sample_bounds(sample, k, scale), "query long, id long, vector array<double>, least double"
    ).write.parquet(folder)
    found = rows.select("id", "vector").mapInArrow(
        _shards(folder, k, scale), "query long, query_id long, vec_id long, score long"
    )
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
