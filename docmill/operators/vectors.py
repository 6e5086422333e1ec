"""Vectors as matrices inside tasks: usable rows, scores, the best of each query, and centroids by Lloyd steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METRICS = ("cosine", "ip", "l2")
#: Centroids are fitted on about this many vectors for each.
PER_CELL = 256
MOST_CELLS = 4096
#: Gaps that a task holds at once.
HELD = 1 << 20


def usable(vector: Column, dims: int) -> Column:
    """Whether a vector is there, has the length and no null in it."""
    return F.coalesce((F.size(vector) == dims) & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x)), F.lit(False))


def common_size(vectors: DataFrame, vector: str = "vector") -> int:
    """The length that most vectors have, of equal counts the least; 0 where there are none."""
    found = vectors.where(F.col(vector).isNotNull()).groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), "d").head()
    return found["d"] if found else 0


def matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    """Lists of one length as rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), np.float64).reshape(len(column), dims)


def values(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Keys as an array that sorts as the column does: numbers, or texts as objects."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.to_numpy(zero_copy_only=False)


def unit(v: np.ndarray) -> np.ndarray:
    """Rows of length one; zeros stay."""
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    return np.divide(v, norm, out=np.zeros_like(v), where=norm > 0)


def similarities(q: np.ndarray, v: np.ndarray, metric: str) -> np.ndarray:
    """1 - distance up to a distance of 1, else 0; a row per query. cosine: 1 - cos, ip: 1 - dot, l2: squared distance."""
    if metric == "cosine":
        q, v = unit(q), unit(v)
    product = q @ v.T
    distance = 1 - product if metric != "l2" else (q**2).sum(axis=1)[:, None] + (v**2).sum(axis=1)[None] - 2 * product
    return np.round(np.where(distance <= 1, 1 - distance, 0.0), 6)


def cut(query: np.ndarray, item: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """The places of the k best of each query, by query; ties by item."""
    _, code = np.unique(item, return_inverse=True)
    order = np.lexsort((code, -score, query))
    query = query[order]
    first = np.searchsorted(query, query)
    return order[np.arange(len(order)) - first < k]


def best(scores: np.ndarray, items: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, item, score) of the k best of each row of scores. Only values that reach a row's k-th one are sorted."""
    n = scores.shape[1]
    if n > k:
        least = np.partition(scores, n - k, axis=1)[:, n - k]
        q, at = np.nonzero(scores >= least[:, None])
    else:
        q, at = (x.ravel() for x in np.indices(scores.shape))
    item, score = items[at], scores[q, at]
    keep = cut(q, item, score, k)
    return q[keep], item[keep], score[keep]


# ---- centroids


def angles(v: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The angle of each row to each centroid; a right one where either is zero."""
    return np.arccos(np.clip(unit(v) @ unit(centroids).T, -1.0, 1.0))


def gaps(v: np.ndarray, centroids: np.ndarray, metric: str) -> np.ndarray:
    """Distances that obey the triangle inequality: angles for cosine, lengths of differences otherwise."""
    if metric == "cosine":
        return angles(v, centroids)
    square = (v**2).sum(axis=1)[:, None] + (centroids**2).sum(axis=1)[None] - 2 * v @ centroids.T
    return np.sqrt(np.maximum(square, 0.0))


def fit_centroids(vectors: DataFrame, cells: int, metric: str = "cosine", steps: int = 4, per_cell: int = PER_CELL) -> np.ndarray:
    """At most `cells` centroids (MOST_CELLS at the utmost) by Lloyd steps over a sample of about per_cell * cells vectors.

    vectors: item_id, vector, all usable. The sample holds the ids of least hash, so it is the same each time. A task sums
    the vectors of each centroid, the sums of tasks are added by Spark, and only the centroids reach the driver.
    """
    cells = min(cells, MOST_CELLS)
    n = vectors.count()
    share = F.pmod(F.xxhash64("item_id", F.lit("fit")), F.lit(1 << 30)) < min(1.0, cells * per_cell / max(n, 1)) * (1 << 30)
    sample = vectors.where(share).select("vector", F.xxhash64("item_id").alias("h"))
    first = sample.groupBy("vector").agg(F.min("h").alias("h")).orderBy("h", "vector").limit(cells).collect()  # cells rows
    centroids = np.array([r["vector"] for r in first], np.float64)
    if len(first) < 2:
        return centroids
    dims = centroids.shape[1]

    def sums(centroids: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, count = np.zeros_like(centroids), np.zeros(len(centroids), np.int64)
            step = max(1, HELD // len(centroids))
            for batch in (b.slice(at, step) for b in batches for at in range(0, b.num_rows, step)):
                v = matrix(batch.column("vector"), dims)
                v = unit(v) if metric == "cosine" else v
                home = gaps(v, centroids, metric).argmin(axis=1) if len(v) else np.zeros(0, np.int64)
                np.add.at(total, home, v)
                count += np.bincount(home, minlength=len(centroids))
            some = np.flatnonzero(count)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * dims), pa.array(total[some].ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(some), lists, pa.array(count[some])], names=["cell", "total", "n"])

        return run

    def add(table: pa.Table) -> pa.Table:  # a row per task
        total = matrix(table.column("total"), dims).sum(axis=0)
        return pa.table({"cell": table.column("cell")[:1], "total": pa.array([total]), "n": [sum(table.column("n").to_pylist())]})

    kinds = "cell long, total array<double>, n long"
    for _ in range(steps):
        found = sample.mapInArrow(sums(centroids), kinds).groupBy("cell").applyInArrow(add, kinds).collect()  # cells rows
        for r in found:
            centroids[r["cell"]] = np.array(r["total"]) / r["n"]
    return centroids
