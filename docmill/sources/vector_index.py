"""An index of vectors in cells: a query reads the cells that can hold one of its k nearest.

Centroids come from Lloyd steps; each vector is stored in the folder of its nearest centroid's cell with its distance to
the centroid, and the greatest of these is the cell's radius. By the triangle inequality a cell's centroid and radius
bound the score that any of its vectors can have with a query. A search scores each query against the cells of its
nearest centroids first; the k-th score found is a threshold, and only cells whose bound reaches it are read after that,
so the result is that of a scan of all vectors. An approximate search stops after the first cells; how many it takes for
a recall is measured by calibrate().
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docmill.operators.search import PART, meet_groups, top_k
from docmill.operators.vectors import METRICS, common_size, fit_centroids, gaps, matrix, usable

#: Cells that a query is scored against before the bounds of the others are looked at.
PROBE = 4
_ROUND = 2e-6  # scores are rounded to six digits


def _settings(spark: SparkSession, path: str, metric: str, dims: int, probe: int, kind: str) -> None:
    spark.createDataFrame([(metric, dims, probe, kind)], "metric string, dims int, probe int, kind string").coalesce(1).write.mode("overwrite").json(f"{path}/settings")


def bounds(q: np.ndarray, centroids: np.ndarray, radii: np.ndarray, metric: str) -> np.ndarray:
    """The greatest score that each query can have in each cell; -1 in a cell without vectors."""
    if metric == "ip":
        most = np.maximum(q @ centroids.T + np.linalg.norm(q, axis=1)[:, None] * radii[None], 0.0)
    else:
        near = np.maximum(gaps(q, centroids, metric) - radii[None], 0.0)
        most = np.maximum(np.cos(near) if metric == "cosine" else 1 - near**2, 0.0)
    return np.where(radii[None] >= 0, most, -1.0)


def closeness(q: np.ndarray, centroids: np.ndarray, metric: str) -> np.ndarray:
    """By which the first cells are chosen; a cell of great radius has a great bound, but seldom the nearest vectors."""
    return q @ centroids.T if metric == "ip" else -gaps(q, centroids, metric)


class VectorIndex:
    """The folder of an index: settings, centroids, vectors by cell, and for each load the radius and size of its cells."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        found = spark.read.json(f"{self.path}/settings").head()
        self.metric, self.dims, self.probe, self.kind = found["metric"], found["dims"], found["probe"], found["kind"]
        rows = spark.read.parquet(f"{self.path}/centroids").orderBy("cell").collect()  # MOST_CELLS at most
        self.centroids = np.array([r["centroid"] for r in rows], np.float64).reshape(len(rows), self.dims)

    @staticmethod
    def build(vectors: DataFrame, path: str, metric: str = "cosine", cells: int | None = None) -> VectorIndex:
        """Indexes all vectors (item_id, vector) that have an id and the length of most, without nulls.

        cells: the square root of their number if not given, MOST_CELLS at most.
        """
        if metric not in METRICS:
            raise ValueError(f"unknown metric {metric}")
        dims = common_size(vectors)
        rows = vectors.where(F.col("item_id").isNotNull() & usable(F.col("vector"), dims)).select("item_id", F.col("vector").cast("array<double>").alias("vector"))
        wanted = cells or max(1, round(rows.count() ** 0.5))
        centroids = fit_centroids(rows, wanted, metric)
        spark, path = vectors.sparkSession, path.rstrip("/")
        _settings(spark, path, metric, dims, PROBE, dict(rows.dtypes)["item_id"])
        spark.createDataFrame([(k, c.tolist()) for k, c in enumerate(centroids)], "cell int, centroid array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/centroids")
        index = VectorIndex(spark, path)
        index._append(rows, "overwrite")
        return index

    def add(self, vectors: DataFrame) -> None:
        """Adds vectors under the centroids that are there; their ids have to be new."""
        self._append(vectors.where(F.col("item_id").isNotNull() & usable(F.col("vector"), self.dims)).select("item_id", F.col("vector").cast("array<double>").alias("vector")), "append")

    def _append(self, rows: DataFrame, mode: str) -> None:
        centroids, metric, dims = self.centroids, self.metric, self.dims

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                v = matrix(batch.column("vector"), dims)
                far = gaps(v, centroids, metric)
                cell = far.argmin(axis=1)
                gap = far[np.arange(len(v)), cell]
                if metric == "cosine":
                    gap[~v.any(axis=1)] = 0.0  # a zero vector scores 0, which every bound reaches
                yield pa.RecordBatch.from_arrays([batch.column("item_id"), batch.column("vector"), pa.array(gap), pa.array(cell.astype(np.int32))], names=["item_id", "vector", "gap", "cell"])

        found = rows.mapInArrow(run, f"item_id {self.kind}, vector array<double>, gap double, cell int")
        seen = f"{self.path}/vectors"
        before = self._sizes() if mode == "append" else None
        found.hint("rebalance", "cell").write.mode(mode).partitionBy("cell").parquet(seen)
        sizes = self.vectors().groupBy("cell").agg(F.max("gap").alias("radius"), F.count(F.lit(1)).alias("n"))
        if before is not None:  # only cells that have grown are read again
            touched = [r["cell"] for r in found.select("cell").distinct().collect()]
            sizes = sizes.where(F.col("cell").isin(touched)).unionByName(before.where(~F.col("cell").isin(touched)))
        rows = sizes.collect()  # MOST_CELLS at most
        self.spark.createDataFrame(rows, "cell int, radius double, n long").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/cells")

    def _sizes(self) -> DataFrame:
        return self.spark.read.schema("cell int, radius double, n long").parquet(f"{self.path}/cells")

    def vectors(self, cells: list[int] | None = None) -> DataFrame:
        """(item_id, vector, gap, cell), of some cells or all; folders of other cells are not read."""
        rows = self.spark.read.schema(f"item_id {self.kind}, vector array<double>, gap double, cell int").parquet(f"{self.path}/vectors")
        return rows if cells is None else rows.where(F.col("cell").isin(cells))

    def _cells(self, queries: DataFrame, pick, schema: str) -> DataFrame:
        """Rows of pick(bounds, batch) for batches of queries; centroids and radii, MOST_CELLS of them, go to every task."""
        radii = np.full(len(self.centroids), -1.0)
        for r in self._sizes().collect():
            radii[r["cell"]] = r["radius"]
        centroids, metric, dims = self.centroids, self.metric, self.dims

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    most = bounds(matrix(batch.column("vector"), dims), centroids, radii, metric)
                    q, cell = pick(most, batch)
                    rows = batch.take(pa.array(q))
                    yield pa.RecordBatch.from_arrays([rows.column("query_id"), rows.column("vector"), pa.array(cell.astype(np.int32))], names=["query_id", "vector", "cell"])

        return queries.mapInArrow(run, schema)

    def calibrate(self, k: int = 10, least: float = 0.9, sample: int = 100) -> int:
        """The number of first cells that hold a share of `least` of the true k nearest, over `sample` of the vectors as queries.

        Kept in the settings as the default of query(). The truth is the exact search, a query's own vector left out.
        """
        rows = self.vectors().orderBy(F.xxhash64("item_id", F.lit("calibrate")), "item_id").limit(sample)
        drawn = rows.select(F.col("item_id").alias("query_id"), "vector").persist()
        truth = self.query(drawn, k + 1).where("item_id <> query_id").select("query_id", "item_id")
        cells = truth.join(self.vectors().select("item_id", "cell"), "item_id").select("query_id", "cell").collect()  # sample * (k + 1) rows
        asked = drawn.collect()
        drawn.unpersist()
        if not cells:
            return self.probe
        order = np.argsort(-closeness(np.array([r["vector"] for r in asked]), self.centroids, self.metric), axis=1, kind="stable")
        number = {r["query_id"]: j for j, r in enumerate(asked)}
        places = np.sort([int(np.flatnonzero(order[number[r["query_id"]]] == r["cell"])[0]) for r in cells])
        self.probe = int(places[int(np.ceil(least * len(places))) - 1]) + 1
        _settings(self.spark, self.path, self.metric, self.dims, self.probe, self.kind)
        return self.probe

    def query(self, queries: DataFrame, k: int = 5, probe: int | None = None, exact: bool = True) -> DataFrame:
        """(query_id, rank, item_id, score) of the k nearest, as search.dense_top_k gives them.

        queries: query_id, vector; those without an id or of another length have no row. With exact=False only the
        `probe` cells of nearest centroids are read for each query.
        """
        first, more = self.cells_of(queries, k, probe or self.probe, exact)
        found = first if more is None else first.unionByName(self._score(more, k))
        return top_k(found, k).select("query_id", "rank", "item_id", "score")

    def cells_of(self, queries: DataFrame, k: int, probe: int, exact: bool) -> tuple[DataFrame, DataFrame | None]:
        """What the first cells hold, and the (query_id, vector, cell) that have to be read after that."""
        kind = dict(queries.dtypes)["query_id"]
        schema = f"query_id {kind}, vector array<double>, cell int"
        asked = queries.where(F.col("query_id").isNotNull() & usable(F.col("vector"), self.dims)).select("query_id", F.col("vector").cast("array<double>").alias("vector"))

        centroids, metric, dims = self.centroids, self.metric, self.dims

        def leading(most: np.ndarray, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
            near = np.where(most >= 0, closeness(matrix(batch.column("vector"), dims), centroids, metric), -np.inf)
            order = np.argsort(-near, axis=1, kind="stable")[:, :probe]
            q = np.repeat(np.arange(len(most)), order.shape[1])
            keep = most[q, order.ravel()] >= 0
            return q[keep], order.ravel()[keep]

        first = self._score(self._cells(asked, leading, schema), k)
        if not exact:
            return first, None
        first = first.persist()  # a few rows for each query, read twice
        reached = Window.partitionBy("query_id").orderBy(F.desc("score"), "item_id")
        least = first.withColumn("_n", F.row_number().over(reached)).where(F.col("_n") == k).select("query_id", F.col("score").alias("least"))
        ready = asked.join(least, "query_id", "left").withColumn("least", F.coalesce("least", F.lit(-2.0)))

        def others(most: np.ndarray, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
            q, cell = leading(most, batch)
            open_cells = (most >= 0) & (most + _ROUND >= np.asarray(batch.column("least"))[:, None])
            open_cells[q, cell] = False
            return np.nonzero(open_cells)

        return first, self._cells(ready, others, schema)

    def _score(self, asked: DataFrame, k: int) -> DataFrame:
        """The k best of each (query_id, vector, cell) and part of the cell; parts and blocks of queries bound what a task holds."""
        kinds = f"query_id {dict(asked.dtypes)['query_id']}, item_id {self.kind}, score double"
        asked = asked.persist()
        blocks = {r["cell"]: -(-r["count"] // PART) for r in asked.groupBy("cell").count().collect()}  # a row per cell
        parts = {r["cell"]: -(-r["n"] // PART) for r in self._sizes().collect()}
        if not blocks:
            return self.spark.createDataFrame([], kinds)
        shape = self.spark.createDataFrame([(c, n, parts.get(c, 1)) for c, n in blocks.items()], "cell int, blocks int, parts int")
        own = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        one = asked.join(F.broadcast(shape), "cell").withColumn("i", own("query_id", "blocks")).withColumn("j", every("parts"))  # MOST_CELLS rows
        two = self.vectors(list(blocks)).join(F.broadcast(shape), "cell").withColumn("j", own("item_id", "parts")).withColumn("i", every("blocks"))
        keys = ("cell", "i", "j")
        met = one.select(*keys, "query_id", "vector").groupBy(*keys).cogroup(two.select(*keys, "item_id", "vector").groupBy(*keys))
        return met.applyInArrow(meet_groups(self.dims, k, self.metric), kinds)
