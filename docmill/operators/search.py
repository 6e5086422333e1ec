"""Retrieval for many queries at once: dense top-k, BM25, reciprocal-rank fusion and reranking."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docmill.functions.text import tokens
from docmill.operators.vectors import METRICS, best, common_size, cut, matrix, similarities, usable, values

# The constants of BM25 and of fusion, and how many times k is fetched before either.
K1, B, EPSILON = 1.5, 0.75, 0.25
RRF = 60
OVERFETCH = 4
#: Queries that are scored at once against the vectors of a task.
BLOCK = 256
#: Bytes of query vectors that are sent to every task, at most.
MOST = 64 << 20
#: Queries of a block and vectors of a part, where queries are more.
PART = 1 << 13
#: Words of queries that are sent to every task, at most.
ASKED = 1 << 18


Step = Callable[[DataFrame], DataFrame]


def similarity(distance: Column) -> Column:
    """1 - d up to a distance of 1, else 0."""
    return F.when(distance <= 1, 1 - distance).otherwise(0.0)


def top_k(rows: DataFrame, k: int, query: str = "query_id", score: str = "score", item: str = "item_id") -> DataFrame:
    """Ranked from 1; ties by item. Each task keeps its own k best before rows move."""
    order = Window.partitionBy(query).orderBy(F.desc(score), item)
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def dense_top_k(queries: DataFrame, vectors: DataFrame, k: int = 5, metric: str = "cosine") -> DataFrame:
    """(query_id, rank, item_id, score) of the nearest vectors, by a scan of all. queries: query_id, vector; vectors: item_id, vector.

    Queries of up to MOST bytes, counted beforehand, go to every task, which returns its k nearest to each; more are
    dealt to blocks that each meet every part of the vectors. Rows without an id, null vectors and vectors with nulls or
    of another length than most queries have no score. For many searches of one table see sources.vector_index.
    """
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric}")
    kinds = f"query_id {dict(queries.dtypes)['query_id']}, item_id {dict(vectors.dtypes)['item_id']}, score double"
    spark = vectors.sparkSession
    dims = common_size(queries)
    rows = vectors.where(F.col("item_id").isNotNull() & usable(F.col("vector"), dims)).select("item_id", "vector")
    asked = queries.where(F.col("query_id").isNotNull() & usable(F.col("vector"), dims)).select("query_id", "vector")
    n = asked.count()
    if n * dims * 8 > MOST:
        return top_k(_meet(asked, rows, n, dims, k, metric, kinds), k).select("query_id", "rank", "item_id", "score")
    local = asked.toArrow()  # MOST bytes
    shared = spark.sparkContext.broadcast((local.column("query_id"), matrix(local.column("vector"), dims)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, q = shared.value
        held, kind = None, None  # query, item and score of the best so far
        for batch in batches:
            kind = batch.column("item_id").type
            if not batch.num_rows or not len(ids):
                continue
            items, v = values(batch.column("item_id")), matrix(batch.column("vector"), dims)
            found = [held] if held else []
            for at in range(0, len(ids), BLOCK):
                query, item, score = best(similarities(q[at : at + BLOCK], v, metric), items, k)
                found.append((query + at, item, score))
            query, item, score = (np.concatenate(x) for x in zip(*found, strict=True))
            keep = cut(query, item, score, k)
            held = query[keep], item[keep], score[keep]
        if held:
            yield _found(ids, *held, kind)

    return top_k(rows.mapInArrow(run, kinds), k).select("query_id", "rank", "item_id", "score")


def _found(ids: pa.ChunkedArray, query: np.ndarray, item: np.ndarray, score: np.ndarray, kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([ids.combine_chunks().take(pa.array(query)), pa.array(item, kind), pa.array(score)], names=["query_id", "item_id", "score"])


def meet_groups(dims: int, k: int, metric: str):
    """For cogrouped tables of queries and vectors: the k best of each query."""

    def run(asked: pa.Table, rows: pa.Table) -> pa.Table:
        found = [(np.zeros(0, np.int64), values(rows.column("item_id"))[:0], np.zeros(0))]
        if rows.num_rows and asked.num_rows:
            q, v, items = matrix(asked.column("vector"), dims), matrix(rows.column("vector"), dims), values(rows.column("item_id"))
            for at in range(0, len(q), BLOCK):
                query, item, score = best(similarities(q[at : at + BLOCK], v, metric), items, k)
                found.append((query + at, item, score))
        return pa.Table.from_batches([_found(asked.column("query_id"), *(np.concatenate(x) for x in zip(*found, strict=True)), rows.column("item_id").type)])

    return run


def _meet(asked: DataFrame, rows: DataFrame, n: int, dims: int, k: int, metric: str, kinds: str) -> DataFrame:
    """Every block of queries with every part of the vectors, each pair in a task of its own."""
    blocks, parts = -(-n // PART), -(-rows.count() // PART)
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(max(m, 1) - 1)))
    dealt = lambda c, m: F.pmod(F.xxhash64(c), F.lit(max(m, 1))).cast("int")
    one = asked.withColumn("i", dealt("query_id", blocks)).withColumn("j", every(parts))
    two = rows.withColumn("j", dealt("item_id", parts)).withColumn("i", every(blocks))
    return one.groupBy("i", "j").cogroup(two.groupBy("i", "j")).applyInArrow(meet_groups(dims, k, metric), kinds)


def build_index(docs: DataFrame, item: str = "item_id", text: str = "text", asked: DataFrame | None = None) -> dict[str, DataFrame]:
    """BM25 tables: postings (term, item_id, tf), lengths (item_id, length) and terms (term, df, idf).

    With `asked` (a column `query`), postings and terms hold the terms of these queries only, which are picked before
    rows are moved; df and the mean idf are those of all terms.
    """
    words = docs.select(F.col(item).alias("item_id"), tokens(F.coalesce(F.col(text), F.lit(""))).alias("_t"))
    lengths = words.select("item_id", F.size("_t").cast("long").alias("length"))
    every = words.select("item_id", F.explode("_t").alias("term"))
    df = words.select(F.explode(F.array_distinct("_t")).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    n = lengths.agg(F.count(F.lit(1)).alias("n"))
    raw = df.join(F.broadcast(n)).withColumn("raw", F.log(F.col("n") - F.col("df") + 0.5) - F.log(F.col("df") + 0.5))  # one row
    mean = raw.agg(F.avg("raw").alias("mean"))
    if asked is not None:
        wanted = asked.select(F.explode(tokens(F.coalesce("query", F.lit("")))).alias("term")).distinct()
        every, raw = every.join(wanted, "term", "left_semi"), raw.join(wanted, "term", "left_semi")
    postings = every.groupBy("term", "item_id").agg(F.count(F.lit(1)).alias("tf"))
    idf = F.when(F.col("raw") < 0, F.col("mean") * EPSILON).otherwise(F.col("raw"))
    terms = raw.join(F.broadcast(mean)).select("term", "df", idf.alias("idf"))  # one row
    return {"postings": postings, "lengths": lengths, "terms": terms}


def bm25_scores(queries: DataFrame, index: dict[str, DataFrame]) -> DataFrame:
    """(query_id, item_id, score) of every item that holds a query term. queries: query_id, query. Repeated terms count repeatedly.

    Postings are dealt by item; words of queries up to ASKED, counted beforehand, go to every task, so that the rows of a
    score are made where they are added up, and none of them moves.
    """
    asked = queries.select("query_id", F.explode(tokens(F.coalesce("query", F.lit("")))).alias("term"))
    few = asked.count() <= ASKED
    asked = asked.groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("qf")).join(index["terms"], "term")
    mean = index["lengths"].agg(F.avg("length").alias("_mean"))
    placed = index["postings"].join(index["lengths"], "item_id")
    hits = placed.join(F.broadcast(asked) if few else asked, "term").join(F.broadcast(mean))  # ASKED rows, one row
    part = F.col("qf") * F.col("idf") * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / F.col("_mean")))
    return hits.groupBy("query_id", "item_id").agg(F.round(F.sum(part), 6).alias("score"))


def bm25_top(queries: DataFrame, index: dict[str, DataFrame], n: int) -> DataFrame:
    """The n best of each query; of these, those with a positive score."""
    return top_k(bm25_scores(queries, index), n).where("score > 0").select("query_id", "rank", "item_id", "score")


def fuse(dense: DataFrame, sparse: DataFrame, k: int = 5) -> DataFrame:
    """Reciprocal-rank fusion of two rankings (query_id, rank from 1, item_id)."""
    both = dense.select("query_id", "item_id", "rank").unionByName(sparse.select("query_id", "item_id", "rank"))
    fused = both.groupBy("query_id", "item_id").agg(F.round(F.sum(1 / (RRF + F.col("rank"))), 8).alias("score"))
    return top_k(fused, k).select("query_id", "rank", "item_id", "score")


def with_payload(fused: DataFrame, dense: DataFrame, sparse: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of each fused item, from the dense ranking if it has the item, else from the sparse one."""
    one = dense.select("query_id", "item_id", *[F.col(c).alias(f"_d_{c}") for c in columns])
    two = sparse.select("query_id", "item_id", *[F.col(c).alias(f"_s_{c}") for c in columns])
    out = fused.join(one, ["query_id", "item_id"], "left").join(two, ["query_id", "item_id"], "left")
    return out.withColumns({c: F.coalesce(f"_d_{c}", f"_s_{c}") for c in columns}).drop(*[f"_{x}_{c}" for x in "ds" for c in columns])


def with_latency(found: DataFrame, embed_ms: float = 0.0, search_ms: float = 0.0, rerank_ms: float = 0.0) -> DataFrame:
    """found with the milliseconds that a query took: a batch is answered at once, so each query has its share of them."""
    steps = {"embed_ms": embed_ms, "search_ms": search_ms, "rerank_ms": rerank_ms}
    n = found.agg(F.greatest(F.countDistinct("query_id"), F.lit(1)).alias("_n"))
    out = found.join(F.broadcast(n)).withColumns({k: F.lit(float(v)) / F.col("_n") for k, v in steps.items()})  # one row
    return out.withColumn("total_ms", F.col("embed_ms") + F.col("search_ms") + F.col("rerank_ms")).drop("_n")


def measured(queries: DataFrame, search: Step, embed: Step | None = None, rerank: Step | None = None) -> DataFrame:
    """What the steps find, with the milliseconds that each of them took.

    A step takes the rows of the one before (embed, search, rerank). Its rows are kept and computed before the next one
    begins, so that the time between is its own.
    """
    rows, took = queries, {}
    for name, step in (("embed_ms", embed), ("search_ms", search), ("rerank_ms", rerank)):
        if step is not None:
            began = time.perf_counter()
            rows = step(rows).persist()
            rows.write.format("noop").mode("overwrite").save()
            took[name] = 1000 * (time.perf_counter() - began)
    return with_latency(rows, **took)


def lexical_score(query: Column, text: Column) -> Column:
    """The share of a query's distinct terms that a text has."""
    asked = F.array_distinct(tokens(F.coalesce(query, F.lit(""))))
    return F.when(F.size(asked) > 0, F.size(F.array_intersect(asked, tokens(F.coalesce(text, F.lit(""))))) / F.size(asked)).otherwise(0.0)


def rerank(candidates: DataFrame, k: int, score: Callable[[Column, Column], Column] = lexical_score) -> DataFrame:
    """candidates (query_id, item_id, query, text) by a score of each pair, which replaces theirs."""
    scored = candidates.drop("rank", "score").withColumn("score", F.round(score(F.col("query"), F.col("text")), 6))
    return top_k(scored, k)
