"""A stored BM25 index in blocks with score bounds, and a search that reads only the blocks that can matter.

Documents are dealt to chunks by a hash of their id. A block holds the postings of one term in one chunk and the greatest
share of a score that any of them has. For a query, the bounds of its terms' blocks in a chunk add up to what a document
of the chunk can reach. A search scores the chunks of greatest reach first; the k-th score is a threshold. Of every other
chunk that reaches it, the terms of least bound that cannot get there together are put aside: a document has to stand in
a block of the remaining, essential terms. Those are scored, and only where a document with what is put aside can still
reach the threshold, the blocks that were put aside are read too. The result is that of scoring every posting.

Documents move once, to the task of their chunk, where they are counted and their blocks are made. In a search, the bounds
of a chunk are added up where its blocks are read, and its asked blocks meet all queries in one task, so that rows per
query and block are never sent or kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docmill.functions.text import tokens
from docmill.operators.search import BLOCK, EPSILON, K1, B, top_k

#: Documents of a chunk, about; chunks that are scored first; terms of queries that are sent to every task at once, about.
CHUNK, PROBE, ASKED = 64, 4, 1 << 18
_ROUND = 1e-5
_NONE = -1e300  # a threshold that everything reaches


def _share(tf, length, mean):
    """What a posting adds to a score, without the term's weight; columns or arrays."""
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))


class Bm25Index:
    """The folder of an index: blocks by chunk, terms (df, idf), and the size and mean length of the corpus."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        found = spark.read.json(f"{self.path}/corpus").head()
        self.mean, self.n, self.kind = found["mean"], found["n"], found["kind"]

    @staticmethod
    def build(docs: DataFrame, path: str, item: str = "item_id", text: str = "text", chunk: int = CHUNK) -> Bm25Index:
        """Indexes all documents in two passes over their texts. Rows of one id are one document; rows without one are left out.

        A null text has no terms. An empty table gives an empty index.
        """
        spark, path = docs.sparkSession, path.rstrip("/")
        docs = docs.where(F.col(item).isNotNull()).select(F.col(item).alias("item_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
        sized = docs.groupBy("item_id").agg(F.sum(F.size(tokens(F.col("_text")))).alias("length")).agg(F.count(F.lit(1)).alias("n"), F.avg("length").alias("mean")).head()
        n, mean = sized["n"], sized["mean"] or 1.0
        chunks = max(1, -(-n // chunk))
        # all that follows groups inside a chunk, so this is the one time that rows move
        words = docs.withColumn("chunk", F.pmod(F.xxhash64("item_id"), F.lit(chunks)).cast("int")).repartition("chunk").withColumn("_t", tokens(F.col("_text")))
        counted = words.select("chunk", "item_id", F.explode("_t").alias("term")).groupBy("chunk", "item_id", "term").agg(F.count(F.lit(1)).alias("tf"))
        postings = counted.withColumn("length", F.sum("tf").over(Window.partitionBy("chunk", "item_id")))
        own = F.struct("item_id", "tf", "length")
        blocks = postings.groupBy("chunk", "term").agg(F.max(_share(F.col("tf"), F.col("length"), F.lit(mean))).alias("most"), F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(own)).alias("postings"))  # a chunk's documents at most
        blocks.select("term", "chunk", "most", "n", "postings").sortWithinPartitions("chunk", "term").write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/blocks")
        spark.createDataFrame([(n, mean, dict(docs.dtypes)["item_id"])], "n long, mean double, kind string").coalesce(1).write.mode("overwrite").json(f"{path}/corpus")
        index = Bm25Index(spark, path)
        raw = index.blocks("term", "n").groupBy("term").agg(F.sum("n").alias("df")).withColumn("raw", F.log(F.lit(n) - F.col("df") + 0.5) - F.log(F.col("df") + 0.5))
        average = raw.agg(F.avg("raw").alias("average"))
        idf = F.when(F.col("raw") < 0, F.col("average") * EPSILON).otherwise(F.col("raw"))
        raw.join(F.broadcast(average)).select("term", "df", idf.alias("idf")).sortWithinPartitions("term").write.mode("overwrite").parquet(f"{path}/terms")  # one row
        return index

    def blocks(self, *columns: str) -> DataFrame:
        schema = f"term string, chunk int, most double, n long, postings array<struct<item_id: {self.kind}, tf: long, length: long>>"
        return self.spark.read.schema(schema).parquet(f"{self.path}/blocks").select(*columns)

    def steps(self, queries: DataFrame, k: int, probe: int = PROBE) -> dict[str, DataFrame]:
        """The blocks of a search: `bounds` of all its terms, and those read in the steps `first`, `essential` and `rest`; `found` has the scores.

        queries: query_id, query. Repeated terms count repeatedly. More than about ASKED terms are taken in turns by query.
        """
        asked = queries.where("query_id IS NOT NULL").select("query_id", F.explode(tokens(F.coalesce("query", F.lit("")))).alias("term")).groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("qf"))
        terms = self.spark.read.schema("term string, df long, idf double").parquet(f"{self.path}/terms")
        asked = asked.join(terms, "term").select("query_id", "term", (F.col("qf") * F.col("idf")).alias("weight")).persist()
        turns = max(1, -(-asked.count() // ASKED))
        out = [self._turn(asked.where(F.pmod(F.xxhash64("query_id"), F.lit(turns)) == i), k, probe) for i in range(turns)]
        whole = out[0]
        for more in out[1:]:
            whole = {name: df.unionByName(more[name]) for name, df in whole.items()}
        return whole

    def _turn(self, asked: DataFrame, k: int, probe: int) -> dict[str, DataFrame]:
        kind = dict(asked.dtypes)["query_id"]
        local = asked.toArrow()  # about ASKED rows
        names = sorted(set(local.column("term").to_pylist()))
        codes = self.spark.createDataFrame(pa.table({"term": pa.array(names, pa.string()), "code": pa.array(range(len(names)), pa.int32())}))
        wanted = self.blocks("term", "chunk", "most", "n", "postings").join(F.broadcast(codes), "term")  # about ASKED rows
        bounds = wanted.join(F.broadcast(asked), "term").withColumn("bound", F.greatest("weight", F.lit(0.0)) * F.col("most"))  # about ASKED rows
        reach = bounds.groupBy("query_id", "chunk").agg(F.sum("bound").alias("reach"))
        leading = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("reach"), "chunk"))
        probes = reach.withColumn("_n", leading).where(F.col("_n") <= probe).select("query_id", "chunk").persist()
        first = bounds.join(F.broadcast(probes), ["query_id", "chunk"], "left_semi")  # `probe` rows per query
        part = F.col("weight") * _share(F.col("tf"), F.col("length"), F.lit(self.mean))
        scored = first.select("query_id", "weight", F.inline("postings")).groupBy("query_id", "item_id").agg(F.sum(part).alias("score")).persist()
        least = top_k(scored, k).where(F.col("rank") == k).select("query_id", (F.col("score") - _ROUND).alias("least"))
        ids = list(dict.fromkeys(local.column("query_id").to_pylist()))
        number = {q: i for i, q in enumerate(ids)}
        code = {t: i for i, t in enumerate(names)}
        limits = np.full(len(ids), _NONE)
        for r in least.collect():  # a row per query
            limits[number[r["query_id"]]] = r["least"]
        done: dict[int, list[int]] = {}
        for r in probes.collect():  # `probe` rows per query
            done.setdefault(r["chunk"], []).append(number[r["query_id"]])
        rows = np.array([(number[q], code[t]) for q, t in zip(local.column("query_id").to_pylist(), local.column("term").to_pylist(), strict=True)], np.int64).reshape(-1, 2)
        shared = self.spark.sparkContext.broadcast((pa.array(ids, local.schema.field("query_id").type), rows[:, 0], rows[:, 1], np.array(local.column("weight"), np.float64), len(names), limits, done))
        meet = wanted.select("chunk", "code", "most", "n", "postings").groupBy("chunk").applyInArrow(_chunk_search(shared, self.mean), f"query_id {kind}, item_id {self.kind}, score double, step string, n long")
        read = lambda step: meet.where(F.col("step") == step).select("query_id", "n")
        found = scored.unionByName(meet.where("step = 'found'").select("query_id", "item_id", "score"))
        return {"bounds": bounds.select("query_id", "n"), "first": first.select("query_id", "n"), "essential": read("essential"), "rest": read("rest"), "found": found}

    def top(self, queries: DataFrame, k: int, probe: int = PROBE) -> DataFrame:
        """(query_id, rank, item_id, score) of the k best of each query; of these, those with a positive score."""
        found = self.steps(queries, k, probe)["found"].withColumn("score", F.round("score", 6))
        return top_k(found, k).where("score > 0").select("query_id", "rank", "item_id", "score")

    def postings_read(self, queries: DataFrame, k: int, probe: int = PROBE) -> dict[str, int]:
        """How many postings the terms of the queries have, for all queries together, and how many each step reads."""
        steps = self.steps(queries, k, probe)
        return {name: steps[name].agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0] for name in ("bounds", "first", "essential", "rest")}


def _chunk_search(shared, mean: float):
    """For the asked blocks of a chunk: the scores that can matter, and how many postings were read for each query."""

    def run(table: pa.Table) -> pa.Table:
        ids, query, code, weight, size, limits, done = shared.value
        place = np.full(size, -1)
        place[table.column("code").to_numpy()] = np.arange(table.num_rows)
        block = place[code]
        open_ = np.ones(len(limits), bool)
        open_[done.get(table.column("chunk")[0].as_py(), [])] = False
        keep = (block >= 0) & open_[query]
        q, t, w = query[keep], block[keep], weight[keep]
        bound = np.maximum(w, 0.0) * table.column("most").to_numpy()[t]
        reach = np.bincount(q, bound, len(limits))
        held = reach[q] >= limits[q]
        order = np.lexsort((t, bound, q))
        order = order[held[order]]
        q, t, w, bound = q[order], t[order], w[order], bound[order]
        # of each query, the terms of least bound that cannot reach its threshold together
        total = np.cumsum(bound)
        start = np.searchsorted(q, q)
        aside = total - (total[start] - bound[start]) < limits[q]
        postings = table.column("postings").combine_chunks()
        flat = postings.flatten()
        items, item = np.unique(np.asarray(flat.field("item_id").dictionary_encode().indices), return_inverse=True)
        names = flat.field("item_id").dictionary_encode().dictionary.take(pa.array(items))
        share = np.zeros((table.num_rows, len(items)))
        share[np.repeat(np.arange(table.num_rows), np.asarray(postings.value_lengths())), item] = _share(np.asarray(flat.field("tf"), np.float64), np.asarray(flat.field("length"), np.float64), mean)
        n, out, of = table.column("n").to_numpy(), {"essential": [], "rest": []}, []
        some = np.unique(q)
        for at in range(0, len(some), BLOCK):
            own = some[at : at + BLOCK]
            a, b = np.searchsorted(q, own[0]), np.searchsorted(q, own[-1], side="right")
            row, col, far = np.searchsorted(own, q[a:b]), t[a:b], aside[a:b]
            near, other, stands = np.zeros((len(own), len(share))), np.zeros((len(own), len(share))), np.zeros((len(own), len(share)))
            near[row[~far], col[~far]], other[row[far], col[far]], stands[row[~far], col[~far]] = w[a:b][~far], w[a:b][far], 1.0
            more = np.bincount(row, bound[a:b] * far, len(own))
            score = near @ share
            good = (stands @ (share > 0) > 0) & (score + more[:, None] >= limits[own][:, None])
            x, y = np.nonzero(good)
            of.append((own[x], y, score[x, y] + (other @ share)[x, y]))
            read = good.any(axis=1)
            out["essential"].append((own, np.bincount(row, n[col] * ~far, len(own))))
            out["rest"].append((own[read], np.bincount(row, n[col] * far, len(own))[read]))
        tables = []
        for step, parts in (("found", of), *out.items()):
            if parts:
                x, *rest = (np.concatenate(p) for p in zip(*parts, strict=True))
                item_id = names.take(pa.array(rest[0])) if step == "found" else pa.nulls(len(x), names.type)
                score = pa.array(rest[1]) if step == "found" else pa.nulls(len(x), pa.float64())
                count = pa.nulls(len(x), pa.int64()) if step == "found" else pa.array(rest[0].astype(np.int64))
                tables.append(pa.table([ids.take(pa.array(x)), item_id, score, pa.array([step] * len(x), pa.string()), count], names=["query_id", "item_id", "score", "step", "n"]))
        empty = pa.table([ids[:0], names[:0], pa.array([], pa.float64()), pa.array([], pa.string()), pa.array([], pa.int64())], names=["query_id", "item_id", "score", "step", "n"])
        return pa.concat_tables([empty, *tables])

    return run
