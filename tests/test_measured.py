"""Measured latencies, and chunks by a table function in SQL."""

import time

from pyspark.sql import functions as F

from docmill.operators import chunks as K
from docmill.operators import search as S


def test_steps_are_measured(spark):
    vectors = spark.createDataFrame([(k, [1.0, float(k)]) for k in range(5)], "item_id long, vector array<double>")
    queries = spark.createDataFrame([(1, "a"), (2, "b")], "query_id long, query string")

    def embed(rows):
        @F.udf("array<double>")
        def slow(_):
            time.sleep(0.4)
            return [1.0, 0.0]

        return rows.coalesce(1).withColumn("vector", slow("query"))

    got = S.measured(queries, lambda rows: S.dense_top_k(rows, vectors, 2), embed=embed).collect()
    assert {(r["query_id"], r["rank"], r["item_id"]) for r in got} == {(1, 1, 0), (1, 2, 1), (2, 1, 0), (2, 2, 1)}
    for r in got:  # two queries share the time of their batch
        assert r["embed_ms"] >= 400 and r["search_ms"] > 0 and r["rerank_ms"] == 0
        assert abs(r["total_ms"] - r["embed_ms"] - r["search_ms"]) < 1e-6


def test_chunks_by_sql_equal_those_of_the_operator(spark):
    rows = [(f"http://e/{k}", f"t{k}", "# A\n\n" + "some words. " * (60 * k) + "\n\n## B\n\n```py\nx\n```") for k in range(6)] + [(None, "t", "text"), ("u", None, "text"), ("v", "t", " "), ("w", "t", None)]
    docs = spark.createDataFrame(rows, "url string, title string, markdown_content string")
    config = K.ChunkConfig(min_tokens=30, max_tokens=200)
    K.register_chunks(spark, "chunks_of", config)
    got = spark.sql("SELECT c.* FROM {docs} d, LATERAL chunks_of(d.url, d.title, d.markdown_content) c", docs=docs)
    want = K.chunk_documents(docs, config)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr) and got.count() > 6
