"""The stored BM25 index against scoring every posting."""

import random

import pytest

from docmill.operators import search as S
from docmill.sources.bm25_index import Bm25Index

WORDS = [f"w{k}" for k in range(60)]


def corpus(seed, n):
    draw = random.Random(seed)
    weights = [1 / (k + 1) for k in range(len(WORDS))]
    return [(k, " ".join(draw.choices(WORDS, weights, k=draw.randrange(0, 30)))) for k in range(n)]


def tables(spark, docs, asked):
    return spark.createDataFrame(docs, "item_id long, text string"), spark.createDataFrame(asked, "query_id long, query string")


def ranking(df):
    return sorted((r["query_id"], r["rank"], r["item_id"], round(r["score"], 5)) for r in df.collect())


@pytest.mark.parametrize(("chunk", "probe", "k"), [(3, 1, 2), (500, 2, 7)])
def test_equals_scoring_every_posting(spark, tmp_path, chunk, probe, k):
    asked = [(1, "w0 w1 w40 w41"), (2, "w59"), (3, "w3 W3 w3 w9 nowhere"), (4, ""), (5, None), (6, " ".join(WORDS)), (7, "w0")]
    docs, queries = tables(spark, corpus(1, 200) + [(900, None), (901, "")], asked)
    index = Bm25Index.build(docs, f"{tmp_path}/index", chunk=chunk)
    want = ranking(S.bm25_top(queries, S.build_index(docs), k))
    assert ranking(index.top(queries, k, probe)) == want and want


def test_fewer_postings_are_read_for_fewer_results_and_rare_words(spark, tmp_path):
    docs, queries = tables(spark, corpus(2, 1500), [(1, "w0 w50"), (2, "w1 w55 w57")])
    index = Bm25Index.build(docs, f"{tmp_path}/index", chunk=10)
    few, many = index.postings_read(queries, 1), index.postings_read(queries, 200)
    read = lambda x: x["first"] + x["essential"] + x["rest"]
    assert few["bounds"] == many["bounds"] == sum(w in t.split() for _, t in corpus(2, 1500) for w in ("w0", "w50", "w1", "w55", "w57"))
    assert read(few) < 0.5 * few["bounds"] and read(few) < read(many) <= many["bounds"]
    assert ranking(index.top(queries, 200)) == ranking(S.bm25_top(queries, S.build_index(docs), 200))


def test_repeated_ids_no_ids_and_an_empty_table(spark, tmp_path):
    docs, queries = tables(spark, [(1, "a b"), (1, "a c"), (2, "a"), (None, "a a a"), (3, "d d")], [(1, "a c"), (None, "a")])
    one, _ = tables(spark, [(1, "a b a c"), (2, "a"), (3, "d d")], [(1, "a")])
    got = ranking(Bm25Index.build(docs, f"{tmp_path}/index").top(queries, 5))
    assert got == ranking(S.bm25_top(queries.where("query_id = 1"), S.build_index(one), 5))
    empty = Bm25Index.build(docs.limit(0), f"{tmp_path}/empty")
    assert empty.top(queries, 5).collect() == [] and empty.postings_read(queries, 5)["bounds"] == 0
    assert Bm25Index.build(docs, f"{tmp_path}/index2").top(queries.limit(0), 5).collect() == []


def test_text_ids_and_ties(spark, tmp_path):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x y"), ("c", "z z"), ("d", "z q"), ("e", "q")], "doc string, body string")
    index = Bm25Index.build(docs, f"{tmp_path}/index", item="doc", text="body", chunk=1)
    got = index.top(spark.createDataFrame([("q", "x")], "query_id string, query string"), 1, probe=1).collect()
    assert [(r["query_id"], r["rank"], r["item_id"]) for r in got] == [("q", 1, "a")]


def moved(spark):
    """Rows that stages of the session have shuffled."""
    context, new = spark.sparkContext, spark.sparkContext._gateway.new_array
    context._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    stages = context._jsc.sc().statusStore().stageList(spark._jvm.java.util.ArrayList(), False, False, new(spark._jvm.double, 0), spark._jvm.java.util.ArrayList())
    return {stages.apply(k).stageId(): stages.apply(k).shuffleWriteRecords() for k in range(stages.size())}


def test_no_row_per_posting_moves(spark, tmp_path):
    passages = [(k, " ".join(WORDS[k:] + WORDS[:k])) for k in range(20)]
    docs, queries = tables(spark, corpus(3, 1500), passages)
    before = moved(spark)
    found = Bm25Index.build(docs, f"{tmp_path}/index").top(queries, 5).collect()
    rows = sum(n for stage, n in moved(spark).items() if stage not in before)
    assert found and rows < sum(len(set(t.split())) for _, t in corpus(3, 1500))


def test_scores_are_added_up_where_their_rows_are_made(spark, monkeypatch):
    docs, queries = tables(spark, corpus(4, 300), [(1, "w0 w1 w40 w1"), (2, "w59 w0")])
    scores = S.bm25_scores(queries, S.build_index(docs, asked=queries))
    plan = scores._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(query_id" not in plan.split("BroadcastExchange")[0]
    want = ranking(S.bm25_top(queries, S.build_index(docs, asked=queries), 5))
    monkeypatch.setattr(S, "ASKED", 0)
    assert ranking(S.bm25_top(queries, S.build_index(docs, asked=queries), 5)) == want and want
