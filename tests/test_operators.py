import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docmill.functions.urls import BINARY_PATTERNS, UrlFilter
from docmill.operators import blocks as B
from docmill.operators import chunks as K
from docmill.operators import clean as C
from docmill.operators import crawl as W
from docmill.operators import embeddings as V
from docmill.operators import evaluate as E
from docmill.operators import search as S

FENCE = "```"


def split(spark, *texts):
    rows = B.measure_blocks(B.split_blocks(spark.createDataFrame(list(enumerate(texts)), "doc long, markdown_content string"))).orderBy("doc", "block_idx").collect()
    return [[r for r in rows if r.doc == k] for k in range(len(texts))]


def test_blocks(spark):
    first, glued, spaced, inline = split(
        spark,
        f"# T\n\nPara one\n- item\n{FENCE}py\nx = 1\n\ny = 2\n{FENCE}\n|a|b|\n|---|---|\n|1|2|\nend",
        f"|a|\n|---|\n{FENCE}\nx\n{FENCE}\nt",
        "| a |\n| --- |\n| 1 |",
        f"a {FENCE}x{FENCE} b\nnext",
    )
    kinds = [next((k for k in ("is_heading", "is_list", "is_code", "is_table") if r[k]), "") for r in first]
    assert kinds == ["is_heading", "", "is_list", "is_code", "is_table", ""]
    assert [r.position_ratio for r in first] == [k / 6 for k in range(6)] and "\n\n" in first[3].content
    assert [r.content for r in glued] == [f"|a|\n|---|\n{FENCE}\nx", FENCE, "t"] and glued[1].is_code
    assert len(spaced) == 1 and not spaced[0].is_table
    assert len(inline) == 2


def _scored(spark, **block):
    base = {"doc": 0, "block_idx": 5, "content": "c", "content_hash": "h", "is_code": False, "is_heading": False, "is_table": False, "is_list": False, "position_ratio": 0.5, "word_count": 20, "unique_word_ratio": 1.0, "link_count": 0, "link_density": 0.0}
    block = base | block
    n = block.pop("n_docs", 1)
    rows = [block | {"doc": k} for k in range(n)]
    schema = "doc long, block_idx int, content string, content_hash string, is_code boolean, is_heading boolean, is_table boolean, is_list boolean, position_ratio double, word_count long, unique_word_ratio double, link_count long, link_density double"
    frame = spark.createDataFrame([tuple(r[c.split()[0]] for c in schema.split(", ")) for r in rows], schema)
    return C.score_blocks(frame, 100).orderBy("doc").head()


def test_scores(spark):
    one = _scored(spark, n_docs=96, word_count=5)
    assert (one.boilerplate_score, one.is_removed) == (5.0, True) and one.removal_reason.endswith(C.TIERS[0])
    two = _scored(spark, n_docs=50, position_ratio=0.0, link_density=0.9, link_count=1, word_count=4)
    assert two.boilerplate_score == 9.5 and two.is_removed and C.TIERS[1] in two.removal_reason and len(two.triggered_signals) == 4
    long = _scored(spark, n_docs=5, word_count=40)
    assert (long.boilerplate_score, long.triggered_signals, long.is_removed) == (-3.0, [], False)
    code = _scored(spark, n_docs=99, is_code=True, word_count=3)
    assert (code.boilerplate_score, code.is_removed) == (0.0, False)


@pytest.mark.parametrize(("n", "code", "listed", "expected"), [(0, 0, 0, "uncategorized"), (5, 5, 0, "overview"), (10, 3, 0, "reference"), (12, 0, 3, "tutorial"), (12, 0, 0, "guide")])
def test_categories(spark, n, code, listed, expected):
    assert spark.range(1).select(C.category(F.lit(n), F.lit(code), F.lit(listed)).alias("c")).head().c == expected


def test_documents_without_blocks_stay(spark):
    docs = spark.createDataFrame([(1, "  "), (2, "a b\n\n|x|\n|---|\n|1|")], "doc long, markdown_content string")
    out = {r.doc: r for r in C.process_documents(docs, C.score_blocks(B.measure_blocks(B.split_blocks(docs)), 2)).collect()}
    assert out[1].page_category == "uncategorized" and out[1].blocks_retained == 0 and out[1].retention == 0
    assert out[2].tables_before == 2 and out[2].retention == 100


def blocks(*items):
    return [K.Section("S", 1, ["S"], [K.Block(f"{kind}{k}", kind, n, k) for k, (kind, n) in enumerate(items)])]


@pytest.mark.parametrize(
    ("items", "expected"),
    [
        ([("text", 300), ("text", 300), ("text", 150), ("text", 100)], [[300, 300, 150], [100]]),
        ([("text", 700), ("text", 100), ("text", 60)], [[700, 100], [100, 60]]),
        ([("text", 500), ("code", 400), ("text", 50)], [[500], [400, 50]]),
        ([("text", 700), ("text", 100), ("text", 750)], [[700, 100], [100, 750]]),
    ],
)
def test_pack(items, expected):
    got = K.pack(blocks(*items), K.ChunkConfig())
    assert [[b.tokens for b in c.blocks] for c in got] == expected
    assert [c.oversized for c in got] == [sum(x) > 800 for x in expected]


@settings(deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["text", "code", "table"]), st.integers(1, 900)), max_size=15))
def test_packing_keeps_every_block_in_order(items):
    got = K.pack(blocks(*items), K.ChunkConfig())
    seen = []
    for c in got:
        own = [b.start for b in c.blocks]
        seen += [s for s in own if not seen or s > seen[-1]]
        carried = [b for b in c.blocks if b.start < (seen[-1] if seen else 0)]
        assert c.tokens <= 800 or len(c.blocks) == 1 or carried
    assert seen == list(range(len(items)))


def test_heading_paths_and_merging(spark):
    docs = spark.createDataFrame([(1, "# A\n### B\n## C\n# D")], "doc long, markdown_content string")
    assert [r.heading_path for r in K.heading_paths(docs).orderBy("section").collect()] == [["A"], ["A", "B"], ["A", "C"], ["D"]]
    assert [s.path for s in K.parse("# A\n### B\n## C\n# D", K.estimate)] == [["A"], ["A", "B"], ["A", "C"], ["D"]]
    body = " ".join(f"w{k}" for k in range(300))
    rows = [("http://e.com/1", "T", f"# A\n\n## B\n\n{body}\n\n## C\n\n{body}\n\n{FENCE}py\nx\n{FENCE}"), ("http://e.com/2", None, "text"), ("http://e.com/3", "T", " \n"), ("http://e.com/4", "T", "only")]
    got = K.chunk_documents(spark.createDataFrame(rows, "url string, title string, markdown_content string")).orderBy("source_url", "chunk_index").collect()
    assert [(r.source_url[-1], r.heading_path, r.chunk_index, r.total_chunks, r.tiny_chunk_merged) for r in got] == [("1", ["A", "B"], 0, 2, True), ("1", ["A", "C"], 1, 2, False), ("4", [], 0, 1, False)]
    assert got[1].code_languages == ["py"] and got[1].content_type == "mixed" and got[0].chunk_id.endswith("_chunk_000") and got[1].chunk_id.endswith("_chunk_002")


def test_estimators_agree(spark):
    from docmill.functions.text import estimated_tokens

    texts = ["It's é_1, ok!", "", "a-b  c\n\td", "x²½ 漢字"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(estimated_tokens(F.col("t")).alias("n")).collect()
    assert [r.n for r in got] == [K.estimate(t) for t in texts]


def test_embeddings(spark):
    vectors = lambda *v: spark.createDataFrame(list(enumerate(v)), "vec_id long, embedding array<float>")
    assert V.validate(vectors([1.0, 0.0], [0.0, 1.0]), 2).head().is_valid
    assert V.validate(vectors([1.0], [0.0, 1.0]), 2).head().reason == "dimension mismatch"
    assert V.validate(vectors(), 2).head().reason == "empty"
    zero = V.validate(vectors([0.003, 0.0]), 2).head()
    assert zero.zero_vectors == 1 and zero.reason == "zero vectors" and V.norm_audit(vectors([0.003, 0.0])).head().near_zero_vectors == 0
    assert V.norm_audit(vectors([3.0, 4.0])).head().stdev_norm == 0
    r = random.Random(1)
    many = [[r.gauss(0, 1) for _ in range(4)] for _ in range(80)]
    many += [[2 * x for x in many[3]], [0.0] * 4]
    got = V.near_duplicates(vectors(*many), 0.99).collect()
    assert (got[0].id_a, got[0].id_b, got[0].similarity) == (3, 80, 1.0)
    embedded = V.embed(spark.createDataFrame([("a b a",), ("",)], "chunk_text string"), dims=16)
    norms = embedded.select(V.squared_norm(F.col("embedding")).alias("n")).collect()
    assert sorted(round(x.n, 5) for x in norms) == [0, 1]

    def failing(texts):
        raise RuntimeError

    report = V.embedding_report(V.embed(spark.createDataFrame([("a",)], "chunk_text string"), failing)).head()
    assert (report.processed, report.failures) == (0, 1)


def test_bm25_rrf_and_clamp(spark):
    docs = spark.createDataFrame([(1, "a b b"), (2, "b c"), (3, "c c d e"), (4, "b")], "item_id long, text string")
    queries = spark.createDataFrame([(9, "B c c")], "query_id long, query string")
    scores = {r.item_id: r.score for r in S.bm25_scores(queries, S.build_index(docs)).collect()}
    assert scores == pytest.approx({1: 0.113731, 2: 0.093110, 3: 0.0, 4: 0.116068}, abs=1e-6)
    assert [r.item_id for r in S.bm25_top(queries, S.build_index(docs), 3).orderBy("rank").collect()] == [4, 1, 2]
    ranking = lambda *items: spark.createDataFrame([(9, k + 1, i) for k, i in enumerate(items)], "query_id long, rank int, item_id string")
    fused = S.fuse(ranking("a", "b"), ranking("b", "c")).orderBy("rank").collect()
    assert [(r.item_id, r.score) for r in fused] == [("b", 0.03252247), ("a", 0.01639344), ("c", 0.01612903)]
    clamp = spark.createDataFrame([(0.2,), (1.0,), (1.3,)], "d double").select(F.round(S.similarity(F.col("d")), 6).alias("s"))
    assert [r.s for r in clamp.collect()] == [0.8, 0.0, 0.0]


def test_dense_metrics_and_passes(spark, monkeypatch):
    monkeypatch.setattr(S, "MOST", 1)
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.6, 0.8]), (3, [0.0, 0.0]), (4, [2.0, 0.0])], "item_id long, vector array<double>").repartition(3)
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "query_id long, vector array<double>")
    got = [tuple(r) for r in S.dense_top_k(queries, vectors, 2).orderBy("query_id", "rank").collect()]
    assert got == [(1, 1, 1, 1.0), (1, 2, 4, 1.0), (2, 1, 2, 0.8), (2, 2, 1, 0.0)]
    assert S.dense_top_k(queries, vectors, 1, "l2").where("query_id = 1").head().item_id == 1
    assert S.dense_top_k(queries, vectors, 1, "ip").where("query_id = 1").head().item_id == 4
    assert S.dense_top_k(queries.limit(0), vectors, 1).count() == 0


def test_evaluation(spark):
    queries = E.with_defaults(
        spark.createDataFrame(
            [(1, "q", ["guide"], None), (2, "q", ["a-b"], ["Set Up"]), (3, "r", [], None), (4, "s", ["zz"], None)], "query_id long, query string, acceptable_documents array<string>, acceptable_headings array<string>"
        )
    )
    rows = spark.createDataFrame(
        [(1, 1, 10, "http://x/other", "", None), (1, 2, 11, "http://x/guide", "", None), (2, 1, 12, "http://x/A_B/c", "Intro", ["Intro"]), (2, 2, 13, "http://x/a-b", "How to set up it", None), (3, 1, 14, "any", "", None)],
        "query_id long, rank int, item_id long, identifier string, section_title string, heading_path array<string>",
    )
    got = E.classify(rows, queries)
    kinds = {r.item_id: (r.match_type, r.matching_rule) for r in got.collect()}
    assert kinds == {10: (E.NO_MATCH, ""), 11: (E.EXACT, E.SUBSTRING_RULE), 12: (E.PARTIAL, E.TOKEN_RULE), 13: (E.EXACT, E.SUBSTRING_RULE), 14: (E.NO_MATCH, "")}
    ranked = E.ranks(got, queries)
    assert {r.query_id: (r.first_hit_rank, r.first_exact_rank, r.best_match_type) for r in ranked.collect()} == {1: (2, 2, E.EXACT), 2: (1, 2, E.EXACT), 3: (-1, -1, E.WRONG), 4: (-1, -1, E.NO_MATCH)}
    three = spark.createDataFrame([(1,), (4,), (-1,)], "first_hit_rank int")
    m = E.metrics(three).head()
    assert (m.recall_at_1, m.recall_at_3, m.recall_at_5, m.mrr) == pytest.approx((1 / 3, 1 / 3, 2 / 3, 1.25 / 3))
    assert E.metrics(three.limit(0)).head().mrr == 0
    i = E.integrity(queries).head()
    assert (i.repeated, i.no_documents, i.ok) == (1, 1, False)
    paths = spark.createDataFrame([('["A", "B"]',), ("A > B",), ('"x"',), ("7",)], "p string").select(E.heading_path(F.col("p")).alias("p")).collect()
    assert [r.p for r in paths] == [["A", "B"], ["A", "B"], ["x"], ["7"]]
    with pytest.raises(Exception, match="query is missing"):
        E.with_defaults(spark.createDataFrame([(None,)], "query string")).collect()


def test_crawl_is_breadth_first_and_capped(spark):
    site = "http://e.com/"
    pages = spark.createDataFrame([(site + n, [site + x for x in links]) for n, links in {"a": ["b", "c", "z.pdf"], "b": ["a", "d#x"], "c": ["d", "c?hl=en"], "d": ["e"], "e": []}.items()], "url string, outgoing_links array<string>")
    pages = pages.unionByName(spark.createDataFrame([(site + "d#x", [site + "e"])], "url string, outgoing_links array<string>"))
    seeds = spark.createDataFrame([(site + "a",)], "url string")
    rules = UrlFilter(exclude_patterns=BINARY_PATTERNS)
    got = [(r.url.removeprefix(site), r.depth) for r in W.crawl(pages, seeds, rules).orderBy("depth", "order").collect()]
    assert got == [("a", 0), ("b", 1), ("c", 1), ("d#x", 2), ("e", 3)]
    assert W.crawl(pages, seeds, rules, W.CrawlLimits(max_pages=2)).count() == 2
    assert W.crawl(pages, seeds, rules, W.CrawlLimits(max_depth=1)).count() == 3
    assert W.crawl(pages, seeds.limit(0), rules).count() == 0


def test_store_readers_and_streaming(spark, tmp_path):
    from docmill.sources.readers import read_documents, read_manifest, read_queries, versions
    from docmill.sources.store import read_index, write_index
    from docmill.sources.writers import write_embeddings
    from docmill.streaming.ingest import fresh, ingest, read_stream

    docs = tmp_path / "docs"
    docs.mkdir()
    for k, url in enumerate(("http://e.com/a", "http://e.com/a#x", "http://e.com/b.pdf", "http://e.com/c")):
        (docs / f"{k}.json").write_text(json.dumps({"url": url, "title": "t", "markdown_content": "x", "crawl_depth": 0, "crawled_at": "2024-01-01T00:00:00"}))
    (docs / "bad.json").write_text("{")
    assert read_documents(spark, str(docs)).count() == 4
    assert sum(r._corrupt_record is not None for r in read_documents(spark, str(docs), keep_bad=True).collect()) == 1
    (docs / "bad.json").unlink()
    stream = ingest(fresh(read_stream(spark, str(docs)), UrlFilter(exclude_patterns=BINARY_PATTERNS)), str(tmp_path / "out"), str(tmp_path / "cp"))
    stream.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    (tmp_path / "q.json").write_text(json.dumps([{"query": "a"}, {"query": "b", "difficulty": "hard"}]))
    assert {(r.query, r.difficulty, r.category) for r in read_queries(spark, str(tmp_path / "q.json")).collect()} == {("a", "medium", "Concept"), ("b", "hard", "Concept")}
    assert read_manifest(spark, str(tmp_path / "none.json")).head().distance_metric == "cosine"
    for v in ("v1", "v12", "x"):
        (tmp_path / "ver" / v).mkdir(parents=True)
    assert versions(spark, str(tmp_path / "ver")).count() == 3
    write_index(spark.createDataFrame([(1, "a b"), (2, "b")], "item_id long, text string"), str(tmp_path / "index"))
    assert read_index(spark, str(tmp_path / "index"))["postings"].count() == 3
    vectors = spark.createDataFrame([(1, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert write_embeddings(vectors, str(tmp_path / "e1"), 2) and not write_embeddings(vectors, str(tmp_path / "e2"), 3) and not (tmp_path / "e2" / "embeddings").exists()


def test_index_of_asked_terms_gives_the_scores_of_the_whole_one(spark):
    docs = spark.createDataFrame([(k, " ".join(f"t{(k * j) % 7}" for j in range(k + 1))) for k in range(12)] + [(99, None)], "item_id long, text string")
    queries = spark.createDataFrame([(1, "t1 t2 t2"), (2, "t0"), (3, None), (4, "none")], "query_id long, query string")
    whole, some = (S.bm25_scores(queries, x).collect() for x in (S.build_index(docs), S.build_index(docs, asked=queries)))
    assert sorted(map(tuple, whole)) == sorted(map(tuple, some)) and whole
    assert {r.term for r in S.build_index(docs, asked=queries)["terms"].collect()} == {"t0", "t1", "t2"}


def test_sinks_and_a_store_from_a_folder(spark, tmp_path):
    from docmill.operators import chunks as K
    from docmill.operators import embeddings as V
    from docmill.operators import evaluate as E
    from docmill.sources import readers, writers
    from docmill.sources.store import VectorStore

    docs = spark.createDataFrame([(f"http://e.com/{k}", f"T{k}", f"# T{k}\n\n" + "some words here. " * 300) for k in range(3)], "url string, title string, markdown_content string")
    chunks = K.chunk_documents(docs)
    n = chunks.count()
    writers.write_chunks(chunks, f"{tmp_path}/c", "v2", "v1", 3)
    assert spark.read.json(f"{tmp_path}/c/chunking_manifest").head().asDict() == {"chunking_version": "v2", "source_processed_version": "v1", "total_documents": 3, "total_chunks": n}
    assert readers.read_chunks(spark, f"{tmp_path}/c/chunks").count() == n
    writers.write_chunk_stats(chunks, f"{tmp_path}/s")
    report = spark.read.json(f"{tmp_path}/s").head()
    assert report.stats.chunks == n and report.config.max_tokens == 800
    embedded = V.embed(chunks, dims=8).withColumn("embedded_at", F.lit(None).cast("timestamp"))
    writers.write_embedded_chunks(embedded, f"{tmp_path}/e")
    files = [f for f in (tmp_path / "e").glob("part-*.json") if f.stat().st_size]
    assert len(files) == n
    (tmp_path / "e" / "bad.json").write_text("{ no json")
    store = VectorStore(spark, f"file://{tmp_path}/store")
    assert store.load_folder(f"{tmp_path}/e") == (n, 1) and store.load_folder(f"{tmp_path}/e") == (0, 1) and store.size() == n
    queries = E.with_defaults(spark.createDataFrame([(1, "q", ["doc-1"])], "query_id long, query string, acceptable_documents array<string>"))
    found = spark.createDataFrame([(1, 1, 7, "doc-1", "s", None)], "query_id long, rank int, item_id long, identifier string, section_title string, heading_path array<string>")
    classified = E.classify(found, queries)
    ranked = E.ranks(classified, queries).join(S.with_latency(found, search_ms=6.0).select("query_id", "total_ms"), "query_id")
    writers.write_evaluation(ranked, classified, queries, f"{tmp_path}/v", "set", "store")
    got = spark.read.json(f"{tmp_path}/v/evaluation_metrics").head()
    assert got.recall_at_1 == 1.0 and got.avg_latency_ms == 6.0 and got.dataset_used == "set"
    assert "- **Recall@1**: 1.00" in (r.value for r in spark.read.text(f"{tmp_path}/v/evaluation_summary").collect())
    assert spark.read.json(f"{tmp_path}/v/benchmark_reliability_report").head().dataset_quality == "High"
    for _ in range(2):
        writers.append_queries(queries, f"{tmp_path}/q")
    assert spark.read.json(f"{tmp_path}/q").count() == 2


def test_callbacks(spark):
    from docmill.operators import callbacks as B

    def fetch(url):
        if url.endswith("bad"):
            raise OSError("no route")
        return (200, "<html lang='en'><p>some text</p></html>") if url.endswith("a") else (404, "")

    pages = B.fetch_pages(spark.createDataFrame([("http://e.com/a",), ("http://e.com/a",), ("http://e.com/b",), ("http://e.com/bad",)], "url string"), fetch, pause=0.0, tasks=2)
    assert {r.url[13:]: (r.status_code, r.error) for r in pages.collect()} == {"a": (200, None), "b": (404, None), "bad": (None, "OSError: no route")}
    assert {r.url[13:]: r.failure for r in W.parse_pages(pages).collect()} == {"a": None, "b": "HTTP 404", "bad": "HTTP ?"}

    def ask(prompt):
        assert prompt.startswith("Ask about: ")
        if "two" in prompt:
            return "no json"
        if "three" in prompt:
            raise ValueError("bad key")
        return '```json\n{"query": "What {x}?", "difficulty": "hard"}\n```'

    chunks = spark.createDataFrame([("u1", ["H"], "one"), ("u2", None, "two"), ("u3", None, "three")], "source_url string, heading_path array<string>, chunk_text string")
    got = {r.acceptable_documents[0]: r for r in B.generate_questions(chunks, ask, "Ask about: {text}", pause=0.0).collect()}
    assert (got["u1"].query, got["u1"].expected_topic, got["u1"].difficulty, got["u1"].acceptable_headings, got["u1"].error) == ("What {x}?", "Unknown", "hard", ["H"], None)
    assert got["u2"].query is None and "JSONDecodeError" in got["u2"].error and got["u3"].error == "ValueError: bad key"


def test_a_call_over_the_quota_is_tried_again():
    from docmill.operators.callbacks import QUOTA, paced

    calls = []

    def call(x):
        calls.append(x)
        if len(calls) < 3:
            raise RuntimeError("429 too many")
        return x

    assert paced(call, 0.0, 0.0, 5, lambda e: QUOTA[0] in e)(7) == 7 and len(calls) == 3
    calls.clear()
    import pytest

    with pytest.raises(RuntimeError):
        paced(call, 0.0, 0.0, 5, lambda e: False)(7)


def test_crawl_says_thresholds_and_progress(spark, caplog):
    import logging

    pages = spark.createDataFrame([("http://e.com/0", ["http://e.com/1", "http://e.com/2"]), ("http://e.com/1", []), ("http://e.com/2", [])], "url string, outgoing_links array<string>")
    with caplog.at_level(logging.INFO, "docmill.operators.crawl"):
        W.crawl(pages, pages.select("url").limit(1), UrlFilter(), W.CrawlLimits(soft_pages=2, warning_pages=3))
    said = [r.getMessage() for r in caplog.records]
    assert "soft limit of 2 pages reached" in said and "warning limit of 3 pages reached" in said and any("queued 2" in x for x in said)
    assert W.progress(10, 7200, 10.0).endswith("2.0 h left")


def test_blocks_are_cut_where_documents_are_read(spark):
    texts = ["a\n\u00a0\n b \u2003\n\x1c", "```\nx\n\n|y|\n```\n| a |\n|---|\nz", "|p|\n```q```\n```\n|r|", "", None, "|\n|\n\n``` ```\nend"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc long, markdown_content string")
    blocks = B.split_blocks(docs)
    assert "Exchange" not in B.measure_blocks(blocks)._jdf.queryExecution().executedPlan().toString()
    got = [(r["doc"], r["block_idx"], r["content"], r["n_blocks"]) for r in blocks.orderBy("doc", "block_idx").collect()]
    want = [["a", "b", "\x1c"], ["```\nx\n\n|y|\n```", "| a |\n|---|", "z"], ["|p|", "```q```", "```\n|r|"], [], [], ["|\n|", "``` ```", "end"]]
    assert got == [(d, k, c, len(w)) for d, w in enumerate(want) for k, c in enumerate(w)]


def test_contents_of_blocks_move_once(spark):
    docs = spark.createDataFrame([(k, f"common\nown {k}\n[x](http://x) [y](http://y)\ncommon") for k in range(9)], "doc long, markdown_content string")
    scored = C.score_blocks(B.measure_blocks(B.split_blocks(docs)), 9)
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") == 1 and "content_hash#" not in "".join(x for x in plan.split("\n") if "Join LeftOuter" in x)
    assert {(r["doc"], r["block_idx"], round(r["document_frequency"], 4)) for r in scored.collect()} == {(d, k, 0.1111 if k == 1 else 1.0) for d in range(9) for k in range(4)}


def test_any_names_of_contents_are_counted_as_they_are(spark):
    """Not md5 alone: a name that is no hexadecimal number has a frequency, and names of one number are not the same."""
    names = ["h", "h", "h", "a", "0a", "0A", "A", "", "", None, None, "-" * 17, "2d" * 16, "2d" * 16, "2D" * 16, "-" * 16]
    docs = spark.createDataFrame([(k, "text") for k in range(len(names))], "doc long, markdown_content string")
    measured = B.measure_blocks(B.split_blocks(docs)).withColumn("content_hash", F.element_at(F.array(*map(F.lit, names)), F.col("doc").cast("int") + 1))
    got = {r["doc"]: round(r["document_frequency"] * 100) for r in C.score_blocks(measured, 100).collect()}
    assert got == {k: 1 if x is None else names.count(x) for k, x in enumerate(names)}
