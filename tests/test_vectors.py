"""Vector search, the index, near duplicates and the checks of vectors, against plain loops."""

import math
import random

import numpy as np
import pytest

from docmill.operators import embeddings as V
from docmill.operators import search as S
from docmill.operators.vectors import best, fit_centroids
from docmill.sources.store import VectorStore
from docmill.sources.vector_index import VectorIndex
from docmill.sources.writers import write_embeddings

METRICS = ("cosine", "l2", "ip")


def clustered(seed, n, dims=6, centers=8):
    draw = np.random.default_rng(seed)
    middle = draw.normal(size=(centers, dims)) * 3
    rows = middle[draw.integers(0, centers, n)] + draw.normal(size=(n, dims)) * 0.4
    rows[: n // 20] = rows[0]  # copies
    rows[n // 20] = 0
    return [(k, [float(x) for x in r]) for k, r in enumerate(rows)]


BAD = [(10_001, None), (10_002, [1.0]), (10_003, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (None, [1.0] * 6), (10_004, [math.nan] * 6)]


def frame(spark, rows, key="item_id", kind="long"):
    return spark.createDataFrame(rows, f"{key} {kind}, vector array<double>")


def plain(queries, vectors, k, metric):
    out = []
    for q, x in queries:
        scored = []
        for i, v in vectors:
            x, v = np.array(x), np.array(v)
            if metric == "l2":
                d = ((x - v) ** 2).sum()
            else:
                scale = np.linalg.norm(x) * np.linalg.norm(v) if metric == "cosine" else 1.0
                d = 1 - (x @ v / scale if scale else 0.0)
            scored.append((-(round(1 - d, 6) + 0.0 if d <= 1 else 0.0), i))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def same(got, want):
    got = sorted(map(tuple, got))
    assert [r[:3] for r in got] == [r[:3] for r in want] and np.allclose([r[3] for r in got], [r[3] for r in want], atol=1.1e-6)


@pytest.mark.parametrize("metric", METRICS)
def test_scan_and_index_equal_plain_search(spark, tmp_path, metric, monkeypatch):
    rows, asked = clustered(1, 300), [(k, v) for k, v in clustered(2, 30) if k > 5] + [(999, [0.0] * 6)]
    want = plain(asked, rows, 4, metric)
    vectors, queries = frame(spark, rows + BAD).repartition(3), frame(spark, asked + [(5000, None), (5001, [1.0]), (None, [1.0] * 6)], "query_id")
    same(S.dense_top_k(queries, vectors, 4, metric).collect(), want)
    index = VectorIndex.build(vectors, f"{tmp_path}/index", metric)
    same(index.query(queries, 4).collect(), want)
    if metric == "cosine":
        same(VectorIndex(spark, f"{tmp_path}/index").query(queries, 4, probe=1).collect(), want)
        assert index.query(queries.limit(0), 4).count() == 0 and S.dense_top_k(queries, vectors.limit(0), 4, metric).count() == 0
    monkeypatch.setattr(S, "MOST", 1)  # too many queries for a broadcast
    same(S.dense_top_k(queries, vectors, 4, metric).collect(), want)


def test_text_keys_and_more_asked_than_there_is(spark, tmp_path):
    rows = [("b", [1.0, 0.0]), ("a", [1.0, 0.0]), ("é", [0.0, 1.0])]
    vectors, queries = frame(spark, rows, kind="string"), frame(spark, [("q", [1.0, 0.1])], "query_id", "string")
    want = [("q", 1, "a"), ("q", 2, "b"), ("q", 3, "é")]
    index = VectorIndex.build(vectors, f"{tmp_path}/index")
    assert sorted(tuple(r)[:3] for r in S.dense_top_k(queries, vectors, 9).collect()) == want == sorted(tuple(r)[:3] for r in index.query(queries, 9).collect())


def test_index_reads_only_the_cells_it_needs(spark, tmp_path):
    rows = clustered(3, 400)
    index = VectorIndex.build(frame(spark, rows), f"{tmp_path}/index", cells=16)
    queries = frame(spark, [(1, rows[100][1]), (2, rows[101][1])], "query_id")
    want = plain([(1, rows[100][1]), (2, rows[101][1])], rows, 3, "cosine")
    first, more = index.cells_of(queries, 3, 1, True)
    near = {r["cell"] for r in more.collect()}
    home = {r["cell"] for r in index.vectors().where("item_id IN (100, 101)").collect()}
    spoilt = 0
    for folder in (tmp_path / "index/vectors").glob("cell=*"):
        if int(folder.name[5:]) not in near | home:
            for file in folder.glob("*.parquet"):
                file.write_bytes(b"not to be read")
                spoilt += 1
    assert spoilt >= 8
    for crc in (tmp_path / "index/vectors").rglob(".*.crc"):
        crc.unlink()
    same(VectorIndex(spark, f"{tmp_path}/index").query(queries, 3, probe=1).collect(), want)


def test_calibrated_recall(spark, tmp_path):
    rows = clustered(4, 900, centers=30)
    index = VectorIndex.build(frame(spark, rows), f"{tmp_path}/index", cells=25)
    probe = index.calibrate(5)
    assert 1 <= probe < 13 and VectorIndex(spark, f"{tmp_path}/index").probe == probe
    asked = [(k, [x + 0.05 for x in v]) for k, v in rows[100:180]]
    true = {r[:1] + r[2:3] for r in plain(asked, rows, 5, "cosine")}
    got = {(r["query_id"], r["item_id"]) for r in index.query(frame(spark, asked, "query_id"), 5, exact=False).collect()}
    assert len(true & got) >= 0.9 * len(true)


def test_store_keeps_its_index_up_to_date(spark, tmp_path):
    def chunks(rows):
        head = ", ".join(f"'{c}' AS {c}" for c in ("source_url", "source_document", "title", "section_title", "content_type", "document_version", "chunk_version"))
        counts = ", ".join(f"1 AS {c}" for c in ("chunk_index", "total_chunks", "token_count"))
        return frame(spark, rows).selectExpr("CAST(item_id AS STRING) AS chunk_id", "vector AS embedding", *[x.strip() for x in f"{head}, {counts}".split(", ")], "array('h') AS heading_path", "'text' AS chunk_text")

    rows = clustered(5, 120)
    queries = frame(spark, rows[60:63], "query_id")
    store = VectorStore(spark, f"{tmp_path}/store")
    store.load(chunks(rows[:80]))
    scanned = sorted((r["query_id"], r["rank"], r["item_id"]) for r in store.query(queries, 5).collect())
    store.build_index(6)
    assert sorted((r["query_id"], r["rank"], r["item_id"]) for r in store.query(queries, 5).collect()) == scanned
    assert store.load(chunks(rows)) == 40 and store.index().vectors().count() == 120
    want = [(q, r, str(i)) for q, r, i, _ in plain(rows[60:63], [(str(k), v) for k, v in rows], 5, "cosine")]
    assert sorted((r["query_id"], r["rank"], r["item_id"]) for r in VectorStore(spark, f"{tmp_path}/store").query(queries, 5).collect()) == sorted(want)
    cells = {r["cell"]: r for r in spark.read.parquet(f"{tmp_path}/store/index/cells").collect()}
    assert sum(r["n"] for r in cells.values()) == 120
    assert all(r["gap"] <= cells[r["cell"]]["radius"] for r in store.index().vectors().collect())


def test_best_breaks_ties_by_item():
    scores = np.array([[0.5, 0.5, 0.5, 0.9], [0.1, 0.2, 0.2, 0.1]])
    q, item, score = best(scores, np.array([7, 3, 5, 9]), 3)
    assert list(zip(q.tolist(), item.tolist(), strict=True)) == [(0, 9), (0, 3), (0, 5), (1, 3), (1, 5), (1, 7)]


def test_centroids_are_the_same_each_time(spark):
    rows = frame(spark, clustered(6, 200))
    one, two = (fit_centroids(rows.repartition(n), 7) for n in (1, 4))
    assert one.shape == (7, 6) and np.allclose(one, two)


# ---- near duplicates


def pairs(rows, threshold, top):
    out = []
    for k, (i, a) in enumerate(rows):
        for j, b in rows[k + 1 :]:
            scale = np.linalg.norm(a) * np.linalg.norm(b)
            c = np.dot(a, b) / scale if scale else 0.0
            if c > threshold and i != j:
                out.append((-round(c, 4), min(i, j), max(i, j)))
    return [(i, j, -s) for s, i, j in sorted(set(out))[:top]]


@pytest.mark.parametrize(("threshold", "top"), [(0.99, 1000), (0.3, 100)])
def test_near_duplicates_equal_all_pairs(spark, monkeypatch, threshold, top):
    for name, value in (("PART", 40), ("TILE", 25)):
        monkeypatch.setattr(V, name, value)
    rows = clustered(7, 260)
    vectors = frame(spark, rows + rows[50:53] + BAD, "vec_id").withColumnRenamed("vector", "embedding").selectExpr("*", "concat('d', vec_id % 7) AS doc")
    got = [tuple(r) for r in V.near_duplicates(vectors, threshold, top).collect()]
    want = pairs(rows, threshold, top)
    assert [g[:2] for g in got] == [w[:2] for w in want] and np.allclose([g[2] for g in got], [w[2] for w in want], atol=1.1e-4)
    with_docs = V.near_duplicates(vectors, threshold, top, payload=("doc",)).collect()
    assert {(r["id_a"], r["id_b"], r["doc_a"], r["doc_b"]) for r in with_docs} == {(a, b, f"d{a % 7}", f"d{b % 7}") for a, b, _ in want}


def test_near_duplicates_of_one_large_group_of_copies(spark):
    rows = [(k, [1.0, 2.0]) for k in range(5000)] + [(9000, [1.0, 2.1])]
    got = [(r["id_a"], r["id_b"]) for r in V.near_duplicates(frame(spark, rows, "vec_id").withColumnRenamed("vector", "embedding"), 0.9, 100).collect()]
    assert got == [(0, k) for k in range(1, 101)]
    assert V.near_duplicates(frame(spark, BAD[:1], "vec_id").withColumnRenamed("vector", "embedding")).collect() == []


# ---- checks


def test_null_vectors_are_not_valid(spark, tmp_path):
    rows = frame(spark, [(1, [1.0, 0.0]), (2, None)]).withColumnRenamed("vector", "embedding")
    assert tuple(V.validate(rows, 2).select("is_valid", "reason", "null_vectors").head()) == (False, "null vectors", 1)
    inside = frame(spark, [(1, [1.0, 0.0]), (2, [1.0, None])]).withColumnRenamed("vector", "embedding")
    assert not V.validate(inside, 2).head()["is_valid"]

    def fails(texts):
        if "bad" in texts:
            raise RuntimeError
        return np.ones((len(texts), 2))

    chunks = spark.createDataFrame([(1, "good"), (2, "bad")], "id int, chunk_text string")
    embedded = V.embed(chunks, fails, batch=1)
    assert not write_embeddings(embedded, f"{tmp_path}/out", 2) and not (tmp_path / "out/embeddings").exists()
    assert write_embeddings(embedded.where("id = 1"), f"{tmp_path}/out", 2)


@pytest.mark.parametrize("n", [0, 1, 7, 500])
def test_exact_median(spark, n):
    draw = random.Random(n)
    values = [draw.choice([1.0, 2.0, draw.random(), draw.random() * 1e9]) for _ in range(n)]
    got = V.exact_median(spark.createDataFrame([(v,) for v in values], "x double"), "x", bins=4, few=5)
    assert got == (None if not n else float(np.median(values)))


def test_audits_leave_bad_vectors_out(spark):
    rows = clustered(8, 60)
    good, bad = (frame(spark, r).selectExpr("item_id AS vec_id", "vector AS embedding", "item_id % 3 AS doc", "item_id % 2 AS section") for r in (rows, rows + BAD[:3]))
    assert V.norm_audit(good).drop("total").head() == V.norm_audit(frame(spark, rows + BAD[:1]).withColumnRenamed("vector", "embedding")).drop("total").head()
    assert np.allclose(*[list(V.similarity_health(x).select("same_section", "same_document", "different_document").head()) for x in (good, bad)])


def test_low_thresholds_have_large_cells_and_floats_travel_as_they_are(spark, monkeypatch):
    import random

    from docmill.operators import embeddings

    draw, seen, fit = random.Random(5), [], embeddings.fit_centroids
    monkeypatch.setattr(embeddings, "fit_centroids", lambda rows, cells, **more: seen.append((cells, dict(rows.dtypes)["vector"])) or fit(rows, cells, **more))
    rows = spark.createDataFrame([(k, [draw.gauss(0, 1) for _ in range(6)]) for k in range(1500)], "vec_id long, embedding array<float>")
    low = embeddings.near_duplicates(rows, threshold=0.3, top=20).collect()
    monkeypatch.setattr(embeddings, "HELD", 1000)
    monkeypatch.setattr(embeddings, "MADE", 7)
    monkeypatch.setattr(embeddings, "TILE", 128)
    assert embeddings.near_duplicates(rows, threshold=0.3, top=20).collect() == low and len(low) == 20
    embeddings.near_duplicates(rows, threshold=0.99, top=20).count()
    assert seen == [(1, "array<float>"), (12, "array<float>"), (2, "array<float>")]
