import random
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from docmill.llm.components import components
from docmill.llm.jaccard import GROUPS, CountTree, bounds, digests, gram_sets, one_of_each, op4_ngram_jaccard, points, similar, wanted


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + n]) for k in range(len(words) - n + 1)) if len(words) >= n else frozenset([tuple(words)])


def brute(rows, n, num, den):
    """(doc_id, size, component) of each row, from all pairs."""
    sets = [shingles(t, n) for _, t in rows]
    label = list(range(len(rows)))

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and both * den >= num * (len(sets[a]) + len(sets[b]) - both):
                label[root(a)] = root(b)
    least = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(k)] = min(least.get(root(k), doc), doc)
    return sorted(((doc, len(s), least.get(root(k))) for k, ((doc, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def prose(n, seed):
    r = random.Random(seed)
    return [f"W{r.randint(0, 5000)}" for _ in range(n)]


def corpus():
    rows, r = [], random.Random(3)
    passage = prose(40, "passage")
    for k in range(120):
        words = prose(r.randint(1, 120), k)
        if k % 4 == 0:
            words += passage
        rows.append(words)
    for k in range(0, 60, 2):  # near copies, and copies of near copies
        words = list(rows[k])
        for _ in range(4):
            words[r.randrange(len(words))] = f"e{r.randint(0, 9)}"
            rows.append(list(words))
    big = prose(200, "big")
    for k in range(60):
        words = list(big)
        words[k * 3] = f"x{k}"
        rows.append(words)
    return [(k, " ".join(w)) for k, w in enumerate(rows)] + [(1000 + k, " ".join(rows[k])) for k in range(30)]


def check(spark, rows, n, num, den, schema="doc_id long, text string"):
    got = similar(spark.createDataFrame(rows, schema).repartition(3), n, num, den).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute([r[:2] for r in rows], n, num, den)


def test_against_all_pairs(spark):
    check(spark, corpus(), 4, 85, 100)
    check(spark, corpus(), 5, 80, 100)


def test_split_blocks(spark, monkeypatch):
    monkeypatch.setattr("docmill.llm.jaccard.SPLIT", 7)
    monkeypatch.setattr("docmill.llm.jaccard.NEAREST", 1)
    # all sketch counts alike and no hot n-grams: blocks stay large
    monkeypatch.setattr("docmill.llm.jaccard._common", lambda docs, words: np.zeros(1 << 20, np.uint8))
    check(spark, corpus(), 4, 60, 100)


def test_edge_cases(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \t", "x"), (4, "one two", "x"), (5, "ONE two", "x"), (5, "ONE two", "x"), (6, "one two three", ""), (None, "one two", ""), (None, "alone here", ""), (7, "a b c d " * 9000, ""), (8, "a b c d", "")]
    check(spark, rows, 4, 85, 100, "doc_id long, text string, label string")
    assert similar(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@settings(deadline=None, max_examples=60)
@given(st.lists(st.tuples(st.integers(0, 3), st.sets(st.integers(0, 60), min_size=1, max_size=30)), min_size=1, max_size=40), st.sampled_from([50, 80, 95]))
def test_tree_loses_no_pair(items, num):
    sets = [np.array(sorted(s), np.uint64) for _, s in items]
    first = np.cumsum([0, *map(len, sets)])
    vectors, sizes, labels = points(np.concatenate(sets), first), np.diff(first), np.array([x for x, _ in items])
    tree = CountTree(vectors, sizes, labels)
    found = {(int(a), int(b)) for q, p in tree.pairs(vectors, sizes, labels, num, 100) for a, b in zip(q, p, strict=True)}
    for a in range(len(items)):
        for b in range(len(items)):
            both = len(items[a][1] & items[b][1])
            if labels[a] != labels[b] and both * 100 >= num * (sizes[a] + sizes[b] - both):
                assert (a, b) in found
    for a, b in found:
        assert labels[a] != labels[b]
        assert bounds(vectors[[a]], vectors[[b]], sizes[[a]], sizes[[b]])[0] >= wanted(sizes[a], sizes[b], num, 100)


def test_points_bound_the_overlap_when_counts_are_cut_off():
    sets, first = gram_sets(pa.array([" ".join(f"w{k}" for k in range(40000)), " ".join(f"w{k}" for k in range(39000))]), 4)
    p = points(sets, first)
    assert (p == 255).any() and p.shape == (2, GROUPS)
    n = np.diff(first)
    assert bounds(p[:1], p[1:], n[:1], n[1:])[0] >= 39000 - 3


def test_links_that_only_blocks_of_two_classes_hold(spark):
    """d shares one early member with each of a, b and c; only c is like it, and is the last of the three by name."""
    rows, k = [], 0
    while len(rows) < 12:
        k += 1
        d = [f"w{j}x{k}" for j in range(12)] + [f"p{k}", f"q{k}"]
        a, b = [f"a{k}{j}" for j in range(9)] + d[-6:-1], [f"b{k}{j}" for j in range(9)] + d[-5:]
        texts = [" ".join(x) for x in (a, b, d[:-2], d)]
        sets, first = gram_sets(pa.array(texts), 5)
        a, b, c, d = (set(sets[x : x + keep].tolist()) for x, keep in zip(first, (3, 3, 2, 3)))
        names = digests(sets, first).view(np.int64)
        if len(a & d) == len(b & d) == len(c & d) == 1 and max(names[:2]) < names[2] < names[3]:
            rows += texts
    check(spark, list(enumerate(rows)), 5, 80, 100)


def check_links(spark, rows, n, num, den):
    sets = {doc: shingles(text, n) for doc, text in rows}
    classes = set(sets.values()) - {frozenset()}
    of = {s: sum(len(s & o) * den >= num * len(s | o) for o in classes) - 1 for s in classes}
    got = similar(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), n, num, den).collect()
    assert sorted((r.doc_id, r.n_links) for r in got) == sorted((doc, of.get(s, 0)) for doc, s in sets.items())
    return max(of.values())


def test_all_links_are_counted(spark, monkeypatch):
    rows = [*corpus(), (5000, ""), (5001, None)]
    assert check_links(spark, rows, 5, 80, 100) > 50
    monkeypatch.setattr("docmill.llm.jaccard.SPLIT", 7)
    check_links(spark, rows, 4, 60, 100)
    monkeypatch.setattr("docmill.llm.jaccard.MEMBERS", 1000)
    check_links(spark, rows, 4, 85, 100)


def check_one_of_each(spark, rows):
    names = ["_id", "_null", "_hash", "_bit", "_gone", "_row", "_0", "a.b"]
    frame = spark.createDataFrame([(*r, *[f"{r[2]}{n}" for n in names]) for r in rows], ", ".join(["doc_id long", "text string", "label string", *[f"`{n}` string" for n in names]]))
    got = one_of_each(frame.repartition(3), 5, 80, 100)
    assert got.columns == frame.columns
    want = {(d, t) for d, t, c in brute_components(rows) if c is None or d == c}
    found = got.collect()
    assert sorted(((r.doc_id, r.text) for r in found), key=str) == sorted(want, key=str)
    assert all(r[n] == f"{r.label}{n}" for r in found for n in names)


def test_one_of_each(spark, monkeypatch):
    rows = [(*r, f"s{k}") for k, r in enumerate(corpus())] + [(5000, "same text of six words here", "a"), (5000, "same text of six words here", "a"), (5001, "other text of six words there", "b"), (5001, None, "c"), (None, "other text of six words there", "d"), (None, "no id and no kin at all", "e")]
    check_one_of_each(spark, rows)
    monkeypatch.setattr("docmill.llm.jaccard.MOST_BITS", 0)  # as for so many rows that no filter is made
    check_one_of_each(spark, rows)
    empty = one_of_each(spark.createDataFrame([], "doc_id long, text string, _id long"))
    assert empty.columns == ["doc_id", "text", "_id"] and empty.count() == 0


def test_small_sets_with_many_neighbours(spark):
    """Sets of 5 to 20 shingles, each of which shares single shingles with several others, and some near copies."""
    r, rows = random.Random(11), []
    for k in range(60):
        words = [f"u{k}x{j}" for j in range(r.randint(8, 22))]
        rows.append(words)
        for at in r.sample(range(len(words) - 4), 3):
            rows.append([f"v{k}y{j}z{at}" for j in range(r.randint(4, 10))] + words[at : at + 4])
        for cut in (1, 2):
            rows.append(words[cut:])
            rows.append(words[:-cut])
    check(spark, [(k, " ".join(w)) for k, w in enumerate(rows)], 4, 85, 100)


def test_pairs_of_several_large_blocks_meet_once(spark, monkeypatch):
    monkeypatch.setattr("docmill.llm.jaccard.BIG", 2)
    monkeypatch.setattr("docmill.llm.jaccard.BEFORE", 2)
    monkeypatch.setattr("docmill.llm.jaccard.SPLIT", 20)
    monkeypatch.setattr("docmill.llm.jaccard._common", lambda docs, words: np.zeros(1 << 20, np.uint8))
    check(spark, corpus(), 4, 60, 100)
    check(spark, corpus(), 5, 80, 100)


def brute_components(rows):
    sets = [shingles(t, 5) for _, t, _ in rows]
    near = {k: {j for j in range(len(rows)) if sets[k] and sets[j] and len(sets[k] & sets[j]) * 100 >= 80 * len(sets[k] | sets[j])} | {k} for k in range(len(rows))}
    for k, (doc, text, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            new = near[todo.pop()] - seen
            seen |= new
            todo += new
        yield doc, text, min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)


def test_components(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100 + k, 200) for k in range(30)] + [(300, 301), (301, 300), (302, 302)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).df.collect()}
    assert got == {k: 0 for k in range(41)} | {100 + k: 100 for k in range(30)} | {200: 100, 300: 300, 301: 300}


def test_query(spark):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in op4_ngram_jaccard(spark, "/root/testdata/sf0.001").collect()), key=str)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert got == brute(rows, 4, 85, 100)
