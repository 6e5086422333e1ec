import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from harness import compare, connect

from docmill.llm import divergence as D

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string"


def brute(rows, least=10, top=10):
    """The contract over lists, with Python's integers."""
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for _, text, lang, source in rows]
    frequency, by_lang, by_group = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for lang, source, words in docs:
        frequency[lang].update(set(words))
        by_lang[lang].update(words)
        by_group[lang, source].update(words)
    out = []
    for lang in {d[0] for d in docs}:
        kept = [t for t, n in frequency[lang].items() if n >= least]
        share = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c[x] for x in kept) + 2 * len(kept)) for t in kept}
        f = lambda p, q: (p - q) ** 2 // (p + q)
        q = share(by_lang[lang])
        p = {s: share(c) for (l, s), c in by_group.items() if l == lang}
        for s in p:
            pairs = sorted(((-sum(f(p[s][t], p[o][t]) for t in kept), o) for o in p if o != s), key=lambda x: (x[0], x[1].encode()))
            terms = sorted(((-f(p[s][t], q[t]), t) for t in kept if by_group[lang, s][t] > 0 and p[s][t] > q[t]), key=lambda x: (x[0], x[1].encode()))[:top]
            out += [(lang, s, part, item, -v, k + 1) for part, found in (("pair", pairs), ("term", terms)) for k, (v, item) in enumerate(found)]
    return sorted(out)


def run(spark, rows, **options):
    return sorted(map(tuple, D.divergence(spark.createDataFrame(rows, SCHEMA), **options).collect()))


def made(seed, n):
    draw = random.Random(seed)
    words = ["alpha", "Beta", "ÉCOLE", "école", "zz" * 50, "internationalisation", "international", "漢字", "a", "zz" * 50 + "b", "don't", "x1y"]
    return [(k, " ".join(draw.choices(words, k=draw.randrange(0, 30))), draw.choice(["en", "fr", None]), draw.choice(["s1", "s2", "", None, "Ü"])) for k in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rows = made(seed, 120)
    rows += [(None, None, None, None), (5, "", "de", "s1"), (6, "rare", "de", "s2"), rows[0], rows[0]]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, least=1, top=3) == brute(rows, 1, 3)


def test_parts_of_tries_and_blocks_of_sources(spark, monkeypatch):
    rows = [(k, t, "en", f"s{k % 7}") for k, (_, t, _, _) in enumerate(made(9, 100))]
    want = brute(rows, 2)
    for name, value in (("LEAVES", 3), ("SOURCES", 2), ("CELLS", 8), ("COUNTERS", 8)):
        monkeypatch.setattr(D, name, value)
    # workers import the module afresh, so the small limits are tried on the functions themselves
    batch = pa.RecordBatch.from_pylist([{"text": t, "lang": l, "source": s} for _, t, l, s in rows], pa.schema([(c, pa.string()) for c in ("text", "lang", "source")]))
    counted = pa.Table.from_batches(list(D._count(iter([batch.slice(0, 50), batch.slice(50)])))).sort_by([("lang", "ascending"), ("term", "ascending")])
    tries = list(D._merge(2)(iter(counted.to_batches(max_chunksize=4))))
    sums, kept = Counter(), 0
    for t in tries:
        assert len(t.column("terms")[0]) <= 3
        kept += len(t.column("terms")[0])
        sums.update(dict(zip(t.column("names")[0].as_py(), t.column("sums")[0].as_py(), strict=True)))
    names = sorted({r[3] for r in rows})
    heads = {"kept": [kept], "all_names": [names], "all_sums": [[sums[n] for n in names]]}
    value, terms = Counter(), defaultdict(set)
    for t in tries:
        for block in range(4):
            visit = pa.RecordBatch.from_arrays([*t.columns[:5], *map(pa.array, heads.values()), pa.array([block])], names=[*t.schema.names[:5], *heads, "block"])
            for part in D._traverse(10)(iter([visit])):
                for r in part.to_pylist():
                    if r["part"] == "pair":
                        value[r["source"], r["item"]] += r["value"]
                    else:
                        terms[r["source"]].add((r["item"], r["value"]))
    assert dict(value) == {(s, i): v for _, s, part, i, v, _ in want if part == "pair"}
    assert all((i, v) in terms[s] for _, s, part, i, v, _ in want if part == "term")


def test_empty_table_and_clashing_columns(spark):
    assert run(spark, []) == []
    rows = made(4, 40)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS term", "1 AS `a.b`", "text AS counts")
    assert sorted(map(tuple, D.divergence(df).collect())) == brute(rows)


def test_leaves_of_long_and_equal_terms():
    words = [b"a", b"a" * 8, b"a" * 9, b"a" * 64, b"a" * 65, b"a" * 5000, b"a" * 5000, b"a" * 4999 + b"b", b"a", b"\xff\xfe"]
    raw = np.frombuffer(b"".join(words), np.uint8)
    end = np.cumsum([len(w) for w in words])
    leaf, first = D.leaves(raw, end - [len(w) for w in words], end)
    assert [words[first[x]] for x in leaf] == words and len(set(leaf)) == len(set(words))


def test_shares_are_exact():
    draw = random.Random(1)
    for _ in range(2000):
        kept = draw.randrange(1, 10**6)
        total = draw.randrange(0, 10**15)
        count = draw.randrange(0, total + 1)
        assert D.shares(np.array([count]), total, kept)[0] == 1 + 10**9 * (count + 2) // (total + 2 * kept)


def test_query_equals_sql(spark):
    compare(spark, connect(SF), "op11", D.op11_source_divergence, D.ORACLE, SF)
