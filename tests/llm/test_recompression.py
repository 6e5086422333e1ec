import hashlib
import random
import re
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from docmill.llm.recompression import Stretches, deduplicated, op7_substring_dedup, repeats
from docmill.llm.textbatch import mix, spans


def brute(texts, window):
    """Kept words and counts by text, straight from the definition."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    count = defaultdict(int)
    for w in words:
        for k in range(len(w) - window + 1):
            count[tuple(w[k : k + window])] += 1
    out = []
    for w in words:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if count[tuple(w[k : k + window])] > 1:
                gone[k : k + window] = [True] * window
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


@settings(deadline=None, max_examples=1500)
@given(st.lists(st.lists(st.integers(0, 2), max_size=40), min_size=1, max_size=4), st.integers(1, 9), st.integers(0, 7))
def test_equal_windows_share_a_name_and_a_place(texts, window, rounds):
    first = np.cumsum([0, *map(len, texts)])
    words = mix(np.array([x for t in texts for x in t], np.uint64) + np.uint64(5))
    found = Stretches(words, first, window, rounds)
    names, seen = {}, set()
    for name, of, start, n in zip(found.name, found.of, found.start, found.windows, strict=True):
        for k in range(start, start + n):
            assert (of, k) not in seen
            seen.add((of, k))
            content = tuple(texts[of][k : k + window])
            assert len(content) == window and names.setdefault(content, name) == name
    assert len(seen) == sum(max(0, len(t) - window + 1) for t in texts)


def check(spark, rows, window, rounds=3, schema="doc_id long, text string"):
    got = repeats(spark.createDataFrame(rows, schema).repartition(3), window, rounds).collect()
    want = [(n, gone, kept if gone else r[1] or "") for r, (n, gone, kept) in zip(rows, brute([r[1] for r in rows], window), strict=True)]
    assert sorted((r.n_words, r.n_removed, r.kept) for r in got) == sorted(want)
    ids = {(r._id, r.n_words, r.n_removed, r.kept) for r in got}
    assert ids == {(r[0] or 0, *w) for r, w in zip(rows, want, strict=True)}


def prose(n, seed, kinds=300):
    r = random.Random(seed)
    return " ".join(f"w{int(r.paretovariate(0.6)) % kinds}" for _ in range(n))


def test_planted_passages(spark):
    passage, other = prose(60, "p"), prose(40, "q")
    rows = []
    for k in range(60):
        words = prose(20 + k * 7 % 200, k).split()
        if k % 3 == 0:
            words[k % len(words) : k % len(words)] = passage.split()
        if k % 7 == 0:
            words += other.split()
        rows.append((k, " ".join(words)))
    rows += [(100, rows[10][1]), (101, rows[11][1] + "\n x"), (102, passage), (103, " ".join([passage] * 3)), (104, "same " * 500), (105, "same\tsame\x0b" * 40)]
    edited = rows[27][1].split()
    edited[30] = "edited"
    rows.append((106, " ".join(edited)))
    check(spark, rows, 35)
    check(spark, rows, 5)


def test_edge_cases(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "one", "x"), (None, "a b c d e", ""), (None, "x a b c d", ""), (4, " a b c d ", ""), (4, " a b c d ", ""), (0, "a b c d q", ""), (5, "long é " * 20000, "")]
    check(spark, rows, 4, schema="doc_id long, text string, place string")
    check(spark, rows, 1, schema="doc_id long, text string, name string")
    check(spark, [(1, "a b c " * 30)], 35)
    assert repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_deduplicated_keeps_columns_and_untouched_rows(spark):
    rows = [(1, "a  b\nc", "x", 6, "y"), (2, "p q r s t", "x", 9, "y"), (3, "0 p q r s t 1", None, 13, "z"), (None, "", "x", 0, "y")]
    got = deduplicated(spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long, _tag string"), 5)
    assert got.columns == ["doc_id", "text", "lang", "n_chars", "_tag"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted([rows[0], (3, "0 1", None, 3, "z"), rows[3]], key=str)


def test_query(spark):
    got = {r.doc_id: r for r in op7_substring_dedup(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    for d, (n, removed, kept) in zip(docs, brute([d.text for d in docs], 35), strict=True):
        r = got[d.doc_id]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (n, removed, hashlib.sha256(kept.encode()).hexdigest())


def test_texts_of_one_doc_id_with_equal_checksums_stay_apart(spark):
    """Two texts of one CRC-32, found by their last characters, of which one holds a repeated window."""
    import zlib

    passage, seen, r = "a b c d e", {}, random.Random(1)
    for k in range(400_000):
        text = f"{passage if k % 2 else 'p q r s t'} {r.getrandbits(64):x}"
        pair = seen.setdefault(zlib.crc32(text.encode()), text)
        if pair != text and (pair[0] == "a") != (text[0] == "a"):
            break
    else:
        raise AssertionError("no two texts of one checksum")
    check(spark, [(1, pair), (1, text), (2, passage)], 5)
