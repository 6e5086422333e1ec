import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from docmill.llm.ngram_lm import BEGIN, ENDS, SYMBOLS, Spelling, discounts, op5_lm_score, perplexity, score, trigrams


def tokens(text):
    return [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))]


class Plain:
    """The same model with dictionaries and loops."""

    def __init__(self, texts):
        self.pairs = Counter(x for t in texts for x in zip(["begin", *tokens(t)], [*tokens(t), "end"], strict=True))
        self.count = Counter(w for t in texts for w in [*tokens(t), "end"])
        self.n = sum(self.count.values())
        self.words = [w for w in self.count if w != "end"]
        self.c = Counter(w for _, w in self.pairs)  # how many tokens each one follows
        self.begun = defaultdict(list)
        for (h, _), c in self.pairs.items():
            self.begun[h].append(c)
        grams = Counter()
        for w in self.words:
            s = [BEGIN, BEGIN, *w, ENDS]
            grams.update(zip(s, s[1:], s[2:], strict=False))
        self.levels = [grams, Counter(x[1:] for x in grams)]
        self.levels.append(Counter(x[1:] for x in self.levels[1]))
        self.d = [discounts(np.array(list(x.values()), int)) for x in self.levels]
        self.dw = discounts(np.array(list(self.c.values()), int))
        self.dp = discounts(np.array(list(self.pairs.values()), int))

    def symbol(self, gram):
        if not gram:
            return 1 / SYMBOLS
        k = 3 - len(gram)
        level, d = self.levels[k], self.d[k]
        same = [c for g, c in level.items() if g[:-1] == gram[:-1]]
        if not same:
            return self.symbol(gram[1:])
        c = level.get(gram, 0)
        return ((c - d[min(c, 3)]) + sum(d[min(x, 3)] for x in same) * self.symbol(gram[1:])) / sum(same)

    def spelled(self, word):
        s = [BEGIN, BEGIN, *word, ENDS]
        return math.prod(self.symbol(g) for g in zip(s, s[1:], s[2:], strict=False))

    def alone(self, word):
        share = 1 / (len(self.count) + 2)
        if word == "end":
            below = share
        else:
            below = (1 - 2 * share) * (self.spelled(word) if word in self.count else 1 - sum(map(self.spelled, self.words))) + share * (word not in self.count)
        if not self.n:
            return below
        total, c = sum(self.c.values()), self.c.get(word, 0)
        return (c - self.dw[min(c, 3)] + sum(self.dw[min(x, 3)] for x in self.c.values()) * below) / total

    def p(self, history, word):
        own = self.begun.get(history)
        if not own:
            return self.alone(word)
        c = self.pairs.get((history, word), 0)
        return (c - self.dp[min(c, 3)] + sum(self.dp[min(x, 3)] for x in own) * self.alone(word)) / sum(own)

    def row(self, doc, text):
        all_ = [*tokens(text), "end"]
        held = doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2
        base = sum(math.log10((self.count.get(w, 0) + 1) / (self.n + len(self.count) + 1)) for w in all_)
        return doc, held, len(all_), sum(w in self.count for w in all_), self.n, base, sum(math.log10(self.p(h, w)) for h, w in zip(["begin", *all_], all_, strict=False))


def check(spark, rows, schema="doc_id long, text string"):
    got = score(spark.createDataFrame(rows, schema).repartition(3)).collect()
    model = Plain([r[1] for r in rows if r[0] is None or zlib.crc32(str(r[0]).encode()) % 7 != 2])
    want = sorted((model.row(*r[:2]) for r in rows), key=lambda r: (str(r[0]), r[2]))
    got = sorted((tuple(r) for r in got), key=lambda r: (str(r[0]), r[2]))
    for a, b in zip(got, want, strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


def corpus(n):
    r = random.Random(1)
    parts = ["the", "of", "an", "ing", "er", "st", "ou", "ré"]
    return [(k, " ".join("".join(r.choices(parts, k=r.randint(1, 3))).capitalize() for _ in range(r.randint(0, 60)))) for k in range(n)]


def test_against_the_plain_model(spark):
    check(spark, corpus(80))


def test_small_blocks_and_edge_cases(spark, monkeypatch):
    monkeypatch.setattr("docmill.llm.ngram_lm.BLOCK", 300)
    monkeypatch.setattr("docmill.llm.ngram_lm.SHARD", 100)
    monkeypatch.setattr("docmill.llm.ngram_lm.STEP", 90)
    check(spark, [(*r, "x") for r in corpus(50)] + [(1000, None, ""), (1001, "", ""), (1001, "", ""), (None, "the NULL id", ""), (1002, "x" * 400, ""), (1003, "long é " * 3000, "")], "doc_id long, text string, score string")
    held = [k for k in range(100) if zlib.crc32(str(k).encode()) % 7 == 2]
    check(spark, [(held[0], "nothing was learnt"), (held[1], None)])
    check(spark, [(held[0], None), (3, None)])
    assert score(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_spelling_is_a_distribution():
    words = [w.encode() for w in ("the", "then", "of", "off", "an", "and", "é", "\x00")]
    data, ends = np.frombuffer(b"".join(words), np.uint8), np.cumsum([len(w) for w in words])
    codes, n = np.unique(trigrams(data, ends)[0], return_counts=True)
    model = Spelling.mapped(Spelling.fit(codes, n).dump())
    for context in (BEGIN << 9 | BEGIN, BEGIN << 9 | ord("t"), ord("t") << 9 | ord("h"), ord("q") << 9 | ord("q"), ord("q") << 9 | ord("h")):
        every = 10 ** model.log10(np.array([context << 9 | s for s in range(SYMBOLS)]))
        assert every.sum() == pytest.approx(1)


def test_events_sum_to_one():
    model = Plain([t for _, t in corpus(20)])
    for history in ("begin", b"never seen", *model.words[:20]):
        assert sum(model.p(history, w) for w in model.count) + model.p(history, b"never seen either") == pytest.approx(1)


def test_the_order_of_words_counts(spark):
    texts = [t for _, t in corpus(150) if len(tokens(t)) > 5]
    rows = [(k, t) for k, t in enumerate(texts)] + [(1000 + k, " ".join(reversed(t.split()))) for k, t in enumerate(texts)]
    held = {k for k, _ in rows if zlib.crc32(str(k).encode()) % 7 == 2}
    got = {r.doc_id: r for r in score(spark.createDataFrame([r for r in rows if r[0] < 1000 or r[0] in held], "doc_id long, text string")).collect()}
    both = [(got[k - 1000], got[k]) for k in held if k >= 1000 and k - 1000 not in held]
    assert len(both) > 2 and all(a.n_known == b.n_known and a.score > b.score + 1 for a, b in both)


def test_held_out_text_is_likelier_than_by_the_base(spark):
    got = op5_lm_score(spark, "/root/testdata/sf0.01").collect()
    by = defaultdict(lambda: [0.0, 0.0])
    for r in got:
        by[r.held_out][0] += r.score
        by[r.held_out][1] += r.base_score
    assert by[True][0] > 0.95 * by[True][1]
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert perplexity(op5_lm_score(spark, "/root/testdata/sf0.001")).count() == 2
