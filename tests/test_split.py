"""Cutting oversized text, against every way of cutting; headings of long documents; crawl orders; reports."""

import itertools
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from docmill.functions.urls import UrlFilter
from docmill.operators import chunks as K
from docmill.operators import crawl as W
from docmill.sources.writers import write_crawl_summary


def cost(atoms, ends):
    """Pieces, cost of the cuts and unevenness of cutting before each of `ends`."""
    edges = [0, *ends, len(atoms)]
    sizes = [sum(n for _, n, _ in atoms[a:b]) for a, b in itertools.pairwise(edges)]
    return len(sizes), sum(atoms[e - 1][2] for e in ends), sum(s * s for s in sizes), max(sizes)


@pytest.mark.parametrize("seed", range(60))
def test_cuts_cost_least(seed):
    draw = random.Random(seed)
    sentences = [" ".join(draw.choices(["a", "bb", "ccc"], k=draw.randrange(1, 6))) + draw.choice([". ", "!\n", "\n", "? "]) for _ in range(draw.randrange(2, 9))]
    text, most = "".join(sentences).strip(), draw.randrange(7, 12)
    got = K.split_text(text, most, K.estimate)
    assert "".join(got) == text and all(K.estimate(p) <= most for p in got)
    atoms = [(m[0], K.estimate(m[0]), K.LINE if re.search(r"\n\s*\Z", m[0]) else K.SENTENCE) for m in K._ATOM.finditer(text)]
    assert all(n <= most for _, n, _ in atoms)
    every = (cost(atoms, ends) for k in range(len(atoms)) for ends in itertools.combinations(range(1, len(atoms)), k))
    best = min(c[:3] for c in every if c[3] <= most)
    places = {e: k for k, e in enumerate(itertools.accumulate(len(a) for a, _, _ in atoms), 1)}
    ends = [places[e] for e in itertools.accumulate(map(len, got))][:-1]
    assert cost(atoms, ends)[:3] == best


@pytest.mark.parametrize("text", ["", "word", "x" * 50_000, "!" * 5_000, "no stops " * 3_000, "é. " * 2_000, "a\n" * 3_000, " \n "])
def test_pieces_fit_and_keep_every_character(text):
    got = K.split_text(text, 40, K.estimate)
    assert "".join(got) == text and all(K.estimate(p) <= 40 for p in got)
    halves = K.split_text(text, 40, lambda t: len(t) // 4)  # a count that does not add up
    assert "".join(halves) == text and all(len(p) // 4 <= 40 for p in halves)


def test_no_chunk_of_text_is_oversized(spark):
    fence = "```py\n" + "x = 1\n" * 100 + "```"
    text = "# A\n\nShort.\n\n## B\n\n" + "One two three four. " * 200 + "\n\n" + fence + "\n\n" + "tail " * 300 + "\n\n# C\n\n" + "w " * 118
    docs = spark.createDataFrame([("u", "t", text)], "url string, title string, markdown_content string")
    config = K.ChunkConfig(overlap=40, min_tokens=30, max_tokens=120, split_oversized=True)
    rows = K.chunk_documents(docs, config).orderBy("chunk_index").collect()
    assert [r for r in rows if r["oversized_chunk"]] == [r for r in rows if r["contains_code"]] and len([r for r in rows if r["contains_code"]]) == 1
    assert all(r["token_count"] <= 120 and K.estimate(r["chunk_text"]) <= 120 for r in rows if not r["contains_code"])
    assert fence in [r["chunk_text"] for r in rows if r["contains_code"]][0]
    words = re.findall(r"\w+", " ".join(r["chunk_text"] for r in rows))
    assert {w: words.count(w) >= n for w, n in (("two", 200), ("tail", 300), ("w", 118))} == dict.fromkeys(("two", "tail", "w"), True)
    whole = K.chunk_documents(docs, K.ChunkConfig(max_tokens=120)).collect()
    assert any(r["oversized_chunk"] and not r["contains_code"] for r in whole)


def test_headings_of_a_long_document(spark):
    draw = random.Random(5)
    levels = [draw.randrange(1, 7) for _ in range(20_000)]
    docs = spark.createDataFrame([(1, "\n".join(f"{'#' * n} h{k}" for k, n in enumerate(levels)))], "doc long, markdown_content string")
    start = time.time()
    got = [r["heading_path"] for r in K.heading_paths(docs).orderBy("section").collect()]
    assert time.time() - start < 60
    stack = []
    for k, n in enumerate(levels):
        stack = [s for s in stack if s[0] < n] + [(n, f"h{k}")]
        assert got[k] == [t for _, t in stack]


def test_crawl_without_limits_numbers_levels_as_one_task_would(spark):
    site = "http://e.com/"
    edges = {k: [2 * k + 1, 2 * k + 2] for k in range(40)}
    pages = spark.createDataFrame([(f"{site}{k:02d}", [f"{site}{x:02d}" for x in to]) for k, to in edges.items()], "url string, outgoing_links array<string>")
    seeds = spark.createDataFrame([(site + "00",)], "url string")
    got = W.crawl(pages, seeds, UrlFilter(), W.CrawlLimits(None, None, None, soft_pages=5, warning_pages=10)).collect()
    assert sorted((r["depth"], r["order"], int(r["url"][-2:])) for r in got) == [(d, k - 2**d + 2, k) for k in range(40) for d in [(k + 1).bit_length() - 1]]
    first = W.crawl(pages, seeds, UrlFilter(), W.CrawlLimits(None, 5, None)).collect()
    assert sorted(int(r["url"][-2:]) for r in first) == [0, 1, 2, 3, 4]


def test_crawl_summary_keeps_its_settings(spark, tmp_path):
    parsed = spark.createDataFrame([("u", None)], "url string, failure string")
    write_crawl_summary(parsed, parsed, parsed, f"{tmp_path}/s", W.CrawlLimits(max_depth=7), UrlFilter(allowed_domains=("e.com",)))
    said = spark.read.json(spark.read.json(f"{tmp_path}/s/config").select("settings").rdd.map(lambda r: r[0])).select(F.col("limits.max_depth"), F.col("rules.allowed_domains")).head()
    assert tuple(said) == (7, ["e.com"])
