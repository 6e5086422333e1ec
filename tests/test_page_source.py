"""The data source of pages, over the table `pages` behind a fetch that knows its pages by URL."""

import json
import time
from urllib.parse import urlsplit

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from docmill.operators.crawl import crawl_metrics, parse_pages
from docmill.sources.page_source import Stretch, page_source, visit

PAGES = {p["url"]: p["html"] for p in pq.read_table("/root/testdata/sf0.001/pages.parquet", columns=["url", "html"]).to_pylist()}
SITES = {}
for _url in sorted(PAGES):
    SITES.setdefault(urlsplit(_url).netloc, []).append(_url)
GONE = next(iter(sorted(PAGES)))


def functions():
    """Functions that carry their pages with them, as tasks cannot import a test."""
    pages, sites, gone = dict(PAGES), dict(SITES), GONE

    def listing(host, start, end):
        if host == "down.example":
            raise OSError("no answer")
        return sites[host][start:end]

    def fetch(url):
        if url == gone:
            raise TimeoutError("too slow")
        return 200, pages[url]

    return listing, fetch


def test_a_batch_reads_every_page_once(spark):
    spark.dataSource.register(page_source(*functions(), name="pages_batch"))
    for tasks in (1, 3):
        frame = spark.read.format("pages_batch").options(hosts=" ".join([*SITES, "down.example"]), pause=0, tasks=tasks).load()
        rows = frame.collect()
        good = {r.url: r.html for r in rows if r.error is None}
        assert good == {u: h for u, h in PAGES.items() if u != GONE}
        assert len(rows) == len(PAGES) + tasks
        assert {(r.host, r.url, r.error) for r in rows if r.error} == {(urlsplit(GONE).netloc, GONE, "TimeoutError: too slow"), ("down.example", None, "OSError: no answer")}
        assert all(SITES[r.host][r.place] == r.url for r in rows if r.url)
    assert frame.rdd.getNumPartitions() == 3 * (len(SITES) + 1)


def test_its_rows_are_pages_of_a_crawl(spark):
    spark.dataSource.register(page_source(*functions(), name="pages_crawl"))
    frame = spark.read.format("pages_crawl").options(hosts=" ".join(SITES), pause=0).load()
    got = crawl_metrics(parse_pages(frame)).head()
    table = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").where(F.col("url") != GONE)
    want = crawl_metrics(parse_pages(table)).head()
    assert (got.attempted, got.failed) == (want.attempted + 1, want.failed + 1) and got.total_words == want.total_words


def test_a_host_has_one_pace(spark):
    """What a stretch waits: nothing before its first page, the pause times the tasks that share the host behind it."""
    urls = [f"http://a/{k}" for k in range(6)]
    seen = []
    for first in range(2):
        began = time.time()
        rows = list(visit(Stretch("a", 0, None, first, 2), lambda h, s, e: urls[s:e], lambda u: (200, u), 0.02))
        assert 0.08 <= time.time() - began < 1
        seen += [r[1] for r in rows]
    assert sorted(seen) == list(range(6))


def test_options(spark):
    spark.dataSource.register(page_source(*functions(), name="pages_options"))
    for options in ({}, {"hosts": " "}, {"hosts": "a", "tasks": 0}, {"hosts": "a", "pause": -1}):
        with pytest.raises(Exception, match="hosts names no host|is 1 or more"):
            spark.read.format("pages_options").options(**options).load().collect()
    with pytest.raises(Exception, match="known"):
        spark.readStream.format("pages_options").option("hosts", "a").load().writeStream.format("noop").trigger(once=True).start().awaitTermination()


def test_a_stream_takes_what_is_new_and_restarts(spark, tmp_path):
    """Three runs over a growing listing, the second of which fails half-way: each page once, and only new ones fetched."""
    state, out, mark, log = (str(tmp_path / x) for x in ("state.json", "out", "mark", "log"))
    pages, sites = dict(PAGES), {h: u for h, u in sorted(SITES.items())[:3]}
    (tmp_path / "log").mkdir()

    def known(host):
        with open(state) as f:
            return json.load(f)[host]

    def listing(host, start, end):
        return sites[host][start:end]

    def fetch(url):
        with open(state) as f:
            if json.load(f).get("stop"):
                import os

                os.stat(log + "/no such file that stops nothing")
        with open(f"{log}/{hash(url)}", "a") as f:
            f.write(url + "\n")
        return 200, pages[url]

    spark.dataSource.register(page_source(listing, fetch, known, name="pages_stream"))

    def grow(n, **more):
        (tmp_path / "state.json").write_text(json.dumps({h: min(n, len(u)) for h, u in sites.items()} | more))

    def run():
        read = spark.readStream.format("pages_stream").options(hosts=" ".join(sites), pause=0, tasks=2).load()
        query = read.writeStream.format("parquet").option("path", out).option("checkpointLocation", mark).trigger(processingTime="0 seconds").start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()
        return sorted((r.host, r.place, r.url, r.error is None) for r in spark.read.parquet(out).collect())

    grow(2)
    first = run()
    assert first == sorted((h, k, u, True) for h, us in sites.items() for k, u in enumerate(us[:2]))
    assert run() == first
    grow(3, stop=True)
    second = run()
    assert [r for r in second if r[3]] == first and sorted(r[:2] for r in second if not r[3]) == sorted((h, 2) for h, us in sites.items() if len(us) > 2)
    grow(5)
    third = run()
    assert len({r[:2] for r in third}) == len(third) == sum(min(5, len(u)) for u in sites.values())
    fetched = [line for f in (tmp_path / "log").iterdir() for line in f.read_text().splitlines()]
    assert len(fetched) == len(set(fetched))


def test_a_stream_stops_where_a_listing_fails(spark, tmp_path):
    """Nothing is passed over: the query fails, and its pages come once the host answers again."""
    up = str(tmp_path / "up")

    def listing(host, start, end):
        with open(up):
            return [f"http://{host}/{k}" for k in range(4)][start:end]

    spark.dataSource.register(page_source(listing, lambda u: (200, u), lambda host: 4, name="pages_down"))

    def run():
        read = spark.readStream.format("pages_down").options(hosts="a b", pause=0).load()
        query = read.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "mark")).start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()

    with pytest.raises(Exception, match="up"):
        run()
    (tmp_path / "up").write_text("")
    run()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(r.url for r in got) == [f"http://{h}/{k}" for h in "ab" for k in range(4)]
