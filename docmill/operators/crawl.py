"""A crawl over a table of pages, breadth first, a level at a time."""

from __future__ import annotations

import itertools
import logging
import time
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docmill.functions.html import content, is_english, links, title, to_markdown
from docmill.functions.text import word_count
from docmill.functions.urls import UrlFilter, filter_urls, normalize

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class CrawlLimits:
    """None: without a limit."""

    max_depth: int | None = 3
    max_pages: int | None = 300
    abort_pages: int | None = 10000
    soft_pages: int = 1000
    warning_pages: int = 5000


def progress(crawled: int, queued: int, seconds: float) -> str:
    """Pages done and left, the mean time of a page, and the time that is left at this pace."""
    each = seconds / crawled
    left = queued * each
    return f"crawled {crawled}, queued {queued}, {each:.2f} s a page, {left / 60:.1f} min left" if left < 3600 else f"crawled {crawled}, queued {queued}, {each:.2f} s a page, {left / 3600:.1f} h left"


def parse_pages(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """url, markdown_content, title, word_count, outgoing_links and failure (null for a page that counts)."""
    status = F.col("status_code") if "status_code" in pages.columns else F.lit(200)
    given = F.col("markdown") if "markdown" in pages.columns else F.lit(None).cast("string")
    text = content(given, to_markdown(F.col(html)))
    out = pages.select(F.col(url).alias("url"), text.alias("markdown_content"), status.alias("status_code"), is_english(F.col(html)).alias("_english"))
    failure = F.when(F.coalesce(F.col("status_code"), F.lit(0)) != 200, F.concat(F.lit("HTTP "), F.coalesce(F.col("status_code").cast("string"), F.lit("?")))).when(~F.col("_english"), "Not English").when(F.col("markdown_content").isNull(), "Empty content")
    u, m = F.col("url"), F.col("markdown_content")
    return out.withColumns({"failure": failure, "title": title(u, m), "word_count": word_count(m), "outgoing_links": links(u, F.coalesce(m, F.lit("")))}).drop("_english")


def _numbered(reached: DataFrame, cut: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """reached with its order by (_from, url), from 1: places inside ranges, behind the sizes of the ranges before."""
    ranged = cut(reached.repartitionByRange("_from", "url").withColumn("_part", F.spark_partition_id()))
    sizes = sorted((r["_part"], r["count"]) for r in ranged.groupBy("_part").count().collect())  # a row per partition
    before = dict(zip([p for p, _ in sizes], itertools.accumulate((n for _, n in sizes), initial=0), strict=False))
    offset = F.element_at(F.create_map(*[F.lit(x) for pair in before.items() for x in pair]), F.col("_part")) if before else F.lit(0)
    place = F.row_number().over(Window.partitionBy("_part").orderBy("_from", "url"))
    return ranged.withColumn("order", (place + offset).cast("int")).drop("_part")


def crawl(pages: DataFrame, seeds: DataFrame, rules: UrlFilter, limits: CrawlLimits | None = None) -> DataFrame:
    """(url, depth, order) of the pages that are reached. pages: url, outgoing_links; seeds: url.

    Each level is joined with the pages, its links are filtered, made distinct and cleared of what was visited. The
    lineage of a level is cut by a checkpoint in the session's shared folder, where one is set. In a level, pages
    come in the order of the page that names them first, then of the URL; max_pages cuts in this order.
    """
    limits = limits or CrawlLimits()
    spark = pages.sparkSession
    cut = (lambda df: df.checkpoint()) if spark.sparkContext._jsc.sc().getCheckpointDir().isDefined() else (lambda df: df.persist())
    known = pages.select("url", "outgoing_links").dropDuplicates(["url"])
    front = filter_urls(seeds.select("url", F.lit(0).cast("long").alias("_from")), rules).where("filter_reason IS NULL")
    levels: list[DataFrame] = []
    visited = None
    most = [n for n in (limits.max_pages, limits.abort_pages) if n is not None]
    left, done, began = min(most) if most else None, 0, time.time()
    for depth in itertools.count() if limits.max_depth is None else range(limits.max_depth + 1):
        one = F.row_number().over(Window.partitionBy("norm_url").orderBy("_from", "url"))
        front = front.withColumn("_n", one).where("_n = 1")
        if visited is not None:
            front = front.join(visited, "norm_url", "left_anti")
        reached = front.join(known, "url").select("url", "norm_url", "_from", "outgoing_links")
        level = _numbered(reached, cut).withColumn("depth", F.lit(depth))
        level = cut(level if left is None else level.where(F.col("order") <= left))
        n = level.count()
        if not n:
            break
        levels.append(level)
        left = None if left is None else left - n
        # a level passes a threshold once, as pages come by levels
        for name, mark, say in (("soft", limits.soft_pages, log.info), ("warning", limits.warning_pages, log.warning)):
            if done < mark <= done + n:
                say("%s limit of %d pages reached", name, mark)
        done += n
        visited = level.select("norm_url") if visited is None else visited.unionByName(level.select("norm_url"))
        if left is not None and left <= 0:
            break
        found = level.select(F.explode("outgoing_links").alias("url"), F.col("order").cast("long").alias("_from"))
        front = filter_urls(found, rules).where("filter_reason IS NULL")
        if log.isEnabledFor(logging.INFO):
            log.info(progress(done, level.agg(F.sum(F.size("outgoing_links"))).head()[0] or 0, time.time() - began))
    if not levels:
        return spark.createDataFrame([], "url string, depth int, order int")
    return reduce(DataFrame.unionByName, [x.select("url", "depth", "order") for x in levels])


def crawl_metrics(parsed: DataFrame) -> DataFrame:
    done = F.col("failure").isNull()
    return parsed.agg(
        F.count(F.lit(1)).alias("attempted"), F.count_if(done).alias("crawled"), F.count_if(~done).alias("failed"),
        F.coalesce(F.sum(F.when(done, F.col("word_count"))), F.lit(0)).alias("total_words"), F.coalesce(F.avg(F.when(done, F.col("word_count"))), F.lit(0.0)).alias("average_page_words"),
    )


def sitemap_seeds(urls: DataFrame, rules: UrlFilter) -> DataFrame:
    """The URLs of a sitemap that the rules let through, once per normalised URL."""
    kept = filter_urls(urls, rules).where("filter_reason IS NULL")
    return kept.groupBy("norm_url").agg(F.min("url").alias("url")).select("url", "norm_url")


def visited_table(urls: DataFrame) -> DataFrame:
    return urls.select(normalize(F.col("url")).alias("norm_url")).distinct()
