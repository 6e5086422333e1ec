"""Takes new pages of a growing folder into the document table and the index of their words.

    python -m jobs.page_ingest --pages IN --output OUT --checkpoint MARK [--config jobs/page_ingest.json]

The folder is read as a stream of files that ends when all present ones are read. The checkpoint remembers the files, so
a later run takes only those that have come since. OUT gets, a folder per batch of the stream,

    documents    pages that the rules let through, as Markdown, once per normalised URL, partitioned by language
    postings     (term, norm_url, tf) of these documents, the table that BM25 reads
    rejected     the other pages, with the reason

A URL that an earlier batch has stays as it is, as a crawl does not fetch a page twice; inside a batch the page of least
page_id counts, and a row that stands there twice is one page. A batch that was stopped half-way is run again under its number and overwrites its own folders, so no row
is lost or doubled. Output and checkpoint belong together: delete both or none. With files_per_batch 0, one batch takes
all new files.
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.functions.html import content, is_english, language, links, title, to_markdown
from docmill.functions.text import tokens, word_count
from docmill.functions.urls import BINARY_PATTERNS, DUPLICATE, UrlFilter, filter_urls
from jobs.runs import command, configured, log, write

DOCUMENT = "page_id long, url string, norm_url string, title string, markdown_content string, word_count long, outgoing_links array<string>"
POSTING = "term string, norm_url string, tf long"
NOT_ENGLISH, EMPTY = "Not English", "Empty content"
REJECTED = "page_id long, url string, norm_url string, reason string"
#: Words of the documents that a task turns into postings, and that a file of postings has.
WORDS = 1 << 20


@dataclass(frozen=True)
class Config:
    """The rules for URLs, and how many files a batch takes at most (0: all)."""

    allowed_domains: tuple[str, ...] = ()
    exclude_patterns: tuple[str, ...] = BINARY_PATTERNS
    allow_pagination: bool = False
    required_path_keywords: tuple[str, ...] = ()
    min_path_length: int = 5
    files_per_batch: int = 0

    @property
    def rules(self) -> UrlFilter:
        return UrlFilter(self.allowed_domains, self.exclude_patterns, self.allow_pagination, self.required_path_keywords, self.min_path_length)


def documents(spark: SparkSession, output: str) -> DataFrame:
    """All documents taken in, with their language and batch."""
    return spark.read.schema(f"{DOCUMENT}, batch long, lang string").parquet(f"{output}/documents")


def postings(spark: SparkSession, output: str) -> DataFrame:
    return spark.read.schema(f"{POSTING}, batch long").parquet(f"{output}/postings")


def rejected(spark: SparkSession, output: str) -> DataFrame:
    return spark.read.schema(f"{REJECTED}, batch long").parquet(f"{output}/rejected")


def judged(pages: DataFrame, known: DataFrame, config: Config) -> DataFrame:
    """pages as documents, with norm_url and the reason against each (null for those that may be taken).

    Only pages whose URL passes are converted. A page that is not English or empty is no document, so its URL stays free.
    """
    out = filter_urls(pages, config.rules, visited=known).withColumnRenamed("filter_reason", "reason")
    passes = F.col("reason").isNull()
    out = out.withColumn("markdown_content", F.when(passes, content(to_markdown(F.col("html")))))
    text = F.col("markdown_content")
    failure = F.when(passes & ~is_english(F.col("html")), NOT_ENGLISH).when(passes & text.isNull(), EMPTY)
    found = {"title": title(F.col("url"), text), "word_count": word_count(text), "outgoing_links": links(F.col("url"), text), "lang": F.coalesce(F.nullif(language(F.col("html")), F.lit("")), F.lit("und"))}
    return out.withColumn("reason", F.coalesce("reason", failure)).withColumns({k: F.when(F.col("reason").isNull(), c) for k, c in found.items()}).drop("html")


def counted(docs: DataFrame) -> DataFrame:
    """The postings of documents, one row per norm_url: words are sorted and counted within their row, so that a task holds one document."""
    words = docs.select("norm_url", F.sort_array(tokens(F.col("markdown_content"))).alias("words"))
    first = lambda x, k: (k == 0) | (x != F.get("words", k - 1))
    # where each word begins, and the end
    runs = words.withColumn("at", F.concat(F.filter(F.transform("words", lambda x, k: F.when(first(x, k), k)), lambda k: k.isNotNull()), F.array(F.size("words"))))
    counts = F.transform(F.slice("at", 1, F.size("at") - 1), lambda k, i: F.struct(F.get("words", k).alias("term"), (F.get("at", i + 1) - k).cast("long").alias("tf")))
    return runs.select("norm_url", F.inline(counts)).select("term", "norm_url", "tf")


def take(pages: DataFrame, batch: int, output: str, config: Config) -> None:
    """Writes one batch; run again with the same pages and number, it leaves the same files."""
    spark = pages.sparkSession
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    before = documents(spark, output).where(F.col("batch") < batch).select("norm_url")
    rows = judged(rows, before, config).persist()
    good, bad = rows.where("reason IS NULL"), rows.where("reason IS NOT NULL")
    # of one URL the least page, found by tasks before rows move: one URL may have most of the rows
    first = good.groupBy("norm_url").agg(F.min(F.struct("page_id", "url", "title", "markdown_content", "word_count", "outgoing_links", "lang")).alias("w"))
    write(first.select("w.page_id", "w.url", "norm_url", "w.title", "w.markdown_content", "w.word_count", "w.outgoing_links", "w.lang"), f"{output}/documents/batch={batch}", ("lang",))
    new = documents(spark, output).where(F.col("batch") == batch)
    tasks = -(-(new.agg(F.sum("word_count")).head()[0] or 1) // WORDS)
    index = counted(new.select("norm_url", "markdown_content").repartition(tasks, "norm_url"))
    # by both columns, as a common word is in most documents
    write(index.repartitionByRange(tasks, "term", "norm_url").sortWithinPartitions("term", "norm_url"), f"{output}/postings/batch={batch}")
    taken = new.select("norm_url", F.col("page_id").alias("_page"), F.col("url").alias("_url"))
    again = good.join(taken, "norm_url").where(~(F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("url") == F.col("_url")))).withColumn("reason", F.lit(DUPLICATE))
    columns = [c.split()[0] for c in REJECTED.split(", ")]
    write(bad.select(columns).unionByName(again.select(columns)), f"{output}/rejected/batch={batch}")
    rows.unpersist()


def as_pattern(path: str) -> str:
    """A stream of files takes a folder or a pattern; as a pattern, a path may also be a single file."""
    if any(c in path for c in "*?[{"):
        return path
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/{{{name}}}"


def ingest_pages(spark: SparkSession, pages: str, output: str, checkpoint: str, config: Config | None = None) -> DataFrame:
    """Takes in all files that have come since the last run, waits for the end and returns the documents, read back."""
    config = config or Config()
    for name, kind in (("documents", f"{DOCUMENT}, batch long, lang string"), ("postings", f"{POSTING}, batch long"), ("rejected", f"{REJECTED}, batch long")):
        spark.createDataFrame([], kind).write.mode("ignore").partitionBy("batch").parquet(f"{output}/{name}")
    reader = spark.readStream.schema(spark.read.parquet(pages).schema)
    if config.files_per_batch:
        reader = reader.option("maxFilesPerTrigger", config.files_per_batch)
    stream = reader.parquet(as_pattern(pages)).writeStream.foreachBatch(lambda rows, n: take(rows, n, output, config))
    query = stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    read = sum(p.numInputRows for p in query.recentProgress)
    log.info("read %d pages in %d batches from %s", read, len(query.recentProgress), pages)
    return documents(spark, output)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    for name in ("pages", "output", "checkpoint"):
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--config")
    args = parser.parse_args()
    config = configured(Config, args.config)
    command("page_ingest", lambda spark: ingest_pages(spark, args.pages, args.output, args.checkpoint, config))


if __name__ == "__main__":
    main()
