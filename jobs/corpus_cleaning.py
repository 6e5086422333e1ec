"""Cleans a table of documents by how common their blocks are in the whole table.

    python -m jobs.corpus_cleaning --documents IN --output OUT [--config jobs/corpus_cleaning.json] [--only en fr]

OUT gets cleaned (a row per document with its cleaned text, category and counts, partitioned by the configured column),
measured (the blocks that were judged) and reports (corpus, repeated_blocks, removed_blocks and signals, JSON lines). A
run overwrites what it writes, so a rerun over the same input leaves the same output, also after a run that was stopped.
With --only, the statistics are still those of the whole table, but only the named partitions of cleaned are replaced.

Rows without a key are left out; of rows with one key, the one of the greatest text stays. A document without text, or
with nothing left, stays with an empty text.
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from docmill.operators.blocks import measure_blocks, split_blocks
from docmill.operators.clean import corpus_sums, process_documents, removed_report, repeated_blocks, report_of, score_blocks, signal_histogram
from jobs.runs import command, configured, log, write

STATISTICS = ("blocks_removed", "blocks_retained", "words_before", "words_after", "retention")


@dataclass(frozen=True)
class Config:
    """The columns of the table, and the length of the report of repeated blocks."""

    key: str = "doc_id"
    text: str = "text"
    partition: str = "lang"
    repeated_top: int = 100


def read_documents(spark: SparkSession, path: str, config: Config) -> DataFrame:
    """(doc, markdown_content, the partition column), one row per key."""
    rows = spark.read.parquet(path).select(F.col(config.key).alias("doc"), F.struct(F.coalesce(F.col(config.text).cast("string"), F.lit("")).alias("text"), F.col(config.partition).alias("part")).alias("row"))
    return rows.where("doc IS NOT NULL").groupBy("doc").agg(F.max("row").alias("row")).select("doc", F.col("row.text").alias("markdown_content"), F.col("row.part").alias(config.partition))


def clean_corpus(spark: SparkSession, documents: str, output: str, config: Config | None = None, only: tuple[str, ...] = ()) -> DataFrame:
    """Runs the job and returns the cleaned documents, read back."""
    config = config or Config()
    docs = read_documents(spark, documents, config)
    n_docs = docs.count()
    log.info("read %d documents from %s", n_docs, documents)
    write(measure_blocks(split_blocks(docs)), f"{output}/measured")
    measured = spark.read.parquet(f"{output}/measured")
    scored = score_blocks(measured, n_docs)
    kept = docs.where(F.col(config.partition).cast("string").isin(*only)) if only else docs
    own = scored.join(kept.select("doc"), "doc", "left_semi") if only else scored
    sums = Observation()  # added up while the documents are written, so that they are not cleaned again for the report
    processed = process_documents(kept, own).observe(sums, *corpus_sums())
    cleaned = processed.join(kept.select("doc", config.partition), "doc").select(F.col("doc").alias(config.key), "cleaned_markdown", "page_category", *STATISTICS, config.partition)
    write(cleaned, f"{output}/cleaned", (config.partition,), dynamic=bool(only))
    out = spark.read.schema(cleaned.schema).parquet(f"{output}/cleaned")
    if not only:  # reports are those of the whole table
        empty = processed.limit(0).agg(*corpus_sums())
        seen = [sums.get] if n_docs else []  # without documents, Spark takes the observation away with the rest of the plan
        write(report_of(spark.createDataFrame(seen, empty.schema)), f"{output}/reports/corpus", form="json")
        write(repeated_blocks(measured, n_docs, config.repeated_top).coalesce(1), f"{output}/reports/repeated_blocks", form="json")
        write(removed_report(scored), f"{output}/reports/removed_blocks", form="json")
        write(signal_histogram(scored).coalesce(1), f"{output}/reports/signals", form="json")
    return out


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("--documents", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--config")
    parser.add_argument("--only", nargs="*", default=[])
    args = parser.parse_args()
    config = configured(Config, args.config)
    command("corpus_cleaning", lambda spark: clean_corpus(spark, args.documents, args.output, config, tuple(args.only)))


if __name__ == "__main__":
    main()
