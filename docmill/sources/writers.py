"""Sinks: documents, processed documents, chunks, embeddings behind their check, and reports."""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.functions.html import rendered
from docmill.functions.urls import DEFAULT_RULES, UrlFilter, processed_file_name, raw_file_name
from docmill.operators.clean import corpus_report, removed_report, repeated_blocks, review_set, signal_histogram, signal_report
from docmill.operators.chunks import ChunkConfig, chunk_stats
from docmill.operators.crawl import CrawlLimits
from docmill.operators.embeddings import validate
from docmill.operators.evaluate import evidence, integrity, metrics, metrics_by, reliability_report, review_sample


def write_documents(docs: DataFrame, path: str) -> None:
    """Parquet, a row per URL, with the file name and the Markdown file that the document would have by itself."""
    url = F.col("url")
    docs.withColumns({"file_name": raw_file_name(url), "rendered": rendered(F.col("title"), url, F.col("markdown_content"))}).write.mode("overwrite").parquet(path)


def write_processed(processed: DataFrame, path: str) -> None:
    processed.withColumn("file_name", processed_file_name(F.col("url"))).write.mode("overwrite").parquet(path)


def write_json(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def write_reports(processed: DataFrame, scored: DataFrame, n_docs: int, path: str) -> None:
    """The reports of a cleaning run, each a folder of JSON lines."""
    reports = {
        "manifest": corpus_report(processed),
        "repeated_blocks": repeated_blocks(scored, n_docs),
        "removed_blocks": removed_report(scored),
        "signals": signal_histogram(scored),
        "detection": signal_report(scored),
        "review_set": review_set(processed, scored),
    }
    for name, rows in reports.items():
        write_json(rows, f"{path}/{name}")


def write_crawl_summary(parsed: DataFrame, report: DataFrame, metrics: DataFrame, path: str, limits: CrawlLimits | None = None, rules: UrlFilter = DEFAULT_RULES) -> None:
    """The settings of a crawl, what it did, what it took and failed to take, and what the rules held back."""
    settings = {"limits": asdict(limits or CrawlLimits()), "rules": {k: list(v) if isinstance(v, tuple) else v for k, v in vars(rules).items() if k != "extra"}}
    write_json(parsed.sparkSession.createDataFrame([(json.dumps(settings),)], "settings string").coalesce(1), f"{path}/config")
    write_json(metrics, f"{path}/metrics")
    write_json(parsed.where("failure IS NULL").select("url", F.lit("success").alias("status")), f"{path}/manifest")
    write_json(parsed.where("failure IS NOT NULL").select("url", F.col("failure").alias("error")), f"{path}/failures")
    write_json(report, f"{path}/filter_report")


def write_chunks(chunks: DataFrame, path: str, version: str, processed_version: str, n_documents: int) -> None:
    """The chunks, and the manifest of the run."""
    write_json(chunks, f"{path}/chunks")
    counted = chunks.agg(F.count(F.lit(1)).alias("total_chunks"))
    write_json(counted.select(F.lit(version).alias("chunking_version"), F.lit(processed_version).alias("source_processed_version"), F.lit(n_documents).alias("total_documents"), "total_chunks"), f"{path}/chunking_manifest")


def write_chunk_stats(chunks: DataFrame, path: str, config: ChunkConfig | None = None) -> None:
    """The configuration and the statistics, in one row."""
    settings = F.struct(*[F.lit(v).alias(k) for k, v in asdict(config or ChunkConfig()).items()]).alias("config")
    write_json(chunk_stats(chunks).select(settings, F.struct("*").alias("stats")), path)


def write_embedded_chunks(embedded: DataFrame, path: str, file_rows: int = 1) -> None:
    """JSON files of file_rows embedded chunks; with one row a file, a file per chunk."""
    embedded.write.mode("overwrite").option("maxRecordsPerFile", file_rows).json(path)


def write_evaluation(ranked: DataFrame, classified: DataFrame, queries: DataFrame, path: str, dataset: str = "", collection: str = "", version: str = "v1") -> None:
    """Metrics in all and by group, a Markdown summary, evidence, the review sample, integrity and reliability."""
    total, checked = metrics(ranked), integrity(queries)
    write_json(total.select(F.lit(dataset).alias("dataset_used"), F.lit(collection).alias("collection_used"), "*"), f"{path}/evaluation_metrics")
    write_json(metrics_by(ranked), f"{path}/evaluation_metrics_by_group")
    line = lambda name, c: F.format_string(f"- **{name}**: %.2f", c)
    summary = F.concat_ws("\n", F.lit(f"# Evaluation {version} Summary\n"), line("Recall@1", F.col("recall_at_1")), line("Recall@5", F.col("recall_at_5")), line("MRR", F.col("mrr")))
    total.select(summary).write.mode("overwrite").text(f"{path}/evaluation_summary")
    write_json(evidence(classified, queries), f"{path}/evidence")
    write_json(review_sample(ranked), f"{path}/review")
    write_json(checked, f"{path}/integrity")
    write_json(reliability_report(checked), f"{path}/benchmark_reliability_report")


def append_queries(queries: DataFrame, path: str) -> None:
    """Adds generated queries to an evaluation set; what is there stays, so a run that stops keeps what it has."""
    queries.write.mode("append").json(path)


def write_embeddings(embedded: DataFrame, path: str, dims: int) -> bool:
    """The check's report always, the vectors only if they pass."""
    report = validate(embedded, dims)
    write_json(report, f"{path}/validation_report")
    if not report.head()["is_valid"]:
        return False
    embedded.write.mode("overwrite").parquet(f"{path}/embeddings")
    return True
