"""Incremental ingestion of documents: new URLs once each, within a watermark, into a versioned table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docmill.functions.urls import UrlFilter, normalize
from docmill.sources.readers import DOCUMENT


def read_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(DOCUMENT).option("pathGlobFilter", "*.json").json(path)


def fresh(docs: DataFrame, rules: UrlFilter, delay: str = "1 hour") -> DataFrame:
    """Documents that the rules let through, the first of each normalised URL within the delay."""
    kept = docs.withColumns({"norm_url": normalize(F.col("url")), "crawled_at": F.coalesce("crawled_at", F.current_timestamp())}).where(rules.reason(F.col("url")).isNull())
    return kept.withWatermark("crawled_at", delay).dropDuplicatesWithinWatermark(["norm_url"])


def ingest(docs: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends batch after batch; the file sink commits each once."""
    return docs.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def counts_by_window(events: DataFrame, time: str = "ts", size: str = "5 minutes", delay: str = "10 minutes", key: str = "event_type") -> DataFrame:
    return events.withWatermark(time, delay).groupBy(F.window(time, size).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), key, "n")
