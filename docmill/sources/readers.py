"""Scans of documents, chunks, vectors and evaluation sets, with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.functions.html import sitemap_urls
from docmill.operators.chunks import CHUNK_SCHEMA
from docmill.operators.evaluate import with_defaults

DOCUMENT = "url string, title string, markdown_content string, crawl_depth int, crawled_at timestamp, source_url string, outgoing_links array<string>, word_count int, status_code int, error string"
PROCESSED = DOCUMENT + ", cleaned_markdown string, page_category string"
EMBEDDED = CHUNK_SCHEMA + ", embedding array<float>, embedding_model string, embedded_at timestamp"
QUERY = "query string, expected_topic string, expected_content_type string, acceptable_documents array<string>, acceptable_headings array<string>, difficulty string, category string"
MANIFEST = "distance_metric string, model string, version string"
CORRUPT = "_corrupt_record"


def _json(spark: SparkSession, path: str, schema: str, recursive: bool = False, keep_bad: bool = False) -> DataFrame:
    reader = spark.read.option("multiLine", True).option("recursiveFileLookup", recursive).option("pathGlobFilter", "*.json")
    if keep_bad:
        return reader.schema(f"{schema}, {CORRUPT} string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path)
    return reader.schema(schema).option("mode", "DROPMALFORMED").json(path)


def read_documents(spark: SparkSession, path: str, keep_bad: bool = False) -> DataFrame:
    """The JSON files of a folder (not below it), one document each; malformed ones are left out, or kept in _corrupt_record."""
    return _json(spark, path, DOCUMENT, keep_bad=keep_bad)


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    """The JSON files at any depth but those in folders named metrics or review."""
    rows = _json(spark, path, PROCESSED, recursive=True).withColumn("_file", F.col("_metadata.file_path"))
    return rows.where(~F.col("_file").rlike("/(metrics|review)/[^/]*$")).drop("_file")


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of chunks, or a folder of them."""
    return _json(spark, path, CHUNK_SCHEMA)


def read_embedded(spark: SparkSession, path: str, keep_bad: bool = False) -> DataFrame:
    return _json(spark, path, EMBEDDED, recursive=True, keep_bad=keep_bad)


def read_queries(spark: SparkSession, path: str) -> DataFrame:
    return with_defaults(_json(spark, path, QUERY))


def read_manifest(spark: SparkSession, *paths: str) -> DataFrame:
    """The first manifest that exists; its distance metric is cosine where it names none."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        if place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
            rows = spark.read.schema(MANIFEST).option("multiLine", True).json(path)
            return rows.withColumn("distance_metric", F.coalesce("distance_metric", F.lit("cosine")))
    return spark.createDataFrame([("cosine", None, None)], MANIFEST)


def read_sitemap(spark: SparkSession, path: str) -> DataFrame:
    """The URLs of sitemap files, once each."""
    xml = spark.read.text(path, wholetext=True)
    return xml.select(F.explode(sitemap_urls(F.col("value"))).alias("url")).distinct()


def versions(spark: SparkSession, path: str) -> DataFrame:
    """The names of the folders in a folder; see functions.urls.latest_version."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [(x.getPath().getName(),) for x in fs.listStatus(place) if x.isDirectory()] if fs.exists(place) else []
    return spark.createDataFrame(names, "name string")
