"""Inputs that the tables lack, as SQL that Spark and DuckDB both read: Markdown documents, link edges and evaluation sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

NL = "chr(10)"
FENCE = "repeat(chr(96), 3)"

#: Every document whole, its sentences as paragraphs, with headings, code, a table, lists, links and a date around it.
MARKDOWN = f"""
SELECT doc_id AS doc, concat('http://docs.example.com/', source, '/', lang, '/', doc_id) AS url, concat('Document ', doc_id) AS title, source, lang,
  concat(
    CASE WHEN doc_id % 7 = 0 THEN concat('[Home](http://docs.example.com/) [Docs](http://docs.example.com/docs)', {NL}) ELSE '' END,
    '# Document ', doc_id, {NL}, {NL},
    CASE WHEN doc_id % 3 = 0 THEN concat({FENCE}, 'py', {NL}, 'x = ', doc_id, {NL}, {NL}, 'y = 2', {NL}, {FENCE}, {NL}) ELSE '' END,
    '## Text', {NL}, {NL}, replace(text, '. ', concat('.', {NL}, {NL})), {NL}, {NL},
    CASE WHEN doc_id % 4 = 1 THEN concat('| a | b |', {NL}, '|---|---|', {NL}, '| 1 | ', doc_id, ' |', {NL}, {NL}) ELSE '' END,
    CASE WHEN doc_id % 5 = 2 THEN concat('#### Deep', {NL}, {NL}, '- one', {NL}, '- [two](http://docs.example.com/', doc_id % 9, ')', {NL}, '1. three', {NL}, {NL}) ELSE '' END,
    '## See also', {NL}, {NL}, '- [part ', doc_id % 11, '](http://docs.example.com/part)', {NL},
    'Updated 2024-01-', CASE WHEN doc_id % 2 = 0 THEN '02' ELSE '13' END, ' [terms](http://docs.example.com/terms)'
  ) AS markdown_content
FROM documents
"""

#: Page i links to pages 2i + 1 and 2i + 2 of the table by their place in order, and to a file that rules exclude.
EDGES = """
SELECT concat('http://site.example.com/page/', n) AS url, n,
  concat('http://site.example.com/page/', 2 * n + 1) AS a, concat('http://site.example.com/page/', 2 * n + 2) AS b, concat('http://site.example.com/file/', n, '.pdf') AS c
FROM (SELECT row_number() OVER (ORDER BY page_id) - 1 AS n FROM pages) t
"""

#: A query per benchmark passage; the documents that hold the passage are acceptable.
EVALUATION = """
SELECT item_id AS query_id, text AS query,
  CASE WHEN item_id % 3 = 0 THEN 'easy' WHEN item_id % 3 = 1 THEN 'medium' ELSE 'hard' END AS difficulty,
  CASE WHEN item_id % 2 = 0 THEN 'Concept' ELSE 'Howto' END AS category,
  CASE WHEN item_id % 4 = 0 THEN '' ELSE concat('topic ', item_id % 5) END AS expected_topic
FROM benchmark
"""


def tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def select(spark: SparkSession, sf_dir: str, sql: str, table: str) -> DataFrame:
    """A fixture over one table, without registering a name."""
    return spark.sql(sql.replace(f"FROM {table}", "FROM {t}"), t=spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select(spark, sf_dir, MARKDOWN, "documents")
