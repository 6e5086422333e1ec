"""The jobs as registered queries, with their SQL."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.functions.urls import PAGINATION_KEYS
from docmill.plans.sql import BLOCKS, MARK, MEASURED, PROCESSED, SCORED, URLS, quoted, strip, with_, words
from docmill.plans.fixtures import MARKDOWN
from jobs import corpus_cleaning, page_ingest


def _new_folder(spark: SparkSession, name: str) -> str:
    """A folder that no other call has, in the shared folder of the session."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="docmill-jobs-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def job1_corpus_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned documents, after a run and a rerun into the same folder."""
    output = _new_folder(spark, "corpus-cleaning")
    for _ in range(2):
        out = corpus_cleaning.clean_corpus(spark, f"{sf_dir}/documents.parquet", output)
    return out.withColumn("retention", F.round("retention", 6))


def job2_page_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, after a run that takes all files and one that finds nothing new."""
    output = _new_folder(spark, "page-ingest")
    for _ in range(2):
        out = page_ingest.ingest_pages(spark, f"{sf_dir}/pages.parquet", f"{output}/table", f"{output}/checkpoint")
    return out.withColumns({"n_links": F.size("outgoing_links").cast("long")}).drop("outgoing_links")


_PLAIN = "SELECT doc_id AS doc, text AS markdown_content FROM documents"
_CLEANED = with_(BLOCKS.replace(MARKDOWN, _PLAIN), MEASURED, SCORED, PROCESSED) + """SELECT p.doc AS doc_id, cleaned AS cleaned_markdown, page_category, p.blocks_removed, p.blocks_retained, words_before, words_after,
  round(CASE WHEN words_before > 0 THEN words_after / words_before::DOUBLE * 100 ELSE 0.0 END, 6) AS retention, d.lang
FROM processed p JOIN full_docs f ON p.doc = f.doc JOIN documents d ON d.doc_id = p.doc"""

_RULES = page_ingest.Config()
_LANG = r"""regexp_extract(lower(html), '<html\b[^>]*\blang=["'']?([^"''\s>]+)', 1)"""
_INGESTED = with_(URLS, MARK) + rf"""SELECT page_id, url, norm_url, title, md AS markdown_content, len({words('md')})::BIGINT AS word_count, lang, 0::BIGINT AS batch, n_links FROM (
  SELECT n.page_id, n.url, norm_url, md, {_LANG} AS lang, len(list_distinct(regexp_extract_all(md, '\[.+?\]\((.+?)\)', 1)))::BIGINT AS n_links,
    CASE WHEN regexp_matches(md, '(?m)^# ') THEN {strip("replace(regexp_extract(md, '(?m)^(# .*)$', 1), '# ', '')")} ELSE string_split(regexp_replace(n.path, '/+$', ''), '/')[-1] END AS title,
    row_number() OVER (PARTITION BY norm_url ORDER BY n.page_id, n.url) AS r
  FROM normal n JOIN marked m USING (page_id)
  WHERE NOT ({" OR ".join(f"regexp_matches(n.url, {quoted('^(?:' + p + ')')})" for p in _RULES.exclude_patterns)}) AND length(path) >= {_RULES.min_path_length}
    AND len(list_filter(pairs, lambda p: regexp_matches(string_split(p, '=')[1], '^({"|".join(PAGINATION_KEYS)})$'))) = 0 AND starts_with({_LANG}, 'en') AND md <> ''
) x WHERE r = 1"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"job1_corpus_cleaning": job1_corpus_cleaning, "job2_page_ingest": job2_page_ingest}
ORACLE_SQL: dict[str, str] = {"job1_corpus_cleaning": _CLEANED, "job2_page_ingest": _INGESTED}
