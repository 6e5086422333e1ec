"""From documents to packed training sequences: language ID, near duplicates, repeated passages, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docmill.llm import jaccard, langid, packing, recompression
from docmill.llm.tables import Stored


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has letters and, by the word labels, a main language; the labelled ones teach the model."""
    return langid.accepted(docs, langid.fit(docs.select("doc_id", "text", "lang")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least doc_id of each group that is linked at a similarity of 0.8 on five-word shingles."""
    return jaccard.one_of_each(docs, words=5, num=80, den=100)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 35 words or more that occur more than once; emptied documents go."""
    return recompression.deduplicated(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens in as few sequences as best-fit finds."""
    return packing.pack_documents(docs)


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("substring_dedup", substring_dedup), ("packing", pack)]

#: SQL expresses neither the model of the first stage nor the tokenizer of the last.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over the table documents; each one's result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = Stored(stage(spark, docs, sf_dir)).df
    return STAGES[-1][1](spark, docs, sf_dir)
