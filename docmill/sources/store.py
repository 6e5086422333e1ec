"""A vector store and a BM25 index as Parquet tables in versioned folders."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.operators.search import build_index, dense_top_k
from docmill.sources.readers import CORRUPT, read_embedded
from docmill.sources.vector_index import VectorIndex

METADATA = ("source_url", "source_document", "title", "section_title", "chunk_index", "total_chunks", "token_count", "content_type", "document_version", "chunk_version")


def metadata() -> Column:
    """The flat form of a chunk's metadata: scalars, and the heading path as JSON text."""
    return F.struct(*METADATA, F.to_json("heading_path").alias("heading_path"))


class VectorStore:
    """Rows of chunk_id, embedding, metadata and text. A chunk_id that is there keeps its row."""

    def __init__(self, spark: SparkSession, path: str, metric: str = "cosine") -> None:
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if self._fs.exists(self._path(f"{self.path}/properties")):
            self.metric = json.loads(spark.read.text(f"{self.path}/properties").head()[0])["metric"]
        else:
            self.metric = metric
            spark.createDataFrame([(json.dumps({"metric": metric}),)], "value string").coalesce(1).write.text(f"{self.path}/properties")

    def _exists(self) -> bool:
        return self._fs.exists(self._path(f"{self.path}/rows/_SUCCESS"))

    def table(self) -> DataFrame:
        if not self._exists():
            raise ValueError("the store is empty")
        return self.spark.read.parquet(f"{self.path}/rows")

    def size(self) -> int:
        return self.table().count() if self._exists() else 0

    def load(self, chunks: DataFrame) -> int:
        """Appends the chunks whose ids are new, once each; returns how many."""
        rows = chunks.dropDuplicates(["chunk_id"]).select("chunk_id", "embedding", metadata().alias("metadata"), F.col("chunk_text").alias("text"))
        before = self.size()
        if before:
            rows = rows.join(self.table().select("chunk_id"), "chunk_id", "left_anti")
        rows.write.mode("append").parquet(f"{self.path}/rows")
        if (index := self.index()) is not None:
            # whatever the index lacks, so that a load that was stopped is made up for
            index.add(self._vectors().join(index.vectors().select("item_id"), "item_id", "left_anti"))
        return self.size() - before

    def _vectors(self) -> DataFrame:
        return self.table().select(F.col("chunk_id").alias("item_id"), F.col("embedding").alias("vector"))

    def index(self) -> VectorIndex | None:
        """The index of the rows, if there is one."""
        return VectorIndex(self.spark, f"{self.path}/index") if self._fs.exists(self._path(f"{self.path}/index/cells/_SUCCESS")) else None

    def build_index(self, cells: int | None = None) -> VectorIndex:
        """Indexes all rows; later loads are added, and queries read only the cells they need."""
        return VectorIndex.build(self._vectors(), f"{self.path}/index", self.metric, cells)

    def load_folder(self, path: str) -> tuple[int, int]:
        """Appends the embedded chunks of a folder of JSON files; returns how many rows were new and how many were bad."""
        rows = read_embedded(self.spark, path, keep_bad=True)
        bad = F.col(CORRUPT).isNotNull() | F.col("chunk_id").isNull() | F.col("embedding").isNull()
        # the column of bad records alone may not be asked of files, so the rows are counted with their ids
        failed = rows.select("chunk_id", bad.alias("bad")).where("bad").count()
        return self.load(rows.where(~bad).drop(CORRUPT)), failed

    def query(self, queries: DataFrame, k: int = 5, exact: bool = True) -> DataFrame:
        """The k nearest rows of each query (query_id, vector), with text and metadata: by the index if there is one, else by a scan.

        exact=False: with an index, only the cells of nearest centroids are read (see VectorIndex.calibrate).
        """
        index = self.index()
        found = index.query(queries, k, exact=exact) if index else dense_top_k(queries, self._vectors(), k, self.metric)
        return found.join(self.table().select(F.col("chunk_id").alias("item_id"), "text", "metadata"), "item_id")


def write_index(docs: DataFrame, path: str, item: str = "item_id", text: str = "text") -> None:
    """Postings are sorted by term in each file, so that a scan for a few terms skips the rest."""
    for name, table in build_index(docs, item, text).items():
        if name == "postings":
            table = table.repartitionByRange("term").sortWithinPartitions("term")
        table.write.mode("overwrite").parquet(f"{path}/{name}")


def read_index(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{path}/{name}") for name in ("postings", "lengths", "terms")}
