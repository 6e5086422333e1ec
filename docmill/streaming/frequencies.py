"""Block frequencies that are kept up to date: a batch of new or changed documents adds signed changes.

For every batch the table `hashes` gets what blocks its documents have now, and `changes` by how much the count of
documents of each block goes up or down: a document's earlier blocks, from the last batch that had it, are taken back. The
sum of the changes is the frequency of a block, whatever order documents came in and however often. Each batch has a
folder of its number, which running it again overwrites.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docmill.functions.text import content_hash
from docmill.operators.blocks import split_blocks

CHANGES = "content_hash string, change long, batch long"


class BlockFrequencies:
    """The folder of the two tables. key: the type of the documents' keys."""

    def __init__(self, spark: SparkSession, path: str, key: str = "long") -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._hashes = f"doc {key}, hashes array<string>, batch long"
        for name, kind in (("hashes", self._hashes), ("changes", CHANGES)):
            spark.createDataFrame([], kind).write.mode("ignore").partitionBy("batch").parquet(f"{self.path}/{name}")

    def _read(self, name: str, kind: str) -> DataFrame:
        return self.spark.read.schema(kind).parquet(f"{self.path}/{name}")

    def take(self, docs: DataFrame, batch: int, doc: str = "doc", text: str = "markdown_content") -> None:
        """Takes a batch in. Of rows of one document in a batch, the one of the greatest text counts; rows without a key are left out.

        A null or empty text has no blocks: a page that was emptied takes its blocks back.
        """
        now = docs.where(F.col(doc).isNotNull()).groupBy(F.col(doc).alias("doc")).agg(F.max(F.coalesce(F.col(text), F.lit(""))).alias("markdown_content")).persist()
        own = split_blocks(now).select("doc", content_hash(F.col("content")).alias("h")).groupBy("doc").agg(F.collect_set("h").alias("hashes"))  # a document's blocks
        none = F.array().cast("array<string>")
        own = now.select("doc").join(own, "doc", "left").select("doc", F.coalesce("hashes", none).alias("hashes"))
        own.write.mode("overwrite").parquet(f"{self.path}/hashes/batch={batch}")
        own = self._read("hashes", self._hashes).where(F.col("batch") == batch).select("doc", "hashes")
        past = self._read("hashes", self._hashes).where(F.col("batch") < batch).join(own.select("doc"), "doc", "left_semi")
        past = past.groupBy("doc").agg(F.max_by("hashes", "batch").alias("old"))
        both = own.join(past, "doc", "left").withColumn("old", F.coalesce("old", none))
        signed = lambda c, n: F.transform(c, lambda h: F.struct(h.alias("content_hash"), F.lit(n).cast("long").alias("change")))
        moved = F.concat(signed(F.array_except("hashes", "old"), 1), signed(F.array_except("old", "hashes"), -1))
        changes = both.select(F.inline(moved)).groupBy("content_hash").agg(F.sum("change").alias("change")).where("change <> 0")
        changes.write.mode("overwrite").parquet(f"{self.path}/changes/batch={batch}")
        now.unpersist()

    def follow(self, docs: DataFrame, checkpoint: str, doc: str = "doc", text: str = "markdown_content") -> StreamingQuery:
        """Takes in what a stream of documents has, batch by batch, and ends when nothing is left."""
        return docs.writeStream.foreachBatch(lambda rows, n: self.take(rows, n, doc, text)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    def documents(self) -> int:
        """How many documents have been seen."""
        return self._read("hashes", self._hashes).select("doc").distinct().count()

    def frequencies(self) -> DataFrame:
        """(content_hash, n_docs) of all blocks that some document has now."""
        return self._read("changes", CHANGES).groupBy("content_hash").agg(F.sum("change").alias("n_docs")).where("n_docs > 0")

    def repeated(self, n_docs: Column | int, top: int = 100) -> DataFrame:
        """As clean.repeated_blocks of the documents' last versions."""
        share = F.col("n_docs") / (n_docs if isinstance(n_docs, Column) else F.lit(n_docs)) * 100
        return self.frequencies().withColumn("percent", share).orderBy(F.desc("n_docs"), "content_hash").limit(top)
