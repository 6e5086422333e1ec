"""Best-fit packing of documents into sequences of a fixed capacity, in bulk-synchronous steps.

A step sorts documents and gaps by size into one order, in which a gap follows the documents that it holds, and sweeps
over it. The height of a place is the number of documents less the number of gaps up to it. On each level of height
documents and gaps alternate, and the gap behind a document on its level is its successor: the nearest one in size that no
document between them, larger and so of higher rank, takes. Surplus documents reach on to larger gaps or stay. A gap with
room for several of the longest documents that are left counts as that many. Gaps are updated, and the step is repeated.
Fresh sequences are opened when none of the longest documents found a gap: as many as these fill.

A step needs one shuffle, which deals rows to lanes of bounded size by a hash that changes with the step;
the windows of a lane run in that partition. A lane's level is crossed at most twice for each size.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docmill.llm.tables import stored
from docmill.llm.textbatch import slices

CAPACITY = 1024
END = 2
JSON, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
SPECIAL = "<|endoftext|>"
#: The pattern of the ranks backtracks over white space and dies in a run of a million characters; runs of this many
#: and more go to tokenizers.
BLANK = 100_000
_BLANK = re.compile(rf"(?<!\s)\s{{{BLANK}}}")  # tried once a run
#: Rows of a lane, which one task sorts.
LANE = 1 << 19
#: Up to this many of the longest documents to a sequence, fresh sequences are counted by them, beyond it by volume.
FEW = 3
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@cache
def _fast(path: str, pattern: str) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@cache
def _exact(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def encode(text: str | None, paths: tuple[str, str, str]) -> list[int]:
    """The ids that tokenizers gives for the JSON file, without special tokens added.

    The same vocabulary as ranks gives equal ids at a quarter of the time; a text that spells a special token, which
    the JSON file maps to one id, or has a very long run of white space goes to tokenizers itself.
    """
    if not text:
        return []
    if SPECIAL in text or len(text) >= BLANK and _BLANK.search(text):
        return _exact(paths[0]).encode(text, add_special_tokens=False).ids
    return _fast(paths[1], paths[2]).encode_ordinary(text)


def cuts(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones, behind a first one with the rest if there is a rest."""
    rest = length % capacity
    starts = ([0] if rest else []) + list(range(rest, length, capacity))
    return [(a, min(capacity, b - a)) for a, b in zip(starts, [*starts[1:], length], strict=True)]


def pieces(docs: DataFrame, capacity: int = CAPACITY, end: int = END, paths: tuple[str, str, str] | None = None) -> DataFrame:
    """One row per piece of each document. A null or empty text is the end id alone; repeated rows are kept."""
    if paths is None:
        import public_tokenizers as P

        paths = (P.path(JSON), P.path(RANKS), P.PATTERN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = np.array([*encode(text.as_py(), paths), end], "<u4")
                out += [(doc, k, at, n, zlib.crc32(ids[at : at + n].tobytes())) for k, (at, n) in enumerate(cuts(len(ids), capacity))]
            columns = list(zip(*out, strict=True))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, PIECES)


def sweep(docs: DataFrame, gaps: DataFrame, longest: int, most: int, lanes: int, turn: int, capacity: int) -> DataFrame:
    """One step. docs: id, size of documents of at most `longest`; gaps: id, size. Ids are distinct in each.

    Returns rows of documents that stay (gap is false: id, size) and of gaps (gap is true): slot 1 of each gap has in size
    what is left of it; slots that got a document have its id in doc and its offset in offset. A gap has a slot for each
    document of the greatest length that it holds, at least one and at most `most`.
    """
    slots = F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.floor(F.col("size") / longest), F.lit(most))).cast("int"))
    rows = docs.select("id", "size", F.lit(False).alias("gap"), F.lit(0).alias("slot")).unionByName(
        gaps.select("id", "size", F.lit(True).alias("gap"), slots.alias("slot")).withColumn("slot", F.explode("slot"))
    )
    order = ("size", "gap", "id", "slot")
    rows = rows.withColumn("lane", F.pmod(F.xxhash64("id", F.lit(turn)), F.lit(lanes)))
    height = F.sum(F.when(F.col("gap"), -1).otherwise(1)).over(Window.partitionBy("lane").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("level", height + F.col("gap").cast("int"))
    level, own = Window.partitionBy("lane", "level").orderBy(*order), Window.partitionBy("lane", "gap", "id")
    rows = rows.select("*", F.lead("id").over(level).alias("next"), F.lag("id").over(level).alias("doc"), F.lag("size").over(level).alias("taken"))
    taken = F.coalesce("taken", F.lit(0))
    before = F.coalesce(F.sum(taken).over(own.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.select(
        "gap", "id", "slot", F.when(F.col("gap"), F.col("size") - F.sum(taken).over(own)).otherwise(F.col("size")).alias("size"),
        F.when(F.col("gap"), F.col("doc")).alias("doc"), (capacity - F.col("size") + before).alias("offset"), "next",
    ).where("IF(gap, slot = 1 OR doc IS NOT NULL, next IS NULL)").drop("next")


def _fresh(docs: dict[int, int], before: dict[int, int] | None, gaps: int, capacity: int) -> int:
    """Sequences to open for documents by size, where `before` tells how many there were ahead of the last step."""
    fit = capacity // max(docs)
    if fit > FEW:
        return 0 if gaps and before != docs else max(1, sum(size * n for size, n in docs.items()) // capacity)
    like = [sum(n for size, n in table.items() if size * (fit + 1) > capacity) for table in (docs, before or docs)]
    return 0 if gaps and like[0] < like[1] else -(-like[0] // fit)


def places(docs: DataFrame, capacity: int) -> DataFrame:
    """id, sequence_id and offset for each row of docs (id, size from 1 to capacity). docs must be stored: it is read twice.

    What the driver sees of a step is the number of documents and gaps by size, at most twice the capacity of rows.
    """
    spark = docs.sparkSession
    done: list[DataFrame] = []
    gaps, rooms, before, opened = spark.createDataFrame([], "id long, size long"), {}, None, 0
    left = dict(map(tuple, docs.groupBy("size").agg(F.count(F.lit(1))).collect()))
    if left and not 1 <= min(left) <= max(left) <= capacity:
        raise ValueError(f"lengths from {min(left)} to {max(left)} do not fit 1 to {capacity}")
    while left:
        if new := _fresh(left, before, len(rooms), capacity):
            gaps = gaps.unionByName(spark.range(opened, opened + new).select("id", F.lit(capacity).cast("long").alias("size")))
            rooms[capacity], opened = rooms.get(capacity, 0) + new, opened + new
        n, longest = sum(left.values()), max(left)
        most = max(capacity // longest, -(-2 * n // sum(rooms.values())))
        lanes = 1 + (n + sum(max(1, min(size // longest, most)) * k for size, k in rooms.items())) // LANE
        step = stored(sweep(docs, gaps, longest, most, lanes, len(done), capacity))
        done.append(step.where("gap AND doc IS NOT NULL").select(F.col("doc").alias("id"), F.col("id").alias("sequence_id"), "offset"))
        docs, gaps = step.where("NOT gap").select("id", "size"), step.where("gap AND slot = 1").select("id", "size")
        counts = step.where("slot < 2").groupBy("gap", "size").agg(F.count(F.lit(1))).collect()
        before, left = left, {size: k for gap, size, k in counts if not gap}
        shortest = min(left, default=capacity)
        rooms = {size: k for gap, size, k in counts if gap and size >= shortest}
        gaps = gaps.where(F.col("size") >= shortest)
    return reduce(DataFrame.unionByName, done) if done else spark.createDataFrame([], "id long, sequence_id long, offset long")


def pack(sized: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to rows that have a length from 1 to capacity and no such columns, nor one called _row.

    No sequence exceeds the capacity, offsets are gapless from 0. Repeated rows get places of their own; an empty table
    gives an empty table. Rows are numbered once and stored, so a lost executor changes nothing.
    """
    rows = stored(sized.withColumn("_row", F.monotonically_increasing_id()))
    placed = places(rows.select(F.col("_row").alias("id"), F.col("length").cast("long").alias("size")), capacity)
    return rows.join(placed.withColumnRenamed("id", "_row"), "_row").drop("_row")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """A row per piece of each document with its place: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is one piece of the end id; a text of more than the capacity is cut into full pieces behind a
    shorter first one. Repeated rows and rows without a doc_id are packed each by itself. An empty table gives an empty
    table; further columns, of any name, are not read. Which of equally long pieces gets which place is not defined.
    """
    return pack(pieces(docs, capacity), capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
