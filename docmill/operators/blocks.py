"""Markdown documents as blocks: one row per block with its type and measures.

A task cuts each of its documents; all else is an expression on one block. A document is the largest group.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docmill.functions.text import FENCE, SPACES, content_hash, total
from docmill.session import small_batches

LINK_TEXT = r"\[([^\]]+)\]\([^\)]+\)"
NO_WORD = r"[^\p{L}\p{N}_]+"


def blocks_of(text: str) -> list[str]:
    """The blocks of one document, stripped. A line is a block, but fenced code and runs of |rows| are one; blank ones are dropped."""
    lines = text.split("\n")
    if FENCE not in text and "|" not in text:
        return [bare for line in lines if (bare := line.strip(SPACES))]
    runs: list[list[str]] = []
    code, table, ends = False, False, True
    for line in lines:
        bare = line.strip(SPACES)
        row, was = bare[:1] == "|" == bare[-1:], table
        code ^= line.count(FENCE) % 2 == 1
        table = table if code else row
        if ends or (not code and was and not row):
            runs.append([])
        runs[-1].append(line)
        ends = not code and not table
    return [bare for run in runs if (bare := "\n".join(run).strip(SPACES))]


def split_blocks(docs: DataFrame, doc: str = "doc", text: str = "markdown_content") -> DataFrame:
    """(doc, block_idx, content, n_blocks: how many the document has). A document is one row, and is cut where it is read."""
    small_batches(docs.sparkSession)

    @F.arrow_udf("array<string>")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else blocks_of(t) for t in texts.to_pylist()], pa.list_(pa.string()))

    cut = docs.select(F.col(doc).alias("doc"), run(F.col(text)).alias("_blocks"))
    return cut.select("doc", F.size("_blocks").alias("n_blocks"), F.posexplode("_blocks").alias("block_idx", "content")).select("doc", "block_idx", "content", "n_blocks")


def _types(c: Column) -> dict[str, Column]:
    code = c.startswith(FENCE) & c.endswith(FENCE)
    heading = ~code & c.startswith("#")
    table = ~code & ~heading & (F.contains(c, F.lit("|---")) | F.contains(c, F.lit("---|")))
    listed = ~code & ~heading & ~table & (c.startswith("- ") | c.startswith("* ") | c.rlike(r"(?U)^\d+\.\s"))
    return {"is_code": code, "is_heading": heading, "is_table": table, "is_list": listed}


def measure_blocks(blocks: DataFrame) -> DataFrame:
    """Adds type flags, content_hash, position_ratio, word_count, unique_word_ratio, link_count and link_density."""
    c = F.col("content")
    words = F.array_remove(F.split(F.lower(c), NO_WORD), "")  # many times as fast as taking matches
    shown = F.regexp_extract_all(c, F.lit(LINK_TEXT), F.lit(1))
    out = blocks.withColumns({**_types(c), "content_hash": content_hash(c), "_words": words, "_links": shown})
    n = F.col("n_blocks") if "n_blocks" in blocks.columns else F.count(F.lit(1)).over(Window.partitionBy("doc"))
    return out.withColumns(
        {
            "position_ratio": F.col("block_idx") / n,
            "word_count": F.size("_words").cast("long"),
            "unique_word_ratio": F.when(F.size("_words") > 0, F.size(F.array_distinct("_words")) / F.size("_words")).otherwise(0.0),
            "link_count": F.size("_links").cast("long"),
            "link_density": total(F.transform("_links", lambda x: F.length(x).cast("long"))) / F.length(c),
        }
    ).drop("_words", "_links", "n_blocks")
