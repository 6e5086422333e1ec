"""Placement of documents by a hierarchical weighted hash tree.

A tree has regions, racks in a region and shards in a rack; a node weighs what its shards weigh together. A key
descends from the root: at each node every child draws -ln(u) / weight, u being a hash of the key and the child in
(0, 1), and the least draw wins, so that a child gets its share by weight. A draw depends on the key, the child and
the child's weight alone. Where weights change, keys therefore move only from or into the children whose weights
changed, and a subtree without changes keeps every key that still reaches it in its place.

A shard that joins an existing rack makes its rack and region heavier, and the keys these win spread over the rack's
other shards too. grow() therefore opens a region with one rack for a new shard: the only changed subtree is the new
shard itself, and it alone receives rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docmill.llm.tables import partitions, stored

LAW = "key"
#: Rows of a shard are numbered in at least so many parts, each sorted by itself; a parameter of number_slots.
SLOT_PARTS = 256


@dataclass(frozen=True)
class Leaf:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def topology(shards: int, regions: int = 3, racks: int = 2) -> list[Leaf]:
    """shards of equal weight, dealt over the racks in blocks."""
    if shards < 1:
        raise ValueError("a tree needs a shard")
    cells = min(regions * racks, shards)
    return [Leaf((cell := k * cells // shards) // racks, cell % racks, k) for k in range(shards)]


def grow(tree: Sequence[Leaf], weight: float = 1.0) -> list[Leaf]:
    """The tree with one more shard, in a region of its own."""
    return [*tree, Leaf(max(x.region for x in tree) + 1, 0, max(x.shard for x in tree) + 1, weight)]


def _draw(key: Column, node: str, weight: float) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(node)), 11).cast("double")
    return -F.log((bits + 0.5) / float(1 << 53)) / F.lit(float(weight))


def _winner(key: Column, children: dict[str, float]) -> Column:
    """The place, among the children in order, of the least draw."""
    draws = [F.struct(_draw(key, name, weight).alias("draw"), F.lit(k).alias("child")) for k, (name, weight) in enumerate(children.items()) if weight > 0]
    return F.least(*draws)["child"] if len(draws) > 1 else draws[0]["child"]


def place(key: Column, tree: Sequence[Leaf]) -> Column:
    """The shard of key. Equal keys, null included, share a shard; nodes of weight 0 get none."""
    if not any(x.weight > 0 for x in tree):
        raise ValueError("a tree needs a shard of positive weight")

    def descend(leaves: Sequence[Leaf], level: int, name: str) -> Column:
        if level == 3:
            return F.lit(leaves[0].shard)
        groups: dict[int, list[Leaf]] = {}
        for x in leaves:
            groups.setdefault((x.region, x.rack, x.shard)[level], []).append(x)
        names = [f"{name}/{k}" for k in groups]
        live = {n: sum(x.weight for x in g) for n, g in zip(names, groups.values(), strict=True)}
        below = [descend(g, level + 1, n) for n, g in zip(names, groups.values(), strict=True)]
        if len(below) == 1:
            return below[0]
        won = _winner(key, live)
        out = F.when(won == 0, below[0])
        for k, column in enumerate(below[1:], 1):
            out = out.when(won == k, column)
        return out

    return descend(tree, 0, "").cast("int")


def number_slots(df: DataFrame, group: str, key: Sequence[str], order: Sequence[str], out: str = "slot", parts: int = SLOT_PARTS) -> DataFrame:
    """Gapless numbers from 0 within each group, whose values are few.

    A group's rows are dealt by a hash of the key columns to parts that are counted and sorted apart, so no task holds
    a group. The counts read the group and the key alone; their table has at most groups x parts rows.
    """
    df = df.withColumn("_part", F.pmod(F.xxhash64(*key, F.lit("slot")), F.lit(parts)).cast("int"))
    counts = df.groupBy(F.col(group).alias("_group"), F.col("_part").alias("_of")).agg(F.count(F.lit(1)).alias("_rows"))
    before = counts.selectExpr("_group", "_of", "sum(_rows) OVER (PARTITION BY _group ORDER BY _of ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _before")
    numbered = df.withColumn("_at", F.row_number().over(Window.partitionBy(group, "_part").orderBy(*key, *order)))
    joined = numbered.join(before, (F.col(group) == F.col("_group")) & (F.col("_part") == F.col("_of")), "left")
    return joined.withColumn(out, (F.coalesce("_before", F.lit(0)) + F.col("_at") - 1).cast("long")).drop("_group", "_of", "_part", "_at", "_before")


def shard_documents(docs: DataFrame, tree: Sequence[Leaf], grown: Sequence[Leaf] | None = None) -> DataFrame:
    """Every row with its shard, its slot there, and its shard after growth.

    Returns doc_id, size, text_crc32, law, shard, slot, grown_shard. Law: doc_id and the tree decide. A null text has
    size 8 and the checksum of an empty text; a null doc_id is a key like others. Repeated rows keep one shard and
    get slots of their own. An empty table gives an empty table; further columns of docs are not read.

    Texts are read once, into a stored table of narrow rows. Slots are dealt by a hash of all columns, so the rows of
    one doc_id, a frequent null included, are numbered in many tasks.
    """
    text = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(F.coalesce(F.col("text"), F.lit(""))) + 8).cast("long").alias("size"), F.crc32(text).cast("long").alias("text_crc32"), F.lit(LAW).alias("law")
    )
    rows = rows.withColumns({"shard": place(F.col("doc_id"), tree), "grown_shard": place(F.col("doc_id"), grown or grow(tree))})
    parts = max(SLOT_PARTS, partitions(docs.sparkSession))
    return number_slots(stored(rows), "shard", ["doc_id", "size", "text_crc32"], [], parts=parts).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op1_sharding(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return shard_documents(docs, topology(24))
