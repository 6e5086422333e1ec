import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from docmill.llm.sharding import Leaf, grow, place, shard_documents, topology

ROWS = [(k, f"text {k} é" * (k % 5)) for k in range(3000)]


def docs(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def test_rows_slots_and_checksums(spark):
    got = shard_documents(docs(spark, ROWS), topology(24)).collect()
    text = dict(ROWS)
    assert len(got) == len(ROWS)
    slots = defaultdict(list)
    for r in got:
        assert r.size == len(text[r.doc_id].encode()) + 8 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode())
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(24))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) < 2 * min(map(len, slots.values()))


def test_growth_moves_rows_into_the_new_shard_only(spark):
    got = shard_documents(docs(spark, ROWS), topology(24)).collect()
    moved = [r for r in got if r.grown_shard != r.shard]
    assert moved and all(r.grown_shard == 24 for r in moved)
    assert 60 < len(moved) < 200
    again = {r.doc_id: r.shard for r in shard_documents(docs(spark, ROWS), grow(topology(24))).collect()}
    assert all(again[r.doc_id] == r.grown_shard for r in got)


def test_a_changed_weight_leaves_other_subtrees_alone(spark):
    tree = topology(12)
    heavier = [Leaf(x.region, x.rack, x.shard, 3.0 if x.shard == 5 else x.weight) for x in tree]
    home = next(x for x in tree if x.shard == 5)
    frame = docs(spark, ROWS)
    rows = frame.select(place(frame.doc_id, tree).alias("a"), place(frame.doc_id, heavier).alias("b")).collect()
    of = {x.shard: x for x in tree}
    for a, b in rows:
        assert a == b or of[b].region == home.region
        if of[a].region == of[b].region and (of[a].rack, a) != (of[b].rack, b):
            assert of[b].rack == home.rack
    n = Counter(r.b for r in rows)
    assert n[5] > 2 * n[11]


def test_nulls_repeats_empty_tables_and_extra_columns(spark):
    rows = [(1, None, "x"), (1, None, "x"), (None, "a", "y"), (None, "a", "y"), (2, "", "z"), (3, "w " * 50000, "q")]
    frame = docs(spark, rows, "doc_id long, text string, shard string")
    got = shard_documents(frame, topology(24)).collect()
    assert len(got) == 6
    assert sorted(r.size for r in got) == [8, 8, 8, 9, 9, 100008]
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert shard_documents(docs(spark, []), topology(24)).count() == 0


def test_descent_against_the_definition(spark):
    """Each level drawn in plain Python: the child whose -ln(u) / weight is least, u from the hash of the key and the child's name."""
    import math
    import struct

    import xxhash

    def draw(key, node, weight):
        seed = 42 if key is None else xxhash.xxh64(struct.pack("<q", key), seed=42).intdigest()
        bits = xxhash.xxh64(node.encode(), seed=seed).intdigest() >> 11
        return -math.log((bits + 0.5) / 2**53) / weight

    def descend(key, leaves, level=0, name=""):
        if level == 3:
            return leaves[0].shard
        groups = {}
        for x in leaves:
            groups.setdefault((x.region, x.rack, x.shard)[level], []).append(x)
        live = {k: g for k, g in groups.items() if sum(x.weight for x in g) > 0}
        best = min(live, key=lambda k: draw(key, f"{name}/{k}", sum(x.weight for x in live[k]))) if len(groups) > 1 else next(iter(groups))
        return descend(key, groups[best], level + 1, f"{name}/{best}")

    keys = [None, *range(-5, 400), 2**62]
    for tree in (topology(24), grow(topology(24)), [Leaf(0, 0, 0, 3.0), Leaf(0, 1, 1, 0.5), Leaf(2, 0, 2, 1.0), Leaf(2, 0, 3, 0.0), Leaf(2, 0, 4, 7.0)]):
        got = spark.createDataFrame([(k,) for k in keys], "k long").select("k", place(F.col("k"), tree).alias("s")).collect()
        assert {r.k: r.s for r in got} == {k: descend(k, tree) for k in keys}


def test_rows_of_one_id_are_numbered_apart(spark):
    """100,000 rows without an id: one shard, gapless slots, and no part of the numbering that holds many of them."""
    rows = shard_documents(spark.range(100_000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text")), topology(24))
    got = rows.agg(F.count_distinct("shard"), F.count_distinct("slot"), F.min("slot"), F.max("slot")).head()
    assert tuple(got) == (1, 100_000, 0, 99_999)
    key = F.pmod(F.xxhash64("doc_id", "size", "text_crc32", F.lit("slot")), F.lit(256))
    assert rows.groupBy(key).count().agg(F.max("count")).head()[0] < 1000
