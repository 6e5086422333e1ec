"""Exact n-gram Jaccard self-join with an R-tree over count vectors.

A document's set holds the hashes of its distinct word n-grams. The hashes are dealt to GROUPS groups; how many fall
into each is the document's point. Two sets share at most the sum of the coordinate minima of their points, and a set
shares at most that sum over the upper corner of a box with any set whose point lies in the box. An R-tree of such
boxes therefore finds every pair that may be similar enough. Survivors are held to the same bound with as many groups as
suit their sizes, and what is left is verified on the sets.

Trees are built where similar sets must meet: sets of Jaccard similarity t share one of the first
n - ceil(t * n) + 1 members in any common order, so a set goes to the blocks of those. The order puts members of
common groups of hashes last (a sketch of bounded size counts them), which keeps blocks small. Sets of equal members
are one class throughout.

A block of many classes is cut twice: into bands of sizes, as only sets of one band or of neighbouring bands can be
similar, and a band by a hash of the class. Two classes that share several large blocks are joined in the first of them:
a row knows the larger blocks of its class.

Blocks are joined in three sweeps. The first verifies each class against a few of the least classes of its blocks,
and the two ends of each block against one another, which is all there is to a block of two classes. The second builds the trees of the blocks that still hold several components, one for all blocks of one least class, split
where they are large, and verifies the likeliest pairs of each class. Both link large groups of near copies at a cost that grows with the group, not with its
square. The third takes all pairs that the trees let through and that are not in one component already, so no component is torn.
The links are counted inside the components that result, each of which is joined with itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docmill.llm.components import components
from docmill.llm.tables import Stored
from docmill.llm.textbatch import Words, distinct, lists, mix, powers, slices, trim

WORDS, NUM, DEN = 5, 80, 100
GROUPS = 64
LEAF, FAN = 16, 8
#: Classes of one block that a task joins with as many others at once.
SPLIT = 1024
#: Set members of one component that a task compares with as many others at once.
MEMBERS = 1 << 20
#: Least classes of its blocks that a class is verified against in the first sweep.
PIVOTS = 3
#: Likeliest pairs of each class of a block that the second sweep verifies.
NEAREST = 3
#: Counters of the sketch of common n-grams.
SKETCH, CHUNK = 1 << 20, 1 << 12
#: Bits of a filter of wanted rows for each of them, and the most bits that are broadcast. Where more rows are wanted
#: than that holds, there is no filter, and the join alone finds them.
BITS, MOST_BITS = 16, 1 << 27
#: A row of a block knows up to so many larger blocks of its class, of blocks with more than BIG classes.
BEFORE, BIG = 8, 64
_GRAM = 0xBF58476D1CE4E5B9


def gram_sets(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct n-gram hashes in ascending order, and where each text's begin.

    A text of fewer words has its whole sequence as the only member; one without words has an empty set.
    """
    found = Words(column, lower=True)
    values, first = found.hashes(), found.first
    n = np.diff(first)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(_GRAM, len(values)), out=total[1:])
    inverse = powers(pow(_GRAM, -1, 1 << 64), len(values) + 1)
    size = np.minimum(n, words)
    count = np.where(n > 0, n - size + 1, 0)
    begin = np.cumsum(count) - count
    start = np.arange(int(count.sum())) - np.repeat(begin, count) + np.repeat(first[:-1], count)
    length = np.repeat(size, count)
    grams = mix((total[start + length] - total[start]) * inverse[start] + length.astype(np.uint64))
    return distinct(grams, np.append(begin, count.sum()))


def digests(sets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A name of each set; 0 for an empty one."""
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(sets ^ np.uint64(0x2545F4914F6CDD1D)))))
    n = np.diff(first).astype(np.uint64)
    return np.where(n > 0, mix(mix(total[first[1:]] - total[first[:-1]]) + n), np.uint64(0))


def points(sets: np.ndarray, first: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    """Counts by group, at most 255; a coordinate of 255 stands for any count."""
    of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    flat = np.bincount(of * groups + (mix(sets) % np.uint64(groups)).astype(np.int64), minlength=(len(first) - 1) * groups)
    return np.minimum(flat, 255).astype(np.uint8).reshape(-1, groups)


def fine_points(sets: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Counts by hash in about a quarter as many cells as a set has members, at most 255 each; cells are a power of two.

    Sets for which GROUPS cells are as fine have none.
    """
    cells = 1 << np.clip(np.ceil(np.log2(np.maximum(np.diff(first), 1) / 4)), 1, 16).astype(np.int64)
    none, hashes = np.zeros(0, np.uint8), mix(sets)
    return [np.minimum(np.bincount((hashes[a:b] & np.uint64(c - 1)).astype(np.int64), minlength=c), 255).astype(np.uint8) if c > GROUPS else none for a, b, c in zip(first, first[1:], cells, strict=False)]


def fine_bound(p: np.ndarray, q: np.ndarray, a: int, b: int) -> int:
    """As bounds(), of two fine points, the finer one folded; the smaller size where either has none."""
    n = min(len(p), len(q))
    if not n or p.max() == 255 or q.max() == 255:
        return min(a, b)
    p, q = (x.reshape(-1, n).sum(axis=0, dtype=np.int64) for x in (p, q))
    return int(np.minimum(p, q).sum())


def wanted(a, b, num: int, den: int):
    """The least overlap of sets of sizes a and b whose similarity is num/den or more."""
    return -(-num * (a + b) // (num + den))


def bounds(p: np.ndarray, q: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """At least the overlap of the sets: the coordinate minima summed, or the smaller size where counts are cut off."""
    low = np.minimum(p, q)
    return np.where((low == 255).any(axis=1), np.minimum(a, b), low.sum(axis=1, dtype=np.int64))


class CountTree:
    """A packed R-tree over count vectors, sorted by size and then by the point's coarse coordinates."""

    def __init__(self, vectors: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> None:
        coarse = vectors.reshape(len(vectors), -1, 16).sum(axis=2, dtype=np.int64)
        step = np.floor(np.log(np.maximum(sizes, 1)) / np.log(1.15)).astype(np.int64)
        self.order = np.lexsort((*coarse.T[::-1], step))
        self.vectors, self.sizes, self.labels = vectors[self.order], sizes[self.order], labels[self.order]
        # levels from the leaves up: upper corner, least and greatest size, and the label if all share one
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        corner, least, most, low, high, width = self.vectors, self.sizes, self.sizes, self.labels, self.labels, LEAF
        while True:
            at = np.arange(0, len(corner), width)
            corner, least, most = np.maximum.reduceat(corner, at), np.minimum.reduceat(least, at), np.maximum.reduceat(most, at)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            self.levels.append((corner, least, most, np.where(low == high, low, np.int64(-1)), low == high))
            if len(at) == 1:
                return
            width = FAN

    def pairs(self, vectors: np.ndarray, sizes: np.ndarray, labels: np.ndarray, num: int, den: int, step: int = 1 << 14) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, point) places whose sets may be similar enough and whose labels differ."""
        for at in range(0, len(vectors), max(1, step // FAN)):
            query = np.arange(at, min(len(vectors), at + max(1, step // FAN)))
            stack = [(len(self.levels) - 1, query, np.zeros(len(query), np.int64))]
            while stack:
                level, q, node = stack.pop()
                if len(q) > step:
                    stack += [(level, q[k : k + step], node[k : k + step]) for k in range(0, len(q), step)]
                    continue
                if level < 0:
                    corner, least, most = self.vectors[node], self.sizes[node], self.sizes[node]
                    skip = self.labels[node] == labels[q]
                else:
                    corner, least, most, label, one = (x[node] for x in self.levels[level])
                    skip = one & (label == labels[q])
                fits = ~skip & (most * den >= num * sizes[q]) & (sizes[q] * den >= num * least)
                q, node, corner, least, most = q[fits], node[fits], corner[fits], least[fits], most[fits]
                fits = bounds(corner, vectors[q], most, sizes[q]) >= wanted(least, sizes[q], num, den)
                q, node = q[fits], node[fits]
                if level < 0:
                    yield q, self.order[node]
                elif len(q):
                    width = LEAF if level == 0 else FAN
                    below = len(self.vectors) if level == 0 else len(self.levels[level - 1][0])
                    child = (node[:, None] * width + np.arange(width)).ravel()
                    q = np.repeat(q, width)
                    stack.append((level - 1, q[child < below], child[child < below]))


def _batch(columns, names) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names)


def _common(docs: DataFrame, words: int) -> np.ndarray:
    """How common each cell of hashes is: 0 within the noise of rare ones, else rising with the logarithm of the excess.

    Every task counts all its n-grams in SKETCH cells; the counts of all tasks are summed, in pieces of CHUNK cells and
    in two steps, so that no group grows with the number of tasks times the size of the sketch.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        seen = np.zeros(SKETCH, np.int64)
        for batch in slices(batches):
            sets, _ = gram_sets(batch.column("text"), words)
            seen += np.bincount((sets >> np.uint64(64 - SKETCH.bit_length() + 1)).astype(np.int64), minlength=SKETCH)
        if seen.any():
            pack = zstandard.ZstdCompressor(level=1)
            yield _batch([np.arange(SKETCH // CHUNK), pa.array([pack.compress(c.tobytes()) for c in seen.reshape(-1, CHUNK)], pa.binary())], ["chunk", "n"])

    def add(table: pa.Table) -> pa.Table:
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        total = np.zeros(CHUNK, np.int64)
        for x in table.column("n"):
            total += np.frombuffer(unpack.decompress(x.as_py()), np.int64)
        return pa.table({"chunk": [table.column("chunk")[0].as_py()], "n": pa.array([zstandard.ZstdCompressor(level=1).compress(total.tobytes())], pa.binary())})

    counted = docs.mapInArrow(count, "chunk long, n binary").withColumn("part", F.spark_partition_id() % 64)
    some = counted.groupBy("chunk", "part").applyInArrow(add, "chunk long, n binary")
    rows = some.groupBy("chunk").applyInArrow(add, "chunk long, n binary").toArrow()  # SKETCH cells
    import zstandard

    total = np.zeros((SKETCH // CHUNK, CHUNK), np.int64)
    for k, x in zip(rows["chunk"].to_pylist(), rows["n"].to_pylist(), strict=True):
        total[k] = np.frombuffer(zstandard.ZstdDecompressor().decompress(x), np.int64)
    middle = np.median(total)
    above = (total.ravel() - middle) / (np.sqrt(middle) + 1)
    return np.where(above > 3, 1 + 2 * np.log2(np.maximum(above, 1)), 0).astype(np.uint8)


def _signatures(docs: DataFrame, words: int, num: int, den: int, common) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare, shift = common.value, np.uint64(64 - SKETCH.bit_length() + 1)
        for batch in slices(batches):
            sets, first = gram_sets(batch.column("text"), words)
            n = np.diff(first)
            keep = np.where(n > 0, n - -(-num * n // den) + 1, 0)
            # members are sorted by hash: a stable order by how common they are is a total order of all hashes
            level = rare[(sets >> shift).astype(np.int64)]
            keys = [sets[a : a + k] if not level[a:b].any() else sets[a:b][np.argsort(level[a:b], kind="stable")[:k]] for a, b, k in zip(first[:-1], first[1:], keep, strict=True)]
            vectors = points(sets, first)
            yield _batch(
                [batch.column("doc_id"), batch.column("text_hash"), n, digests(sets, first).view(np.int64), lists(np.concatenate([sets[:0], *keys]).view(np.int64), np.concatenate(([0], np.cumsum(keep))), pa.int64()), pa.array([v.tobytes() for v in vectors], pa.binary()), pa.array([v.tobytes() for v in fine_points(sets, first)], pa.binary())],
                ["doc_id", "text_hash", "n", "digest", "keys", "point", "fine"],
            )

    return docs.mapInArrow(run, "doc_id long, text_hash long, n long, digest long, keys array<long>, point binary, fine binary")


def _finer(pairs: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of classes whose fine points allow the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = zip(*(batch.column(c) for c in ("fa", "fb", "na", "nb")), strict=True)
            fits = [fine_bound(*(np.frombuffer(x.as_buffer(), np.uint8) for x in (fa, fb)), na.as_py(), nb.as_py()) >= wanted(na.as_py(), nb.as_py(), num, den) for fa, fb, na, nb in columns]
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(fits, pa.bool_())) for c in ("a", "b")], names=["a", "b"])

    one = classes.select(F.col("digest").alias("a"), F.col("n").alias("na"), F.col("fine").alias("fa"))
    two = classes.select(F.col("digest").alias("b"), F.col("n").alias("nb"), F.col("fine").alias("fb"))
    return pairs.join(one, "a").join(two, "b").mapInArrow(run, "a long, b long")


def _likely(pairs: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of classes whose points allow the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = np.asarray(batch.column("na")), np.asarray(batch.column("nb"))
            p, q = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, GROUPS) for c in ("pa", "pb"))
            fits = (a * den >= num * b) & (b * den >= num * a) & (bounds(p, q, a, b) >= wanted(a, b, num, den))
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(fits)) for c in ("a", "b")], names=["a", "b"])

    one = classes.select(F.col("digest").alias("a"), F.col("n").alias("na"), F.col("point").alias("pa"))
    two = classes.select(F.col("digest").alias("b"), F.col("n").alias("nb"), F.col("point").alias("pb"))
    return pairs.join(one, "a").join(two, "b").mapInArrow(run, "a long, b long")


def _filter(keys: DataFrame):
    """A broadcast filter of the hashes in column `bit`, or none if BITS for each would be more than MOST_BITS."""
    n = keys.count()
    if n * BITS > MOST_BITS:
        return None
    width = 1 << max(16, (n * BITS - 1).bit_length())
    cells = keys.select(F.pmod("bit", F.lit(width)).alias("bit")).groupBy(F.floor(F.col("bit") / 32).alias("cell"))
    found = cells.agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("bit") % 32).cast("int"))).alias("bits")).toArrow()
    out = np.zeros(width // 32, np.uint32)
    out[found["cell"].to_numpy()] = found["bits"].to_numpy()
    return keys.sparkSession.sparkContext.broadcast(out)  # at most MOST_BITS


def _passes(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bit = hashes.view(np.uint64) & np.uint64(32 * len(table) - 1)
    return (table[(bit >> np.uint64(5)).astype(np.int64)] >> (bit & np.uint64(31)).astype(np.uint32)) & 1 > 0


def _row_hash(doc_id: Column, text_hash: Column) -> Column:
    return F.xxhash64(F.coalesce(doc_id, F.lit(0)), text_hash)


def _bodies(nodes: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """digest and _body, a compressed text of the class, of each of the classes in nodes. docs has doc_id, text and text_hash."""
    rows = Stored(classes.join(nodes, "digest").select("digest", F.coalesce("row.doc_id", F.lit(0)).alias("_id"), F.col("row.doc_id").isNull().alias("_null"), F.col("row.text_hash").alias("_hash"))).df
    bits = _filter(rows.select(_row_hash(F.col("_id"), F.col("_hash")).alias("bit")))

    def bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            own = batch.filter(pa.array(_passes(bits.value, np.asarray(batch.column("bit"))))) if bits else batch
            bodies = pa.array([pack.compress((t.as_py() or "").encode()) for t in own.column("text")], pa.binary())
            yield _batch([own.column("doc_id").fill_null(0), own.column("doc_id").is_null(), own.column("text_hash"), bodies], ["_id", "_null", "_hash", "_body"])
            trim()

    found = docs.withColumn("bit", _row_hash(F.col("doc_id"), F.col("text_hash"))).mapInArrow(bodies, "_id long, _null boolean, _hash long, _body binary")
    return found.join(rows, ["_id", "_null", "_hash"]).groupBy("digest").agg(F.first("_body").alias("_body"))


def _members(bodies: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """gram_sets() of compressed texts."""
    import zstandard

    unpack = zstandard.ZstdDecompressor()
    return gram_sets(pa.array([unpack.decompress(x) for x in bodies], pa.binary()).cast(pa.string()), words)


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, words: int, num: int, den: int) -> Stored:
    """The pairs whose sets are similar enough, by their sets. pairs is stored; docs has doc_id, text and text_hash."""
    nodes = pairs.select(F.col("a").alias("digest")).unionByName(pairs.select(F.col("b").alias("digest"))).distinct()

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, None

        def members(bodies: list[bytes]) -> list[np.ndarray]:
            sets, first = _members(bodies, words)
            return [sets[a:b] for a, b in zip(first, first[1:], strict=False)]

        for batch in batches:
            a, fits = batch.column("a").to_pylist(), []
            for k in range(0, batch.num_rows, 64):
                others = members(batch.column("two").slice(k, 64).to_pylist())
                for at, y in enumerate(others, k):
                    if own is None or a[at] != last:
                        last, own = a[at], members([batch.column("one")[at].as_py()])[0]
                    shared = int((own[np.minimum(np.searchsorted(own, y), len(own) - 1)] == y).sum())
                    fits.append(shared * den >= num * (len(own) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(fits, pa.bool_())) for c in ("a", "b")], names=["a", "b"])
            trim()

    found = _bodies(nodes, docs, classes)
    one = found.select(F.col("digest").alias("a"), F.col("_body").alias("one"))
    two = found.select(F.col("digest").alias("b"), F.col("_body").alias("two"))
    both = pairs.join(one, "a").join(two, "b").sortWithinPartitions("a")
    return Stored(both.mapInArrow(check, "a long, b long").distinct())


def _cells(cuts: str, own: str) -> Column:
    """The cells (i, j) of a block's cuts that a row of the cut `own` takes part in."""
    return F.transform(F.sequence(F.lit(0), F.col(cuts) - 1), lambda x: F.struct(F.least(x, F.col(own)).alias("i"), F.greatest(x, F.col(own)).alias("j")))


def _block_pairs(rows: DataFrame, classes: DataFrame, num: int, den: int, most: int | None) -> DataFrame:
    """Pairs that the trees of the blocks and then the fine points let through. rows: key, digest, label.

    With `most`, each class of a block keeps those of its pairs whose bounds are the highest.

    A block of more than SPLIT classes is cut into bands of sizes, each of which also holds the next one's classes, and
    a band of more than SPLIT by a hash of the class; then every two cuts meet in a task of their own. A pair that also
    shares a larger block, by the up to BEFORE that its rows know, is left to that one.
    """
    narrow = Stored(rows.join(classes.select("digest", "n"), "digest")).df
    sizes = Stored(narrow.groupBy("key").agg(F.count(F.lit(1)).alias("_m")).where(F.col("_m") > min(BIG, SPLIT))).df
    large = F.struct((-F.col("_m")).alias("m"), "key")
    order = narrow.join(sizes, "key").groupBy("digest").agg(F.array_sort(F.collect_list(large)).alias("_order")).where(F.size("_order") > 1)
    before = F.filter("_order", lambda x: x < large)
    held = narrow.join(sizes, "key", "left").join(order, "digest", "left").withColumn("_before", F.transform(F.slice(before, 1, BEFORE), lambda x: x["key"]))
    band = F.when(F.col("_m") > SPLIT, F.floor(F.log(F.col("n")) / np.log(den / num) + 1e-9).cast("int")).otherwise(0)
    bands = F.when(F.col("_m") > SPLIT, F.array(F.struct(band.alias("band"), F.lit(False).alias("upper")), F.struct((band - 1).alias("band"), F.lit(True).alias("upper"))))
    places = F.coalesce(bands, F.array(F.struct(F.lit(0).alias("band"), F.lit(False).alias("upper"))))
    dealt = held.withColumn("_place", F.explode(places)).select("key", "_place.band", F.col("_place.upper").alias("_upper"), "_before", "digest", "label")
    cuts = narrow.join(sizes.where(F.col("_m") > SPLIT), "key").select("key", F.explode(F.array(band, band - 1)).alias("band")).groupBy("key", "band").agg(F.ceil(F.count(F.lit(1)) / SPLIT).cast("int").alias("_cuts"))
    dealt = dealt.join(cuts, ["key", "band"], "left").withColumn("_cuts", F.coalesce("_cuts", F.lit(1))).withColumn("_own", F.pmod(F.xxhash64("digest", F.lit("cut")), F.col("_cuts")).cast("int"))
    dealt = dealt.withColumn("_cell", F.explode(_cells("_cuts", "_own"))).select("key", "band", "_cell.i", "_cell.j", "_own", "_upper", "_before", "digest", "label")
    dealt = dealt.join(classes.select("digest", "n", "point", "fine"), "digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seen = None, set()

        def join(block: pa.Table) -> Iterator[pa.RecordBatch]:
            digest, label, n, part, i, j = (block.column(c).to_numpy() for c in ("digest", "label", "n", "_own", "i", "j"))
            vectors = np.frombuffer(b"".join(block.column("point").to_pylist()), np.uint8).reshape(-1, GROUPS)
            fine = block.column("fine").combine_chunks()
            upper, before = block.column("_upper").to_numpy(), [frozenset(x or ()) for x in block.column("_before").to_pylist()]
            alone = i[0] == j[0]
            left = np.arange(len(n)) if alone else np.flatnonzero(part == i[0])
            right = left if alone else np.flatnonzero(part == j[0])
            if not len(left) or not len(right):
                return
            tree = CountTree(vectors[left], n[left], label[left])
            for q, p in tree.pairs(vectors[right], n[right], label[right], num, den):
                here = [k for k, (x, y) in enumerate(zip(left[p].tolist(), right[q].tolist(), strict=True)) if before[x].isdisjoint(before[y]) and not (upper[x] and upper[y])]
                q, p = q[here], p[here]
                a, b = digest[left[p]], digest[right[q]]
                low, high = np.minimum(a, b), np.maximum(a, b)
                fresh = [k for k, x in enumerate(zip(low.tolist(), high.tolist(), strict=True)) if x[0] != x[1] and x not in seen and not seen.add(x)]
                if len(seen) > 1 << 18:
                    seen.clear()
                x, y = left[p[fresh]], right[q[fresh]]
                need = wanted(n[x], n[y], num, den)
                bound = np.array([fine_bound(np.frombuffer(fine[i].as_buffer(), np.uint8), np.frombuffer(fine[j].as_buffer(), np.uint8), n[i], n[j]) for i, j in zip(x.tolist(), y.tolist(), strict=True)], np.int64)
                bound = np.minimum(bound, bounds(vectors[x], vectors[y], n[x], n[y]))
                fits = np.flatnonzero(bound >= need)
                if most is not None and len(fits):
                    fits = fits[np.lexsort((-bound[fits] / need[fits], y[fits]))]
                    turn = np.concatenate(([True], y[fits][1:] != y[fits][:-1]))
                    place = np.arange(len(fits)) - np.maximum.accumulate(np.where(turn, np.arange(len(fits)), 0))
                    fits = fits[place < most]
                if len(fits):
                    own = np.array(fresh)[fits]
                    yield _batch([low[own], high[own]], ["a", "b"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None else table
            cell = np.stack([table.column(c).to_numpy() for c in ("key", "band", "i", "j")], axis=1)
            turns = np.flatnonzero((cell[1:] != cell[:-1]).any(axis=1)) + 1
            for a, b in zip(np.concatenate(([0], turns[:-1])), turns, strict=False):
                if b - a > 1:
                    yield from join(table.slice(int(a), int(b - a)))
            held = table.slice(int(turns[-1]) if len(turns) else 0)
            trim()
        if held is not None and held.num_rows > 1:
            yield from join(held)

    return dealt.repartition("key", "band", "i", "j").sortWithinPartitions("key", "band", "i", "j").mapInArrow(run, "a long, b long").distinct()


def link_counts(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray], num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """How many sets of the other side each set of the left and of the right is similar enough to; sides are as from gram_sets()."""
    (one, first), (two, other) = left, right
    n, m = np.diff(first), np.diff(other)
    kinds, place = np.unique(one, return_inverse=True)
    at = np.minimum(np.searchsorted(kinds, two), max(len(kinds) - 1, 0))
    both = np.flatnonzero(kinds[at] == two) if len(kinds) else np.zeros(0, np.int64)
    at, of = at[both], np.repeat(np.arange(len(m)), m)[both]
    lefts, rights, have = np.zeros(len(n), np.int64), np.zeros(len(m), np.int64), np.zeros(len(kinds), bool)
    for k, (a, b) in enumerate(zip(first, first[1:], strict=False)):
        have[place[a:b]] = True
        shared = np.bincount(of[have[at]], minlength=len(m))
        have[place[a:b]] = False
        fits = (shared > 0) & (shared * den >= num * (n[k] + m - shared))
        lefts[k] = fits.sum()
        rights += fits
    return lefts, rights


def _links(label: DataFrame, docs: DataFrame, classes: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """digest and n_links of each class in label (node, label): how many other classes it is similar enough to.

    Links never leave a component, so every two classes of one component are held against one another by their sets,
    once. A component of more than SPLIT classes or MEMBERS members is cut by a hash of the class, and every two cuts
    meet in a task of their own, which gives counts and no pairs. Two classes alone are linked with each other.
    """
    named = label.join(classes.select(F.col("digest").alias("node"), "n"), "node")
    sizes = named.groupBy("label").agg(F.count(F.lit(1)).alias("_m"), F.ceil(F.greatest(F.count(F.lit(1)) / SPLIT, F.sum("n") / MEMBERS)).cast("int").alias("_cuts"))
    named = Stored(named.join(sizes, "label").select(F.col("node").alias("digest"), "label", "_m", "_cuts")).df
    more = named.where("_m > 2")
    own = F.pmod(F.xxhash64("digest", F.lit("cut")), F.col("_cuts")).cast("int")
    dealt = more.join(_bodies(more.select("digest"), docs, classes), "digest").withColumn("_own", own).withColumn("_cell", F.explode(_cells("_cuts", "_own"))).select("label", "_cell.i", "_cell.j", "_own", "digest", "_body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tile(block: pa.Table) -> pa.RecordBatch:
            own, i, j = (block.column(c).to_numpy() for c in ("_own", "i", "j"))
            sides = [block.filter(pa.array(own == x)) for x in ((i[0],) if i[0] == j[0] else (i[0], j[0]))]
            sets = [_members(x.column("_body").to_pylist(), words) for x in sides]
            counts = link_counts(sets[0], sets[-1], num, den)
            # within one cut each class meets itself, too
            counts = [counts[0] - 1] if len(sides) == 1 else counts
            return _batch([np.concatenate([x.column("digest").to_numpy() for x in sides]), np.concatenate(counts)], ["digest", "n_links"])

        held: list[pa.RecordBatch] = []
        cell = None
        for batch in batches:
            cells = np.stack([np.asarray(batch.column(c)) for c in ("label", "i", "j")], axis=1)
            turns = [0, *(np.flatnonzero((cells[1:] != cells[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
            for a, b in zip(turns, turns[1:], strict=False):
                if a == b:
                    continue
                if held and tuple(cells[a]) != cell:
                    yield tile(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(a, b - a))
                cell = tuple(cells[a])
            trim()
        if held:
            yield tile(pa.Table.from_batches(held))

    counted = dealt.repartition("label", "i", "j").sortWithinPartitions("label", "i", "j").mapInArrow(run, "digest long, n_links long")
    two = named.where("_m = 2").select("digest", F.lit(1).cast("long").alias("n_links"))
    return Stored(counted.unionByName(two).groupBy("digest").agg(F.sum("n_links").alias("n_links"))).df


def _all(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def similar(docs: DataFrame, words: int = WORDS, num: int = NUM, den: int = DEN, links: bool = True) -> DataFrame:
    """doc_id, text_hash, n_shingles (size of the set), component_id, class_id and, unless links is false, n_links of every row.

    Rows with equal sets are one class, named by its least doc_id; component_id is the least doc_id that links of
    similarity num/den or more reach. n_links counts all other classes that the row's class is that similar to. Texts
    without words, or null, have an empty set and are linked with nothing, so each is its own component. Null doc_ids are never the least; a component of
    nulls alone has none. Repeated rows are members of one class. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    common = spark.sparkContext.broadcast(_common(docs, words))  # SKETCH bytes
    rows = Stored(_signatures(docs, words, num, den, common)).df
    classes = Stored(rows.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.min(F.struct("doc_id", "text_hash")).alias("row"), F.first("n").alias("n"), F.min("point").alias("point"), F.min("fine").alias("fine"))).df
    spread = rows.select("digest", F.explode("keys").alias("key"))
    shared = spread.groupBy("key").agg(F.min("digest").alias("low"), F.max("digest").alias("high")).where("low <> high")
    blocks = Stored(spread.join(shared, "key").distinct()).df
    # each class against at most PIVOTS of the least classes of its blocks: those of most of them, and the least; and the
    # least class of each block against its greatest, so that blocks of two classes need no later sweep
    lows = blocks.where("digest <> low").groupBy("digest", "low").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("digest") == F.col("high")).alias("_ends"))
    by = Window.partitionBy("digest")
    often, least = F.row_number().over(by.orderBy(F.desc("n"), "low")), F.row_number().over(by.orderBy("low"))
    first = lows.withColumns({"_o": often, "_l": least}).where((F.col("_o") < PIVOTS) | (F.col("_l") == 1) | F.col("_ends")).select(F.col("low").alias("a"), F.col("digest").alias("b"))
    tried = Stored(_finer(_likely(first, classes, num, den), classes, num, den))
    found = [_verified(tried.df, docs, classes, words, num, den).df]
    tried = [tried.df]
    more = F.max((F.col("digest") != F.col("low")) & (F.col("digest") != F.col("high")))
    for most in (NEAREST, None):  # blocks of two classes are done
        label = components(_all(found))
        labelled = blocks.join(label.df, blocks.digest == label.df.node, "left").select("key", "digest", "low", "high", F.coalesce("label", "digest").alias("label"))
        open_ = labelled.groupBy("key").agg(F.min("label").alias("_a"), F.max("label").alias("_b"), more.alias("_more")).where("_more AND _a <> _b").select("key")
        # blocks of one least class are joined as one: whoever meets in them meets there, once
        members = labelled.join(open_, "key").select(F.col("low").alias("key"), "digest", "label").distinct()
        rest = Stored(_block_pairs(members, classes, num, den, most).join(_all(tried), ["a", "b"], "left_anti"))
        label.drop()
        found.append(_verified(rest.df, docs, classes, words, num, den).df)
        tried.append(rest.df)
    label = components(_all(found))
    named = classes.select("digest", F.col("doc_id").alias("class_id"))
    places = named.join(label.df, named.digest == label.df.node)
    least = places.groupBy("label").agg(F.min("class_id").alias("component_id"))
    joined = places.select("digest", "label").join(least, "label").select("digest", "component_id")
    if links:
        joined = joined.join(_links(label.df, docs, classes, words, num, den), "digest")
    named = named.join(joined, "digest", "left")
    out = rows.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "digest").join(named, "digest", "left")
    own = lambda c: F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(c)
    number = [F.coalesce("n_links", F.lit(0)).alias("n_links")] if links else []
    return out.select("doc_id", "text_hash", "n_shingles", own(F.coalesce("component_id", "class_id")).alias("component_id"), own(F.col("class_id")).alias("class_id"), *number)


def one_of_each(docs: DataFrame, words: int = WORDS, num: int = NUM, den: int = DEN) -> DataFrame:
    """docs, all columns, without the rows whose component has a lesser doc_id, and once each where rows are equal in doc_id and text.

    Rows without a doc_id go if their component has one, else they stay. Columns of any name come back as they were. An
    empty table gives an empty table. Only rows that a filter does not clear are shuffled.
    """
    rows = Stored(similar(docs, words, num, den, links=False).select("doc_id", "text_hash", "component_id")).df
    again = rows.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n"), F.min("component_id").alias("c"))
    gone = F.col("c").isNotNull() & (F.col("doc_id").isNull() | (F.col("doc_id") != F.col("c")))
    listed = Stored(again.where(gone | (F.col("n") > 1)).select(F.coalesce("doc_id", F.lit(0)).alias("_id"), F.col("doc_id").isNull().alias("_null"), F.col("text_hash").alias("_hash"), gone.alias("_gone"))).df
    bits = _filter(listed.select(_row_hash(F.col("_id"), F.col("_hash")).alias("bit")))
    # the columns of docs travel by number, so none of theirs is hidden by one of ours
    carried = [F.col(f"`{c}`").alias(f"_{k}") for k, c in enumerate(docs.columns)]
    doc_id, text_hash = F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string"))
    hashed = docs.select(*carried, F.coalesce(doc_id, F.lit(0)).alias("_id"), doc_id.isNull().alias("_null"), text_hash.alias("_hash"), _row_hash(doc_id, text_hash).alias("_bit"))

    def pick(wanted: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(_passes(bits.value, np.asarray(batch.column("_bit"))) == wanted))
                trim()

        return run

    rest = hashed.mapInArrow(pick(True), hashed.schema) if bits else hashed
    rest = rest.join(listed, ["_id", "_null", "_hash"], "left").where("_gone IS NULL OR NOT _gone")
    # equal rows that stay: the first of each, which a group limit finds before the shuffle
    number = F.row_number().over(Window.partitionBy("_id", "_null", "_hash").orderBy("_bit"))
    out = rest.withColumn("_row", F.when(F.col("_gone").isNull(), 1).otherwise(number)).where("_row = 1")
    named = [F.col(f"_{k}").alias(c) for k, c in enumerate(docs.columns)]
    return hashed.mapInArrow(pick(False), hashed.schema).select(*named).unionByName(out.select(*named)) if bits else out.select(*named)


def op4_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    found = similar(spark.read.parquet(f"{sf_dir}/documents.parquet"), words=4, num=85, den=100)
    return found.select("doc_id", "n_shingles", "component_id", "class_id", "n_links")
