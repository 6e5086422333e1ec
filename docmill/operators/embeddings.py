"""Embedding columns: a default embedder, validation, near duplicates and similarity by closeness in the corpus."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docmill.functions.text import tokens
from docmill.operators.vectors import angles, common_size, fit_centroids, matrix, unit, usable, values

ZERO = 1e-5
#: Vectors of a part of a cell, two of which meet in one task, at most; and vectors for each pivot where cells can exclude others.
TILE, PART = 1 << 13, 1 << 10
#: Angles or products that a task holds at once, and vectors of an Arrow batch that it makes.
HELD, MADE = 1 << 20, 1 << 12


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def squared_norm(v: Column) -> Column:
    return dot(v, v)


def cosine(a: Column, b: Column) -> Column:
    """0 if either is a zero vector."""
    scale = F.sqrt(squared_norm(a)) * F.sqrt(squared_norm(b))
    return F.when(scale > 0, dot(a, b) / scale).otherwise(0.0)


def hashed_embedding(text: Column, dims: int = 384, normalize: bool = True) -> Column:
    """The default embedder: term counts by a hash of the term, with a sign, scaled to unit length.

    Terms are hashed in the JVM; a batch of texts then becomes vectors in one pass over its terms.
    """
    code = lambda t: (F.pmod(F.xxhash64(t), F.lit(dims)) * 2 + F.pmod(F.xxhash64(t, F.lit("sign")), F.lit(2))).cast("int")

    @F.arrow_udf("array<float>")
    def vectors(codes: pa.Array) -> pa.Array:
        flat, n = np.asarray(codes.flatten()), len(codes)
        row = np.repeat(np.arange(n), np.asarray(codes.value_lengths()))
        out = np.bincount(row * dims + flat // 2, 1.0 - 2.0 * (flat % 2), n * dims).astype(np.float64).reshape(n, dims)
        out = (unit(out) if normalize else out).astype(np.float32)
        return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * dims), pa.array(out.ravel()))

    return vectors(F.transform(tokens(F.coalesce(text, F.lit(""))), code))


def embed(chunks: DataFrame, encode: Callable[[list[str]], np.ndarray] | None = None, text: str = "chunk_text", dims: int = 384, model: str = "hashed-terms", batch: int = 32) -> DataFrame:
    """chunks with embedding and embedding_model. A given encoder sees `batch` texts at a time; a batch that fails has null embeddings."""
    if encode is None:
        return chunks.withColumns({"embedding": hashed_embedding(F.col(text), dims), "embedding_model": F.lit(model)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            out: list = []
            for k in range(0, rows.num_rows, batch):
                part = [t or "" for t in rows.column(text).slice(k, batch).to_pylist()]
                try:
                    out += list(np.asarray(encode(part), np.float32))
                except Exception:  # noqa: BLE001  an encoder may fail in any way; its batch counts as failures
                    out += [None] * len(part)
            yield rows.append_column("embedding", pa.array(out, pa.list_(pa.float32())))

    from pyspark.sql import types as T

    schema = T.StructType([*chunks.schema.fields, T.StructField("embedding", T.ArrayType(T.FloatType()))])
    return chunks.mapInArrow(run, schema).withColumn("embedding_model", F.lit(model))


def embedding_report(embedded: DataFrame, tokens_column: str | None = None) -> DataFrame:
    average = F.avg(tokens_column) if tokens_column else F.lit(None).cast("double")
    return embedded.agg(F.count("embedding").alias("processed"), F.count_if(F.col("embedding").isNull()).alias("failures"), F.max(F.size("embedding")).alias("dimensions"), average.alias("avg_tokens"))


def validate(vectors: DataFrame, dims: int, vector: str = "embedding") -> DataFrame:
    """One row: is_valid, reason, total, dimensions, null_vectors (null, or with a null in them) and zero_vectors (squared norm under 1e-5)."""
    n, v = F.size(vector), F.col(vector)
    missing = v.isNull() | F.exists(v, lambda x: x.isNull())
    out = vectors.agg(F.count(F.lit(1)).alias("total"), F.min(n).alias("_low"), F.max(n).alias("dimensions"), F.count_if(missing).alias("null_vectors"), F.count_if(squared_norm(v) < ZERO).alias("zero_vectors"))
    uneven = (F.col("_low") != dims) | (F.col("dimensions") != dims)
    reason = F.when(F.col("total") == 0, "empty").when(uneven, "dimension mismatch").when(F.col("null_vectors") > 0, "null vectors").when(F.col("zero_vectors") > 0, "zero vectors")
    return out.withColumns({"reason": reason, "is_valid": reason.isNull()}).drop("_low")


def exact_median(values: DataFrame, column: str, bins: int = 1024, few: int = 100_000) -> float | None:
    """The median of a column of numbers without nulls, by rounds of histograms: a round narrows the range to one bin.

    At most `few` values are sorted at the end, and a range of equal values needs no sort, so no task holds all values.
    """
    n = values.count()
    if not n:
        return None

    def value_at(rank: int) -> float:
        part = values.select(F.col(column).alias("x"))
        while True:
            low, high, size = part.agg(F.min("x"), F.max("x"), F.count(F.lit(1))).head()
            if low == high:
                return low
            if size <= few:
                return part.orderBy("x").collect()[rank]["x"]
            place = F.least(F.floor((F.col("x") - low) / (high - low) * bins), F.lit(bins)).cast("int")
            counts = sorted((r["b"], r["n"]) for r in part.groupBy(place.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect())  # bins rows
            for b, m in counts:
                if rank < m:
                    part = part.where(place == b)
                    break
                rank -= m

    return (value_at((n - 1) // 2) + value_at(n // 2)) / 2


def norm_audit(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """Counts of zero and near-zero vectors and statistics of the norms; null vectors and those with nulls are left out."""
    norms = vectors.select(F.sqrt(squared_norm(F.col(vector))).alias("n")).where("n IS NOT NULL")
    middle = F.lit(exact_median(norms, "n")).cast("double")
    stats = {"min_norm": F.min("n"), "max_norm": F.max("n"), "avg_norm": F.avg("n"), "median_norm": middle, "stdev_norm": F.coalesce(F.stddev_samp("n"), F.lit(0.0))}
    return norms.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("n") == 0).alias("zero_vectors"), F.count_if(F.col("n") < ZERO).alias("near_zero_vectors"), *[F.round(c, 4).alias(k) for k, c in stats.items()]
    )


def near_duplicates(vectors: DataFrame, threshold: float = 0.99, top: int = 100, key: str = "vec_id", vector: str = "embedding", payload: Sequence[str] = ()) -> DataFrame:
    """The `top` pairs of greatest cosine over a threshold of 0 or more, ids of a pair ascending; ties by ids.

    A vector belongs to the cell of its nearest pivot. By the triangle inequality of angles it can have a partner in
    another cell only if the angle to that cell's pivot exceeds the one to its own by at most twice the threshold's angle,
    and the cell's radius by at most once; to such cells, of greater number, it goes as a guest, so that a pair meets once.
    A cell's vectors are cut into parts of at most TILE, and each two parts meet in a task that keeps `top` pairs. Where twice
    the threshold's angle is a right one or more, hardly a cell is excluded, so cells are as large as parts. Of equal vectors only the top + 1 of least ids can be in the result. payload: columns of both sides to add, as <name>_a and
    <name>_b. Zero vectors, null ones and those of another length than most have no partner.
    """
    if threshold < 0:
        raise ValueError("the threshold has to be 0 or more")
    dims = common_size(vectors, vector)
    shape = "array<float>" if dict(vectors.dtypes)[vector] == "array<float>" else "array<double>"  # floats travel as they are
    rows = vectors.where(F.col(key).isNotNull() & usable(F.col(vector), dims)).select(F.col(key).alias("item_id"), F.col(vector).cast(shape).alias("vector")).where(F.exists("vector", lambda x: x != 0))
    number = F.dense_rank().over(Window.partitionBy("vector").orderBy("item_id"))
    rows = rows.withColumn("_n", number).where(F.col("_n") <= top + 1).drop("_n").distinct().persist()
    kind, spark = dict(vectors.dtypes)[key], vectors.sparkSession
    wide = math.acos(min(1.0, threshold)) + 1e-6
    pivots = fit_centroids(rows, max(1, -(-rows.count() // (PART if 2 * wide < math.pi / 2 else TILE))), steps=2)

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, step := max(1, HELD // max(1, len(pivots)))):
                yield batch.slice(at, step)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            far = angles(matrix(batch.column("vector"), dims), pivots)
            home = far.argmin(axis=1) if len(far) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(home), pa.array(far[np.arange(len(home)), home])], names=["cell", "gap"])

    sizes = rows.mapInArrow(placed, "cell long, gap double").groupBy("cell").agg(F.max("gap").alias("radius"), F.count(F.lit(1)).alias("n")).collect()  # a row per pivot
    radius = np.full(len(pivots), -math.inf)
    radius[[r["cell"] for r in sizes]] = [r["radius"] for r in sizes]

    def visits(batches: Iterator[pa.RecordBatch], whole: bool = True) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            far = angles(matrix(batch.column("vector"), dims), pivots)
            home = far.argmin(axis=1) if len(far) else np.zeros(0, np.int64)
            gap = far[np.arange(len(home)), home]
            near = (far <= gap[:, None] + 2 * wide) & (far <= radius[None] + wide) & (np.arange(len(pivots))[None] > home[:, None])
            near[np.arange(len(home)), home] = True
            every, cells = np.nonzero(near)
            for k in range(0, len(every), MADE):
                at, cell = every[k : k + MADE], cells[k : k + MADE]
                some = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(home[at] == cell), *([some.column("item_id"), some.column("vector")] if whole else [])], names=["cell", "own", "item_id", "vector"][: 4 if whole else 2])

    counts = {(r["cell"], r["own"]): r["count"] for r in rows.mapInArrow(lambda b: visits(b, False), "cell long, own boolean").groupBy("cell", "own").count().collect()}  # two rows per pivot
    parts = [(c, -(-counts[c, True] // TILE), -(-counts.get((c, False), 0) // TILE)) for c in sorted({c for c, own in counts if own})]
    sizes = spark.createDataFrame(parts, "cell long, parts int, others int")
    dealt = rows.mapInArrow(visits, f"cell long, own boolean, item_id {kind}, vector {shape}").join(F.broadcast(sizes), "cell")  # a row per pivot
    part = F.when(F.col("own"), F.pmod(F.xxhash64("item_id"), F.col("parts"))).otherwise(F.col("parts") + F.pmod(F.xxhash64("item_id"), F.greatest("others", F.lit(1)))).cast("int")
    tile = lambda x: F.struct(F.least(x, F.col("part")).alias("i"), F.greatest(x, F.col("part")).alias("j"))
    partners = F.sequence(F.lit(0), F.when(F.col("own"), F.col("parts") + F.col("others")).otherwise(F.col("parts")) - 1)
    dealt = dealt.withColumn("part", part).withColumn("_tile", F.explode(F.transform(partners, tile))).select("cell", "_tile.i", "_tile.j", "part", "item_id", "vector")

    def meet(table: pa.Table) -> pa.Table:
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        own, ids = table.column("part").to_numpy(), values(table.column("item_id"))
        v = unit(matrix(table.column("vector"), dims))
        a, b = np.flatnonzero(own == i), np.flatnonzero(own == j)
        right, kept = v[b].T, (ids[:0], ids[:0], np.zeros(0))
        for at in range(0, len(a), step := max(1, HELD // max(1, len(b)))):
            some = a[at : at + step]
            scores = v[some] @ right
            # once there are `top` pairs, only those that round to the least of them or more
            x, y = np.nonzero(scores > (max(threshold, kept[2][-1] - 1e-4) if len(kept[2]) == top else threshold))
            s, x, y = np.round(scores[x, y], 4), ids[some[x]], ids[b[y]]
            keep = x < y if i == j else x != y
            x, y = x[keep], y[keep]
            both = np.where(x < y, x, y), np.where(x < y, y, x), s[keep]
            low, high, s = (np.concatenate(z) for z in zip(kept, both, strict=True))
            _, code = np.unique(np.concatenate((low, high)), return_inverse=True)
            best = np.lexsort((code[len(low) :], code[: len(low)], -s))[:top]
            kept = low[best], high[best], s[best]
        ids_type = table.schema.field("item_id").type
        return pa.table({"id_a": pa.array(kept[0], ids_type), "id_b": pa.array(kept[1], ids_type), "similarity": kept[2]})

    pairs = dealt.groupBy("cell", "i", "j").applyInArrow(meet, f"id_a {kind}, id_b {kind}, similarity double")
    found = pairs.orderBy(F.desc("similarity"), "id_a", "id_b").limit(top)
    if not payload:
        return found
    for side in "ab":
        own = vectors.groupBy(F.col(key).alias(f"id_{side}")).agg(*[F.first(c).alias(f"{c}_{side}") for c in payload])
        found = found.join(own, f"id_{side}", "left")
    return found.select("id_a", "id_b", "similarity", *[f"{c}_{side}" for side in "ab" for c in payload])


def similarity_health(vectors: DataFrame, sample: int = 100, key: str = "vec_id", vector: str = "embedding", document: str = "doc", section: str = "section") -> DataFrame:
    """Mean cosine of sampled vectors to all others in the same section, the same document and other documents; do they fall in this order?

    The sample is a stated query set: those of least md5 of the key. It goes to every task, which sums by itself. Null
    vectors and those of another length than most are left out.
    """
    vectors = vectors.where(usable(F.col(vector), common_size(vectors, vector)))
    drawn = vectors.orderBy(F.md5(F.col(key).cast("string").cast("binary")), key).limit(sample).select(F.col(key).alias("k"), F.col(vector).cast("array<double>").alias("v"), F.col(document).alias("d"), F.col(section).alias("s")).collect()
    keys, docs, parts = [r["k"] for r in drawn], np.array([r["d"] for r in drawn], object), np.array([r["s"] for r in drawn], object)
    queries = unit(np.array([r["v"] for r in drawn], np.float64)) if drawn else None
    shared = vectors.sparkSession.sparkContext.broadcast((keys, docs, parts, queries))  # `sample` rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, docs, parts, queries = shared.value
        total, count = np.zeros(3), np.zeros(3, np.int64)
        for batch in batches:
            if not batch.num_rows or queries is None:
                continue
            scores = queries @ unit(np.array(batch.column("v").to_pylist(), np.float64)).T
            other = np.array(keys, object)[:, None] != np.array(batch.column("k").to_pylist(), object)[None]
            d, s = np.array(batch.column("d").to_pylist(), object), np.array(batch.column("s").to_pylist(), object)
            same_doc = docs[:, None] == d[None]
            same_part = same_doc & (parts[:, None] == s[None]) & np.array([p is not None for p in parts])[:, None]
            for k, mask in enumerate((same_part, same_doc & ~same_part, ~same_doc)):
                total[k] += scores[mask & other].sum()
                count[k] += (mask & other).sum()
        yield pa.RecordBatch.from_arrays([pa.array([0, 1, 2], pa.int32()), pa.array(total), pa.array(count)], names=["bucket", "total", "n"])

    rows = vectors.select(F.col(key).alias("k"), F.col(vector).cast("array<double>").alias("v"), F.col(document).alias("d"), F.col(section).alias("s"))
    sums = rows.mapInArrow(run, "bucket int, total double, n long")
    mean = lambda k: F.coalesce(F.try_divide(F.sum(F.when(F.col("bucket") == k, F.col("total"))), F.sum(F.when(F.col("bucket") == k, F.col("n")))), F.lit(0.0))
    out = sums.agg(mean(0).alias("same_section"), mean(1).alias("same_document"), mean(2).alias("different_document"))
    return out.withColumn("holds", (F.col("same_section") >= F.col("same_document")) & (F.col("same_document") >= F.col("different_document")))
