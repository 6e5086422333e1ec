"""Substring deduplication of word sequences by recompression.

Recompression names runs of one word, then, in rounds, pairs of a left and a right symbol, the alphabet being split in
two by a hash of the symbol and the round. A name is a 64-bit hash of what it stands for, so it is global without any table
of names: equal word sequences get equal symbols inside, wherever they stand. With each symbol goes its reach, the
words that decided it: a pair was decided by its halves, a symbol that stayed by its neighbour too, a word or run of
words by the words around it. (Runs of later symbols are left as they are: to name them, every symbol's reach would have
to grow by its neighbours once a round, and windows would hold none.)

A window of WINDOW words is named by the least symbol whose reach lies inside it (by itself, if there is none), which
its words alone decide; so equal windows share a symbol at one place. All windows that have it in their first half also
share the half window of words from it on, those that have it in their second half the words before it: symbol and
words are their anchor. Consecutive windows of one anchor are a stretch, the unit of the tables: anchors that occur once
cannot be in a repeat. Stretches of one anchor with equal words repeat whole. Where an anchor has stretches of different
words, their windows are compared one by one by the hashes of their words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmill.llm.tables import Stored
from docmill.llm.textbatch import Words, mix, slices, spans, trim

WINDOW = 35
#: Rounds of pairs; the mean symbol then spans two words, and hardly a window of 35 words lacks one.
ROUNDS = 3
_NAME = np.uint64(0x9E3779B97F4A7C15)
_WORDS = 0xC2B2AE3D27D4EB4F


class Symbols:
    """Symbols in the order of the words: name, first word, reach [low, high), and list (document)."""

    def __init__(self, words: np.ndarray, lists: np.ndarray) -> None:
        n = len(words)
        self.name, self.at, self.low, self.high, self.of = words, np.arange(n), np.arange(n), np.arange(n) + 1, lists

    def _joined(self) -> np.ndarray:
        """True where a symbol follows one of its own list."""
        out = np.zeros(len(self.name), bool)
        out[1:] = self.of[1:] == self.of[:-1]
        return out

    def _keep(self, heads: np.ndarray, name: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        self.name, self.at, self.low, self.high, self.of = name[heads], self.at[heads], low[heads], high[heads], self.of[heads]

    def runs(self) -> None:
        """Runs of one word become one symbol. Whether a word is alone or where a run ends, its neighbours decide, so
        the reach goes one word beyond each side; at the edge of a text it goes past the edge."""
        again = self._joined()
        again[1:] &= self.name[1:] == self.name[:-1]
        heads = np.flatnonzero(~again)
        size = np.diff(np.append(heads, len(self.name)))
        name, low, high = self.name.copy(), self.low - 1, self.high.copy()
        runs = size > 1
        name[heads[runs]] = mix(self.name[heads[runs]] * _NAME + size[runs].astype(np.uint64))
        high[heads] = self.at[heads] + size + 1
        self._keep(heads, name, low, high)

    def pairs(self, number: int) -> None:
        """A left symbol and a right one after it become one. No pairs overlap, so the two alone decide."""
        if not len(self.name):
            return
        right = (mix(self.name + np.uint64(2 * number + 1)) >> np.uint64(63)).astype(bool)
        joined = self._joined()
        second = joined.copy()
        second[1:] &= ~right[:-1] & right[1:]
        first = np.append(second[1:], False)
        name, low, high = self.name.copy(), self.low.copy(), self.high.copy()
        a = np.flatnonzero(first)
        name[a] = mix(self.name[a] * _NAME + mix(self.name[a + 1] ^ _NAME))
        low[a], high[a] = np.minimum(self.low[a], self.low[a + 1]), np.maximum(self.high[a], self.high[a + 1])
        # one that stayed was decided by the neighbour it could have joined; at an edge, by the edge
        stay = ~first & ~second
        left = np.flatnonzero(stay & ~right)
        follows = np.append(joined[1:], False)[left]
        high[left] = np.maximum(self.high[left], np.where(follows, self.high[np.minimum(left + 1, len(self.name) - 1)], self.high[left] + 1))
        own = np.flatnonzero(stay & right)
        low[own] = np.minimum(self.low[own], np.where(joined[own], self.low[own - 1], self.low[own] - 1))
        self._keep(np.flatnonzero(~second), name, low, high)


def symbols(words: np.ndarray, of: np.ndarray, rounds: int = ROUNDS) -> Symbols:
    out = Symbols(words, of)
    out.runs()
    for k in range(rounds):
        out.pairs(k)
    return out


class Stretches:
    """Stretches of the windows of lists of words: name, words' hash, list, first window (in the list) and windows."""

    def __init__(self, words: np.ndarray, first: np.ndarray, window: int = WINDOW, rounds: int = ROUNDS) -> None:
        n = len(words)
        sizes = np.diff(first)
        of = np.repeat(np.arange(len(sizes)), sizes)
        ends = first[1:]
        if not n or sizes.max() < window:
            self.name = self.text = np.zeros(0, np.uint64)
            self.of = self.start = self.windows = np.zeros(0, np.int64)
            return
        found = symbols(words, of, rounds)
        # the windows that each symbol's reach fits into
        a = np.maximum(found.high - window, first[found.of])
        b = np.minimum(found.low, ends[found.of] - window) + 1
        fits = np.flatnonzero((found.low >= first[found.of]) & (found.high <= ends[found.of]) & (b > a))
        rank = mix(found.name[fits] ^ np.uint64(0x5851F42D4C957F2D))
        # the least symbol writes last, the leftmost of equal ones last of all
        order = fits[np.lexsort((-fits, ~rank))]
        size = (b - a)[order]
        begin = np.cumsum(size) - size
        chosen = np.full(n, -1)
        chosen[np.repeat(a[order] - begin, size) + np.arange(int(size.sum()))] = np.repeat(order, size)
        at = np.flatnonzero(np.arange(n) + window <= ends[of])
        mine = chosen[at]
        # windows that have their symbol in the first or in the second half share a core of half a window beside it
        half = (window + 1) // 2
        place = found.at[np.maximum(mine, 0)]
        late = place - at >= half
        new = np.ones(len(at), bool)
        new[1:] = (mine[1:] != mine[:-1]) | (mine[1:] < 0) | (at[1:] != at[:-1] + 1) | (late[1:] != late[:-1])
        heads = np.flatnonzero(new)
        start, place, late, mine = at[heads], place[heads], late[heads], mine[heads]
        self.windows = np.diff(np.append(heads, len(at)))
        self.text = spans(words, start, start + self.windows + window - 1, _WORDS)
        named = mine >= 0
        core = np.where(named, np.where(late, place - half, place), start)
        self.name = spans(words, core, np.where(named, np.where(late, place + 1, place + window - half + 1), start + window), _WORDS)
        self.name[named] = mix(self.name[named] * _NAME + mix(found.name[mine[named]] + late[named].astype(np.uint64)))
        self.of, self.start = of[start], start - first[of[start]]


#: A place packs a stretch's first window and its number of windows (the window at most, if reaches are not empty).
_PLACE = 64
_STRETCH = "name long, text long, _id long, _tag long, place long"
_WINDOW = "name long, hash long, _id long, _tag long, start long, weight int"


def _keyed(docs: DataFrame, others: list[str]) -> DataFrame:
    """_id and _tag name a row: doc_id and the hash of the text, whose last bit tells a null doc_id. Rows equal in both are equal.

    The columns in `others` come along as _0, _1 and so on.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    tag = F.xxhash64(text).bitwiseAND(F.lit(-2)).bitwiseOR(F.col("doc_id").isNull().cast("long"))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("_id"), tag.alias("_tag"), text.alias("text"), *[F.col(f"`{c}`").alias(f"_{k}") for k, c in enumerate(others)])


def _stretch_rows(window: int, rounds: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = Words(batch.column("text"))
            found = Stretches(words.hashes(), words.first, window, rounds)
            of = pa.array(found.of)
            columns = [found.name.view(np.int64), found.text.view(np.int64), batch.column("_id").take(of), batch.column("_tag").take(of), found.start * _PLACE + found.windows]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=["name", "text", "_id", "_tag", "place"])

    return run


def _shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as zstd frames, which a shuffle moves at two thirds of the size."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=1)
    for batch in slices(batches):
        bodies = [pack.compress(t.as_py().encode()) for t in batch.column("text")]
        at = batch.schema.get_field_index("text")
        yield batch.set_column(at, "_body", pa.array(bodies, pa.binary()))


def _grown(batches: Iterator[pa.RecordBatch], step: int = 256) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Slices with their texts, a few at a time."""
    import zstandard

    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        held, size, at = [], 0, 0
        for k, body in enumerate(batch.column("_body")):
            held.append(unpack.decompress(body.as_py()))
            size += len(held[-1])
            if size >= 1 << 20 or k + 1 == batch.num_rows:
                yield batch.slice(at, k + 1 - at), pa.array(held, pa.binary()).cast(pa.string())
                held, size, at = [], 0, k + 1
        trim()


def _window_rows(window: int):
    """The windows of the listed stretches of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _grown(batches):
            words = Words(texts)
            listed = batch.column("stretches")
            flat = listed.flatten()
            of = np.repeat(np.arange(batch.num_rows), np.asarray(listed.value_lengths()))
            place = np.asarray(flat.field("place"))
            first, n = place // _PLACE, place % _PLACE
            begin = np.cumsum(n) - n
            which = np.repeat(np.arange(len(n)), n)
            start = np.arange(int(n.sum())) - np.repeat(begin, n) + first[which]
            at = start + words.first[of[which]]
            rows = pa.array(of[which])
            columns = [
                np.asarray(flat.field("name"))[which],
                spans(words.hashes(), at, at + window, _WORDS).view(np.int64),
                batch.column("_id").take(rows),
                batch.column("_tag").take(rows),
                start,
                np.asarray(flat.field("weight"))[which].astype(np.int32),
            ]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=["name", "hash", "_id", "_tag", "start", "weight"])

    return run


def _kept_rows(window: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _grown(batches):
            words = Words(texts)
            n = np.diff(words.first)
            listed = batch.column("places")
            of = np.repeat(np.arange(batch.num_rows), np.asarray(listed.value_lengths().fill_null(0)))
            place = np.asarray(listed.flatten())
            turn = np.zeros(len(words.start) + 1, np.int64)
            begin = words.first[of] + place // _PLACE
            np.add.at(turn, begin, 1)
            np.add.at(turn, begin + place % _PLACE + window - 1, -1)
            gone = np.cumsum(turn[:-1]) > 0
            removed = np.concatenate(([0], np.cumsum(gone)))[words.first]
            removed = np.diff(removed)
            data = words.bytes.tobytes()
            kept = []
            for d in range(batch.num_rows):
                own = range(words.first[d], words.first[d + 1])
                kept.append(b" ".join(data[words.start[k] : words.end[k]] for k in own if not gone[k]))
            if with_text:
                whole = [t if not r else None for t, r in zip(texts, removed, strict=True)]
                last = pa.array([k.decode() if w is None else w.as_py() for k, w in zip(kept, whole, strict=True)], pa.string())
            else:
                last = pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())
            rest = [c for c in batch.schema.names if c not in ("_id", "_tag", "_body", "places")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("_id", "_tag", *rest)), pa.array(n), pa.array(removed), last], names=["_id", "_tag", *rest, "n_words", "n_removed", "kept"])

    return run


def repeats(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS, with_text: bool = True, others: Sequence[str] = ()) -> DataFrame:
    """The words of each row that no repeated window covers: _id, _tag, n_words, n_removed and kept; and the `others`, as _0, _1 ...

    kept holds the words joined by one space, or the text as it was if nothing goes; without with_text, it is the
    SHA-256 of the joined words.

    A window is `window` consecutive words of one text; it is repeated if its words also start anywhere else in docs,
    its own text included. Repeated windows are judged on docs as they are. A null text is empty and keeps nothing.
    Repeated rows are documents of their own, which repeat each other.
    """
    if not 1 <= window < _PLACE:
        raise ValueError(f"a window has 1 to {_PLACE - 1} words")
    others = list(others)
    rows = _keyed(docs, others)
    found = rows.select("_id", "_tag", "text").mapInArrow(_stretch_rows(window, rounds), _STRETCH)
    names = found.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.min("text").alias("low"), F.max("text").alias("high"))
    again = Stored(names.where("n > 1").select("name", (F.col("low") == F.col("high")).alias("same"))).df
    # written, as the readers below need different columns of it and would shuffle all stretches once each
    there = Stored(found.join(again, "name")).df
    whole = there.where("same").select("_id", "_tag", "place")
    # one stretch stands for all of its name with equal words
    # (written, so that the join below reads both sides from shuffles of its own, whose hot partitions Spark can split)
    kinds = Stored(there.where("NOT same").groupBy("name", "text").agg(F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in ("_id", "_tag", "place")])).df
    weight = F.when(F.col("n") > 1, 2).otherwise(1).alias("weight")
    listed = kinds.groupBy("_id", "_tag").agg(F.collect_list(F.struct("name", "place", weight)).alias("stretches"))
    # stretches of several equals repeat whole, wherever they stand
    twins = there.where("NOT same").join(kinds.where("n > 1").select("name", "text"), ["name", "text"], "left_semi").select("_id", "_tag", "place")
    carried = [T.StructField(f"_{k}", docs.schema[c].dataType) for k, c in enumerate(others)]
    bodies = rows.mapInArrow(_shrink, T.StructType([T.StructField("_id", T.LongType()), T.StructField("_tag", T.LongType()), T.StructField("_body", T.BinaryType()), *carried]))
    # both written, so that the join has plain rows on both sides: Spark then splits the windows of a passage that many share
    windows = Stored(bodies.join(listed, ["_id", "_tag"]).mapInArrow(_window_rows(window), _WINDOW)).df
    seen = Stored(windows.groupBy("name", "hash").agg(F.sum("weight").alias("n")).where("n > 1").select("name", "hash")).df
    single = windows.where("weight = 1").join(seen, ["name", "hash"], "left_semi").select("_id", "_tag", (F.col("start") * _PLACE + 1).alias("place"))
    places = whole.unionByName(twins).unionByName(single).groupBy("_id", "_tag").agg(F.collect_set("place").alias("places"))
    found = [("n_words", T.LongType()), ("n_removed", T.LongType()), ("kept", T.StringType())]
    out = T.StructType([T.StructField("_id", T.LongType()), T.StructField("_tag", T.LongType()), *carried, *[T.StructField(n, t) for n, t in found]])
    return bodies.join(places, ["_id", "_tag"], "left").mapInArrow(_kept_rows(window, with_text), out)


def deduplicated(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs, all columns, with the words of repeated windows taken out of text and n_chars, if there, counted anew.

    Rows of which nothing is left go; untouched rows stay as they were, null texts as empty ones. Repeated rows repeat
    each other. An empty table gives an empty table; columns of any name come back as they were.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    rows = repeats(docs, window, others=others).where("n_removed < n_words OR n_words = 0")
    column = {c: F.col(f"_{k}").alias(c) for k, c in enumerate(others)} | {"doc_id": _doc_id(), "text": F.col("kept").alias("text")}
    if "n_chars" in column:
        length = F.char_length("kept").cast(docs.schema["n_chars"].dataType)
        column["n_chars"] = F.when(F.col("n_removed") > 0, length).otherwise(column["n_chars"]).alias("n_chars")
    return rows.select(*[column[c] for c in docs.columns])


def _doc_id() -> Column:
    return F.when(F.col("_tag").bitwiseAND(F.lit(1)) == 0, F.col("_id")).alias("doc_id")


def op7_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return repeats(docs, with_text=False).select(_doc_id(), "n_words", "n_removed", F.col("kept").alias("kept_sha256"))
