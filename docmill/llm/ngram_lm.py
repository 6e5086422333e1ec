"""Language-model scores from an interpolated modified Kneser-Ney model that is counted in Spark.

Its events are those of the base score: each token that training has, and one event for any other word. The highest order
is the pair of a token and the one before it (a text begins with a mark of its own). Below it is the token by itself, then
its spelling: its bytes and an end mark, each given the two symbols before it, one, or none, and at last all symbols
alike. As Kneser-Ney has it, every order below the highest counts contexts, not occurrences: a token by itself counts the
distinct tokens that it follows, the spelling is counted on distinct words, its lower orders on distinct continuations. Each
order discounts counts of one, two, and three or more by amounts of its own and gives what it takes away to the order
below. An unknown word has a share of its own and what the spelling leaves over when all known words are spelled.

Counting is done on blocks of documents. A block holds its distinct words and distinct pairs once, with how often training
has them; these (not the tokens) are dealt to shards by hash, as sorted arrays, summed there and sent back, so a hot word
or pair costs one entry a block. Of the blocks that have a pair, one counts it for its history and its word; these counts
then travel with the words. There are as many shards as keep one at about SHARD pairs. The spelling has at most 2**24
contexts and symbols that words can hold; its sorted hash arrays are sent to the workers, which map them into memory.
"""

from __future__ import annotations

import os
import tempfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmill.llm.tables import Stored, partitions, small_batches
from docmill.llm.textbatch import LOWER, STEP, Words, mix, slices, trim, word_names

#: Text bytes of a block of documents, unless one text alone is longer, and pairs of all blocks that a shard sums.
BLOCK, SHARD = 1 << 23, 1 << 21
PARTS, HELD = 7, 2
ENDS, BEGIN, SYMBOLS = 256, 257, 257
_BLOCKS = "doc_ids array<long>, held array<boolean>, sizes array<int>, tokens binary, words binary, lengths binary, counts binary, n_pairs long"
#: The names of what stands before the first word of a text and behind the last, and what makes a pair's name.
_BEGIN, _END, _PAIR = np.uint64(0x6A09E667F3BCC908), np.uint64(0xBB67AE8584CAA73B), np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id: Column, parts: int = PARTS, part: int = HELD) -> Column:
    """Whether crc32 of the doc_id as text leaves `part` modulo `parts`; a null doc_id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string").cast("binary")) % parts == part, F.lit(False))


def discounts(counts: np.ndarray) -> np.ndarray:
    """What modified Kneser-Ney takes from counts of 0, 1, 2, and 3 or more."""
    n1, n2, n3, n4 = (int((counts == k).sum()) for k in (1, 2, 3, 4))
    return _discounts(n1, n2, n3, n4)


def _discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    rough = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return np.array([0.0, *(min(max(d, 0.1), k - 0.1) for k, d in enumerate(rough, 1))])


class Spelling:
    """The orders below the whole token. Arrays: per order, sorted hashes, probabilities; per context, hashes and weights left."""

    NAMES = ("k3", "p3", "h3", "b3", "k2", "p2", "h2", "b2", "p1")

    def __init__(self, arrays: dict[str, np.ndarray]) -> None:
        self.__dict__.update(arrays)

    @staticmethod
    def _order(context: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The discounted share of each entry; and each context in order with the weight that is left for the order below."""
        d = discounts(counts)[np.minimum(counts, 3)]
        kinds, which = np.unique(context, return_inverse=True)
        total = np.bincount(which, counts, len(kinds))
        return (counts - d) / total[which], kinds, np.bincount(which, d, len(kinds)) / total

    @classmethod
    def fit(cls, codes: np.ndarray, counts: np.ndarray) -> Spelling:
        """codes: (first * 512 + second) * 512 + symbol of the trigrams of distinct words; counts: in how many places."""
        order = np.argsort(codes)
        codes, counts = codes[order].astype(np.int64), counts[order].astype(np.int64)
        share3, context3, left3 = cls._order(codes >> 9, counts)
        pairs, kept = np.unique(codes & ((1 << 18) - 1), return_counts=True)  # continuations: distinct first symbols
        share2, context2, left2 = cls._order(pairs >> 9, kept)
        ones, alone = np.unique(pairs & 511, return_counts=True)
        share1, _, left1 = cls._order(np.zeros(len(ones), np.int64), alone)
        p1 = np.full(512, (left1[0] if len(left1) else 1.0) / SYMBOLS)
        p1[ones] += share1
        p2 = share2 + left2[np.searchsorted(context2, pairs >> 9)] * p1[pairs & 511]
        out = {"p1": p1}
        out |= cls._sorted("k2", "p2", pairs, p2) | cls._sorted("h2", "b2", context2, left2)
        model = cls(out)
        p3 = share3 + left3[np.searchsorted(context3, codes >> 9)] * model._second(codes & ((1 << 18) - 1))
        return cls(out | cls._sorted("k3", "p3", codes, p3) | cls._sorted("h3", "b3", context3, left3))

    @staticmethod
    def _sorted(key: str, value: str, codes: np.ndarray, values: np.ndarray) -> dict[str, np.ndarray]:
        hashes = mix(codes.astype(np.uint64))
        order = np.argsort(hashes)
        return {key: hashes[order], value: np.asarray(values, np.float64)[order]}

    @staticmethod
    def _probe(keys: np.ndarray, values: np.ndarray, codes: np.ndarray, other: np.ndarray | float) -> np.ndarray:
        """The value of each code, or what `other` says where there is none."""
        if not len(keys):
            return np.broadcast_to(np.asarray(other, np.float64), codes.shape).copy()
        hashes = mix(codes.astype(np.uint64))
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        return np.where(keys[at] == hashes, values[at], other)

    def _second(self, pairs: np.ndarray) -> np.ndarray:
        return self._probe(self.k2, self.p2, pairs, self._probe(self.h2, self.b2, pairs >> 9, 1.0) * self.p1[pairs & 511])

    def log10(self, codes: np.ndarray) -> np.ndarray:
        """The log probability of each trigram's last symbol, given the two before it."""
        kinds, which = np.unique(codes, return_inverse=True)
        p = self._probe(self.k3, self.p3, kinds, self._probe(self.h3, self.b3, kinds >> 9, 1.0) * self._second(kinds & ((1 << 18) - 1)))
        return np.log10(p)[which]

    def dump(self) -> bytes:
        """One file: the number of entries of each array, then the arrays."""
        parts = [np.ascontiguousarray(getattr(self, n)) for n in self.NAMES]
        return np.array([len(p) for p in parts], np.int64).tobytes() + b"".join(p.tobytes() for p in parts)

    @classmethod
    def mapped(cls, data: bytes) -> Spelling:
        """The arrays as views of a file that is mapped into memory; the file has no name any more, so nothing is left
        behind. All tasks of a worker share one."""
        key = zlib.crc32(data)
        if _mapped.get("key") == key:
            return _mapped["model"]
        handle, path = tempfile.mkstemp()
        try:
            with os.fdopen(handle, "wb") as f:
                f.write(data)
            whole = np.memmap(path, np.uint8, "r")
        finally:
            os.unlink(path)
        sizes = np.frombuffer(whole[: 8 * len(cls.NAMES)], np.int64)
        out, at = {}, 8 * len(cls.NAMES)
        for name, n in zip(cls.NAMES, sizes, strict=True):
            out[name] = whole[at : at + 8 * n].view(np.uint64 if name[0] in "kh" else np.float64)
            at += 8 * n
        _mapped.update(key=key, model=cls(out))
        return _mapped["model"]


_mapped: dict = {}


def trigrams(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The codes of the words that data holds one after another, and where each word's begin."""
    sizes = np.diff(ends, prepend=0)
    first = np.cumsum(sizes + 3) - (sizes + 3)
    flat = np.full(int((sizes + 3).sum()), BEGIN, np.int64)
    flat[np.arange(len(data)) + np.repeat(3 * np.arange(len(sizes)) + 2, sizes)] = data
    flat[first + sizes + 2] = ENDS
    codes = np.zeros(max(0, len(flat) - 2), np.int64)
    codes[:] = ((flat[:-2] << 9 | flat[1:-1]) << 9) | flat[2:]
    real = np.ones(len(flat), bool)
    real[first] = real[first + 1] = False
    return codes[real[2:]], np.cumsum(sizes + 1) - (sizes + 1)


def _squeeze(x: np.ndarray, kind: str = "<u4") -> bytes:
    """Numbers as byte planes, all lowest bytes first, in one zstd frame."""
    import zstandard

    size = np.dtype(kind).itemsize
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x.astype(kind).view(np.uint8).reshape(-1, size).T).tobytes())


def _unsqueeze(data: bytes, kind: str = "<u4") -> np.ndarray:
    import zstandard

    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(size, -1).T).view(kind).ravel()


def _deltas(x: np.ndarray) -> np.ndarray:
    """Ascending hashes as the steps between them, whose high bytes are zeros."""
    return np.diff(x, prepend=np.uint64(0))


class Block:
    """A block of documents: names, spelling and training counts of its distinct words, the frequent ones first; its tokens.

    Word number len(names) stands for the beginning of a text as a history, for its end as a token.
    """

    def __init__(self, row: dict) -> None:
        import zstandard

        self.sizes, self.held = np.array(row["sizes"], np.int64), np.array(row["held"], bool)
        self.tokens, self.counts = _unsqueeze(row["tokens"]).astype(np.int64), _unsqueeze(row["counts"], "<u8").astype(np.int64)
        self.data = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["words"]), np.uint8)
        self.lengths = _unsqueeze(row["lengths"]).astype(np.int64)
        self.ends = np.cumsum(self.lengths)
        self.names = word_names(self.data, self.ends - self.lengths, self.ends)

    def codes(self) -> np.ndarray:
        """History and token of each place, the ends of the texts included, as history * (words + 1) + token."""
        mark = len(self.names)
        start = np.cumsum(self.sizes + 1) - self.sizes - 1
        token = np.full(int((self.sizes + 1).sum()), mark, np.int64)
        last = np.zeros(len(token), bool)
        last[start + self.sizes] = True
        token[~last] = self.tokens
        history = np.roll(token, 1)
        history[start] = mark
        return history * (mark + 1) + token

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct codes, ascending, and how often training has each."""
        both = np.sort(self.codes() << 1 | np.repeat(self.held, self.sizes + 1))
        if not len(both):
            return both, both
        first = np.flatnonzero(np.concatenate(([True], (both[1:] >> 1) != (both[:-1] >> 1))))
        return both[first] >> 1, np.add.reduceat(1 - (both & 1), first)

    def split(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return codes // (len(self.names) + 1), codes % (len(self.names) + 1)

    def pair_names(self, codes: np.ndarray) -> np.ndarray:
        history, token = self.split(codes)
        return mix(np.append(self.names, _BEGIN)[history] * _PAIR + mix(np.append(self.names, _END)[token] ^ _PAIR))


def _blocks(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        held: list[tuple] = []
        size = 0

        def block() -> pa.RecordBatch:
            """The slices' distinct words as one list, and their tokens by it."""
            every = np.concatenate([p[3] for p in held])
            names, one, which = np.unique(every, return_index=True, return_inverse=True)
            uses = np.zeros(len(names), np.int64)
            counts = np.zeros(len(names), np.int64)
            first = np.cumsum([0, *[len(p[3]) for p in held]])
            for p, a, b in zip(held, first, first[1:], strict=False):
                uses[which[a:b]] += p[6]
                counts[which[a:b]] += p[7]
            # frequent words get small numbers, whose high bytes then compress to nothing
            order = np.argsort(-uses, kind="stable")
            place = np.empty(len(names), np.int64)
            place[order] = np.arange(len(names))
            tokens = np.concatenate([place[which[a:b]][p[4]] for p, a, b in zip(held, first, first[1:], strict=False)])
            data, lengths = np.concatenate([p[5] for p in held]), np.concatenate([p[8] for p in held])
            start = (np.cumsum(lengths) - lengths)[one][order]
            size = lengths[one][order]
            words = data[np.arange(int(size.sum())) + np.repeat(start - np.cumsum(size) + size, size)]
            sizes, of = np.concatenate([p[2] for p in held]), np.concatenate([p[1] for p in held])
            row = {"sizes": sizes, "held": of, "tokens": _squeeze(tokens), "words": zstandard.ZstdCompressor(level=1).compress(words.tobytes()), "lengths": _squeeze(size), "counts": _squeeze(counts[order], "<u8")}
            n_pairs = len(Block(row).pairs()[0])
            lists = [pa.array([[x for p in held for x in p[0]]], pa.list_(pa.int64())), pa.array([of.tolist()], pa.list_(pa.bool_())), pa.array([sizes.tolist()], pa.list_(pa.int32()))]
            binary = [pa.array([row[k]], pa.binary()) for k in ("tokens", "words", "lengths", "counts")]
            return pa.RecordBatch.from_arrays([*lists, *binary, pa.array([n_pairs])], names=[x.split()[0] for x in _BLOCKS.split(", ")])

        for batch in slices(batches, STEP):
            found = Words(batch.column("text"), lower=True)
            of = np.asarray(batch.column("held"))
            names, one, which = np.unique(found.hashes(), return_index=True, return_inverse=True)
            start, length = found.start[one], (found.end - found.start)[one]
            ends = np.cumsum(length)
            data = LOWER[found.bytes][np.arange(int(length.sum())) + np.repeat(start - ends + length, length)]
            training = np.bincount(which, ~of[found.doc] if len(found.doc) else None, len(names)).astype(np.int64)
            held.append((batch.column("doc_id").to_pylist(), of, np.diff(found.first), names, which.astype(np.int32), data, np.bincount(which, minlength=len(names)), training, length))
            size += len(found.bytes)
            if size >= BLOCK:
                yield block()
                held, size = [], 0
                trim()
        if held:
            yield block()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, _BLOCKS).withColumn("block", F.monotonically_increasing_id())


def _pieces(names: np.ndarray, shards: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The order by name, and (shard, begin, end) of the parts of it that are not empty."""
    order = np.argsort(names)
    edges = np.array([(k << 64) // shards for k in range(1, shards)], np.uint64)
    cut = np.concatenate(([0], np.searchsorted(names[order], edges), [len(names)])).tolist()
    return order, [(s, a, b) for s, (a, b) in enumerate(zip(cut, cut[1:], strict=False)) if b > a]


_PAIRS = "shard int, block long, hashes binary, counts binary"
_WORDS = "shard int, block long, hashes binary, counts binary, words binary, lengths binary, told binary"
#: What a block tells of a word besides its count: distinct pairs that it begins, seen once, twice and more often; that it ends.
_TOLD = 4


def _deal_pairs(blocks: DataFrame, shards: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = Block(row)
                codes, counts = own.pairs()
                names = own.pair_names(codes)
                order, parts = _pieces(names, shards)
                names, counts = names[order], counts[order]
                out = [(s, row["block"], _squeeze(_deltas(names[a:b]), "<u8"), _squeeze(counts[a:b])) for s, a, b in parts]
                kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=[x.split()[0] for x in _PAIRS.split(", ")])
                trim()

    return blocks.select("block", "sizes", "held", "tokens", "words", "lengths", "counts").mapInArrow(run, _PAIRS)


def _hashes(table: pa.Table) -> list[np.ndarray]:
    return [np.cumsum(_unsqueeze(x, "<u8")) for x in table.column("hashes").to_pylist()]


def _summed(names: list[np.ndarray], values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each entry its kind, and whether it stands for its kind; and for each kind the sums of the values and the first entry."""
    kinds, one, which = np.unique(np.concatenate(names), return_index=True, return_inverse=True)
    owner = np.zeros(len(which), bool)
    owner[one] = True
    return which, owner, np.stack([np.bincount(which, v, len(kinds)).astype(np.int64) for v in values]), one


_SUMMED = "block long, shard int, totals binary, stats array<long>, codes array<long>, n array<long>"


def _back(table: pa.Table, names: list[np.ndarray], totals: np.ndarray, stats: list[int], codes: list[int], n: list[int]) -> pa.Table:
    """A row per block with its rows of totals, and as block -1 what the shard tells the model."""
    first = np.cumsum([0, *map(len, names)])
    rows = {
        "block": [*table.column("block").to_pylist(), -1],
        "shard": [table.column("shard")[0].as_py()] * (len(names) + 1),
        "totals": [*(_squeeze(totals[:, a:b].ravel(), "<u8") for a, b in zip(first, first[1:], strict=False)), None],
        "stats": [*[None] * len(names), stats],
        "codes": [*[None] * len(names), codes],
        "n": [*[None] * len(names), n],
    }
    longs = pa.list_(pa.int64())
    return pa.table(rows, pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("totals", pa.binary()), ("stats", longs), ("codes", longs), ("n", longs)]))


def _times(counts: np.ndarray) -> list[int]:
    return [int((counts == k).sum()) for k in (1, 2, 3, 4)]


def _sum_pairs(table: pa.Table) -> pa.Table:
    """Twice each pair's total, plus one where the block counts the pair for its words."""
    names = _hashes(table)
    counts = np.concatenate([_unsqueeze(x) for x in table.column("counts").to_pylist()])
    which, owner, total, _ = _summed(names, counts[None])
    out = 2 * total[0][which] + (owner & (total[0][which] > 0))
    return _back(table, names, out[None], _times(total[0]), [], [])


def _deal_words(blocks: DataFrame, shards: int) -> DataFrame:
    """Words by shard, with the block's share of what their pairs tell. blocks also has `found`: the totals of its pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        for batch in batches:
            for row in batch.to_pylist():
                own = Block(row)
                told, _ = _pair_totals(own, row["found"])
                order, parts = _pieces(own.names, shards)
                names, counts, lengths, told = own.names[order], own.counts[order], own.lengths[order], told[:, order]
                start = (own.ends - own.lengths)[order]
                at = np.concatenate(([0], np.cumsum(lengths)))
                data = own.data[np.arange(int(at[-1])) + np.repeat(start - at[:-1], lengths)].tobytes()
                pack = zstandard.ZstdCompressor(level=1).compress
                out = [(s, row["block"], _squeeze(_deltas(names[a:b]), "<u8"), _squeeze(counts[a:b], "<u8"), pack(data[at[a] : at[b]]), _squeeze(lengths[a:b]), _squeeze(told[:, a:b].ravel())) for s, a, b in parts]
                kinds = (pa.int32(), pa.int64(), *[pa.binary()] * 5)
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=[x.split()[0] for x in _WORDS.split(", ")])
                trim()

    return blocks.mapInArrow(run, _WORDS)


def _joined(found: list, rows: int) -> np.ndarray:
    """What shards sent back to a block, in the order of the names: rows x entries."""
    parts = [_unsqueeze(x["totals"], "<u8").astype(np.int64).reshape(rows, -1) for x in sorted(found or [], key=lambda x: x["shard"])]
    return np.concatenate([np.zeros((rows, 0), np.int64), *parts], axis=1)


def _pair_totals(own: Block, found: list) -> tuple[np.ndarray, np.ndarray]:
    """What the pairs that this block counts tell of each word (the marks' at the end), and the totals of its distinct codes."""
    codes, _ = own.pairs()
    sent = np.empty(len(codes), np.int64)
    sent[np.argsort(own.pair_names(codes))] = _joined(found, 1)[0]
    total, mine = sent >> 1, np.flatnonzero(sent & 1)
    history, token = own.split(codes[mine])
    n, often = len(own.names) + 1, np.minimum(total[mine], 3)
    told = np.stack([*(np.bincount(history[often == k], minlength=n) for k in (1, 2, 3)), np.bincount(token, minlength=n)])
    return told.astype(np.int64), total


def _marks(blocks: DataFrame) -> DataFrame:
    """What the pairs tell of the marks: distinct first words, seen once, twice and more often, and distinct last ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                told, _ = _pair_totals(Block(row), row["found"])
                yield pa.RecordBatch.from_arrays([pa.array([told[:, -1].tolist()], pa.list_(pa.int64()))], names=["told"])

    return blocks.mapInArrow(run, "told array<long>").select(*[F.sum(F.col("told")[k]).alias(f"t{k}") for k in range(_TOLD)])


def _sum_words(table: pa.Table) -> pa.Table:
    import zstandard

    names = _hashes(table)
    counts = np.concatenate([_unsqueeze(x, "<u8") for x in table.column("counts").to_pylist()])
    told = np.concatenate([_unsqueeze(x).reshape(_TOLD, -1) for x in table.column("told").to_pylist()], axis=1)
    which, owner, sums, one = _summed(names, np.concatenate((counts[None], told)))
    unpack = zstandard.ZstdDecompressor()
    data = np.frombuffer(b"".join(unpack.decompress(x) for x in table.column("words").to_pylist()), np.uint8)
    sizes = np.concatenate([_unsqueeze(x) for x in table.column("lengths").to_pylist()]).astype(np.int64)
    start = np.cumsum(sizes) - sizes
    known = one[sums[0] > 0]
    picked = data[np.arange(int(sizes[known].sum())) + np.repeat(start[known] - (np.cumsum(sizes[known]) - sizes[known]), sizes[known])]
    codes, n = np.unique(trigrams(picked, np.cumsum(sizes[known]))[0], return_counts=True) if len(known) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    out = sums[:, which]
    out[0] = 2 * out[0] + (owner & (out[0] > 0))
    stats = [int(sums[0].sum()), len(known), int(sums[-1].sum()), *_times(sums[-1])]
    return _back(table, names, out, stats, codes.tolist(), n.tolist())


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every whole text.

    Tokens are the words, A to Z lower-cased, and one end. A null text is the end alone. base_score adds one to every
    count; score is the model's log10 probability. Repeated rows are trained on and scored as often as they are there.
    Without any training document both models are uniform over what they know. An empty table gives an empty table;
    further columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    first = Stored(_blocks(docs))
    blocks = first.df
    n_pairs, ends = blocks.agg(F.sum("n_pairs"), F.sum(F.size(F.filter("held", lambda h: ~h)))).head()
    ends, shards = int(ends or 0), max(partitions(spark), -(-int(n_pairs or 0) // SHARD))
    dealt = Stored(_deal_pairs(blocks, shards).groupBy("shard").applyInArrow(_sum_pairs, _SUMMED))
    paired = dealt.df
    pair_times = paired.where("block = -1").select(*[F.sum(F.col("stats")[k]).alias(f"s{k}") for k in range(4)]).head()
    pair_back = paired.where("block >= 0").groupBy("block").agg(F.collect_list(F.struct("shard", "totals")).alias("found"))
    held = blocks.select("block", "doc_ids", "sizes", "held", "tokens", "words", "lengths", "counts")
    second = Stored(held.join(pair_back, "block"))
    whole = second.df
    first.drop()
    dealt.drop()
    begin = [int(x or 0) for x in _marks(whole).head()]
    third = Stored(_deal_words(whole, shards).groupBy("shard").applyInArrow(_sum_words, _SUMMED))
    summed = third.df
    told = summed.where("block = -1")
    words, types, follows, *times = (int(x or 0) for x in told.select(*[F.sum(F.col("stats")[k]).alias(f"s{k}") for k in range(7)]).head())
    grams = told.select(F.explode(F.arrays_zip("codes", "n")).alias("x")).groupBy("x.codes").agg(F.sum("x.n").alias("n")).toArrow()  # at most 2**24 and a few rows
    shared = spark.sparkContext.broadcast(Spelling.fit(grams["codes"].to_numpy(), grams["n"].to_numpy()).dump())
    n, v = words + ends, types + (ends > 0)
    # the pairs' discounts; and those of tokens by themselves, counted by what they follow, the end among them
    d2, behind = _discounts(*(int(x or 0) for x in pair_times)), begin[3]
    if 1 <= behind <= 4:
        times[behind - 1] += 1
    d1, n1 = _discounts(*times), follows + behind
    left = (d1[1] * times[0] + d1[2] * times[1] + d1[3] * (v - times[0] - times[1])) / n1 if n1 else 1.0
    # the end and any unknown word have a share of their own, known words the rest, by their spelling
    share = 1 / (v + 2)

    def base(c: np.ndarray) -> np.ndarray:
        return np.log10((c + 1) / (n + v + 1))

    def alone(c: np.ndarray, below: np.ndarray) -> np.ndarray:
        return (c - d1[np.minimum(c, 3)]) / max(n1, 1) + left * below

    end, end_base = float(alone(np.array([behind]), np.array([share]))[0]), float(base(np.array(ends)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Spelling.mapped(shared.value)
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                own = Block(row)
                sums = np.empty((1 + _TOLD, len(own.names)), np.int64)
                sums[:, np.argsort(own.names)] = _joined(row["about"], 1 + _TOLD)
                totals, mine = sums[0] >> 1, sums[0] & 1 > 0
                grams, first = trigrams(own.data, own.ends)
                spelt = 10.0 ** np.add.reduceat(model.log10(grams), first) if len(first) else np.zeros(0)
                known = totals > 0
                # of an unknown word, only what its history leaves is found here
                lower = np.append(np.where(known, alone(sums[4], spelt * (1 - 2 * share)), 1.0), end)
                seen = np.append(totals, ends)
                given = sums[1:4] * d2[1:, None]
                given = np.append(given.sum(axis=0), float(np.dot(begin[:3], d2[1:])))
                leaves = np.where(seen > 0, given / np.maximum(seen, 1), 1.0)
                codes = own.codes()
                kinds, which = np.unique(codes, return_inverse=True)
                sent = np.empty(len(kinds), np.int64)
                sent[np.argsort(own.pair_names(kinds))] = _joined(row["found"], 1)[0]
                history, token = own.split(kinds)
                c = sent >> 1
                logs = np.log10(np.where(seen[history] > 0, (c - d2[np.minimum(c, 3)]) / np.maximum(seen[history], 1), 0.0) + leaves[history] * lower[token])[which]
                of = np.repeat(np.arange(len(own.sizes)), own.sizes)
                total = lambda x: np.bincount(of, x[own.tokens], len(own.sizes)) if len(of) else np.zeros(len(own.sizes))  # noqa: B023, E731
                score_ = np.bincount(np.repeat(np.arange(len(own.sizes)), own.sizes + 1), logs, len(own.sizes))
                # the last row tells what the block's own share of the known words takes from the spelling
                columns = [
                    pa.array([*row["doc_ids"], None], pa.int64()),
                    pa.array([*row["held"], None], pa.bool_()),
                    pa.array([*own.sizes.tolist(), None], pa.int64()),
                    pa.array([*total(known.astype(np.float64)).astype(np.int64).tolist(), None], pa.int64()),
                    pa.array([*total(base(totals)).tolist(), None], pa.float64()),
                    pa.array([*score_.tolist(), None], pa.float64()),
                    pa.array([*[None] * len(own.sizes), float(spelt[mine].sum())], pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "words", "known", "base", "sure", "owned"])
                trim()

    back = summed.where("block >= 0").groupBy("block").agg(F.collect_list(F.struct("shard", "totals")).alias("about"))
    joined = whole.join(back, "block", "left")
    sums = Stored(joined.mapInArrow(run, "doc_id long, held_out boolean, words long, known long, base double, sure double, owned double")).df
    second.drop()
    third.drop()
    spelt = sums.agg(F.sum("owned")).head()[0] or 0.0
    unknown = float(np.log10(left * (share + (1 - 2 * share) * max(1 - spelt, 0.0))))
    return sums.where("words IS NOT NULL").select(
        "doc_id",
        "held_out",
        (F.col("words") + 1).alias("n_tokens"),
        (F.col("known") + int(ends > 0)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + end_base).alias("base_score"),
        (F.col("sure") + (F.col("words") - F.col("known")) * unknown).alias("score"),
    )


def perplexity(scored: DataFrame) -> DataFrame:
    """Per part (held out or not), ten to the power of the mean negative log10 probability of a token."""
    return scored.groupBy("held_out").agg(F.pow(F.lit(10.0), -F.sum("score") / F.sum("n_tokens")).alias("perplexity"), F.sum("n_tokens").alias("n_tokens"))


def op5_lm_score(spark, sf_dir: str) -> DataFrame:
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"))
