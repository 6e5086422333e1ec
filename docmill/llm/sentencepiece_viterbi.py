"""SentencePiece encoding and decoding by a batched numpy Viterbi search.

Distinct words of one length advance together, a character at a time. At each end, every piece length is tried for all
words at once: the substring's hash probes the sorted hashes of the pieces, and a vectorised maximum over the lengths
stores the best score and its backpointer. A very long word, which has none of its length beside it, advances alone: all
substrings of a stretch of it are probed at once, and the same maximum is taken end by end.

The vocabulary is byte-pair encoded: its scores rank merges, and the path of the best sum is not its encoding. A
sequence of pieces is the encoding exactly if each piece, and each two neighbours, encode to themselves; so the search
scores a piece only behind a piece that it may follow. Whether one may follow another is found by merging the two and
kept in a table of fixed size.
"""

from __future__ import annotations

import hashlib
import heapq
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.llm.tables import small_batches
from docmill.llm.textbatch import mix, names, powers, slices, spans

MODEL = "piece_bpe_32k.model"
SPACE = 0x2581
#: Longer words advance alone, a stretch of so many characters at a time.
LONGEST, STRETCH = 200, 1 << 14
#: Words that are kept between batches of a task, and pairs of pieces that a long word's search remembers.
KEPT = 1_000_000
#: Text bytes that are encoded at once: the more distinct words advance together, the fewer steps there are.
STEP = 1 << 22
#: Slots of the table of pieces that follow each other, and of the marks of hashes that may be pieces.
SLOTS, MARKS = 1 << 22, 1 << 20
_CHARS = 0xA0761D6478BD642F
#: Ids from here on stand for characters that are no piece; bytes spell them.
_OTHER = 1 << 20


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


def _values(points: np.ndarray) -> np.ndarray:
    return mix(points.astype(np.uint64) + np.uint64(1))


class Pieces:
    """The vocabulary of a model file: normal pieces by hash, byte pieces, and what each id decodes to."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        special = [model.is_control(k) or model.is_unknown(k) for k in range(n)]
        self.bytes = {int(model.id_to_piece(k)[3:5], 16): k for k in range(n) if model.is_byte(k)}
        text = [model.id_to_piece(k) for k in range(n)]
        self.id = {p: k for k, p in enumerate(text) if not special[k] and not model.is_byte(k)}
        self.text, self.score = text, np.array([model.get_score(k) for k in range(n)])
        self.unknown = model.unk_id()
        ids = np.array(list(self.id.values()))
        words = [_points(text[k]) for k in ids]
        ends = np.cumsum([len(w) for w in words])
        hashes = spans(_values(np.concatenate(words)), ends - [len(w) for w in words], ends, _CHARS)
        order = np.argsort(hashes)
        self.keys, self.ids, self.longest = hashes[order], ids[order], max(map(len, words))
        out = [b"" if special[k] else bytes([int(text[k][3:5], 16)]) if model.is_byte(k) else text[k].replace(chr(SPACE), " ").encode() for k in range(n)]
        self.ends = np.concatenate(([0], np.cumsum([len(x) for x in out])))
        self.data = np.frombuffer(b"".join(out), np.uint8)
        self.alone = {}
        self.marks = np.zeros(MARKS, bool)
        self.marks[(self.keys >> np.uint64(44)).astype(np.int64)] = True
        self.pairs, self.follows = np.full(SLOTS, -1, np.int64), np.zeros(SLOTS, bool)

    def merged(self, word: str) -> list[int]:
        """Merges the best neighbours, the left ones first among equals, until none make a piece; ids, with _OTHER ones."""
        parts = [*word]
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, int, str]] = []

        def offer(a: int) -> None:
            if a >= 0 and after[a] < len(parts) and (k := self.id.get(both := parts[a] + parts[after[a]])) is not None:
                heapq.heappush(heap, (-self.score[k], a, after[a], both))

        for a in range(len(parts) - 1):
            offer(a)
        while heap:
            _, a, b, both = heapq.heappop(heap)
            if not parts[a] or after[a] != b or b >= len(parts) or parts[a] + parts[b] != both:
                continue
            parts[a], parts[b] = both, ""
            after[a] = after[b]
            if after[a] < len(parts):
                before[after[a]] = a
            offer(before[a])
            offer(a)
        return [self.id.get(p, _OTHER + ord(p[0])) for p in parts if p]

    def _may_stand(self, k: int) -> bool:
        """Whether a piece encodes to itself."""
        if k >= _OTHER:
            return True
        if k not in self.alone:
            self.alone[k] = self.merged(self.text[k]) == [k]
        return self.alone[k]

    def may_follow(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether each second piece may stand behind its first one; a first of -1 is the start of the word."""
        codes = (first + 1) * (1 << 22) + second
        slot = (mix(codes.astype(np.uint64)) >> np.uint64(42)).astype(np.int64)
        out = self.follows[slot]
        strange = np.flatnonzero(self.pairs[slot] != codes)
        if len(strange):
            new, which = np.unique(codes[strange], return_inverse=True)
            found = []
            for c in new.tolist():
                a, b = c // (1 << 22) - 1, c % (1 << 22)
                found.append(self._may_stand(b) and (a < 0 or max(a, b) >= _OTHER or self.merged(self.text[a] + self.text[b]) == [a, b]))
            found = np.array(found, bool)
            out[strange] = found[which]
            # one of those that share a slot stays; the others are found again when they are needed
            at = (mix(new.astype(np.uint64)) >> np.uint64(42)).astype(np.int64)
            at, one = np.unique(at, return_index=True)
            self.pairs[at], self.follows[at] = new[one], found[one]
        return out

    def _candidates(self, words: np.ndarray) -> list[np.ndarray]:
        """For each size from 1, the piece (or -1) that each word has from each place on."""
        n, length = words.shape
        total = np.zeros((n, length + 1), np.uint64)
        np.cumsum(_values(words.ravel()).reshape(n, length) * powers(_CHARS, length), axis=1, out=total[:, 1:])
        back = powers(pow(_CHARS, -1, 1 << 64), length + 1)
        out = []
        for size in range(1, min(length, self.longest) + 1):
            names = mix((total[:, size:] - total[:, :-size]) * back[: length - size + 1] + np.uint64(size))
            piece = np.full(names.shape, -1, np.int64)
            row, place = np.nonzero(self.marks[(names >> np.uint64(44)).astype(np.int64)])
            own = names[row, place]
            at = np.minimum(np.searchsorted(self.keys, own), len(self.keys) - 1)
            piece[row, place] = np.where(self.keys[at] == own, self.ids[at], -1)
            out.append(piece)
        out[0] = np.where(out[0] < 0, _OTHER + words.astype(np.int64), out[0])
        return out

    def search(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The encodings of words of one length (a row of code points each), one after another, and the ids of each."""
        n, length = words.shape
        found = self._candidates(words)
        score = np.full((n, length + 1), -np.inf)
        score[:, 0] = 0
        last, back = np.full((n, length + 1), -1, np.int64), np.zeros((n, length + 1), np.int64)
        for end in range(1, length + 1):
            # all pieces that end here, by size, behind ends that a search reached
            tried = [np.flatnonzero((found[size - 1][:, end - size] >= 0) & (back[:, end - size] > 0 if end > size else True)) for size in range(1, min(end, self.longest) + 1)]
            sizes = np.repeat(np.arange(1, len(tried) + 1), [len(r) for r in tried])
            rows = np.concatenate(tried)
            piece = np.concatenate([found[size - 1][r, end - size] for size, r in enumerate(tried, 1)])
            fits = self.may_follow(last[rows, end - sizes], piece)
            rows, piece, sizes = rows[fits], piece[fits], sizes[fits]
            total = score[rows, end - sizes] + np.where(piece < _OTHER, self.score[np.minimum(piece, len(self.score) - 1)], 0.0)
            order = np.argsort(total, kind="stable")  # the best one writes last
            rows, piece, sizes = rows[order], piece[order], sizes[order]
            score[rows, end], last[rows, end], back[rows, end] = total[order], piece, sizes
        out, at = [], np.full(n, length)
        while (live := np.flatnonzero(at > 0)).size:
            out.append((live, last[live, at[live]]))
            at[live] -= back[live, at[live]]
        row, ids = np.concatenate([r for r, _ in out]), np.concatenate([k for _, k in out])
        order = np.lexsort((-np.repeat(np.arange(len(out)), [len(r) for r, _ in out]), row))
        return ids[order], np.bincount(row, minlength=n)

    def walk(self, word: np.ndarray) -> np.ndarray:
        """As search(), of one word of any length; time and memory grow with the length."""
        length = len(word)
        score, last, back = array("d", bytes(8 * (length + 1))), array("l", [-1]) * (length + 1), array("l", [0]) * (length + 1)
        known: dict[int, bool] = {}
        for low in range(0, length, STRETCH):
            high, at = min(low + STRETCH, length), max(0, low - self.longest)
            found = self._candidates(word[None, at:high])
            tried = [(np.flatnonzero(x[0] >= 0), size) for size, x in enumerate(found, 1)]
            ends = np.concatenate([p + at + size for p, size in tried])
            sizes = np.repeat(np.arange(1, len(tried) + 1), [len(p) for p, _ in tried])
            pieces = np.concatenate([found[size - 1][0][p] for p, size in tried])
            order = np.argsort(ends, kind="stable")
            order = order[ends[order] > low]
            worth = np.where(pieces < _OTHER, self.score[np.minimum(pieces, len(self.score) - 1)], 0.0)
            for end, size, piece, own in zip(*(x[order].tolist() for x in (ends, sizes, pieces, worth)), strict=True):
                start = end - size
                if start and not back[start]:
                    continue
                code = (last[start] + 1) << 22 | piece
                fits = known.get(code)
                if fits is None:
                    if len(known) > KEPT:
                        known.clear()
                    fits = known[code] = bool(self.may_follow(np.array([last[start]]), np.array([piece]))[0])
                if fits and (not back[end] or score[start] + own >= score[end]):
                    score[end], last[end], back[end] = score[start] + own, piece, size
        out = []
        while length:
            out.append(last[length])
            length -= back[length]
        return np.array(out[::-1], np.int64)

    def spelled(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids with characters that are no piece replaced by the pieces of their bytes."""
        other = np.flatnonzero(ids >= _OTHER)
        if not len(other):
            return ids, sizes
        of = np.repeat(np.arange(len(sizes)), sizes)
        spelling = [[self.bytes.get(b, self.unknown) for b in chr(c).encode()] for c in (ids[other] - _OTHER).tolist()]
        length = np.ones(len(ids), np.int64)
        length[other] = [len(s) for s in spelling]
        out = np.repeat(ids, length)
        begin = (np.cumsum(length) - length)[other]
        for k, s in zip(begin, spelling, strict=True):
            out[k : k + len(s)] = s
        return out, np.bincount(of, length, len(sizes)).astype(np.int64)


class Encoder:
    """Encodes batches of texts and keeps the words it met, up to KEPT, for the next batch."""

    def __init__(self, path: str) -> None:
        self.pieces = Pieces(path)
        self._forget()

    def _forget(self) -> None:
        self.names = np.zeros(0, np.uint64)
        self.begin = self.sizes = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def _learn(self, fresh: np.ndarray, points: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        flat, sizes = [], np.zeros(len(fresh), np.int64)
        order, length = [], end - start
        for n in np.unique(length):
            which = np.flatnonzero(length == n)
            if n > LONGEST:
                found = [self.pieces.walk(points[start[k] : end[k]]) for k in which]
                ids, count = np.concatenate(found), np.array([len(f) for f in found])
            else:
                ids, count = self.pieces.search(points[start[which, None] + np.arange(n)])
            ids, count = self.pieces.spelled(ids, count)
            flat.append(ids.astype(np.int32))
            sizes[which] = count
            order.append(which)
        order = np.concatenate(order)
        begin = np.empty(len(fresh), np.int64)
        begin[order] = len(self.flat) + np.cumsum(sizes[order]) - sizes[order]
        self.flat = np.concatenate([self.flat, *flat])
        have, begin, sizes = np.concatenate((self.names, fresh)), np.concatenate((self.begin, begin)), np.concatenate((self.sizes, sizes))
        by = np.argsort(have)
        self.names, self.begin, self.sizes = have[by], begin[by], sizes[by]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and where each text's begin (with an end). An empty text has none."""
        joined = [(" " + t) if t else "" for t in texts]
        points = _points("".join(joined)).copy()
        first = np.concatenate(([0], np.cumsum([len(t) for t in joined])))
        if not len(points):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        points[points == 32] = SPACE
        space = points == SPACE
        head = space.copy()
        head[1:] &= ~space[:-1]
        head[first[:-1][np.diff(first) > 0]] = True
        start = np.flatnonzero(head)
        end = np.append(start[1:], len(points))
        kinds, one, which = np.unique(names(points, _values(points), start, end, _CHARS), return_index=True, return_inverse=True)
        if len(self.names) > KEPT:
            self._forget()
        at = np.minimum(np.searchsorted(self.names, kinds), max(0, len(self.names) - 1))
        new = np.flatnonzero(self.names[at] != kinds) if len(self.names) else np.arange(len(kinds))
        if len(new):
            self._learn(kinds[new], points, start[one[new]], end[one[new]])
        at = np.searchsorted(self.names, kinds)[which]
        sizes, begin = self.sizes[at], self.begin[at]
        place = np.cumsum(sizes) - sizes
        ids = self.flat[np.arange(int(sizes.sum())) + np.repeat(begin - place, sizes)]
        return ids, np.append(place, len(ids))[np.searchsorted(start, first)]

    def decode(self, ids: np.ndarray, first: np.ndarray) -> list[bytes]:
        """The UTF-8 of each list of ids: pieces joined, without the space that encoding put in front."""
        p = self.pieces
        size = np.diff(p.ends)[ids]
        place = np.concatenate(([0], np.cumsum(size)))
        data = p.data[np.arange(int(place[-1])) + np.repeat(p.ends[ids] - place[:-1], size)].tobytes()
        at = place[first]
        return [data[a + (data[a : a + 1] == b" ") : b] for a, b in zip(at, at[1:], strict=False)]


@cache
def encoder(path: str) -> Encoder:
    """One for all tasks of a worker."""
    return Encoder(path)


def _path(path: str | None) -> str:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(MODEL)
    return path


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and ids of each text. A null or empty text has no ids; repeated rows are kept."""
    small_batches(docs.sparkSession)
    path = _path(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in slices(batches, STEP):
            ids, first = own.encode([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids, pa.int32()))], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and text of each list of ids; a null list is an empty text. Bytes that are no UTF-8 become U+FFFD."""
    path = _path(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                lists = part.column("ids")
                sizes = np.asarray(lists.value_lengths().fill_null(0))
                texts = own.decode(np.asarray(lists.flatten()), np.concatenate(([0], np.cumsum(sizes))))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([t.decode(errors="replace") for t in texts], pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_ids, ids_crc32 (little-endian 32-bit ids), decoded_sha256 and exact: whether decoding gave the text back.

    Encoding and decoding run in one task, so ids do not travel. Only U+2581, which stands for a space, is not given back.
    A null or empty text has no ids and decodes to an empty one. Repeated rows are kept; an empty table gives an empty
    table; further columns are not read.
    """
    small_batches(docs.sparkSession)
    path = _path(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in slices(batches, STEP):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids, first = own.encode(texts)
            back = own.decode(ids, first)
            columns = [
                np.diff(first),
                np.array([zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(first, first[1:], strict=False)], np.int64),
                [hashlib.sha256(t).hexdigest() for t in back],
                [a.encode() == b for a, b in zip(texts, back, strict=True)],
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, columns)], names=["doc_id", "n_ids", "ids_crc32", "decoded_sha256", "exact"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, n_ids long, ids_crc32 long, decoded_sha256 string, exact boolean")


def op3_sentencepiece(spark, sf_dir: str) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"))
