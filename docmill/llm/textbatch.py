"""Words, hashes and slices of Arrow string columns, computed on their UTF-8 buffers with numpy.

A word is a longest run of bytes other than space and tab to carriage return. Hashes are 64 bits wide and depend on
bytes alone, so that every task gives the same name to the same words.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

#: Text bytes that are handled at once, unless one text alone is longer.
STEP = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Runs of more values than this are named by a digest of their bytes: long runs of two values can be made so that
#: their polynomials modulo 2**64 agree, whatever the base.
LONG = 256

_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 to base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 12)
        have = np.empty(size, np.uint64)
        have[0], done = 1, 1
        while done < size:
            more = min(done, size - done)
            have[done : done + more] = have[:more] * np.uint64(pow(base, done, 1 << 64))
            done += more
        _powers[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on all input bits."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(32)
    return h


def spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _BASE) -> np.ndarray:
    """The hash of values[starts:ends] for each pair; equal runs of values have equal hashes wherever they stand."""
    inverse = pow(base, -1, 1 << 64)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), out=total[1:])
    return mix((total[ends] - total[starts]) * powers(inverse, len(values) + 1)[starts] + (ends - starts).astype(np.uint64))


def names(raw: np.ndarray, values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _BASE) -> np.ndarray:
    """spans() of the values of raw; runs of more than LONG by a digest of raw itself."""
    out = spans(values, starts, ends, base)
    for k in np.flatnonzero(ends - starts > LONG):
        out[k] = int.from_bytes(hashlib.blake2b(raw[starts[k] : ends[k]].tobytes(), digest_size=8).digest(), "little")
    return out


def word_names(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hashes of the words raw[starts:ends], as Words gives them."""
    return names(raw, _BYTE[raw], starts, ends) if len(raw) else np.zeros(len(starts), np.uint64)


def digits(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The first eight bytes of raw[start:end] as a big-endian number, with zeros behind its end."""
    at = start[:, None] + np.arange(8)
    there = at < end[:, None]
    return np.where(there, raw[np.where(there, at, 0)], 0).astype(np.uint8).view(">u8")[:, 0].astype(np.uint64)


@cache
def _libc() -> ctypes.CDLL | None:
    try:
        found = ctypes.CDLL(None)
        return found if hasattr(found, "malloc_trim") else None
    except OSError:
        return None


def trim() -> None:
    """Hands freed memory back: workers outlive tasks, and what one stage needed at most would stay with them."""
    pa.default_memory_pool().release_unused()
    if _libc() is not None:
        _libc().malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], step: int = STEP, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about step bytes of text each."""
    for batch in batches:
        offsets = np.frombuffer(batch.column(column).buffers()[1], np.int32)[batch.column(column).offset :][: batch.num_rows + 1].astype(np.int64) if batch.num_rows else np.zeros(1, np.int64)
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + step, "right")) - 1)
            yield batch.slice(at, min(to, batch.num_rows) - at)
            at = to
        trim()


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins; the last entry is the end. A null is empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.string()) if not pa.types.is_string(column.type) else column
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """The words of a column: start and end in the bytes, doc of each word, and first word of each document (with an end)."""

    def __init__(self, column: pa.Array, lower: bool = False) -> None:
        self.bytes, self.offsets = utf8(column)
        n = len(self.bytes)
        self.lower = lower
        if not n:
            self.start = self.end = self.doc = np.zeros(0, np.int64)
            self.first = np.zeros(len(column) + 1, np.int64)
            return
        word = ~SPACE[self.bytes]
        edge = np.zeros(n + 1, bool)
        edge[self.offsets] = True
        before = np.empty(n, bool)
        before[0], before[1:] = False, word[:-1]
        self.start = np.flatnonzero(word & (~before | edge[:n]))
        after = np.empty(n, bool)
        after[-1], after[:-1] = False, word[1:]
        self.end = np.flatnonzero(word & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, self.offsets).astype(np.int64)
        self.doc = np.repeat(np.arange(len(column)), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        if not len(self.start):
            return np.zeros(0, np.uint64)
        return word_names(LOWER[self.bytes] if self.lower else self.bytes, self.start, self.end)


def distinct(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each list's distinct values in ascending order, and where each list begins."""
    out, sizes = [values[:0]], np.zeros(len(first), np.int64)
    for k in range(len(first) - 1):
        own = np.sort(values[first[k] : first[k + 1]])
        if len(own) > 1:
            own = own[np.concatenate(([True], own[1:] != own[:-1]))]
        out.append(own)
        sizes[k + 1] = len(own)
    return np.concatenate(out), np.cumsum(sizes)


def lists(values: np.ndarray, first: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """values cut into lists at first."""
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values, kind))
