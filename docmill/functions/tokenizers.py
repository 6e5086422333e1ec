"""Token ids by a byte-pair vocabulary of ranks: counts, ids and texts. The file of the vocabulary is a parameter."""

from __future__ import annotations

import base64
import re
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from docmill.session import small_batches

#: The library's own split dies in a run of a million blanks; a text with a run of so many is split here.
BLANK = 100_000
_BLANK = re.compile(rf"(?<!\s)\s{{{BLANK}}}")  # tried once a run


@cache
def vocabulary(path: str, pattern: str):
    """The encoding of a file of ranks (a token in base64 and its rank a line) and the pattern that splits a text."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def text_ids(text: str | None, path: str, pattern: str) -> list[int]:
    """No ids for a null or empty text."""
    if not text:
        return []
    if len(text) >= BLANK and _BLANK.search(text):
        import regex

        return [i for piece in regex.finditer(pattern, text) for i in vocabulary(path, pattern)._encode_single_piece(piece.group())]
    return vocabulary(path, pattern).encode_ordinary(text)


def counter(path: str, pattern: str):
    """The count of a text's tokens, for chunk_documents(count=...)."""
    return lambda text: len(text_ids(text, path, pattern))


def encode(text: Column, path: str, pattern: str) -> Column:
    small_batches(SparkSession.active())

    @F.arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([text_ids(t.as_py(), path, pattern) for t in texts], pa.list_(pa.int32()))

    return run(text)


def decode(ids: Column, path: str, pattern: str) -> Column:
    """The text of each list of ids; empty for a null one."""
    small_batches(SparkSession.active())

    @F.arrow_udf("string")
    def run(lists: pa.Array) -> pa.Array:
        return pa.array([vocabulary(path, pattern).decode(x.as_py() or []) for x in lists], pa.string())

    return run(ids)


def token_count(text: Column, path: str, pattern: str) -> Column:
    small_batches(SparkSession.active())

    @F.arrow_udf("long")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([len(text_ids(t.as_py(), path, pattern)) for t in texts], pa.int64())

    return run(text)
