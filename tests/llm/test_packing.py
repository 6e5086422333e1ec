import random
import time
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from docmill.llm import packing
from docmill.llm.packing import JSON, RANKS, cuts, encode, pack, pack_documents

PATHS = (P.path(JSON), P.path(RANKS), P.PATTERN)


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - n)
        else:
            gaps.append(capacity - n)
    return len(gaps)


def packed(spark, lengths, capacity):
    """Sequences as sorted (offset, length), each checked to be gapless and within the capacity."""
    rows = spark.createDataFrame([(k, n) for k, n in enumerate(lengths)], "doc_id long, length long")
    got = pack(rows, capacity).collect()
    assert sorted((r.doc_id, r.length) for r in got) == list(enumerate(lengths))
    filled = defaultdict(list)
    for r in got:
        filled[r.sequence_id].append((r.offset, r.length))
    for spans in filled.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return filled


CASES = {
    "few": (20, lambda r: [r.randint(1, 20) for _ in range(60)]),
    "any": (1024, lambda r: [r.randint(1, 1024) for _ in range(2000)]),
    "mostly short": (1024, lambda r: [min(1024, int(r.expovariate(1 / 300)) + 1) for _ in range(2000)]),
    "pairs": (1024, lambda r: [r.randint(300, 600) for _ in range(2000)]),
    "triples": (1024, lambda r: [r.randint(200, 340) for _ in range(2000)]),
    "ones": (1024, lambda r: [1] * 5000),
    "full": (1024, lambda r: [1024] * 50),
    "two lengths": (1024, lambda r: [r.choice((600, 5)) for _ in range(2000)]),
}


@pytest.mark.parametrize("case", CASES)
def test_sequences_are_as_few_as_best_fit(spark, case):
    capacity, make = CASES[case]
    lengths = make(random.Random(case))
    assert len(packed(spark, lengths, capacity)) <= best_fit_decreasing(lengths, capacity) + 1


def test_lanes_lose_nothing_and_stay_near_best_fit(spark, monkeypatch):
    monkeypatch.setattr(packing, "LANE", 400)
    lengths = CASES["any"][1](random.Random(1))
    assert len(packed(spark, lengths, 1024)) <= best_fit_decreasing(lengths, 1024) * 1.02


@settings(deadline=None, max_examples=6)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_any_lengths(spark, lengths):
    assert len(packed(spark, lengths, 20)) <= best_fit_decreasing(lengths, 20) + 1


def test_lengths_beyond_the_capacity_are_refused(spark):
    for bad in (0, 21):
        with pytest.raises(ValueError):
            packed(spark, [1, bad], 20)


@settings(deadline=None, max_examples=200)
@given(st.one_of(st.text(max_size=80), st.sampled_from(["a <|endoftext|> b", "<|endoftext|>", "it's  \n\n x y  z", "1234 ½ ٣ x²", "a" * 3000])))
def test_ids_are_those_of_tokenizers(text):
    assert encode(text, PATHS) == Tokenizer.from_file(PATHS[0]).encode(text, add_special_tokens=False).ids


def test_cuts():
    assert cuts(1024, 1024) == [(0, 1024)] and cuts(1, 1024) == [(0, 1)]
    assert cuts(2500, 1024) == [(0, 452), (452, 1024), (1476, 1024)]


def test_whole_table(spark):
    rows = [(k, "word " * (k % 700) + str(k), "x", "y") for k in range(400)] + [(400, None, "", ""), (401, "", "", ""), (401, "", "", ""), (402, "long é " * 20000, "", "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, piece string, offset string")
    got = pack_documents(frame).collect()
    tokenizer = Tokenizer.from_file(PATHS[0])
    by, filled = defaultdict(list), defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
        filled[r.sequence_id].append((r.offset, r.length))
    for doc, text, *_ in {r[0]: r for r in rows}.values():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        own = sorted(by[doc], key=lambda r: r.piece)
        if doc == 401:
            assert len(own) == 2 and own[0].length == 1
            continue
        assert [r.piece for r in own] == list(range(len(own))) and sum(r.length for r in own) == len(ids)
        for r in own:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    for spans in filled.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(filled) <= best_fit_decreasing([r.length for r in got], 1024) + 1
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_very_long_runs():
    exact = Tokenizer.from_file(PATHS[0])
    for text in (" " * 1_000_000 + "a", "\n" * 3_000_000 + "b c", "x" * 5_000_000, "".join(chr(97 + k * k % 26) for k in range(2_000_000)), "a " * 60_000 + " " * 99_999 + "b"):
        assert encode(text, PATHS) == exact.encode(text, add_special_tokens=False).ids


def test_many_runs_under_the_bound_take_linear_time():
    text = ("x" + " " * 99_998) * 50  # 5 MB
    start = time.time()
    got = encode(text, PATHS)
    assert time.time() - start < 20
    assert got == Tokenizer.from_file(PATHS[0]).encode(text, add_special_tokens=False).ids


def test_a_run_of_blanks_in_a_table(spark):
    got = pack_documents(spark.createDataFrame([(1, " " * 1_500_000 + "x"), (2, "y")], "doc_id long, text string")).collect()
    assert {r.doc_id for r in got} == {1, 2} and max(r.length for r in got) <= 1024


def test_rows_without_an_id_and_columns_of_the_steps(spark):
    rows = [(None, "same", 1, 2, 3)] * 50 + [(7, None, None, None, None)] * 3
    got = pack_documents(spark.createDataFrame(rows, "doc_id long, text string, _row long, id long, size long")).collect()
    places = {(r.sequence_id, r.offset) for r in got}
    assert len(got) == len(places) == 53 and {r.sequence_id for r in got} == {got[0].sequence_id}
    assert sorted(r.length for r in got)[:3] == [1, 1, 1] and sum(r.doc_id is None for r in got) == 50
