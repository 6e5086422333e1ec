import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pyarrow.parquet as pq
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from docmill.llm.sentencepiece_viterbi import MODEL, Encoder, decode_documents, encode_documents, round_trip
from docmill.llm.textbatch import Words

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=P.path(MODEL))
ENCODER = Encoder(P.path(MODEL))


def encoded(texts):
    ids, first = ENCODER.encode(texts)
    return [ids[a:b].tolist() for a, b in zip(first, first[1:], strict=False)]


def test_equals_the_library_on_documents():
    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()
    assert encoded(texts) == LIBRARY.encode(texts)


@settings(deadline=None, max_examples=400)
@given(st.lists(st.one_of(st.text(max_size=30), st.text(alphabet=" \n\tabtheint", max_size=40), st.text(alphabet=" a", max_size=40)), max_size=4))
def test_equals_the_library_and_round_trips(texts):
    texts = [t for t in texts if "\x00" not in t]
    assert encoded(texts) == LIBRARY.encode(texts)
    ids, first = ENCODER.encode(texts)
    assert [x.decode() for x in ENCODER.decode(ids, first)] == [t.replace("▁", " ") for t in texts]


def test_long_words_and_runs():
    r = random.Random(1)
    texts = ["".join(r.choices("abcdefghinot", k=n)) for n in (150, 199, 200, 1000, 20000)] + [" " * n for n in (1, 2, 3, 5, 16, 17, 33, 100)] + ["the" * 300, "=" * 500, "é😀" * 120]
    assert encoded(texts) == LIBRARY.encode(texts)


def test_whole_table(spark):
    rows = [(1, "héllo  wörld", "x"), (2, None, ""), (3, "", ""), (3, "", ""), (None, "a\nb\t c ", ""), (4, "word \U0001f600 " * 9000, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = encode_documents(frame)
    assert sorted((r.doc_id or 0, r.ids) for r in got.collect()) == sorted((d or 0, LIBRARY.encode(t or "")) for d, t, _ in rows)
    assert sorted((r.doc_id or 0, r.text) for r in decode_documents(got).collect()) == sorted((d or 0, t or "") for d, t, _ in rows)
    for r in round_trip(frame).collect():
        text = next(t for d, t, _ in rows if d == r.doc_id) or ""
        assert r.exact and r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert r.ids_crc32 == zlib.crc32(np.array(LIBRARY.encode(text), "<u4").tobytes())
    assert round_trip(frame.limit(0)).count() == 0


def thue_morse(bits):
    word = "a"
    for _ in range(bits):
        word += word.translate(str.maketrans("ab", "ba"))
    return word


def test_words_of_equal_polynomials_are_told_apart():
    one = thue_morse(11)
    other = one.translate(str.maketrans("ab", "ba"))
    assert encoded([one, other]) == LIBRARY.encode([one, other])
    assert len(set(Words(pa.array([one, other])).hashes().tolist())) == 2


def test_long_words_advance_alone_by_the_same_recurrence(monkeypatch):
    r = random.Random(5)
    texts = ["".join(r.choices("abcdefghinot", k=n)) for n in (3, 40, 201, 700, 40000)] + ["é😀the" * 90, "=" * 700]
    want = LIBRARY.encode(texts)
    assert encoded(texts) == want
    monkeypatch.setattr("docmill.llm.sentencepiece_viterbi.LONGEST", 0)
    monkeypatch.setattr("docmill.llm.sentencepiece_viterbi.STRETCH", 7)
    own = Encoder(P.path(MODEL))
    ids, first = own.encode(texts[:4] + texts[5:])
    assert [ids[a:b].tolist() for a, b in zip(first, first[1:], strict=False)] == want[:4] + want[5:]
