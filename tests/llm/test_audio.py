import hashlib
import zlib

import numpy as np

from docmill.llm.audio import COLUMNS, FLOOR, FRAMES, HOP, MELS, TENSOR, UNIT, audio_columns, digest, features, log_mel, op10_audio_features, payload, read_back, read_tensors, resample, segments, store_tensors, stored_form, tensor_array


def test_payload_and_lossless_form():
    assert payload("") == payload(None) == b" " * UNIT and payload("x" * UNIT) == b"x" * UNIT and len(payload("x" * (UNIT + 1))) == 2 * UNIT
    data = bytes(range(256)) * 3
    assert read_back(stored_form(data)) == (8000, data)


def test_resampling_keeps_a_tone_and_its_level():
    x = np.sin(2 * np.pi * 500 * np.arange(8000) / 8000)
    y = resample(x, 3, 4)
    assert len(y) == 6000
    want = np.sin(2 * np.pi * 500 * np.arange(6000) / 6000)
    assert np.abs(y - want)[100:-100].max() < 0.02
    high = resample(np.sin(2 * np.pi * 3900 * np.arange(8000) / 8000), 3, 4)
    assert np.abs(high)[100:-100].max() < 0.1


def test_resampling_against_the_plain_form():
    from docmill.llm.audio import HALF

    x = np.random.default_rng(1).normal(size=101)
    for up, down in ((3, 4), (1, 2), (2, 1), (5, 3)):
        wide = max(up, down)
        n = np.arange(-HALF * wide, HALF * wide + 1)
        taps = np.sinc(n / wide) * np.hanning(len(n) + 2)[1:-1] * up / wide
        full = np.convolve(np.insert(x[:, None], 1, np.zeros((up - 1, len(x))), axis=1).ravel() if up > 1 else x, taps)[HALF * wide :]
        want = full[::down][: len(resample(x, up, down))]
        assert np.allclose(resample(x, up, down), want)


def test_log_mel_peaks_at_the_tone():
    mels, _ = log_mel(np.sin(2 * np.pi * 1500 * np.arange(6000) / 6000), 6000)
    assert mels.shape == (-(-6000 // HOP), MELS)
    assert len(set(mels[2:-2].argmax(axis=1))) == 1
    low, _ = log_mel(np.sin(2 * np.pi * 300 * np.arange(6000) / 6000), 6000)
    assert low[5].argmax() < mels[5].argmax()


def test_hysteresis_against_a_loop():
    energy = np.random.default_rng(3).normal(size=500)
    high, low = np.percentile(energy, [65, 35])
    on, runs, start = False, [], 0
    for k, e in enumerate(energy):
        if not on and e >= high:
            on, start = True, k
        elif on and e < low:
            runs.append((start, k))
            on = False
    if on:
        runs.append((start, len(energy)))
    assert segments(energy) == runs


def test_features_have_a_fixed_shape_and_spans():
    tensors, spans, found = features(payload("some words of text " * 1000))
    assert tensors.shape[1:] == (FRAMES, MELS) and len(spans) == len(tensors) and (tensors[-1, -1] == FLOOR).all()
    assert all(a < b for a, b in [*spans, *found]) and spans[0][0] == 0
    assert tensor_array(tensors).type == TENSOR and np.array_equal(tensor_array(tensors).to_numpy_ndarray(), tensors)
    stored, at = read_tensors(store_tensors(tensors, spans))
    assert np.array_equal(stored, tensors) and at == spans
    assert digest(*features(payload("a"))[::2]) == digest(*features(payload("a"))[::2]) != digest(*features(payload("b"))[::2])


def test_whole_table(spark):
    rows = [(1, "héllo", "x"), (2, None, "y"), (3, "", "z"), (4, "w " * 60000, ""), (4, "w " * 60000, ""), (None, "héllo", "")]
    got = audio_columns(spark.createDataFrame(rows, "doc_id long, text string, feature string")).collect()
    assert len(got) == 6
    by = {}
    for r, (doc, text, _) in zip(sorted(got, key=lambda r: (r.doc_id is None, r.doc_id)), rows, strict=True):
        data = payload(text)
        assert (r.doc_id, r.n_bytes, r.payload_bytes) == (doc, len((text or "").encode()), len(data))
        assert r.payload_sha256 == hashlib.sha256(data).hexdigest() and r.tail_crc32 == zlib.crc32(data[-16:])
        assert r.media_bytes == len(stored_form(data)) and r.media_sha256 == hashlib.sha256(stored_form(data)).hexdigest()
        assert by.setdefault(text or "", r.feature) == r.feature
        assert read_back(bytes(r.media))[1] == data
        tensors, spans, found = features(data)
        kept, at = read_tensors(bytes(r.tensors))
        assert np.array_equal(kept, tensors) and at == spans and [tuple(x) for x in r.segments] == found
    assert audio_columns(spark.createDataFrame([], "doc_id long, text string")).select(*COLUMNS).count() == 0


def test_filterbank_against_its_definition():
    """Every band of a frame is the triangle-weighted sum of the power at the bins, summed one by one."""
    rate, x = 6000, np.random.default_rng(2).normal(size=700)
    mels, energy = log_mel(x, rate)
    y = [x[k] - 0.97 * x[max(k - 1, 0)] for k in range(len(x))]
    mel = lambda f: 2595 * np.log10(1 + f / 700)
    edges = [700 * (10 ** (mel(rate / 2) * k / (MELS + 1) / 2595) - 1) for k in range(MELS + 2)]
    for t in (0, 2, len(mels) - 1):
        frame = [(y[k] if 0 <= (k := t * HOP - 128 + j) < len(y) else 0.0) * (0.5 - 0.5 * np.cos(2 * np.pi * j / 255)) for j in range(256)]
        power = [abs(sum(v * np.exp(-2j * np.pi * f * j / 256) for j, v in enumerate(frame))) ** 2 / 256 for f in range(129)]
        for m in (0, 5, MELS - 1):
            a, b, c = edges[m : m + 3]
            total = sum(p * max(0, min((f * rate / 256 - a) / (b - a), (c - f * rate / 256) / (c - b))) for f, p in enumerate(power))
            assert np.isclose(mels[t, m], 10 * np.log10(max(total, 1e-10)))
        assert np.isclose(energy[t], 10 * np.log10(max(np.mean(np.square(frame)), 1e-10)))


def test_query_returns_what_was_stored(spark):
    rows = op10_audio_features(spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        assert read_back(bytes(r.media))[1] == payload(texts[r.doc_id]) and len(read_tensors(bytes(r.tensors))[1]) == int(r.feature.split("x")[0])
