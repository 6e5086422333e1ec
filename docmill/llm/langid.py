"""Language of the words of code-switched text by a linear-chain conditional random field.

A chain is a run of words of one document, broken at line ends and sentence ends and nowhere else. A word's state scores
add up learned weights of its features: byte n-grams of the word with its borders (the border ones are its affixes,
up to four bytes long) and, for words of the lexicon, the word itself. Learned transitions join neighbouring words.
Forward-backward gives each word's probability of each language; all chains advance together, the longest to the end.

Only `per_lang` documents of each language, and of these no more than LANG_BYTES beyond the first, train the model
(documented bounds, drawn by a hash of doc_id; rows without a doc_id do not train); whole texts of all documents are
labelled. Training chains are spliced from stretches of documents of several languages, so that
the transitions learn how languages switch as well as how they stay.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docmill.llm.tables import small_batches
from docmill.llm.textbatch import LOWER, Words, mix, slices, spans, trim

PER_LANG = 150
#: Bytes of text of one language that train the model; one document trains whatever its size.
LANG_BYTES = 1 << 24
#: Text bytes that are labelled at once.
STEP = 1 << 19
BITS = 16
LEXICON = 20000
EPOCHS, BATCH, RATE = 3, 512, 0.25
UNKNOWN = "und"
#: Share of a text's letters that its language needs to be accepted.
LEAST = 0.5
#: Orders of the n-grams of bytes; a border counts as a byte.
ORDERS = (1, 2, 3, 4)
_STOPS = np.zeros(256, bool)
_STOPS[[ord(c) for c in ".!?\n"]] = True
_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123)]] = True


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


class Features:
    """The features of distinct words: ids into the weights, and where each word's ids begin."""

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, lexicon: np.ndarray, names: np.ndarray) -> None:
        sizes = end - start + 2  # with both borders
        first = np.cumsum(sizes) - sizes
        flat = np.full(int(sizes.sum()), 32, np.uint64)
        inside = np.ones(len(flat), bool)
        inside[first], inside[first + sizes - 1] = False, False
        at = np.repeat(start - first - 1, sizes)[inside] + np.flatnonzero(inside)
        flat[inside] = data[at]
        word = np.repeat(np.arange(len(start), dtype=np.int32), sizes)
        room = (np.repeat(first + sizes, sizes) - np.arange(len(flat))).astype(np.int32)
        ids, of = [], []
        code = np.zeros(len(flat), np.uint64)
        for n in range(1, max(ORDERS) + 1):
            code[: len(flat) - n + 1] = (code[: len(flat) - n + 1] << np.uint64(8)) | flat[n - 1 :]
            fits = np.flatnonzero(room >= n)
            ids.append((mix(code[fits] ^ (np.uint64(n) << np.uint64(56))) >> np.uint64(64 - BITS)).astype(np.int32))
            of.append(word[fits])
        if len(lexicon):
            k = np.minimum(np.searchsorted(lexicon, names), len(lexicon) - 1)
            known = np.flatnonzero(lexicon[k] == names)
            ids.append(((1 << BITS) + k[known]).astype(np.int32))
            of.append(known.astype(np.int32))
        del flat, code, word, room
        ids, of = np.concatenate(ids), np.concatenate(of)
        order = np.argsort(of, kind="stable")
        self.ids, self.first = ids[order], np.searchsorted(of[order], np.arange(len(start)))
        self.sizes = np.diff(np.append(self.first, len(ids)))

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """Words x languages: the mean weight of the features, times their number to the half."""
        if not len(self.first):
            return np.zeros((0, weights.shape[1]), np.float32)
        total = np.add.reduceat(weights[self.ids], self.first)
        return total / np.sqrt(self.sizes)[:, None]


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # features x languages
    transitions: np.ndarray  # from x to, log scale
    begin: np.ndarray
    lexicon: np.ndarray  # sorted hashes of the lexicon's words

    def scores(self, words: Words) -> np.ndarray:
        """The state scores of all words; equal words are scored once."""
        if not len(words.start):
            return np.zeros((0, len(self.langs)))
        names, one, which = np.unique(words.hashes(), return_index=True, return_inverse=True)
        return Features(LOWER[words.bytes], words.start[one], words.end[one], self.lexicon, names).scores(self.weights)[which]


def chains(words: Words) -> np.ndarray:
    """The first word of each chain, in order, with an end. A chain does not cross documents or stops."""
    n = len(words.start)
    if not n:
        return np.zeros(1, np.int64)
    new = np.zeros(n, bool)
    new[words.first[:-1][np.diff(words.first) > 0]] = True
    gap_stop = np.concatenate(([0], np.cumsum(_STOPS[words.bytes])))
    new[1:] |= gap_stop[words.start[1:]] > gap_stop[words.end[:-1] - 1]
    return np.append(np.flatnonzero(new), n)


def forward_backward(scores: np.ndarray, first: np.ndarray, transitions: np.ndarray, begin: np.ndarray, gold: np.ndarray | None = None):
    """Each word's probabilities; with gold, also expected transitions and the gold labels' log probability.

    Chains advance together, the longest first, so that those that are left are the first ones at every step; in the
    probability domain with scaling. The time grows with the words and the longest chain.
    """
    states = np.exp(scores - scores.max(axis=1, keepdims=True)) if len(scores) else np.zeros_like(scores)
    step, start = np.exp(transitions), np.exp(begin)
    ahead, marginals, scale = np.empty_like(states), np.empty_like(states), np.empty(len(states))
    expected, likely = np.zeros_like(step), 0.0
    sizes = np.diff(first)
    order = np.argsort(-sizes, kind="stable")
    heads = first[:-1][order]
    most = int(sizes.max(initial=0))
    live = len(sizes) - np.searchsorted(np.sort(sizes), np.arange(most), "right")
    for t in range(most):
        at = heads[: live[t]] + t
        own = (ahead[at - 1] @ step if t else start) * states[at]
        scale[at] = total = own.sum(axis=1)
        ahead[at] = own / total[:, None]
    back = np.ones((len(sizes), states.shape[1]))
    for t in range(most - 1, -1, -1):
        at = heads[: live[t]] + t
        marginals[at] = ahead[at] * back[: live[t]]
        if t:
            behind = states[at] * back[: live[t]] / scale[at, None]
            if gold is not None:
                expected += ahead[at - 1].T @ behind * step
            back[: live[t]] = behind @ step.T
    if gold is not None:
        likely -= np.log(scale).sum()
    if gold is None:
        return marginals / marginals.sum(axis=1, keepdims=True)
    likely += (np.log(np.maximum(states[np.arange(len(gold)), gold], 1e-300))).sum() + begin[gold[first[:-1]]].sum()
    inner = np.ones(len(gold), bool)
    inner[first[:-1]] = False
    inner = np.flatnonzero(inner)
    likely += transitions[gold[inner - 1], gold[inner]].sum()
    return marginals / marginals.sum(axis=1, keepdims=True), expected, likely


def train(texts: list[str], labels: list[str], seed: int = 7) -> Model:
    """Stochastic gradient ascent on the log likelihood, with step sizes by accumulated squared gradients."""
    langs = sorted(set(labels))
    words = Words(pa.array(texts, pa.string()), lower=True)
    gold = np.array([langs.index(x) for x in labels])[words.doc]
    names, one, which, count = np.unique(words.hashes(), return_index=True, return_inverse=True, return_counts=True)
    by_count = np.argsort(-count, kind="stable")[:LEXICON]
    lexicon = np.sort(names[by_count[count[by_count] > 1]])
    found = Features(LOWER[words.bytes], words.start[one], words.end[one], lexicon, names)
    rng = np.random.default_rng(seed)
    width, k = (1 << BITS) + len(lexicon), len(langs)
    weights, speed = np.zeros((width, k), np.float32), np.full((width, k), 1e-3, np.float32)
    edges, edge_speed = np.zeros((k + 1, k)), np.full((k + 1, k), 1e-3)  # the last row begins a chain
    # stretches of 3 to 12 words, shuffled and joined by twos and threes: half of the joints change the language
    pieces, at = [], 0
    while at < len(which):
        to = min(at + int(rng.integers(3, 13)), int(words.first[words.doc[at] + 1]))
        pieces.append(np.arange(at, to))
        at = to
    order = rng.permutation(len(pieces))
    groups, at = [], 0
    while at < len(order):
        to = at + int(rng.integers(1, 4))
        groups.append(np.concatenate([pieces[x] for x in order[at:to]]))
        at = to
    for _ in range(EPOCHS if k > 1 else 0):
        order = rng.permutation(len(groups))
        for at in range(0, len(order), BATCH):
            own = [groups[x] for x in order[at : at + BATCH]]
            place = np.concatenate(own)
            first = np.cumsum([0, *map(len, own)])
            kinds, of = np.unique(which[place], return_inverse=True)
            sizes = found.sizes[kinds]
            begin = np.cumsum(sizes) - sizes
            ids = found.ids[np.repeat(found.first[kinds] - begin, sizes) + np.arange(int(sizes.sum()))]
            root = np.sqrt(sizes)[:, None]
            scores = (np.add.reduceat(weights[ids], begin) / root)[of].astype(np.float64)
            y = gold[place]
            marginals, expected, _ = forward_backward(scores, first, edges[:k], edges[k], y)
            miss = -marginals
            miss[np.arange(len(y)), y] += 1
            per_kind = np.zeros((len(kinds), k))
            np.add.at(per_kind, of, miss)
            slope = np.zeros((width, k), np.float32)
            np.add.at(slope, ids, np.repeat((per_kind / root).astype(np.float32), sizes, axis=0))
            speed += slope**2
            weights += RATE * slope / np.sqrt(speed)
            inner = np.ones(len(y), bool)
            inner[first[:-1]] = False
            inner = np.flatnonzero(inner)
            slope = np.zeros((k + 1, k))
            np.add.at(slope, (y[inner - 1], y[inner]), 1)
            np.add.at(slope, (np.full(len(own), k), y[first[:-1]]), 1)
            slope[:k] -= expected
            slope[k] -= marginals[first[:-1]].sum(axis=0)
            edge_speed += slope**2
            edges += RATE * slope / np.sqrt(edge_speed)
    return Model(langs, weights, edges[:k], edges[k], lexicon)


def training_rows(docs: DataFrame, per_lang: int = PER_LANG, lang_bytes: int = LANG_BYTES) -> list:
    """At most per_lang rows of each language, those of least hash of doc_id, while they hold lang_bytes at most.

    docs has doc_id, text and lang. Rows that are equal in all three train once; rows without a doc_id do not.
    """
    text = F.col("text").cast("string")
    some = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    sized = some.select("doc_id", "lang", F.xxhash64(text).alias("_text"), F.octet_length(text).alias("_bytes"))
    order = [F.xxhash64("doc_id", F.lit("train")), "doc_id", "_text"]
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    drawn = sized.withColumn("_n", rank).where(F.col("_n") <= per_lang)
    before = F.sum("_bytes").over(Window.partitionBy("lang").orderBy("_n").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    names = {(r["doc_id"], r["_text"], r["lang"]) for r in drawn.withColumn("_sum", before).where((F.col("_sum") <= lang_bytes) | (F.col("_n") == 1)).collect()}
    rows = some.withColumn("_text", F.xxhash64(text)).where(F.col("doc_id").isin([n[0] for n in names]) & F.col("_text").isin([n[1] for n in names]))
    found = rows.select("doc_id", text.alias("text"), "lang", "_text").distinct().collect()  # per_lang of each language
    return [r for r in found if (r["doc_id"], r["_text"], r["lang"]) in names]


def fit(docs: DataFrame, per_lang: int = PER_LANG) -> Model | None:
    """The model of a bounded sample; none if no row has a doc_id, a text with a letter and a language."""
    rows = sorted((r for r in training_rows(docs, per_lang) if has_letter(r["text"])), key=lambda r: (r["doc_id"], r["text"], r["lang"]))
    model = train([r["text"] for r in rows], [r["lang"] for r in rows]) if rows else None
    trim()
    return model


def label_words(column: pa.Array, model: Model) -> tuple[Words, np.ndarray]:
    """The words of all texts and the probability of each language for each word."""
    words = Words(column, lower=True)
    if not len(words.start):
        return words, np.zeros((0, len(model.langs)))
    scores = model.scores(words).astype(np.float64)
    return words, forward_backward(scores, chains(words), model.transitions, model.begin)


def _predict(texts: pa.Array, model: Model | None, with_words: bool) -> tuple[list[str], np.ndarray, list[list[dict]]]:
    """Each text's language, its share of the letters, and, if asked for, its runs of words of one language."""
    n = len(texts)
    preds, score, runs = [UNKNOWN] * n, np.zeros(n), [[] for _ in range(n)]
    if model is not None:
        words, marginals = label_words(texts, model)
        plain = np.concatenate(([0], np.cumsum(_LETTERS[words.bytes])))
        letters = plain + np.concatenate(([0], np.cumsum(words.bytes >= 128)))
        weight = (letters[words.end] - letters[words.start]).astype(np.float64)
        ascii = np.bincount(words.doc, (plain[words.end] - plain[words.start]), minlength=n) > 0
        total = np.zeros((n, len(model.langs)))
        for k in range(len(model.langs)):
            total[:, k] = np.bincount(words.doc, weight * marginals[:, k], minlength=n)
        best = total.argmax(axis=1)
        for d in range(n):
            if total[d].sum() > 0 and (ascii[d] or has_letter(texts[d].as_py())):
                preds[d], score[d] = model.langs[best[d]], min(1.0, total[d, best[d]] / total[d].sum())
                if with_words:
                    own = marginals[words.first[d] : words.first[d + 1]].argmax(axis=1)
                    turns = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1], [True])))
                    runs[d] = [{"lang": model.langs[own[a]], "words": int(b - a)} for a, b in zip(turns[:-1], turns[1:], strict=True)]
    return preds, score, runs


def identify(docs: DataFrame, model: Model | None, with_words: bool = False) -> DataFrame:
    """doc_id, lang_pred and score of every whole text; with_words, also the spans of words of one language.

    A document's language is the one of the most letters: every word weighs its letters' bytes times its
    probabilities; score is the share. A text without a letter, or null, is `und` with score 0. Repeated rows stay. An
    empty table gives an empty table; further columns are not read. Without a model all are `und`.
    """
    small_batches(docs.sparkSession)
    schema = "doc_id long, lang_pred string, score double" + ", runs array<struct<lang: string, words: int>>" * with_words
    cast = pickle.dumps(model)
    shared = docs.sparkSession.sparkContext.broadcast(cast)  # weights of 2**BITS + LEXICON features at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pickle.loads(shared.value)
        for batch in slices(batches, STEP):
            preds, score, runs = _predict(batch.column("text"), model, with_words)
            columns = [batch.column("doc_id"), pa.array(preds, pa.string()), pa.array(score, pa.float64())]
            if with_words:
                columns.append(pa.array(runs, pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int32())]))))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score", "runs"][: len(columns)])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def accepted(docs: DataFrame, model: Model | None, least: float = LEAST) -> DataFrame:
    """The rows of docs, all columns, whose text has a language with a share of `least` or more.

    Null texts and texts without a letter go, and all rows where there is no model; repeated rows stay as they are. An
    empty table gives an empty table.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    # columns go by number, as their names may be of any kind
    numbered = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    text = f"c{docs.columns.index('text')}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pickle.loads(shared.value)
        for batch in slices(batches, STEP, text):
            preds, score, _ = _predict(batch.column(text), model, False)
            yield batch.filter(pa.array([p != UNKNOWN and s >= least for p, s in zip(preds, score, strict=True)], pa.bool_()))

    return numbered.mapInArrow(run, numbered.schema).toDF(*docs.columns)


def held_out(doc_id, parts: int, part: int):
    """Whether crc32 of the doc_id as text leaves `part` modulo `parts`; false for a null doc_id."""
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string").cast("binary")) % parts == part, F.lit(False))


def op6_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = fit(docs.where(~held_out(F.col("doc_id"), 4, 2)))
    return identify(docs, model).withColumn("held_out", held_out(F.col("doc_id"), 4, 2)).select("doc_id", "held_out", "lang_pred", "score")
