"""How the vocabularies of sources differ inside a language: an audit by mergeable radix tries.

A task counts the terms of its texts in a byte trie. An edge of the trie holds up to eight bytes as one big-endian
number, so that a level is descended by all words at once and the order of edges is the order of bytes; what is beyond
DEPTH levels is one edge of any length. A leaf has a counter for each (language, source): occurrences and documents.
Tries merge by building the trie of their leaves' terms and adding the counters of leaves that meet.

Leaves travel by ranges of (language, term), that is of prefixes. A range merges its leaves in byte order and writes
the kept ones as sub-tries of at most LEAVES leaves, with the sums of each source. Those sums, added up over all
sub-tries, are the heads: one row per language with all its sources. Each sub-trie, in UTF-8 order with its language's
head, then gives its share of every pair of sources and, of each source, the TOP terms that may be among the best, ties
in term order.

All arithmetic is exact in 64 bits as long as a language has less than 9 * 10**15 counted terms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docmill.llm.tables import Stored, partitions, small_batches, stored
from docmill.llm.textbatch import LOWER, digits, slices, utf8

TOP = 10
LEAST = 10
SCALE = 10**9
#: Levels of eight bytes; longer terms have one more edge with the rest.
DEPTH = 8
#: Counters that a task's trie holds before it is handed on.
COUNTERS = 1 << 19
#: Leaves of a sub-trie.
LEAVES = 4096
#: Sources whose pairs with all others are summed at once, and values of a matrix.
SOURCES, CELLS = 256, 1 << 20

_TERM = np.zeros(256, bool)
_TERM[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
LEAF = "lang string, term string, sources array<string>, counts array<long>, docs array<long>"
SUBTRIE = "lang string, terms array<string>, sizes array<int>, sources array<string>, counts array<long>, names array<string>, sums array<long>"
SHARE = "lang string, source string, part string, item string, value long"


# ---- the trie of a task


def terms_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The lower-cased bytes of the texts; start, end and text of each term."""
    raw, offsets = utf8(column)
    n = len(raw)
    inside = np.zeros(n + 2, bool)
    inside[1 : n + 1] = _TERM[raw]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(inside[1 : n + 1] & (~inside[:n] | edge[:n]))
    end = np.flatnonzero(inside[1 : n + 1] & (~inside[2 : n + 2] | edge[1 : n + 1])) + 1
    return LOWER[raw], start, end, np.searchsorted(offsets, start, "right") - 1


def leaves(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The leaf of each word in the trie of all of them, and a word of each leaf. Words hold no zero byte.

    The words stand at nodes; level by level those that have bytes left go along the edge of their next eight bytes. An
    edge is a pair of a node and a number; equal pairs are one edge.
    """
    node, n_nodes = np.zeros(len(start), np.int64), 1
    active = np.arange(len(start))
    for level in range(DEPTH):
        edges, label = np.unique(digits(raw, start[active] + 8 * level, end[active]), return_inverse=True)
        _, edge = np.unique(node[active] * len(edges) + label, return_inverse=True)
        node[active] = n_nodes + edge
        n_nodes += int(edge.max(initial=-1)) + 1
        active = active[end[active] > start[active] + 8 * (level + 1)]
        if not len(active):
            break
    tails: dict[tuple[int, bytes], int] = {}
    for k in active.tolist():
        tail = (int(node[k]), raw[start[k] + 8 * DEPTH : end[k]].tobytes())
        node[k] = tails.setdefault(tail, n_nodes + len(tails))
    _, first, leaf = np.unique(node, return_index=True, return_inverse=True)
    return leaf, first


class Trie:
    """Leaves with counters. terms: the leaves' terms; cells: leaf, group, occurrences and documents, a column each."""

    def __init__(self) -> None:
        self.terms = pa.array([], pa.string())
        self.cells = np.zeros((4, 0), np.int64)

    @staticmethod
    def of(texts: pa.Array, group: np.ndarray) -> Trie:
        """The trie of some texts, whose groups are numbered by `group`."""
        out = Trie()
        raw, start, end, text = terms_of(texts)
        if not len(start):
            return out
        leaf, first = leaves(raw, start, end)
        out.terms = _cut(raw, start[first], end[first])
        pair, n = np.unique(text * len(first) + leaf, return_counts=True)  # a document and a leaf
        text, leaf = np.divmod(pair, len(first))
        out.cells = _summed(np.stack((leaf, group[text], n, np.ones(len(n), np.int64))))
        return out

    @staticmethod
    def merged(tries: list[Trie]) -> Trie:
        out = Trie()
        column = pa.concat_arrays([t.terms for t in tries])
        if not len(column):
            return out
        raw, offsets = utf8(column)
        leaf, first = leaves(raw, offsets[:-1], offsets[1:])
        out.terms = column.take(pa.array(first))
        base = np.cumsum([0, *(len(t.terms) for t in tries)])
        cells = np.concatenate([t.cells + np.array([[b], [0], [0], [0]]) for t, b in zip(tries, base, strict=False)], axis=1)
        cells[0] = leaf[cells[0]]
        out.cells = _summed(cells)
        return out


def _cut(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """raw[start:end] as strings."""
    size = end - start
    offsets = np.concatenate(([0], np.cumsum(size)))
    at = np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])
    return pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(raw[at].tobytes()))


def _summed(cells: np.ndarray) -> np.ndarray:
    """Cells of one leaf and group become one; by leaf, then group."""
    if not cells.shape[1]:
        return cells
    order = np.lexsort((cells[1], cells[0]))
    cells = cells[:, order]
    new = np.flatnonzero(np.concatenate(([True], (np.diff(cells[0]) != 0) | (np.diff(cells[1]) != 0))))
    return np.stack((cells[0][new], cells[1][new], np.add.reduceat(cells[2], new), np.add.reduceat(cells[3], new)))


def _rows(trie: Trie, groups: list[tuple[str, str]]) -> Iterator[pa.RecordBatch]:
    """A row per language and leaf."""
    langs = sorted({g[0] for g in groups})
    number = {x: k for k, x in enumerate(langs)}
    of_group = np.array([number[g[0]] for g in groups], np.int64)
    leaf, group, n, docs = trie.cells
    order = np.lexsort((leaf, of_group[group]))
    leaf, group, n, docs = leaf[order], group[order], n[order], docs[order]
    lang = of_group[group]
    new = np.flatnonzero(np.concatenate(([True], (np.diff(lang) != 0) | (np.diff(leaf) != 0)))) if len(leaf) else np.zeros(0, np.int64)
    first = pa.array(np.concatenate((new, [len(leaf)])).astype(np.int32))
    names = pa.array([g[1] for g in groups], pa.string()).take(pa.array(group))
    columns = [pa.array(langs, pa.string()).take(pa.array(lang[new])), trie.terms.take(pa.array(leaf[new])), *(pa.ListArray.from_arrays(first, c) for c in (names, pa.array(n), pa.array(docs)))]
    whole = pa.RecordBatch.from_arrays(columns, names=["lang", "term", "sources", "counts", "docs"])
    for at in range(0, whole.num_rows, LEAVES):
        yield whole.slice(at, LEAVES)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    numbers: dict[tuple[str, str], int] = {}
    main, small, waiting = Trie(), [], 0
    for batch in slices(batches):
        keys = list(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True))
        small.append(Trie.of(batch.column("text"), np.array([numbers.setdefault(k, len(numbers)) for k in keys], np.int64)))
        waiting += small[-1].cells.shape[1]
        if waiting > max(main.cells.shape[1], COUNTERS >> 2):  # each cell is merged a few times only
            main, small, waiting = Trie.merged([main, *small]), [], 0
        if main.cells.shape[1] > COUNTERS:
            yield from _rows(main, list(numbers))
            main, numbers = Trie(), {}
    main = Trie.merged([main, *small])
    yield from _rows(main, list(numbers))


# ---- merging by ranges of prefixes


class _Cells:
    """Flat cells (row, source, count, docs) of rows (lang, term)."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        self.lang, self.term = batch.column("lang"), batch.column("term")
        self.row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(batch.column("sources")).to_numpy(zero_copy_only=False))
        self.source = batch.column("sources").flatten()
        self.count, self.docs = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("counts", "docs"))


def _joined(cells: _Cells) -> pa.RecordBatch:
    """Rows of one (lang, term), which stand together, made one."""
    n = len(cells.term)
    same = pc.and_(pc.equal(cells.term[1:], cells.term[:-1]), pc.equal(cells.lang[1:], cells.lang[:-1])).to_numpy(zero_copy_only=False)
    run = np.concatenate(([0], np.cumsum(~same))) if n else np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate(([True], ~same))) if n else run
    coded = cells.source.dictionary_encode()
    out = _summed(np.stack((run[cells.row], coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), cells.count, cells.docs)))
    edges = pa.array(np.searchsorted(out[0], np.arange(len(first) + 1)).astype(np.int32))
    at = pa.array(first)
    names = coded.dictionary.take(pa.array(out[1]))
    return pa.RecordBatch.from_arrays([cells.lang.take(at), cells.term.take(at), *(pa.ListArray.from_arrays(edges, c) for c in (names, pa.array(out[2]), pa.array(out[3])))], names=["lang", "term", "sources", "counts", "docs"])


def _subtries(rows: pa.RecordBatch, least: int) -> Iterator[pa.RecordBatch]:
    """The kept leaves of joined rows, in sub-tries of one language."""
    starts = np.concatenate(([0], np.cumsum(pc.list_value_length(rows.column("docs")).to_numpy(zero_copy_only=False))))
    docs = np.concatenate(([0], np.cumsum(rows.column("docs").flatten().to_numpy(zero_copy_only=False))))
    rows = rows.filter(pa.array(docs[starts[1:]] - docs[starts[:-1]] >= least))
    at = 0
    langs = rows.column("lang").to_pylist()
    while at < rows.num_rows:
        to = at + 1
        while to < min(rows.num_rows, at + LEAVES) and langs[to] == langs[at]:
            to += 1
        part = rows.slice(at, to - at)
        source, count = part.column("sources").flatten(), part.column("counts").flatten()
        coded = source.dictionary_encode()
        sums = np.zeros(len(coded.dictionary), np.int64)
        np.add.at(sums, coded.indices.to_numpy(zero_copy_only=False), count.to_numpy(zero_copy_only=False))
        one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        sizes = pc.list_value_length(part.column("sources"))
        yield pa.RecordBatch.from_arrays([pa.array([langs[at]], pa.string()), *map(one, (pa.concat_arrays([part.column("term")]), sizes, source, count, coded.dictionary, pa.array(sums)))], names=[x.split()[0] for x in SUBTRIE.split(", ")])
        at = to


def _merge(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None  # the last (lang, term), which may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([x for x in (held, batch) if x is not None]).combine_chunks().to_batches()[0]
            rows = _joined(_Cells(rows))
            held = rows.slice(rows.num_rows - 1)
            yield from _subtries(rows.slice(0, rows.num_rows - 1), least)
        if held is not None:
            yield from _subtries(held, least)

    return run


# ---- traversal


def shares(count: np.ndarray, total: np.ndarray | int, kept: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / (total + 2 * kept)), by long division in digits to base 1000."""
    below = np.asarray(total, np.int64) + 2 * kept
    whole, rest = np.divmod(count + 2, below)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, below)
        whole = whole * 1000 + digit
    return whole + 1


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _traverse(top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield from visit({c: batch.column(c)[k] for c in batch.schema.names})

    def visit(row: dict) -> Iterator[pa.RecordBatch]:
        lang, kept, block = row["lang"].as_py(), row["kept"].as_py(), row["block"].as_py()
        names, totals = row["all_names"].values, row["all_sums"].values.to_numpy(zero_copy_only=False)
        terms, n_sources = row["terms"].values, len(names)
        own = range(block * SOURCES, min((block + 1) * SOURCES, n_sources))
        leaf = np.repeat(np.arange(len(terms)), row["sizes"].values.to_numpy(zero_copy_only=False))
        source = pc.index_in(row["sources"].values, value_set=names).to_numpy(zero_copy_only=False)
        count = row["counts"].values.to_numpy(zero_copy_only=False)
        whole = np.bincount(leaf, count, len(terms)).astype(np.int64) if count.sum() < 1 << 53 else np.add.reduceat(count, np.searchsorted(leaf, np.arange(len(terms))))
        q = shares(whole, int(totals.sum()), kept)
        pairs = np.zeros((len(own), n_sources), np.int64)
        best: dict[int, list[tuple[int, int]]] = {s: [] for s in own}
        step = max(1, CELLS // n_sources)
        for at in range(0, len(terms), step):
            a, b = np.searchsorted(leaf, [at, min(at + step, len(terms))])
            counts = np.zeros((min(step, len(terms) - at), n_sources), np.int64)
            counts[leaf[a:b] - at, source[a:b]] = count[a:b]
            p = shares(counts, totals[None], kept)
            for i, s in enumerate(own):
                pairs[i] += distance(p[:, s, None], p).sum(axis=0)
                some = np.flatnonzero((counts[:, s] > 0) & (p[:, s] > q[at : at + step]))
                value = distance(p[some, s], q[at + some])
                order = np.argsort(-value, kind="stable")[:top]
                best[s] = sorted(best[s] + list(zip(value[order].tolist(), (at + some[order]).tolist(), strict=True)), key=lambda x: (-x[0], x[1]))[:top]
        mine, other = (x.ravel() for x in np.meshgrid(np.array(own), np.arange(n_sources), indexing="ij"))
        differ = mine != other
        yield _share(lang, names.take(pa.array(mine[differ])), "pair", names.take(pa.array(other[differ])), pairs.ravel()[differ])
        found = [(s, value, term) for s in own for value, term in best[s]]
        s, value, term = (np.array(x, np.int64) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
        yield _share(lang, names.take(pa.array(s)), "term", terms.take(pa.array(term)), value)

    return run


def _share(lang: str, source: pa.Array, part: str, item: pa.Array, value: np.ndarray) -> pa.RecordBatch:
    same = lambda x: pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(value), np.int32)), [x]).cast(pa.string())
    return pa.RecordBatch.from_arrays([same(lang), source, same(part), item, pa.array(value)], names=["lang", "source", "part", "item", "value"])


# ---- the operator


def divergence(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): every pair of sources of a language, and the terms that mark a source.

    docs: text, lang, source; each null is an empty string, further columns are not read, repeated rows count as often
    as they stand there. A language keeps the terms of `least` or more of its documents; one that keeps none has pairs
    of value 0 and no terms, and one with a single source no pairs. An empty table gives an empty table. Terms may have
    any length.
    """
    spark = docs.sparkSession
    small_batches(spark)
    read = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    counted = Stored(read.mapInArrow(_count, LEAF))
    ranged = counted.df.repartitionByRange(partitions(spark), "lang", "term").sortWithinPartitions("lang", "term")
    tries = stored(ranged.mapInArrow(_merge(least), SUBTRIE))
    counted.drop()
    sums = tries.select("lang", F.explode(F.arrays_zip("names", "sums")).alias("s")).groupBy("lang", F.col("s.names").alias("source")).agg(F.sum("s.sums").alias("total"))
    kept = tries.groupBy("lang").agg(F.sum(F.size("terms")).alias("kept"))
    groups = read.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").withColumn("total", F.coalesce("total", F.lit(0).cast("long")))
    # a row per language holds its sources; the result has a row for each two of them
    heads = groups.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("source", "total"))).alias("_all")).join(kept, "lang", "left")
    heads = stored(heads.select("lang", F.coalesce("kept", F.lit(0).cast("long")).alias("kept"), F.col("_all.source").alias("all_names"), F.col("_all.total").alias("all_sums")))
    blocks = F.sequence(F.lit(0), F.floor((F.size("all_names") - 1) / SOURCES).cast("int"))
    visits = tries.drop("names", "sums").join(heads, "lang").withColumn("block", F.explode(blocks))
    found = stored(visits.mapInArrow(_traverse(top), SHARE))
    bare = heads.where("kept = 0").select("lang", F.explode("all_names").alias("source"), "all_names").select("lang", "source", F.explode("all_names").alias("item"))
    bare = bare.where("source <> item").select("lang", "source", "item", F.lit(0).cast("long").alias("value"))
    pairs = found.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).unionByName(bare)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order)
    best = found.where("part = 'term'").select("lang", "source", "item", "value").withColumn("rank", rank).where(F.col("rank") <= top)
    out = pairs.withColumns({"rank": rank, "part": F.lit("pair")}).unionByName(best.withColumn("part", F.lit("term")))
    return out.select("lang", "source", "part", "item", "value", "rank")


def op11_source_divergence(spark, sf_dir: str) -> DataFrame:
    return divergence(spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang", "source"))


ORACLE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT d, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT d) >= 10
), langs AS (
  SELECT lang, sum(n)::HUGEINT AS n, count(*)::HUGEINT AS v FROM kept GROUP BY lang
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term
), groups AS (
  SELECT g.lang, g.source, coalesce(c.n, 0)::HUGEINT AS n FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN (SELECT lang, source, sum(n) AS n FROM counts GROUP BY ALL) c USING (lang, source)
), shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.n + 2 * l.v) AS p,
    1 + (1000000000::HUGEINT * (k.n + 2)) // (l.n + 2 * l.v) AS q
  FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS value
    FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
  ) s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), items AS (
  SELECT lang, source, 'pair' AS part, item, value::BIGINT AS value FROM pairs
  UNION ALL SELECT lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::BIGINT FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM items
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
