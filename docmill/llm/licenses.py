"""License scans by template markup, compiled to token automata.

A template is the wording of a licence or of a notice. In its markup, [[...]] is an optional region (regions nest),
{{1-12}} a replaceable region of so many words, {{a b|c}} a replaceable region with one of the given wordings, and every
other word is mandatory. compile_template() makes an automaton of it: states in the order of the wording, edges that
read a word, edges that read nothing (around optional regions) and edges that read a number of any words. A text is
accepted if its words from some place on lead from the first state to the last, so a single changed mandatory word
rejects.

An automaton runs over all texts of a batch at once: a state holds the places of the text that it is reached at, an edge
moves all of them with one numpy operation. Only places that still agree with the template go on, so a batch costs
about one lookup of its words and a few short arrays for each template, whatever the number of places that start alike.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.llm.tables import small_batches
from docmill.llm.textbatch import LOWER, digits, slices, utf8

#: Less of a template's mandatory wording than this is no evidence.
NEAR = 0.5
#: Bytes of a word of a template, at most.
WORD = 16

# Phrases and labels of the base, wording of licences and of their notices.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

MIT = """permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation
files the software to deal in the software without restriction including without limitation the rights to use copy modify
merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is
furnished to do so subject to the following conditions the above copyright notice and this permission notice
[[including the next paragraph]] shall be included in all copies or substantial portions of the software the software is
provided as is without warranty of any kind express or implied including but not limited to the warranties of
merchantability fitness for a particular purpose and noninfringement in no event shall the {{1-12}} be liable for any claim
damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the
software or the use or other dealings in the software"""
ISC = """permission to use copy modify and [[or]] distribute this software for any purpose with or without fee is hereby granted
provided that the above copyright notice and this permission notice appear in all copies the software is provided as is and
{{1-8}} disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness
in no event shall {{1-8}} be liable for any special direct indirect or consequential damages or any damages whatsoever
resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out
of or in connection with the use or performance of this software"""
_BSD = """redistribution and use in source and binary forms with or without modification are permitted provided that the following
conditions are met [[1]] redistributions of source code must retain the above copyright notice this list of conditions and the
following disclaimer [[2]] redistributions in binary form must reproduce the above copyright notice this list of conditions and
the following disclaimer in the documentation and or other materials provided with the distribution"""
_THIRD = """[[3]] neither the name of {{1-12}} nor the names of its contributors may be used to endorse or promote products derived from
this software without specific prior written permission"""
_AS_IS = """this software is provided by {{1-12}} as is and any express or implied warranties including but not limited to the implied
warranties of merchantability and fitness for a particular purpose are disclaimed"""
ZLIB = """this software is provided as is without any express or implied warranty in no event will the authors be held liable for any
damages arising from the use of this software permission is granted to anyone to use this software for any purpose including
commercial applications and to alter it and redistribute it freely subject to the following restrictions"""
UNLICENSE = """this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile
sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or
non commercial and by any means"""
APACHE = """licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you
may obtain a copy of the license at http[[s]] www apache org licenses license 2 0 [[txt]] unless required by applicable law or
agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions
of any kind either express or implied see the license for the specific language governing permissions and limitations under the
license"""
_GPL = """this {{1-4}} is free software you can redistribute it and or modify it under the terms of the gnu
{KIND}general public license as published by the free software foundation either version {VERSION} of the license or at your option any
later version this {{1-4}} is distributed in the hope that it will be useful but without any warranty without even the implied
warranty of merchantability or fitness for a particular purpose see the gnu {KIND}general public license for more details"""
_UNDER = "{{licensed|released|distributed|available|published}} under [[the terms of]]"
_CC = _UNDER + " [[a|the]] {{cc|creative commons}} {{by|attribution}}"


def _gpl(version: str, kind: str = "") -> str:
    return _GPL.replace("{KIND}", f"{kind} " if kind else "").replace("{VERSION}", version)


TEMPLATES: tuple[tuple[str, str], ...] = (
    ("mit", MIT),
    ("isc", ISC),
    ("bsd-2-clause", f"{_BSD} {_AS_IS}"),
    ("bsd-3-clause", f"{_BSD} {_THIRD} {_AS_IS}"),
    ("zlib", ZLIB),
    ("unlicense", UNLICENSE),
    ("apache-2.0", APACHE.replace("http[[s]]", "{{http|https}}")),
    *((f"gpl-{v}.0", _gpl(v)) for v in "23"),
    ("lgpl-3.0", _gpl("3", "lesser")),
    ("agpl-3.0", _gpl("3", "affero")),
    # notices of one line
    ("mit", f"{_UNDER} the mit license"),
    ("apache-2.0", f"{_UNDER} the apache license version 2 0"),
    *((f"gpl-{v}.0", f"{_UNDER} the gnu general public license [[as published by the free software foundation]] [[either]] version {v}") for v in "23"),
    ("cc-by-4.0", f"{_CC} 4 0"),
    ("cc-by-sa-4.0", f"{_CC} {{{{sa|sharealike}}}} 4 0"),
    ("cc-by-nc-4.0", f"{_CC} {{{{nc|noncommercial}}}} 4 0"),
    *((x, f"spdx license identifier {words}") for x, words in (("mit", "mit"), ("apache-2.0", "apache 2 0"), ("gpl-3.0", "gpl 3 0 {{only|or later}}"), ("bsd-3-clause", "bsd 3 clause"), ("isc", "isc"))),
)


# ---- automata


@dataclass
class Automaton:
    """edges[s]: (kind, argument, target) of state s; kinds are word, any (of a least and greatest number) and empty.

    All edges lead to later states; the last state accepts. passed: mandatory words before each state.
    """

    label: str
    edges: list[list[tuple[str, object, int]]] = field(default_factory=lambda: [[]])
    passed: list[int] = field(default_factory=lambda: [0])

    def state(self, passed: int) -> int:
        self.edges.append([])
        self.passed.append(passed)
        return len(self.edges) - 1

    def word(self, at: int, word: str, mandatory: bool) -> int:
        if len(word.encode()) > WORD:
            raise ValueError(f"a word of a template has at most {WORD} bytes, unlike {word}")
        to = self.state(self.passed[at] + mandatory)
        self.edges[at].append(("word", word, to))
        return to

    def choice(self, ends: list[int], passed: int) -> int:
        to = self.state(passed)
        for e in ends:
            self.edges[e].append(("empty", None, to))
        return to

    @property
    def words(self) -> set[str]:
        return {x for own in self.edges for kind, x, _ in own if kind == "word"}


def compile_template(label: str, markup: str) -> Automaton:
    """The automaton of a template. It begins and ends with a word or an optional region and has a mandatory word."""
    parts = re.findall(r"\[\[|\]\]|\||\{\{.*?\}\}|[^\s\[\]{}|]+", markup.lower(), re.S)
    out = Automaton(label)

    def sequence(at: int, k: int, mandatory: bool) -> tuple[int, int]:
        """Reads parts from the k-th on, up to the end of the region."""
        while k < len(parts) and parts[k] not in ("]]", "|"):
            part = parts[k]
            if part == "[[":
                ends, begin = [at], at
                while parts[k] != "]]":
                    end, k = sequence(begin, k + 1, False)
                    ends.append(end)
                    if k == len(parts):
                        raise ValueError(f"a region of the template of {label} does not end")
                at = out.choice(ends, out.passed[begin])
            elif part[:2] == "{{":
                ends, begin = [], at
                for choice in part[2:-2].split("|"):
                    if number := re.fullmatch(r"\s*(\d+)-(\d+)\s*", choice):
                        end = out.state(out.passed[begin])
                        out.edges[begin].append(("any", (int(number[1]), int(number[2])), end))
                    else:
                        end = begin
                        for word in choice.split():
                            end = out.word(end, word, False)
                    ends.append(end)
                at = out.choice(ends, out.passed[begin])
            else:
                at = out.word(at, part, mandatory)
            k += 1
        return at, k

    _, read = sequence(0, 0, True)
    if read != len(parts) or not out.passed[-1]:
        raise ValueError(f"the template of {label} is not well formed")
    if any(kind == "any" for kind, _, _ in out.edges[0]):
        raise ValueError(f"the template of {label} begins with any words")
    return out


Places = tuple[np.ndarray, np.ndarray]  # where a state is reached, ascending, and where the match began


def _union(some: list[Places]) -> Places:
    """Each place once, with its latest beginning."""
    if len(some) == 1:
        return some[0]
    at, begin = (np.concatenate(x) for x in zip(*some, strict=True))
    order = np.lexsort((-begin, at))
    at, begin = at[order], begin[order]
    new = np.concatenate(([True], at[1:] != at[:-1])) if len(at) else np.zeros(0, bool)
    return at[new], begin[new]


class Batch:
    """The words of a batch as numbers of a vocabulary. Behind each text stands a place that no word has."""

    def __init__(self, column: pa.Array, vocabulary: Vocabulary) -> None:
        raw, offsets = utf8(column)
        raw = LOWER[raw]
        n = len(raw)
        inside = np.zeros(n + 2, bool)
        inside[1 : n + 1] = _WORD[raw]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        start = np.flatnonzero(inside[1 : n + 1] & (~inside[:n] | edge[:n]))
        end = np.flatnonzero(inside[1 : n + 1] & (~inside[2 : n + 2] | edge[1 : n + 1])) + 1
        text = np.searchsorted(offsets, start, "right") - 1
        self.n_words = np.bincount(text, minlength=len(column)).astype(np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.n_words + 1)))  # the place of each text's first word
        self.text = np.repeat(np.arange(len(column)), self.n_words + 1)
        self.ids = np.full(len(start) + len(column), -1, np.int64)
        self.ids[np.arange(len(start)) + text] = vocabulary.numbers(raw, start, end)
        known = np.flatnonzero(self.ids >= 0)
        self._places = known[np.argsort(self.ids[known], kind="stable")]
        self._bounds = np.searchsorted(self.ids[self._places], np.arange(len(vocabulary.words) + 1))

    def places(self, number: int) -> np.ndarray:
        return self._places[self._bounds[number] : self._bounds[number + 1]]

    def later(self, places: Places, least: int, most: int) -> Places:
        """The places that lie `least` to `most` words behind the given ones in the same text, each from the nearest."""
        at, begin = places
        end = self.first[self.text[at] + 1] - 1
        low, high = at + least, np.minimum(at + most, end)
        at, begin, low, high = (x[low <= high] for x in (at, begin, low, high))
        if not len(at):
            return at, begin
        turns = np.zeros(len(self.ids) + 2, np.int64)
        np.add.at(turns, low, 1)
        np.add.at(turns, high + 1, -1)
        reached = np.flatnonzero(np.cumsum(turns) > 0)
        return reached, begin[np.searchsorted(low, reached, "right") - 1]

    def run(self, automaton: Automaton, number: dict[str, int], progress: np.ndarray) -> Places:
        """Where the automaton accepts: ends and beginnings. progress: by text, raised to the share of mandatory words read."""
        waiting: dict[int, list[Places]] = defaultdict(list)
        whole: set[int] = {0}  # states that are reached at every place, without reading a word
        last = len(automaton.edges) - 1
        best = np.zeros(len(self.n_words), np.int64)
        for s, edges in enumerate(automaton.edges):
            if s in whole:
                here = None
            elif s in waiting:
                here = _union(waiting.pop(s))
                best[self.text[here[0]]] = automaton.passed[s]  # states are visited by ascending `passed`
                if s == last:
                    break
            else:
                continue
            for kind, x, to in edges:
                if kind == "empty" and here is None:
                    whole.add(to)
                elif kind == "empty":
                    waiting[to].append(here)
                elif kind == "any":
                    found = self.later(here, *x)
                    if len(found[0]):
                        waiting[to].append(found)
                elif here is None:
                    found = self.places(number[x])
                    if len(found):
                        waiting[to].append((found + 1, found))
                else:
                    on = self.ids[here[0]] == number[x]
                    if on.any():
                        waiting[to].append((here[0][on] + 1, here[1][on]))
        else:
            here = np.zeros(0, np.int64), np.zeros(0, np.int64)
        np.maximum(progress, best / automaton.passed[-1], out=progress)
        return here


_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


class Vocabulary:
    """Numbers of words of at most WORD bytes, compared byte by byte."""

    def __init__(self, words: set[str]) -> None:
        self.words = sorted(words)
        self.number = {w: k for k, w in enumerate(self.words)}
        coded = [w.encode().ljust(WORD, b"\0") for w in self.words]
        low, high = (np.array([int.from_bytes(c[k : k + 8], "big") for c in coded], np.uint64) for k in (0, 8))
        self._low = np.unique(low)
        self._high = np.unique(high)
        pair = np.searchsorted(self._low, low) * len(self._high) + np.searchsorted(self._high, high)
        self._order = np.argsort(pair)
        self._pairs = pair[self._order]

    def numbers(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The number of each word raw[start:end]; -1 for others."""
        out = np.full(len(start), -1, np.int64)
        if not len(start):
            return out
        low = digits(raw, start, end)
        a = np.minimum(np.searchsorted(self._low, low), len(self._low) - 1)
        some = np.flatnonzero((self._low[a] == low) & (end - start <= WORD))
        high = digits(raw, start[some] + 8, end[some])
        b = np.minimum(np.searchsorted(self._high, high), len(self._high) - 1)
        pair = a[some] * len(self._high) + b
        c = np.minimum(np.searchsorted(self._pairs, pair), len(self._pairs) - 1)
        known = (self._high[b] == high) & (self._pairs[c] == pair)
        out[some[known]] = self._order[c[known]]
        return out


# ---- the operator

FOUND = "array<struct<label string, start long, end long>>"


def scan(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, phrases: tuple[tuple[str, str], ...] = PHRASES, key: str = "doc_id") -> DataFrame:
    """(key, n_words, phrases, accepted, progress) of every row of docs.

    phrases and accepted list what stands where in the text, as (label, start, end) in words from 0, end exclusive, by
    start: places of phrases, and of accepted templates. An accepted span is the one of nearest regions for its end.
    progress is the greatest share of a template's mandatory words that were read from one place. A null text is empty
    and has nothing; repeated rows stay as they are, an empty table gives an empty table, further columns are not read,
    texts and words may have any length.
    """
    small_batches(docs.sparkSession)
    kind = dict(docs.dtypes)[key]
    automata = [compile_template(*t) for t in templates]
    wanted = [(tuple(p.split()), label) for p, label in phrases]
    vocabulary = Vocabulary(set().union(*(a.words for a in automata), *(p for p, _ in wanted)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            batch = Batch(rows.column("text"), vocabulary)
            progress = np.zeros(rows.num_rows)
            found = [(label, *_phrase(batch, [vocabulary.number[w] for w in p])) for p, label in wanted]
            accepted = [(a.label, *batch.run(a, vocabulary.number, progress)[::-1]) for a in automata]
            columns = [rows.column("key"), pa.array(batch.n_words), _lists(batch, found), _lists(batch, accepted), pa.array(progress)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "n_words", "phrases", "accepted", "progress"])

    read = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return read.mapInArrow(run, f"key {kind}, n_words long, phrases {FOUND}, accepted {FOUND}, progress double").withColumnRenamed("key", key)


def _phrase(batch: Batch, numbers: list[int]) -> Places:
    at = batch.places(numbers[0])
    for k, number in enumerate(numbers[1:], 1):
        at = at[batch.ids[np.minimum(at + k, len(batch.ids) - 1)] == number]
    return at, at + len(numbers)


def _lists(batch: Batch, found: list[tuple[str, np.ndarray, np.ndarray]]) -> pa.Array:
    """(label, starts, ends) as a list for each text, by start, end and label."""
    names = sorted({f[0] for f in found})
    label = np.concatenate([np.full(len(s), names.index(x)) for x, s, _ in found]).astype(np.int64)
    start, end = (np.concatenate([f[k] for f in found]).astype(np.int64) for k in (1, 2))
    text = batch.text[start]
    rows = np.unique(np.stack((text, start - batch.first[text], end - batch.first[text], label)), axis=1)
    values = pa.StructArray.from_arrays([pa.array(names, pa.string()).take(pa.array(rows[3])), pa.array(rows[1]), pa.array(rows[2])], names=["label", "start", "end"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(rows[0], np.arange(len(batch.n_words) + 1)).astype(np.int32)), values)


def license_report(scanned: DataFrame, key: str = "doc_id") -> DataFrame:
    """A row per scanned one: counts, first and last place of the phrases, labels, and how far the templates were read.

    score is 1 where a template was accepted, else the greatest share of a template's mandatory words that was read, 0
    if that is under NEAR.
    """
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    starts = F.col("phrases.start")
    return scanned.select(
        key, "n_words", F.size("phrases").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(F.col("phrases.label")).alias("base_labels"), joined(F.concat(F.col("phrases.label"), F.col("accepted.label"))).alias("labels"),
        F.when(F.col("progress") >= NEAR, F.col("progress")).otherwise(0.0).alias("score"),
    )


def op12_license_scan(spark, sf_dir: str) -> DataFrame:
    return license_report(scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")))
