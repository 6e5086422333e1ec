import random
import re

import pyarrow as pa
import pytest

from docmill.llm import licenses as L

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def pattern(parts):
    """A regular expression over words that each end in a space. parts: a word, ('opt', wordings) or ('any', a, b) or ('one', wordings)."""
    spelt = lambda wording: "".join(f"{w} " for w in wording)
    out = ""
    for p in parts:
        if isinstance(p, str):
            out += f"{p} "
        elif p[0] == "any":
            out += rf"(?:\S+ ){{{p[1]},{p[2]}}}"
        else:
            out += "(?:" + "|".join(spelt(w) for w in p[1]) + ")" + ("?" if p[0] == "opt" else "")
    return out


def markup(parts):
    out = []
    for p in parts:
        if isinstance(p, str):
            out.append(p)
        elif p[0] == "any":
            out.append(f"{{{{{p[1]}-{p[2]}}}}}")
        elif p[0] == "opt":
            out.append("[[" + " | ".join(" ".join(w) for w in p[1]) + "]]")
        else:
            out.append("{{" + "|".join(" ".join(w) for w in p[1]) + "}}")
    return " ".join(out)


def ends(parts, doc):
    """All (start, end) of accepted runs of words."""
    whole = re.compile(pattern(parts))
    return {(a, b) for a in range(len(doc)) for b in range(a + 1, len(doc) + 1) if whole.fullmatch("".join(f"{w} " for w in doc[a:b]))}


def progress(parts, doc):
    mandatory = [k for k, p in enumerate(parts) if isinstance(p, str)]
    text = "".join(f"{w} " for w in doc)
    read = [n for n, k in enumerate(mandatory, 1) if re.search(r"(?:^|(?<= ))" + pattern(parts[: k + 1]), text)]
    return max(read, default=0) / len(mandatory)


def drawn(draw, letters="abc"):
    some = lambda: [draw.choice(letters) for _ in range(draw.randrange(1, 3))]
    parts = [draw.choice(letters)]
    for _ in range(draw.randrange(1, 6)):
        parts.append(draw.choice([draw.choice(letters), draw.choice(letters), ("opt", [some()]), ("opt", [some(), some()]), ("one", [some(), some()]), ("any", *sorted(draw.choices(range(4), k=2)))]))
    return [*parts, draw.choice(letters)]


@pytest.mark.parametrize("seed", range(150))
def test_automaton_equals_regular_expressions(seed):
    draw = random.Random(seed)
    parts = drawn(draw)
    docs = [[draw.choice("abcx") for _ in range(draw.randrange(0, 25))] for _ in range(8)]
    automaton = L.compile_template("t", markup(parts))
    vocabulary = L.Vocabulary(automaton.words | {"q"})
    batch = L.Batch(pa.array([" ".join(d) for d in docs], pa.string()), vocabulary)
    share = L.np.zeros(len(docs))
    end, begin = batch.run(automaton, vocabulary.number, share)
    got = [set() for _ in docs]
    for b, e in zip(begin.tolist(), end.tolist(), strict=True):
        got[batch.text[b]].add((b - batch.first[batch.text[b]], e - batch.first[batch.text[b]]))
    for doc, mine, read in zip(docs, got, share, strict=True):
        every = ends(parts, doc)
        assert mine <= every and {e for _, e in mine} == {e for _, e in every}
        assert read == progress(parts, doc)


def report(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return {r["doc_id"]: r for r in L.license_report(L.scan(df)).collect()}


def concrete(markup):
    """The words of a wording that a template accepts: optional regions left out, replaceable ones filled, with a mark."""
    text = re.sub(r"\[\[.*?\]\]", " ", markup, flags=re.S)
    first = lambda m: "q9" if re.match(r"\d", m[1].split("|")[0]) else m[1].split("|")[0]
    return re.sub(r"\{\{(.*?)\}\}", lambda m: " ".join(f"*{w}" for w in first(m).split()), text, flags=re.S).split()


def accepts(markup, texts):
    automaton = L.compile_template("t", markup)
    vocabulary = L.Vocabulary(automaton.words)
    batch = L.Batch(pa.array(texts, pa.string()), vocabulary)
    share = L.np.zeros(len(texts))
    _, begin = batch.run(automaton, vocabulary.number, share)
    return [k in set(batch.text[begin].tolist()) for k in range(len(texts))], share.tolist()


@pytest.mark.parametrize("markup", [m for _, m in L.TEMPLATES])
def test_template_accepts_its_wording_and_no_changed_word(markup):
    own = concrete(markup)
    plain = [w.strip("*") for w in own]
    at = [k for k, w in enumerate(own) if w[0] != "*"]
    changed = [" ".join([*plain[:k], plain[k] + "x", *plain[k + 1 :]]) for k in at]
    missing = [" ".join([*plain[:k], *plain[k + 1 :]]) for k in at if plain[k] != plain[k - 1] and "*" not in own[k - 1] + own[min(k + 1, len(own) - 1)]]
    got, share = accepts(markup, ["Copyright (c) 2020 X.\n" + ", ".join(plain).upper() + ". The end", *changed, *missing])
    assert got == [True] + [False] * (len(changed) + len(missing))
    assert share[0] == 1 and max(share[1:]) < 1 and share[1 : len(at) + 1] == sorted(share[1 : len(at) + 1]) or len(set(plain)) < len(plain)


def test_optional_and_replaceable_regions(spark):
    got = report(spark, [
        (1, "This work is licensed under the GNU General Public License, version 3."), (2, "Licensed under CC BY-NC 4.0."), (3, "Released under the MIT License."), (4, "Licensed under the Apache License, Version 2.0."),
        (5, "distributed under the terms of the Apache License 2.0"), (6, "licensed under a Creative Commons Attribution NonCommercial 4.0 licence"), (7, "SPDX-License-Identifier: GPL-3.0-or-later"), (8, "mit license mit mit license"),
    ])
    assert [got[k]["labels"] for k in range(1, 9)] == ["gpl,gpl-3.0", "cc-by-nc-4.0", "mit", "apache,apache-2.0", "apache", "cc-by-nc-4.0", "gpl-3.0", "mit"]
    assert [got[k]["base_labels"] for k in range(1, 9)] == ["gpl", "", "mit", "apache", "apache", "", "", "mit"]
    assert (got[8]["n_base"], got[8]["first_word"], got[8]["last_word"], got[8]["n_words"]) == (2, 0, 3, 5)
    assert got[5]["score"] < 1 == got[6]["score"]


def test_edges(spark):
    long = "x" * 300_000
    rows = [(None, None), (1, ""), (2, "..."), (3, "mit"), (4, "license"), (5, f"{long} MIT license {long} " + "mit license " * 20_000), (5, "mit license"), (6, "ÉMIT license mit licenseé")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS `a.b`", "2 AS key", "'x' AS phrases")
    got = sorted(map(tuple, L.license_report(L.scan(df)).collect()), key=lambda r: (r[0] or 0, r[1]))
    assert [r[:7] for r in got] == [
        (None, 0, 0, None, None, "", ""), (1, 0, 0, None, None, "", ""), (2, 0, 0, None, None, "", ""), (3, 1, 0, None, None, "", ""), (4, 1, 0, None, None, "", ""),
        (5, 2, 1, 0, 0, "mit", "mit"), (5, 40_004, 20_001, 1, 40_002, "mit", "mit"), (6, 4, 0, None, None, "", ""),
    ]
    assert L.license_report(L.scan(df.limit(0))).collect() == []


def test_malformed_templates():
    for markup in ("a [[b", "a ]] b", "[[a]]", "{{1-2}} a", "a" * 17):
        with pytest.raises(ValueError):
            L.compile_template("t", markup)


def test_query_against_plain_search(spark):
    got = L.op12_license_scan(spark, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(got) == len(texts)
    for r in got:
        own = words(texts[r["doc_id"]])
        at = [(k, label) for p, label in L.PHRASES for k in range(len(own)) if own[k : k + len(p.split())] == p.split()]
        starts, base = [k for k, _ in at], {label for _, label in at}
        text = "".join(f"{w} " for w in own)
        more = set()
        for found, label in (("licensed under cc by nc 4 0 ", "cc-by-nc-4.0"), ("licensed under the gnu general public license version 3 ", "gpl-3.0"), ("licensed under the apache license version 2 0 ", "apache-2.0"), ("released under the mit license ", "mit")):
            more |= {label} if found in text else set()
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(own), len(at), min(starts, default=None), max(starts, default=None))
        assert r["base_labels"] == ",".join(sorted(base)) and r["labels"] == ",".join(sorted(base | more)) and (r["score"] == 1) == bool(more)
