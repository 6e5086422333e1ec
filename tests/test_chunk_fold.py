"""Chunks against the rules written anew over the rows of sections(), heading_paths() and section_blocks(), which SQL confirms."""

import random

import pytest

from docmill.operators import chunks as K
from docmill.plans.queries import markdown

SMALL = K.ChunkConfig(chunk_size=30, overlap=8, min_tokens=10, max_tokens=40)
RAISED = K.ChunkConfig(chunk_size=60, overlap=8, min_tokens=10, max_tokens=40)
FENCE = "```"


def carried(rows, limit):
    """The longest run of text rows at the end within the limit; sizes are not negative, so the longest one is found from the front."""
    for k in range(len(rows) + 1):
        run = rows[k:]
        if all(r.block_type == "text" for r in run) and sum(r.token_count for r in run) <= limit:
            return run


def cut(rows, c):
    """The rows of a section in groups."""
    if not rows:
        return []
    for k in range(1, len(rows)):
        size, one = sum(r.token_count for r in rows[:k]), rows[k]
        if size + one.token_count > c.max_tokens:
            if one.block_type != "text":
                return [rows[:k], *cut(rows[k:], c)]
            if size + one.token_count > c.chunk_size:
                return [rows[:k], *after(carried(rows[:k], c.overlap), rows[k:], c)]
    return [rows]


def after(before, rows, c):
    """Groups of rows behind an overlap. The first row joins the overlap whatever its size; the next ones are weighed with both."""
    for k in range(1, len(rows)):
        held, one = [*before, *rows[:k]], rows[k]
        size = sum(r.token_count for r in held) + one.token_count
        if size > c.max_tokens and one.block_type != "text":
            return [held, *cut(rows[k:], c)]
        if size > c.max_tokens and size > c.chunk_size:
            return [held, *after(carried(held, c.overlap), rows[k:], c)]
    return [[*before, *rows]]


def build(number, group, path, title, c):
    text = "\n\n".join(r.text for r in group)
    kinds = {r.block_type for r in group}
    rest = text.lstrip("#")  # blanks behind the marks go, line breaks among them; blanks behind the heading stay
    named = rest.lstrip().split("\n")[0] if rest != text and rest[:1].isspace() else ""
    languages = []
    for r in group:
        word = ""
        if r.block_type == "code" and FENCE in r.text:
            for x in r.text.split(FENCE, 1)[1]:
                if not (x.isalnum() or x == "_"):
                    break
                word += x
        if word and word not in languages:
            languages.append(word)
    tokens = sum(r.token_count for r in group)
    return {
        "number": number, "heading_path": path, "section_title": title, "chunk_text": text, "token_count": tokens, "char_start": group[0].char_start,
        "char_end": group[-1].char_start + len(group[-1].text), "heading": named or None, "contains_code": "code" in kinds, "contains_table": "table" in kinds,
        "code_languages": languages or None, "content_type": min(kinds) if len(kinds) == 1 else "mixed", "oversized_chunk": tokens > c.max_tokens, "tiny_chunk_merged": False,
    }


def joined(a, b, c):
    """a with b taken in, or None if the two stay apart."""
    x, y = a["heading_path"], b["heading_path"]
    near = not x or not y or x == y or (len(y) > len(x) and y[: len(x)] == x) or (len(x) == len(y) and x[:-1] == y[:-1])
    clash = any(a["content_type"] == b["content_type"] == k for k in ("code", "table"))
    lines = [line for line in a["chunk_text"].split("\n") if line.strip()]
    bare = a["heading"] is not None and len(lines) <= 2 and a["token_count"] < 40
    total = a["token_count"] + b["token_count"]
    tiny = a["token_count"] < max(40, c.min_tokens) or b["token_count"] < c.min_tokens
    if clash or not near or not (bare or (tiny and total <= c.max_tokens)):
        return None
    deeper = bare and len(y) > len(x)
    return a | {
        "chunk_text": a["chunk_text"] + "\n\n" + b["chunk_text"], "token_count": total, "char_end": b["char_end"], "tiny_chunk_merged": True,
        "contains_code": a["contains_code"] or b["contains_code"], "contains_table": a["contains_table"] or b["contains_table"],
        "content_type": a["content_type"] if a["content_type"] == b["content_type"] else "mixed",
        "heading_path": y if deeper else x, "section_title": b["section_title"] if deeper else a["section_title"],
    }


def merged(found, c):
    if len(found) < 2:
        return found
    both = joined(found[0], found[1], c)
    return merged([both, *found[2:]], c) if both else [found[0], *merged(found[1:], c)]


def expected(docs, c):
    """Rows by document."""
    parts = K.sections(docs, doc="url")
    titles = {(r.doc, r.section): r.title for r in parts.select("doc", "section", "title").collect()}
    paths = {(r.doc, r.section): r.heading_path for r in K.heading_paths(docs, doc="url").collect()}
    held = {}
    for r in sorted(K.section_blocks(parts).collect(), key=lambda r: (r.doc, r.section, r.block)):
        held.setdefault(r.doc, {}).setdefault(r.section, []).append(r)
    out = {}
    for doc, own in held.items():
        groups = [(s, g) for s, rows in own.items() for g in cut(rows, c)]
        found = [build(k, g, paths.get((doc, s), []), titles[doc, s], c) for k, (s, g) in enumerate(groups)]
        out[doc] = merged(found, c)
    return out


def compare(docs, c):
    want, got = expected(docs, c), {}
    for r in K.chunk_documents(docs, c).orderBy("source_url", "chunk_index").collect():
        got.setdefault(r.source_url, []).append(r)
    assert got.keys() == want.keys()
    for doc, rows in want.items():
        assert [r.chunk_index for r in got[doc]] == list(range(len(rows))) and {r.total_chunks for r in got[doc]} == {len(rows)}
        for r, w in zip(got[doc], rows, strict=True):
            assert r.chunk_id == f"{r.source_document}_chunk_{w['number']:03d}"
            assert {k: r[k] for k in w if k != "number"} == {k: v for k, v in w.items() if k != "number"}, doc
            assert (r.starts_with_heading, r.table_chunk) == (w["heading"] is not None, w["content_type"] == "table")
    return [w for rows in want.values() for w in rows]


def made(r):
    """A document of headings, sentences, code, tables and blank lines."""
    out = []
    for _ in range(r.randint(1, 25)):
        kind = r.random()
        words = " ".join(r.choice(["tea", "x,y", "is", "Größe", "und.", "#no"]) for _ in range(r.randint(1, 30)))
        if kind < 0.25:
            out.append("#" * r.randint(1, 5) + " " + words[:12])
        elif kind < 0.4:
            out.append(f"{FENCE}{r.choice(['', 'py', 'sql'])}\n{words}\n{FENCE}")
        elif kind < 0.5:
            out.append(f"| {words} |\n|-|")
        else:
            out.append(words)
    return r.choice(["\n\n", "\n", "\n\n\n"]).join(out)


@pytest.mark.parametrize("config", [SMALL, RAISED, K.ChunkConfig()], ids=["small", "raised", "default"])
def test_made_documents(spark, config):
    r = random.Random(5)
    docs = spark.createDataFrame([(f"u{k}", "t", made(r)) for k in range(150)], "url string, title string, markdown_content string")
    rows = compare(docs, config)
    assert any(w["tiny_chunk_merged"] for w in rows) and any(w["code_languages"] for w in rows)
    if config is SMALL:
        assert any(w["oversized_chunk"] for w in rows) and any(w["content_type"] == "mixed" for w in rows)


def test_the_table_of_documents(spark):
    compare(markdown(spark, "/root/testdata/sf0.001"), K.ChunkConfig())
    compare(markdown(spark, "/root/testdata/sf0.001"), SMALL)
