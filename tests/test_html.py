"""HTML to Markdown against a converter of its own, on the standard library's parser."""

import random
import re
import time
from html import escape
from html.parser import HTMLParser

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from docmill.functions import html as H
from docmill.functions.markdown import markdown

SILENT = {"script", "style", "head", "template"}
BLOCK = {"p", "div", "ul", "ol", "article", "nav", "footer", "header", "section", "table", "blockquote"}


class Writer(HTMLParser):
    """Writes as it reads: what a tag opens or closes is a mark in the text."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.silent, self.links, self.cells = [], 0, [], 0

    def handle_starttag(self, tag, attrs):
        if tag in SILENT:
            self.silent += 1
        elif re.fullmatch("h[1-6]", tag):
            self.out.append("\n" + "#" * int(tag[1]) + " ")
        elif tag == "a":
            self.links.append(dict(attrs).get("href"))
            self.out.append("[" if self.links[-1] is not None else "")
        elif tag == "li":
            self.out.append("\n- ")
        elif tag == "br":
            self.out.append("\n")
        elif tag == "pre":
            self.out.append("\n```\n")
        elif tag == "tr":
            self.cells = 0
        elif tag in ("td", "th"):
            self.out.append(" | " if self.cells else "\n| ")
            self.cells += 1
        elif tag in BLOCK:
            self.out.append("\n\n")

    def handle_endtag(self, tag):
        if tag in SILENT:
            self.silent -= 1
        elif re.fullmatch("h[1-6]", tag):
            self.out.append("\n")
        elif tag == "a" and self.links:
            href = self.links.pop()
            self.out.append(f"]({href})" if href is not None else "")
        elif tag == "pre":
            self.out.append("\n```\n")
        elif tag == "tr":
            self.out.append(" |\n")
        elif tag in BLOCK:
            self.out.append("\n\n")

    def handle_data(self, data):
        if not self.silent:
            self.out.append(data)


def written(page):
    w = Writer()
    w.feed(page)
    w.close()
    lines = [line.rstrip(" \t") for line in "".join(w.out).split("\n")]
    return re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip()


def test_pages_as_the_parser_reads_them(spark):
    pages = pq.read_table("/root/testdata/sf0.001/pages.parquet", columns=["page_id", "html"]).to_pylist()
    frame = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r.md for r in frame.select("page_id", H.to_markdown(F.col("html")).alias("md")).collect()}
    for p in pages:
        assert got[p["page_id"]] == written(p["html"] or "")


def test_a_page_by_hand(spark):
    page = """<html lang="en"><head><title>t</title></head><body><h2 class="x">Head &amp; <b>tail</b></h2><!-- <p>no</p> --><p>See <a class="l" href='/x?a=1'>the page</a>.<br>Next</p>
<ul><li>one</li><li>two</li></ul><pre>x = 1
y</pre><table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>2</td></tr></table><script>var p = "<p>";</script></body></html>"""
    md = spark.createDataFrame([(page,)], "h string").select(H.to_markdown(F.col("h"))).head()[0]
    assert md == "## Head & **tail**\n\nSee [the page](/x?a=1).\nNext\n\n- one\n- two\n\n```\nx = 1\ny\n```\n\n| a | b |\n|---|---|\n| 1 | 2 |"


class Tree:
    """A random page: the HTML and the Markdown of a tree are written side by side, each from the tree alone."""

    def __init__(self, seed):
        self.r = random.Random(seed)

    def word(self):
        return "".join(self.r.choices("abcdé&<>\"'", k=self.r.randint(1, 6)))

    def words(self):
        text = " ".join(self.word() for _ in range(self.r.randint(1, 4)))
        return escape(text, quote=self.r.random() < 0.5).replace(" ", self.r.choice((" ", "  ", "\t"))), text

    def tag(self, name, inner, attributes=""):
        name = name if self.r.random() < 0.7 else name.upper()
        return f"<{name}{attributes}>{inner}</{name}>"

    def run(self, deep=0):
        """Words and marks around words, apart by blanks."""
        parts = []
        for _ in range(self.r.randint(1, 3)):
            kind = self.r.randrange(7) if deep < 3 else 0
            if kind < 3:
                parts.append(self.words())
            elif kind == 3:
                html, md = self.run(deep + 1)
                name, mark = self.r.choice((("b", "**"), ("strong", "**"), ("i", "*"), ("em", "*"), ("code", "`"), ("del", "~~")))
                parts.append((self.tag(name, html, ' class="x"'), mark + md + mark))
            elif kind == 4:
                html, md = self.run(deep + 1)
                parts.append((self.tag("a", html, ' class="l" href="/p?a=1&amp;b=2"'), f"[{md}](/p?a=1&b=2)"))
            elif kind == 5:
                parts.append(('<img alt="a &quot;b&quot;" src=/x.png>', '![a "b"](/x.png)'))
            else:
                html, md = self.words()
                parts.append((f"<span>{html}<!-- <b>no</b> --></span><script>var x = '<p>';</script>", md))
        return " ".join(h for h, _ in parts), " ".join(m for _, m in parts)

    def items(self, indent, deep):
        kind = self.r.choice(("ul", "ol"))
        first = self.r.choice((1, 1, 7))
        html, lines = "", []
        for k in range(self.r.randint(1, 3)):
            h, m = self.run()
            lines.append(indent + (f"{first + k}. " if kind == "ol" else "- ") + m)
            if deep < 3 and self.r.random() < 0.4:
                more, below = self.items(indent + ("   " if kind == "ol" else "  "), deep + 1)
                h += more
                lines += below
            html += f"<li>{h}</li>" if self.r.random() < 0.5 else f"\n<li>{h}"
        return self.tag(kind, html, f' start="{first}"'), lines

    def block(self, deep=0):
        kind = self.r.randrange(6 if deep < 3 else 5)
        if kind == 0:
            h, m = self.run()
            return self.tag(self.r.choice(("p", "div", "section")), h), m
        if kind == 1:
            k, (h, m) = self.r.randint(1, 6), self.run()
            return self.tag(f"h{k}", h) + "<p>t</p>", "#" * k + " " + m + "\n\n" + "t"
        if kind == 2:
            h, lines = self.items("", 0)
            return h, "\n".join(lines)
        if kind == 3:
            code = "\n".join("  " * self.r.randrange(3) + self.word() for _ in range(3)) + "\n\n\nend"
            return f"<p>c</p><pre class='k'><code>{escape(code)}</code></pre><p>d</p>", f"c\n\n```\n{code}\n```\n\nd"
        if kind == 4:
            n = self.r.randint(1, 3)
            table = [[self.run() for _ in range(n)] for _ in range(3)]
            html = "".join("<tr>" + "".join(self.tag("td" if k else "th", h) for h, _ in row) + "</tr>" for k, row in enumerate(table))
            lines = ["| " + " | ".join(m for _, m in row) + " |" for row in table]
            return self.tag("table", html), "\n".join([lines[0], "|" + "---|" * n, *lines[1:]])
        h, m = self.page(deep + 1)
        return self.tag("blockquote", h), "\n".join(("> " + x).rstrip() if not m.count("```") else "> " + x if x or self.fenced(m, k) else ">" for k, x in enumerate(m.split("\n")))

    def fenced(self, text, k):
        return sum(x.lstrip("> ").startswith("```") for x in text.split("\n")[:k]) % 2 == 1

    def page(self, deep=0):
        blocks = [self.block(deep) for _ in range(self.r.randint(1, 4))]
        return "\n".join(h for h, _ in blocks), "\n\n".join(m for _, m in blocks)


def test_random_trees():
    for seed in range(600):
        html, md = Tree(seed).page()
        assert markdown(f"<html><head><title>t</title></head><body>{html}</body></html>") == md, (seed, html)


def test_marks_without_partners():
    assert markdown("<p><b>one<br>two<p>three</b> <i>four</i></i></p></ul>") == "one\ntwo\n\nthree *four*"
    assert markdown("a <b> b </b>c<code></code> <em> </em>d") == "a **b** c d"
    assert markdown("&copy &amp; &#233;&#x20AC;&nbsp;&unknown; 1 < 2 <3> <unfinished") == "&copy & é€ &unknown; 1 < 2 <3> <unfinished"
    assert markdown("x<script>kept as text") == "xkept as text" and markdown("a<!-- b <p>c") == "a b\n\nc"
    assert markdown("") == markdown(" \n ") == ""
    assert markdown("a\0b<pre>x\0\ny</pre>") == "a�b\n```\nx�\ny\n```"


def test_hostile_pages_take_seconds():
    pages = ("<b>" * 10**5 + "</b>" * 10**5, "<i>" * 10**5 + "<ul></b>" * 10**5, "<" * 10**6, "<!--" * 10**5, "<script>" * 10**5, "<a b " * 10**5, " " * 10**6, "<blockquote>x" * 10**5, "<ul><li>x" * 10**5)
    for page in pages:
        began = time.time()
        markdown(page)
        assert time.time() - began < 10, page[:20]


def test_null_pages(spark):
    frame = spark.createDataFrame([(None,), ("<p>x",)], "h string").select(H.to_markdown(F.col("h")).alias("m"))
    assert sorted((r.m for r in frame.collect()), key=str) == [None, "x"]
