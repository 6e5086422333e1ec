"""Heading-aware chunks of Markdown documents.

Sections and their blocks are DataFrame expressions for analysis; packing and merging are folds over a document's
blocks in order, so they run as one Arrow function on whole documents, without a shuffle.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docmill.functions.text import FENCE, estimated_tokens, strip

HEADING = r"^(#{1,6})\s+(.*)$"
INTRODUCTION = "Introduction"
CODE, TABLE, TEXT, MIXED = "code", "table", "text", "mixed"


@dataclass(frozen=True)
class ChunkConfig:
    """chunk_size matters only where it is above max_tokens: below, a block that fits max_tokens is kept.

    With split_oversized, text of more than max_tokens is cut (see split_text), overlaps and merges respect max_tokens, and
    so only code and tables, which stay whole, can be oversized.
    """

    chunk_size: int = 600
    overlap: int = 125
    min_tokens: int = 150
    max_tokens: int = 800
    document_version: str = "v1"
    chunk_version: str = "v1"
    split_oversized: bool = False


# ---- expressions


def sections(docs: DataFrame, doc: str = "doc", text: str = "markdown_content") -> DataFrame:
    """(doc, section, level, title, char_start, content), blank sections dropped. Fences are not respected."""
    lines = docs.select(F.col(doc).alias("doc"), F.posexplode(F.split(F.col(text), "\n")).alias("pos", "line"))
    by = Window.partitionBy("doc").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    head = F.col("line").rlike("(?U)" + HEADING)
    lines = lines.withColumns({"head": head, "section": F.sum(head.cast("int")).over(by), "at": F.sum(F.length("line") + 1).over(by) - F.length("line") - 1})
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), "\n")
    first = F.max(F.when(F.col("head"), F.col("line")))
    out = lines.groupBy("doc", "section").agg(first.alias("_head"), F.min("at").cast("long").alias("char_start"), joined.alias("content"))
    level = F.coalesce(F.length(F.regexp_extract("_head", "(?U)" + HEADING, 1)), F.lit(0))
    name = F.coalesce(strip(F.regexp_extract("_head", "(?U)" + HEADING, 2)), F.lit(INTRODUCTION))
    return out.select("doc", "section", level.cast("int").alias("level"), name.alias("title"), "char_start", "content").where(strip(F.col("content")) != "")


def heading_paths(docs: DataFrame, doc: str = "doc", text: str = "markdown_content") -> DataFrame:
    """(doc, section, heading_path): the headings that are open at each heading.

    Of each level, a running window has the last heading so far; it is open if none of a lower level has come since.
    """
    lines = docs.select(F.col(doc).alias("doc"), F.posexplode(F.split(F.col(text), "\n")).alias("pos", "line")).where(F.col("line").rlike("(?U)" + HEADING))
    heads = lines.select("doc", "pos", F.length(F.regexp_extract("line", "(?U)" + HEADING, 1)).alias("level"), strip(F.regexp_extract("line", "(?U)" + HEADING, 2)).alias("title"))
    by = Window.partitionBy("doc").orderBy("pos")
    past = by.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = {f"_l{k}": F.last(F.when(F.col("level") == k, F.struct("pos", "title")), ignorenulls=True).over(past) for k in range(1, 7)}
    heads = heads.withColumns({"section": F.row_number().over(by), **last})
    since = lambda k: F.coalesce(F.greatest(F.lit(-1), F.lit(-1), *[F.col(f"_l{i}.pos") for i in range(1, k)]), F.lit(-1))
    path = F.array_compact(F.array(*[F.when(F.col(f"_l{k}.pos") > since(k), F.col(f"_l{k}.title")) for k in range(1, 7)]))
    return heads.select("doc", "section", path.alias("heading_path"))


def section_blocks(parts: DataFrame) -> DataFrame:
    """(doc, section, block, block_type, text, token_count, char_start): a section cut at blank lines; char_start is approximate."""
    blocks = parts.select("doc", "section", F.col("char_start").alias("_base"), F.posexplode(F.split(strip(F.col("content")), "\n\n+")).alias("block", "text"))
    blocks = blocks.withColumn("text", strip(F.col("text"))).where("text <> ''")
    kind = F.when(F.col("text").startswith(FENCE) & F.col("text").endswith(FENCE), CODE).when(F.col("text").startswith("|") | F.contains("text", F.lit("\n|")), TABLE).otherwise(TEXT)
    before = Window.partitionBy("doc", "section").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_base") + F.coalesce(F.sum(F.length("text") + 2).over(before), F.lit(0))
    return blocks.select("doc", "section", "block", kind.alias("block_type"), "text", estimated_tokens(F.col("text")).alias("token_count"), start.cast("long").alias("char_start"))


# ---- folds


@dataclass
class Block:
    text: str
    kind: str
    tokens: int
    start: int


@dataclass
class Section:
    title: str
    level: int
    path: list[str]
    blocks: list[Block]


@dataclass
class Chunk:
    """Blocks of one section, later perhaps of several."""

    number: int
    section: Section
    blocks: list[Block]
    text: str = ""
    tokens: int = 0
    path: list[str] = field(default_factory=list)
    title: str = ""
    kind: str = TEXT
    code: bool = False
    table: bool = False
    languages: list[str] | None = None
    heading: str | None = None
    end: int = 0
    oversized: bool = False
    merged: bool = False

    def __post_init__(self) -> None:
        self.text = "\n\n".join(b.text for b in self.blocks)
        self.tokens = sum(b.tokens for b in self.blocks)
        kinds = {b.kind for b in self.blocks}
        self.kind = kinds.pop() if len(kinds) == 1 else MIXED
        self.code, self.table = any(b.kind == CODE for b in self.blocks), any(b.kind == TABLE for b in self.blocks)
        self.languages = list(dict.fromkeys(m[1] for b in self.blocks if b.kind == CODE and (m := re.search(r"```(\w+)", b.text)))) or None
        self.heading = m[1] if (m := re.match(r"#+\s+(.+)", self.text)) else None
        self.path, self.title = list(self.section.path), self.section.title
        self.end = self.blocks[-1].start + len(self.blocks[-1].text)

    @property
    def start(self) -> int:
        return self.blocks[0].start


_estimate = re.compile(r"\w+|[^\s\w]")


def estimate(text: str) -> int:
    """The estimator of functions.text, in Python."""
    return len(_estimate.findall(text))


def parse(text: str, count: Callable[[str], int]) -> list[Section]:
    """The sections of a document with their blocks."""
    heads: list[tuple[int, str]] = []
    found: list[tuple[int, str, list[str], int, list[str]]] = [(0, INTRODUCTION, [], 0, [])]
    at = 0
    for line in text.split("\n"):
        if m := re.match(HEADING, line):
            level, title = len(m[1]), m[2].strip()
            heads = [h for h in heads if h[0] < level] + [(level, title)]
            found.append((level, title, [t for _, t in heads], at, []))
        found[-1][4].append(line)
        at += len(line) + 1
    out = []
    for level, title, path, base, lines in found:
        body = "\n".join(lines)
        if not body.strip():
            continue
        blocks = []
        for piece in filter(None, map(str.strip, re.split(r"\n\n+", body.strip()))):
            kind = CODE if piece.startswith(FENCE) and piece.endswith(FENCE) else TABLE if piece.startswith("|") or "\n|" in piece else TEXT
            blocks.append(Block(piece, kind, count(piece), base))
            base += len(piece) + 2
        out.append(Section(title, level, path, blocks))
    return out


_ATOM = re.compile(r"\s*\S.*?(?:\n\s*|(?<=[.!?\u3002])\s+|\Z)", re.S)
#: What a cut costs behind a line, a sentence, and inside a sentence. Fewer pieces come first, whatever they cost.
LINE, SENTENCE, WORDS = 0, 1, 4


def _words(text: str, most: int, count: Callable[[str], int]) -> list[str]:
    """A sentence of too many tokens in runs of words, as many as fit in each; a word of too many is halved."""
    out: list[str] = []
    used = 0
    for word in re.findall(r"\s*\S+\s*", text):
        n = count(word)
        if n > most and len(word) > 1:
            out += [*_words(word[: len(word) // 2], most, count), *_words(word[len(word) // 2 :], most, count)]
            used = most
        elif out and used + n <= most:
            out[-1] += word
            used += n
        else:
            out.append(word)
            used = n
    return out


def split_text(text: str, most: int, count: Callable[[str], int], room: int | None = None) -> list[str]:
    """text in pieces of at most `most` tokens, by cuts of least cost: the fewest pieces, then cuts behind lines, sentences and words.

    Sentences that are too long are cut into runs of words first. Of equal costs the pieces of most equal size win. A
    single character of more tokens stays. Where counts do not add up, a piece that comes out too long is cut again with
    less room for the sum of its parts.
    """
    if count(text) <= most or len(text) < 2 or text.isspace():
        return [text]
    room = most if room is None else room
    if room < 1:
        return [q for half in (text[: len(text) // 2], text[len(text) // 2 :]) for q in split_text(half, most, count)]
    atoms: list[tuple[str, int, int]] = []  # text, tokens, cost of a cut behind it
    for m in _ATOM.finditer(text):
        runs = _words(m[0], room, count) if count(m[0]) > room else [m[0]]
        end = LINE if re.search(r"\n\s*\Z", m[0]) else SENTENCE
        atoms += [(r, count(r), WORDS) for r in runs[:-1]] + [(runs[-1], count(runs[-1]), end)]
    best: list[tuple[tuple[int, int, int], int]] = [((0, 0, 0), 0)]  # cost of the first k atoms, and where the last piece begins
    for k in range(1, len(atoms) + 1):
        size, found = 0, None
        for at in range(k - 1, -1, -1):
            size += atoms[at][1]
            if size > room and at < k - 1:
                break
            pieces, cuts, uneven = best[at][0]
            cost = (pieces + 1, cuts + (atoms[at - 1][2] if at else 0), uneven + size * size)
            if found is None or cost < found[0]:
                found = cost, at
        best.append(found)
    ends = [len(atoms)]
    while ends[-1]:
        ends.append(best[ends[-1]][1])
    ends.reverse()
    out = ["".join(a[0] for a in atoms[x:y]) for x, y in zip(ends[:-1], ends[1:], strict=True)]
    return [q for p in out for q in split_text(p, most, count, min(room - 1, room * most // max(count(p), 1)))]


def cut_blocks(found: list[Section], config: ChunkConfig, count: Callable[[str], int]) -> list[Section]:
    """The sections with their oversized text blocks in pieces."""
    for section in found:
        blocks: list[Block] = []
        for b in section.blocks:
            at = b.start
            for piece in split_text(b.text, config.max_tokens, count) if b.kind == TEXT else [b.text]:
                if piece.strip():
                    blocks.append(replace(b, text=piece.strip(), tokens=count(piece.strip()), start=at))
                at += len(piece)
        section.blocks = blocks
    return found


def tail(blocks: list[Block], limit: int) -> list[Block]:
    """The last text blocks that together stay within the limit."""
    out: list[Block] = []
    for b in reversed(blocks):
        if b.kind != TEXT or sum(x.tokens for x in out) + b.tokens > limit:
            break
        out.insert(0, b)
    return out


def pack(found: list[Section], config: ChunkConfig) -> list[Chunk]:
    """Chunks of whole blocks within a section; what overflows the maximum starts a new one, text with an overlap."""
    out: list[Chunk] = []
    for section in found:
        held: list[Block] = []
        used = 0

        def flush(rest: list[Block], section: Section = section) -> None:
            nonlocal held, used
            out.append(Chunk(len(out), section, held))
            held, used = rest, sum(x.tokens for x in rest)

        for b in section.blocks:
            over = held and used + b.tokens > config.max_tokens
            if over and b.kind in (CODE, TABLE):
                flush([])
            elif over and (config.split_oversized or used + b.tokens > config.chunk_size):
                flush(tail(held, min(config.overlap, config.max_tokens - b.tokens) if config.split_oversized else config.overlap))
            held.append(b)
            used += b.tokens
        if held:
            flush([])
    for c in out:
        c.oversized = c.tokens > config.max_tokens
    return out


def _related(a: list[str], b: list[str]) -> bool:
    return not a or not b or a == b or (len(b) > len(a) and b[: len(a)] == a) or (len(a) == len(b) and a[:-1] == b[:-1])


def _bare(a: Chunk) -> bool:
    """A heading with next to nothing below it."""
    return a.heading is not None and sum(bool(x.strip()) for x in a.text.split("\n")) <= 2 and a.tokens < 40


def _absorbs(a: Chunk, b: Chunk, config: ChunkConfig) -> bool:
    clash = a.kind == b.kind and a.kind in (CODE, TABLE)
    small = (a.tokens < 40 or a.tokens < config.min_tokens or b.tokens < config.min_tokens) and a.tokens + b.tokens <= config.max_tokens
    bare = _bare(a) and (not config.split_oversized or a.tokens + b.tokens <= config.max_tokens)
    return not clash and _related(a.path, b.path) and (bare or small)


def merge(chunks: list[Chunk], config: ChunkConfig) -> list[Chunk]:
    """A left fold that lets a chunk take in small or heading-only neighbours. Numbers, languages and `oversized` stay as they were."""

    def step(out: list[Chunk], b: Chunk) -> list[Chunk]:
        if not out or not _absorbs(out[-1], b, config):
            out.append(b)
            return out
        a = out[-1]
        if _bare(a) and len(b.path) > len(a.path):
            a.path, a.title = list(b.path), b.title
        a.kind = a.kind if a.kind == b.kind else MIXED
        a.text, a.tokens, a.end, a.merged = f"{a.text}\n\n{b.text}", a.tokens + b.tokens, b.end, True
        a.code, a.table = a.code or b.code, a.table or b.table
        return out

    return reduce(step, chunks, [])


CHUNK_SCHEMA = (
    "chunk_id string, source_url string, source_document string, title string, heading_path array<string>, section_title string, chunk_index int, total_chunks int, "
    "chunk_text string, token_count int, char_start long, char_end long, starts_with_heading boolean, heading string, contains_code boolean, code_languages array<string>, "
    "contains_table boolean, content_type string, document_version string, chunk_version string, table_chunk boolean, oversized_chunk boolean, tiny_chunk_merged boolean"
)
_ARROW = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string())}


def chunk_rows(doc: str, url: str, title: str, text: str, config: ChunkConfig, count: Callable[[str], int]) -> list[dict]:
    """The chunks of one document, as rows of CHUNK_SCHEMA."""
    found = parse(text, count)
    chunks = merge(pack(cut_blocks(found, config, count) if config.split_oversized else found, config), config)
    return [{
        "chunk_id": f"{doc}_chunk_{c.number:03d}", "source_url": url, "source_document": doc, "title": title, "heading_path": c.path, "section_title": c.title,
        "chunk_index": index, "total_chunks": len(chunks), "chunk_text": c.text, "token_count": c.tokens, "char_start": c.start, "char_end": c.end, "starts_with_heading": c.heading is not None,
        "heading": c.heading, "contains_code": c.code, "code_languages": c.languages, "contains_table": c.table, "content_type": c.kind, "document_version": config.document_version,
        "chunk_version": config.chunk_version, "table_chunk": c.kind == TABLE, "oversized_chunk": c.oversized, "tiny_chunk_merged": c.merged,
    } for index, c in enumerate(chunks)]


def register_chunks(spark: SparkSession, name: str = "chunks_of", config: ChunkConfig | None = None, count: Callable[[str], int] = estimate) -> None:
    """A table function for SQL: SELECT c.* FROM docs d, LATERAL chunks_of(d.url, d.title, d.text) c gives what chunk_documents gives."""
    settings, fields = config or ChunkConfig(), [f.split(" ")[0] for f in CHUNK_SCHEMA.split(", ")]

    class Chunks:
        def eval(self, url: str | None, title: str | None, text: str | None):
            if title is not None and (text or "").strip():
                own = "unknown" if url is None else url
                for row in chunk_rows(hashlib.md5(own.encode()).hexdigest(), own, title, text, settings, count):
                    yield tuple(row[f] for f in fields)

    spark.udtf.register(name, F.udtf(Chunks, returnType=CHUNK_SCHEMA))


def chunk_documents(docs: DataFrame, config: ChunkConfig | None = None, count: Callable[[str], int] = estimate, url: str = "url", title: str = "title", text: str = "markdown_content") -> DataFrame:
    """The chunks of every document that has a title and text. source_document is the md5 of the URL."""
    config = config or ChunkConfig()
    fields = [f.split(" ") for f in CHUNK_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                rows: list[dict] = []
                for r in batch.slice(k, 64).to_pylist():
                    rows += chunk_rows(r["doc"], r["url"], r["title"], r["text"], config, count)
                yield pa.RecordBatch.from_pylist(rows, pa.schema([(n, _ARROW[t]) for n, t in fields]))

    rows = docs.select(F.coalesce(F.col(url), F.lit("unknown")).alias("url"), F.col(title).alias("title"), F.col(text).alias("text")).where(F.col("title").isNotNull() & (strip(F.col("text")) != ""))
    return rows.select(F.md5(F.col("url").cast("binary")).alias("doc"), "url", "title", "text").mapInArrow(run, CHUNK_SCHEMA)


def chunk_stats(chunks: DataFrame) -> DataFrame:
    """Documents, chunks, oversized and merged ones, and chunks by content type, in one row."""
    kinds = [F.count_if(F.col("content_type") == k).alias(f"n_{k}") for k in (TEXT, CODE, TABLE, MIXED)]
    return chunks.agg(F.countDistinct("source_document").alias("documents"), F.count(F.lit(1)).alias("chunks"), F.count_if("oversized_chunk").alias("oversized"), F.count_if("tiny_chunk_merged").alias("merged"), *kinds)


def chunk_report(chunks: DataFrame, config: ChunkConfig | None = None) -> DataFrame:
    config = config or ChunkConfig()
    t = F.col("token_count")
    within = F.count_if(t.between(config.min_tokens, config.max_tokens))
    return chunks.agg(
        F.countDistinct("source_document").alias("total_documents"), F.count(F.lit(1)).alias("total_chunks"), F.sum(t).alias("total_tokens"), F.avg(t).alias("avg_tokens"), F.min(t).alias("min_tokens"), F.max(t).alias("max_tokens"), within.alias("in_range")
    )


def with_config(config: ChunkConfig, **changes) -> ChunkConfig:
    return replace(config, **changes)
