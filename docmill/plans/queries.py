"""The registered queries: each applies one operator, or a few, to whole tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.functions import html as H
from docmill.functions import text as X
from docmill.functions import tokenizers as T
from docmill.functions import urls as U
from docmill.operators import blocks as B
from docmill.operators import chunks as K
from docmill.operators import clean as C
from docmill.operators import crawl as W
from docmill.operators import embeddings as V
from docmill.operators import evaluate as E
from docmill.operators import search as S
from docmill.plans.fixtures import EDGES, EVALUATION, markdown, select
from docmill.sources.bm25_index import Bm25Index
from docmill.sources.store import VectorStore, metadata
from docmill.sources.vector_index import VectorIndex
from docmill.streaming.frequencies import BlockFrequencies

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _new_folder(spark: SparkSession, name: str) -> str:
    """A folder that no other call has, where driver and executors see the same files."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="docmill-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _six(*names: str) -> list[Column]:
    return [F.round(n, 6).alias(n) for n in names]


def _md5(c: str) -> Column:
    return F.md5(F.col(c).cast("binary"))


RULES = U.UrlFilter(allowed_domains=("example.com", "example.net"), exclude_patterns=(*U.BINARY_PATTERNS, r".*[.]html$"), min_path_length=5)


# ---- URLs and pages


@query
def url_normalize(spark, sf_dir):
    return _table(spark, sf_dir, "pages").select("page_id", "url", U.normalize(F.col("url")).alias("norm_url"))


@query
def url_filter_reason(spark, sf_dir):
    return U.filter_urls(_table(spark, sf_dir, "pages").select("page_id", "url"), RULES).select("page_id", "norm_url", "filter_reason")


@query
def url_filter_report(spark, sf_dir):
    return U.filter_report(U.filter_urls(_table(spark, sf_dir, "pages").select("url"), RULES))


@query
def file_names(spark, sf_dir):
    url = F.col("url")
    return _table(spark, sf_dir, "pages").select("page_id", U.raw_file_name(url).alias("raw_name"), U.processed_file_name(url).alias("processed_name"))


@query
def html_to_markdown(spark, sf_dir):
    rows = _table(spark, sf_dir, "pages").select("page_id", H.to_markdown(F.col("html")).alias("md"))
    return rows.select("page_id", _md5("md").alias("md_md5"), F.length("md").cast("long").alias("n_chars"))


@query
def html_title_lang(spark, sf_dir):
    rows = _table(spark, sf_dir, "pages").withColumn("md", H.to_markdown(F.col("html")))
    return rows.select("page_id", H.language(F.col("html")).alias("lang"), H.title(F.col("url"), F.col("md")).alias("title"))


@query
def html_links(spark, sf_dir):
    rows = _table(spark, sf_dir, "pages").withColumn("md", H.to_markdown(F.col("html")))
    return rows.select("page_id", F.array_join(H.links(F.col("url"), F.col("md")), " ").alias("links"))


@query
def crawl_pages(spark, sf_dir):
    out = W.crawl_metrics(W.parse_pages(_table(spark, sf_dir, "pages")))
    return out.select("attempted", "crawled", "failed", "total_words", *_six("average_page_words"))


@query
def crawl_bfs(spark, sf_dir):
    edges = select(spark, sf_dir, EDGES, "pages")
    pages = edges.select("url", F.array("a", "b", "c").alias("outgoing_links"))
    seeds = edges.where("n = 0").select("url")
    rules = U.UrlFilter(exclude_patterns=U.BINARY_PATTERNS)
    return W.crawl(pages, seeds, rules, W.CrawlLimits(max_depth=None, max_pages=None, abort_pages=None)).select("url", "depth")


@query
def sitemap_urls(spark, sf_dir):
    url = F.col("url")
    escaped = F.replace(F.replace(url, F.lit("&"), F.when(F.col("page_id") % 3 == 0, "&#38;").otherwise("&amp;")), F.lit("<"), F.lit("&lt;"))
    location = F.when(F.col("page_id") % 3 == 1, F.concat(F.lit("<![CDATA["), url, F.lit("]]>"))).otherwise(escaped)
    parts = [F.lit("<url xmlns:s='x'><!-- <s:loc>http://gone.example.com/</s:loc> --><s:loc> "), location, F.lit("\n</s:loc></url>")]
    maps = _table(spark, sf_dir, "pages").select(F.concat(*parts).alias("xml"))
    return maps.select(F.explode(H.sitemap_urls(F.col("xml"))).alias("url")).distinct()


@query
def identifier_tokens(spark, sf_dir):
    ids = X.identifier(F.col("url"))
    return _table(spark, sf_dir, "pages").select("page_id", F.array_join(ids, " ").alias("ids"), X.contains_run(ids, F.array(F.lit("example"), F.lit("com"))).alias("has_run"))


# ---- blocks and cleaning


def _measured(spark, sf_dir):
    return B.measure_blocks(B.split_blocks(markdown(spark, sf_dir)))


def _kept(df: DataFrame) -> DataFrame:
    """df computed once for several readers: a checkpoint where the session has a folder for it, else Spark's cache."""
    return df.checkpoint() if df.sparkSession.sparkContext._jsc.sc().getCheckpointDir().isDefined() else df.persist(StorageLevel.MEMORY_AND_DISK)


def _scored(spark, sf_dir, *without):
    return C.score_blocks(_kept(_measured(spark, sf_dir).drop(*without)), _table(spark, sf_dir, "documents").count())


def _processed(spark, sf_dir, scored=None):
    return C.process_documents(markdown(spark, sf_dir), _scored(spark, sf_dir) if scored is None else scored)


@query
def block_parse(spark, sf_dir):
    kind = F.when(F.col("is_code"), "code").when(F.col("is_heading"), "heading").when(F.col("is_table"), "table").when(F.col("is_list"), "list").otherwise("text")
    return _measured(spark, sf_dir).select("doc", "block_idx", _md5("content").alias("content_md5"), "content_hash", kind.alias("block_type"))


@query
def block_metrics(spark, sf_dir):
    return _measured(spark, sf_dir).select("doc", "block_idx", "word_count", "link_count", *_six("position_ratio", "unique_word_ratio", "link_density"))


@query
def repeated_blocks(spark, sf_dir):
    return C.repeated_blocks(_measured(spark, sf_dir), markdown(spark, sf_dir).count()).select("content_hash", "n_docs", *_six("percent"))


@query
def repeated_blocks_updated(spark, sf_dir):
    """As repeated_blocks, from changes: older versions of two fifths of the documents come first, the others in two batches."""
    docs = markdown(spark, sf_dir).select("doc", "markdown_content")
    older = docs.where("doc % 5 < 2").withColumn("markdown_content", F.concat(F.lit("An older line\n"), F.replace("markdown_content", F.lit("## See also"), F.lit("## Links"))))
    kept = BlockFrequencies(spark, _new_folder(spark, "frequencies"))
    for n, batch in enumerate((older.unionByName(docs.where("doc % 5 = 2")), docs.where("doc % 5 IN (0, 3)"), docs.where("doc % 5 IN (1, 4)"))):
        kept.take(batch, n)
    return kept.repeated(kept.documents()).select("content_hash", "n_docs", *_six("percent"))


@query
def clean_scores(spark, sf_dir):
    return _scored(spark, sf_dir, "content").select("doc", "block_idx", "is_removed", F.array_join("triggered_signals", ",").alias("signals"), *_six("document_frequency", "boilerplate_score"))


@query
def clean_removed(spark, sf_dir):
    tier = F.regexp_extract("removal_reason", "(Tier .*)$", 1)
    return C.removed_report(_scored(spark, sf_dir)).select("doc", "block_idx", "preview", tier.alias("tier"))


@query
def signal_histogram(spark, sf_dir):
    return C.signal_histogram(_scored(spark, sf_dir, "content"))


@query
def signal_report(spark, sf_dir):
    return C.signal_report(_scored(spark, sf_dir, "content"))


@query
def processing_stats(spark, sf_dir):
    sides = [f"{n}_{s}" for s in ("before", "after") for n in ("words", "h1", "h2", "h3", "h4", "code_blocks", "tables")]
    return _processed(spark, sf_dir).select("doc", _md5("cleaned_markdown").alias("cleaned_md5"), "blocks_removed", "blocks_retained", "page_category", *sides, *_six("retention"))


@query
def page_category(spark, sf_dir):
    return _processed(spark, sf_dir).groupBy("page_category").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("blocks_retained").alias("blocks_retained"))


@query
def corpus_report(spark, sf_dir):
    return C.corpus_report(_processed(spark, sf_dir)).select("total_documents", "words_before", "words_after", "code_diff", "table_diff", "blocks_removed", *_six("overall_retention", "removal_rate"))


@query
def review_sample(spark, sf_dir):
    scored = _scored(spark, sf_dir)
    rows = C.review_set(_processed(spark, sf_dir, scored), scored)
    shown = [F.size(c).cast("long").alias(f"{c}_shown") for c in ("removed", "borderline", "preserved")]
    return rows.select("doc", "page_category", "removed_count", *shown)


# ---- chunks and tokens


@query
def sections(spark, sf_dir):
    return K.sections(markdown(spark, sf_dir)).select("doc", "section", "level", "title", "char_start", _md5("content").alias("content_md5"))


@query
def heading_paths(spark, sf_dir):
    return K.heading_paths(markdown(spark, sf_dir)).select("doc", "section", F.array_join("heading_path", " > ").alias("heading_path"))


@query
def section_blocks(spark, sf_dir):
    return K.section_blocks(K.sections(markdown(spark, sf_dir))).select("doc", "section", "block", "block_type", _md5("text").alias("text_md5"), "token_count", "char_start")


@query
def chunk_pack(spark, sf_dir):
    return K.chunk_documents(markdown(spark, sf_dir))


@query
def chunk_split(spark, sf_dir):
    """Chunks of at most 120 tokens: text that is longer is cut behind lines, sentences or words."""
    config = K.ChunkConfig(chunk_size=100, overlap=20, min_tokens=30, max_tokens=120, split_oversized=True)
    return K.chunk_documents(markdown(spark, sf_dir), config)


@query
def chunk_stats(spark, sf_dir):
    return K.chunk_stats(K.chunk_documents(markdown(spark, sf_dir)))


@query
def chunk_report(spark, sf_dir):
    return K.chunk_report(K.chunk_documents(markdown(spark, sf_dir)))


@query
def token_estimate(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", X.estimated_tokens(F.col("text")).alias("n_tokens"))


@query
def token_round_trip(spark, sf_dir):
    """Whether the tokenizer's ids give each text back, by the vocabulary that the box offers."""
    import public_tokenizers as P

    ids = T.encode(F.col("text"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    back = T.decode(F.col("ids"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    rows = _table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), ids.alias("ids"))
    return rows.select("doc_id", (back == F.col("text")).alias("exact"), (F.size("ids") > 0).alias("has_ids"))


@query
def token_budget(spark, sf_dir):
    n = X.estimated_tokens(F.col("text"))
    return _table(spark, sf_dir, "documents").select("doc_id", n.alias("n")).select("doc_id", *[c.alias(k) for k, c in _budget().items()])


def _budget() -> dict[str, Column]:
    """A block of n tokens offered to an empty chunk; whether a chunk that holds n should end."""
    return X.token_budget(600, 125, F.lit(0), F.col("n")) | {k: c for k, c in X.token_budget(600, 125, F.col("n"), F.lit(0)).items() if k in ("should_start", "remaining")}


@query
def word_counts(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", X.word_count(F.col("text")).alias("n_words"))


# ---- embeddings


@query
def embed_validate(spark, sf_dir):
    return V.validate(_table(spark, sf_dir, "embeddings"), 64).select("total", "dimensions", "zero_vectors", "reason")


@query
def embed_validate_failed(spark, sf_dir):
    """The check of a table where the batches of one label failed."""
    rows = _table(spark, sf_dir, "embeddings").withColumn("embedding", F.when(F.col("label") != 3, F.col("embedding")))
    return V.validate(rows, 64).select("is_valid", "total", "dimensions", "null_vectors", "zero_vectors", "reason")


@query
def norm_audit(spark, sf_dir):
    return V.norm_audit(_table(spark, sf_dir, "embeddings"))


@query
def near_duplicates(spark, sf_dir):
    return V.near_duplicates(_table(spark, sf_dir, "embeddings"), threshold=0.3)


@query
def near_duplicate_report(spark, sf_dir):
    """The closest pairs with the section of both sides."""
    rows = _table(spark, sf_dir, "embeddings").withColumn("section", F.concat(F.lit("section "), F.col("label")))
    return V.near_duplicates(rows, threshold=0.3, top=50, payload=("section",))


@query
def similarity_health(spark, sf_dir):
    rows = _table(spark, sf_dir, "embeddings").withColumns({"doc": F.col("label") % 2, "section": F.col("label")})
    return V.similarity_health(rows).select("holds", *_six("same_section", "same_document", "different_document"))


@query
def chunk_embeddings(spark, sf_dir):
    """The default embedder over the chunks, and its report."""
    return V.embedding_report(V.embed(K.chunk_documents(markdown(spark, sf_dir))), "token_count")


# ---- retrieval and evaluation


def _asked(spark, sf_dir):
    return _table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


def _corpus(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("item_id"), "text", "source")


def _sparse(spark, sf_dir):
    asked = _asked(spark, sf_dir)
    return S.bm25_top(asked, S.build_index(_corpus(spark, sf_dir), asked=asked), 5 * S.OVERFETCH)


def _dense(spark, sf_dir, k):
    vectors = _table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("vector"))
    queries = _asked(spark, sf_dir).join(vectors.withColumnRenamed("item_id", "query_id"), "query_id").select("query_id", "vector")
    return S.dense_top_k(queries, vectors, k)


@query
def bm25_topk(spark, sf_dir):
    return _sparse(spark, sf_dir)


@query
def bm25_topk_index(spark, sf_dir):
    """As bm25_topk, by a stored index in a new folder: blocks that cannot reach the k-th score are not read."""
    return Bm25Index.build(_corpus(spark, sf_dir), _new_folder(spark, "bm25")).top(_asked(spark, sf_dir), 5 * S.OVERFETCH)


@query
def dense_topk(spark, sf_dir):
    return _dense(spark, sf_dir, 5)


@query
def dense_topk_index(spark, sf_dir):
    """As dense_topk, by an index in a new folder: only the cells that can hold one of the nearest are read."""
    vectors = _table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("vector"))
    queries = _asked(spark, sf_dir).join(vectors.withColumnRenamed("item_id", "query_id"), "query_id").select("query_id", "vector")
    return VectorIndex.build(vectors, _new_folder(spark, "vectors")).query(queries, 5)


@query
def hybrid_rrf(spark, sf_dir):
    return S.fuse(_dense(spark, sf_dir, 5 * S.OVERFETCH), _sparse(spark, sf_dir), 5)


@query
def rerank_lexical(spark, sf_dir):
    pairs = _sparse(spark, sf_dir).join(_asked(spark, sf_dir), "query_id").join(_corpus(spark, sf_dir), "item_id")
    return S.rerank(pairs, 5).select("query_id", "rank", "item_id", "score")


@query
def hybrid_rerank(spark, sf_dir):
    """Both rankings fetch sixteen times as many items as asked for, the fused one four times, and the reranker cuts."""
    n = 5 * S.OVERFETCH * S.OVERFETCH
    asked = _asked(spark, sf_dir)
    sparse = S.bm25_top(asked, S.build_index(_corpus(spark, sf_dir), asked=asked), n)
    fused = S.fuse(_dense(spark, sf_dir, n), sparse, 5 * S.OVERFETCH)
    pairs = fused.join(asked, "query_id").join(_corpus(spark, sf_dir), "item_id")
    return S.rerank(pairs, 5).select("query_id", "rank", "item_id", "score")


def _evaluated(spark, sf_dir):
    """The evaluation set: a document that holds the passage is acceptable, by a word-level index of both and a check of the text."""
    asked, docs = _asked(spark, sf_dir), _table(spark, sf_dir, "documents").select("doc_id", "text")
    # one run of words of each passage finds its documents; passages too short for one are looked for in every text
    anchors = asked.select("query_id", "query", F.get(_grams(F.col("query")), F.lit(0)).alias("gram"))
    runs = docs.select("doc_id", F.explode(_grams(F.col("text"))).alias("gram"))
    likely = runs.join(anchors.where("gram IS NOT NULL").select("query_id", "query", "gram"), "gram").select("query_id", "query", "doc_id").distinct()
    pairs = likely.join(docs, "doc_id").where(F.contains("text", F.col("query")))
    short = anchors.where("gram IS NULL").select("query_id", "query")
    pairs = pairs.select("query_id", "doc_id").unionByName(docs.join(short, F.contains("text", F.col("query"))).select("query_id", "doc_id"))
    hits = pairs.select("query_id", "doc_id").distinct().groupBy("query_id").agg(F.array_sort(F.collect_list(F.concat(F.lit("doc-"), F.col("doc_id").cast("string")))).alias("acceptable_documents"))
    rows = select(spark, sf_dir, EVALUATION, "benchmark").join(hits, "query_id", "left")
    heads = F.when(F.col("query_id") % 2 == 0, F.array().cast("array<string>")).otherwise(F.array(*[F.lit(f"source {k}") for k in (3, 7, 11)]))
    return E.with_defaults(rows.withColumn("acceptable_headings", heads))


def _grams(c: Column, n: int = 8) -> Column:
    """Hashes of the runs of n words inside a text, without its first and last word, which a longer text may continue."""
    names = F.transform(F.filter(F.split(c, r"\s+"), lambda w: w != ""), lambda w: F.xxhash64(w))
    runs = lambda h: F.transform(F.sequence(F.lit(1), F.size(h) - n - 1), lambda k: F.xxhash64(*[F.get(h, k + i) for i in range(n)]))
    # an array of one binds the words, which a lambda would split again for every run
    bound = F.transform(F.array(names), lambda h: F.when(F.size(h) >= n + 2, runs(h)).otherwise(F.array().cast("array<bigint>")))
    return F.get(bound, F.lit(0))


def _classified(spark, sf_dir, evaluated=None):
    found = _sparse(spark, sf_dir).where("rank <= 5").join(_corpus(spark, sf_dir).select("item_id", "source"), "item_id")
    title = F.concat(F.lit("Source "), F.replace(F.col("source"), F.lit("src"), F.lit("")))
    rows = found.select("query_id", "rank", "item_id", F.concat(F.lit("doc-"), F.col("item_id").cast("string")).alias("identifier"), title.alias("section_title"), F.lit(None).cast("array<string>").alias("heading_path"))
    return E.classify(rows, _evaluated(spark, sf_dir) if evaluated is None else evaluated)


def _ranked(spark, sf_dir):
    evaluated = _kept(_evaluated(spark, sf_dir))
    return E.ranks(_classified(spark, sf_dir, evaluated), evaluated)


_METRICS = ("recall_at_1", "recall_at_3", "recall_at_5", "mrr")


@query
def match_classify(spark, sf_dir):
    return _classified(spark, sf_dir).select("query_id", "rank", "item_id", "matched_target", "matching_rule", "heading_match", "match_type", "reason")


@query
def eval_ranks(spark, sf_dir):
    return _ranked(spark, sf_dir).select("query_id", "first_hit_rank", "first_exact_rank", "best_match_type")


@query
def eval_metrics(spark, sf_dir):
    return E.metrics(_ranked(spark, sf_dir)).select("n_queries", *_six(*_METRICS))


@query
def eval_by_group(spark, sf_dir):
    return E.metrics_by(_ranked(spark, sf_dir)).select("dimension", "value", "n_queries", *_six(*_METRICS))


@query
def eval_integrity(spark, sf_dir):
    return E.integrity(_evaluated(spark, sf_dir))


@query
def eval_evidence(spark, sf_dir):
    evaluated = _kept(_evaluated(spark, sf_dir))
    return E.evidence(_classified(spark, sf_dir, evaluated), evaluated).select("query_id", "item_id", "match_type", "matched_target", "reason")


@query
def eval_review(spark, sf_dir):
    return E.review_sample(_ranked(spark, sf_dir)).select("query_id", "best_match_type")


@query
def evalset_sample(spark, sf_dir):
    return E.question_candidates(_table(spark, sf_dir, "documents"), 20, "doc_id", "text").select("doc_id")


# ---- the rest


@query
def heading_path_parse(spark, sf_dir):
    rows = markdown(spark, sf_dir).select("doc", F.to_json(F.array("source", "lang")).alias("j"), F.concat_ws(" > ", "source", "lang").alias("t"))
    return rows.select("doc", F.array_join(E.heading_path(F.col("j")), "/").alias("from_json"), F.array_join(E.heading_path(F.col("t")), "/").alias("from_text"))


@query
def latest_version(spark, sf_dir):
    names = _table(spark, sf_dir, "documents").select(F.replace(F.col("source"), F.lit("src"), F.lit("v")).alias("name"))
    return U.latest_version(names)


@query
def snippet(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", X.snippet(F.col("text")).alias("snippet"))


@query
def json_fence_strip(spark, sf_dir):
    fenced = F.concat(F.lit("```json\n"), F.col("text"), F.lit("\n```"))
    rows = _table(spark, sf_dir, "documents").select("doc_id", X.without_fence(fenced).alias("body"))
    return rows.select("doc_id", _md5("body").alias("body_md5"))


def _stored_rows(spark, sf_dir):
    return markdown(spark, sf_dir).select(
        F.col("doc").cast("string").alias("chunk_id"), F.array(F.col("doc").cast("float")).alias("embedding"), F.col("url").alias("source_url"), F.md5(F.col("url").cast("binary")).alias("source_document"), "title",
        F.lit("s").alias("section_title"), F.lit(0).alias("chunk_index"), F.lit(1).alias("total_chunks"), F.lit(1).alias("token_count"), F.lit("text").alias("content_type"), F.lit("v1").alias("document_version"),
        F.lit("v1").alias("chunk_version"), F.array("source", "lang").alias("heading_path"), F.lit("first").alias("chunk_text"), "doc",
    )


@query
def store_upsert(spark, sf_dir):
    """Two loads into a new store: ids that are there keep their row."""
    rows = _stored_rows(spark, sf_dir)
    store = VectorStore(spark, _new_folder(spark, "store"))
    store.load(rows.where("doc % 2 = 0"))
    store.load(rows.withColumn("chunk_text", F.lit("second")))
    return store.table().select(F.col("chunk_id").cast("long").alias("doc_id"), F.col("text").alias("batch"))


@query
def metadata_flat(spark, sf_dir):
    return _stored_rows(spark, sf_dir).select("doc", metadata().alias("m")).select("doc", "m.heading_path", "m.title", F.col("m.source_url").alias("url"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned documents, BM25 over them, and the quality of what it finds."""
    cleaned = _processed(spark, sf_dir).select(F.col("doc").alias("item_id"), F.col("cleaned_markdown").alias("text"))
    found = S.bm25_top(_asked(spark, sf_dir), S.build_index(cleaned), 5)
    rows = found.select("query_id", "rank", "item_id", F.concat(F.lit("doc-"), F.col("item_id").cast("string")).alias("identifier"), F.lit("").alias("section_title"), F.lit(None).cast("array<string>").alias("heading_path"))
    asked = _evaluated(spark, sf_dir)
    return E.metrics_by(E.ranks(E.classify(rows, asked), asked))
