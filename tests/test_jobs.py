"""The jobs: reruns, growing input, stopped batches, command lines, and their queries against SQL."""

import subprocess
import sys
from collections import Counter
from pathlib import Path

import pytest
from harness import compare, connect
from pyspark.sql.functions import input_file_name

from docmill.functions.urls import DUPLICATE, PAGINATION, SHORT
from docmill.operators.search import build_index
from jobs import corpus_cleaning as C
from jobs import page_ingest as P
from jobs.queries import ORACLE_SQL, QUERIES
from jobs.runs import configured

SF = "/root/testdata/sf0.001"
ROOT = Path(__file__).parent.parent


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.sources.partitionOverwriteMode", "spark.sql.shuffle.partitions")}
    assert compare(spark, connect(SF), name, QUERIES[name], ORACLE_SQL[name], SF)
    assert before == {k: spark.conf.get(k, None) for k in before} and not spark.streams.active


# ---- cleaning


CHROME = "[Home](http://x/) [All pages](http://x/all)"
DOCS = [(k, f"{CHROME}\nText of number {k} that says something.\n" + "More words here.\n" * (k % 3), "en" if k % 2 else "fr", 1) for k in range(20)]
FIELDS = "doc_id long, text string, lang string, `a.b` int"


def documents(spark, path, rows):
    spark.createDataFrame(rows, FIELDS).write.mode("overwrite").parquet(path)


def test_cleaning_removes_what_all_documents_have_and_reruns(spark, tmp_path):
    documents(spark, f"{tmp_path}/in", DOCS)
    first = sorted_rows(C.clean_corpus(spark, f"{tmp_path}/in", f"{tmp_path}/out"))
    assert len(first) == 20 and not any("Home" in r[1] for r in first) and all("Text of number" in r[1] for r in first)
    assert {p.name for p in (tmp_path / "out/cleaned").iterdir() if p.is_dir()} == {"lang=en", "lang=fr"}
    assert sorted_rows(C.clean_corpus(spark, f"{tmp_path}/in", f"{tmp_path}/out")) == first
    reports = {n: spark.read.json(f"{tmp_path}/out/reports/{n}") for n in ("corpus", "repeated_blocks", "removed_blocks", "signals")}
    assert reports["corpus"].head()["total_documents"] == 20 and reports["removed_blocks"].count() == 20
    assert reports["repeated_blocks"].agg({"n_docs": "max"}).head()[0] == 20 and reports["signals"].count()


def test_cleaning_of_one_partition_leaves_the_others(spark, tmp_path):
    documents(spark, f"{tmp_path}/in", DOCS)
    before = sorted_rows(C.clean_corpus(spark, f"{tmp_path}/in", f"{tmp_path}/out"))
    documents(spark, f"{tmp_path}/in", [(k, t + f"New line of number {k}.", lang, n) for k, t, lang, n in DOCS])
    after = sorted_rows(C.clean_corpus(spark, f"{tmp_path}/in", f"{tmp_path}/out", only=("fr",)))
    assert [r for r in after if r[-1] == "en"] == [r for r in before if r[-1] == "en"]
    assert len(after) == 20 and all("New line" in r[1] for r in after if r[-1] == "fr")


def test_cleaning_of_nulls_repeated_keys_and_an_empty_table(spark, tmp_path):
    rows = [(None, "no key", "en", 1), (1, None, "en", 1), (2, "", None, None), (3, "a line", "fr", 1), (3, "b line", "fr", 1), (3, "b line", "fr", 1), (4, " \n\n ", "en", 1)]
    documents(spark, f"{tmp_path}/in", rows)
    got = {r["doc_id"]: r for r in C.clean_corpus(spark, f"{tmp_path}/in", f"{tmp_path}/out").collect()}
    assert sorted(got) == [1, 2, 3, 4] and got[3]["cleaned_markdown"] == "b line" and got[2]["lang"] is None
    assert {got[k]["cleaned_markdown"] for k in (1, 2, 4)} == {""} and got[1]["page_category"] == "uncategorized"
    documents(spark, f"{tmp_path}/in", [])
    assert C.clean_corpus(spark, f"{tmp_path}/in", f"{tmp_path}/out").collect() == []


# ---- ingestion


def page(k, url, text=None, lang="en"):
    return (k, url, f"<html lang='{lang}'><body><h1>Page {k}</h1><p>{text or f'words of page {k}'}</p></body></html>")


def pages(spark, path, rows):
    """One more file in the folder."""
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.mode("append").parquet(path)


URL = "http://e.com/docs/{}"


def ingest(spark, tmp_path, **settings):
    return P.ingest_pages(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/mark", P.Config(**settings))


def state(spark, tmp_path):
    return [sorted_rows(f(spark, f"{tmp_path}/out")) for f in (P.documents, P.postings, P.rejected)]


def test_ingest_takes_only_what_is_new(spark, tmp_path):
    pages(spark, f"{tmp_path}/in", [page(2, URL.format("a")), page(1, URL.format("a#x")), page(3, URL.format("b")), page(4, URL.format("b?page=2")), page(5, URL.format("c"), lang="fr"), page(6, "http://e.com/"), page(3, URL.format("b"))])
    first = ingest(spark, tmp_path).collect()
    assert {(r["page_id"], r["norm_url"], r["batch"], r["lang"]) for r in first} == {(1, URL.format("a"), 0, "en"), (3, URL.format("b"), 0, "en")} and len(first) == 2
    assert {(r["page_id"], r["reason"]) for r in P.rejected(spark, f"{tmp_path}/out").collect()} == {(2, DUPLICATE), (4, PAGINATION), (5, P.NOT_ENGLISH), (6, SHORT)}
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "out/documents").rglob("*.parquet")}
    # the second run: a URL that is there, one that was not a document before, and a new one
    pages(spark, f"{tmp_path}/in", [page(0, URL.format("a"), "newer"), page(7, URL.format("c")), page(8, URL.format("d"))])
    second = {r["page_id"]: r for r in ingest(spark, tmp_path).collect()}
    assert {(k, r["batch"]) for k, r in second.items()} == {(1, 0), (3, 0), (7, 1), (8, 1)} and "newer" not in second[1]["markdown_content"]
    assert all(p.stat().st_mtime_ns == t for p, t in files.items())
    before = state(spark, tmp_path)
    ingest(spark, tmp_path)
    assert state(spark, tmp_path) == before


def test_index_equals_one_from_scratch(spark, tmp_path):
    for part in range(2):
        pages(spark, f"{tmp_path}/in", [page(k, URL.format(f"p{k}"), "same words same " + "x " * k) for k in range(part * 5, part * 5 + 5)])
        out = ingest(spark, tmp_path)
    index = build_index(out.select("norm_url", "markdown_content"), "norm_url", "markdown_content")["postings"]
    assert sorted_rows(P.postings(spark, f"{tmp_path}/out").select("term", "norm_url", "tf")) == sorted_rows(index.select("term", "item_id", "tf").toDF("term", "norm_url", "tf"))


def test_postings_are_counted_within_a_document_and_dealt_in_bounded_parts(spark, tmp_path, monkeypatch):
    rows = [page(k, URL.format(f"p{k}"), "Common common COMMON " + " ".join(f"w{k}x{i} w{k}x{i}" for i in range(k))) for k in range(40)]
    pages(spark, f"{tmp_path}/in", rows)
    whole, plans = P.write, {}

    def watched(df, path, *rest, **more):
        plans[Path(path).parent.name] = df._jdf.queryExecution().optimizedPlan().toString()
        return whole(df, path, *rest, **more)

    monkeypatch.setattr(P, "write", watched)
    monkeypatch.setattr(P, "WORDS", 50, raising=False)
    ingest(spark, tmp_path)
    # no task gathers the words of all its documents
    assert "Aggregate" not in plans["postings"]
    got = P.postings(spark, f"{tmp_path}/out").withColumn("file", input_file_name()).collect()
    want = {("common", URL.format(f"p{k}"), 3) for k in range(40)} | {(f"w{k}x{i}", URL.format(f"p{k}"), 2) for k in range(40) for i in range(k)}
    assert {(r["term"], r["norm_url"], r["tf"]) for r in got if r["term"][0] in "cw"} == want and len(got) == len(want) + 40 * 3  # and of each heading: #, page and its number
    # a word that is in all documents is in several files, and no file has more than about WORDS rows
    sizes = Counter(r["file"] for r in got)
    assert len({r["file"] for r in got if r["term"] == "common"}) > 1 and max(sizes.values()) <= 100, sizes


def test_words_of_a_document_are_counted(spark):
    texts = ["", " \n", "a", "B b  a\u00a0b\nC", "x " * 1000, None, "é É e"]
    got = P.counted(spark.createDataFrame(list(enumerate(texts)), "norm_url int, markdown_content string"))
    assert got.dtypes == [("term", "string"), ("norm_url", "int"), ("tf", "bigint")]
    assert sorted(map(tuple, got.collect())) == sorted((w, k, n) for k, t in enumerate(texts) for w, n in Counter((t or "").lower().split()).items())


def test_batch_that_was_stopped_is_taken_again(spark, tmp_path, monkeypatch):
    pages(spark, f"{tmp_path}/in", [page(k, URL.format(f"p{k}")) for k in range(6)])
    whole, calls = P.write, []

    def failing(df, path, *rest, **more):
        calls.append(path)
        if len(calls) == 2:  # documents are written, postings are not
            raise OSError("an executor is gone")
        return whole(df, path, *rest, **more)

    monkeypatch.setattr(P, "write", failing)
    with pytest.raises(Exception, match="STREAM_FAILED|gone"):
        ingest(spark, tmp_path)
    assert P.postings(spark, f"{tmp_path}/out").count() == 0
    monkeypatch.setattr(P, "write", whole)
    assert ingest(spark, tmp_path).count() == 6
    assert {r["batch"] for r in P.documents(spark, f"{tmp_path}/out").collect()} == {0} and P.postings(spark, f"{tmp_path}/out").select("norm_url").distinct().count() == 6


def test_batches_of_a_file_each_give_the_same_documents(spark, tmp_path):
    for part in range(3):
        pages(spark, f"{tmp_path}/in", [page(10 * part + k, URL.format(f"p{k + part}")) for k in range(3)])
    out = ingest(spark, tmp_path, files_per_batch=1).collect()
    assert {r["batch"] for r in out} == {0, 1, 2} and {r["norm_url"] for r in out} == {URL.format(f"p{k}") for k in range(5)} and len(out) == 5


def test_ingest_of_nulls_and_nothing(spark, tmp_path):
    pages(spark, f"{tmp_path}/in", [(None, None, None), (1, URL.format("a"), None), (None, URL.format("b"), page(0, "")[2]), page(2, URL.format("b"))])
    out = ingest(spark, tmp_path).collect()
    assert [(r["page_id"], r["norm_url"]) for r in out] == [(None, URL.format("b"))]
    assert sorted((r["page_id"] or 0, r["reason"]) for r in P.rejected(spark, f"{tmp_path}/out").collect()) == [(0, SHORT), (1, P.EMPTY), (2, DUPLICATE)]
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/none")
    assert P.ingest_pages(spark, f"{tmp_path}/none", f"{tmp_path}/out2", f"{tmp_path}/mark2").collect() == []


# ---- command lines


def test_settings(tmp_path):
    file = tmp_path / "c.json"
    file.write_text('{"min_path_length": 3, "allowed_domains": ["e.com"]}')
    assert configured(P.Config, str(file)) == P.Config(min_path_length=3, allowed_domains=("e.com",)) and configured(P.Config, None) == P.Config()
    file.write_text('{"no_such": 3}')
    with pytest.raises(ValueError, match="no_such"):
        configured(P.Config, str(file))
    assert configured(C.Config, str(ROOT / "jobs/corpus_cleaning.json")) == C.Config() and configured(P.Config, str(ROOT / "jobs/page_ingest.json")) == P.Config()


@pytest.mark.parametrize(("module", "arguments", "output"), [
    ("corpus_cleaning", ["--documents", f"{SF}/documents.parquet", "--output", "{}/out"], "cleaned"),
    ("page_ingest", ["--pages", f"{SF}/pages.parquet", "--output", "{}/out", "--checkpoint", "{}/mark"], "documents"),
])
def test_command_line(spark, tmp_path, module, arguments, output):
    run = subprocess.run([sys.executable, "-m", f"jobs.{module}", *[a.format(tmp_path) for a in arguments], "--config", f"jobs/{module}.json"], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]
    assert "read " in run.stderr and "wrote " in run.stderr
    assert spark.read.parquet(f"{tmp_path}/out/{output}").count()


def test_corpus_report_is_added_up_while_documents_are_written(spark, tmp_path, monkeypatch):
    from docmill.operators import clean
    from jobs import corpus_cleaning

    calls, process = [], corpus_cleaning.process_documents
    monkeypatch.setattr(corpus_cleaning, "process_documents", lambda *a: calls.append(process(*a)) or calls[-1])
    spark.createDataFrame([(k, f"one\nown {k}\n# two", "en") for k in range(5)], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/in")
    corpus_cleaning.clean_corpus(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    got, want = spark.read.json(f"{tmp_path}/out/reports/corpus").head().asDict(), clean.corpus_report(calls[0]).head().asDict()
    assert got == want and got["total_documents"] == 5
    assert not hasattr(corpus_cleaning, "corpus_report")
