import duckdb
import pytest
from pyspark.sql import functions as F

from docmill.llm.token_counts import DELETE, INSERT, ORACLE, REVISE, TokenCounts, op9_token_counts, rollup

SCHEMA = "kind string, source string, lang string, version string, tokens long, old_tokens long, n_docs string"


def batch(spark, *rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)


def totals(counts):
    return {(r.source, r.lang, r.version): (r.n_docs, r.n_tokens) for r in counts.totals().collect()}


def test_changes_and_repeated_batches(spark, tmp_path):
    counts = TokenCounts(spark, f"file://{tmp_path}/t")
    assert totals(counts) == {}
    first = batch(spark, (INSERT, "a", "en", "1", 10, None), (INSERT, "a", "en", "1", 5, None), (INSERT, None, "en", "1", 7, None), (INSERT, "b", None, "2", None, None))
    assert counts.commit("one / é", first) and not counts.commit("one / é", first)
    assert totals(counts) == {("a", "en", "1"): (2, 15), (None, "en", "1"): (1, 7), ("b", None, "2"): (1, 0)}
    second = batch(spark, (DELETE, "a", "en", "1", None, 5), (REVISE, "a", "en", "1", 12, 10), (DELETE, None, "en", "1", None, 7))
    assert counts.commit("two", second)
    want = {("a", "en", "1"): (1, 12), ("b", None, "2"): (1, 0)}
    assert totals(counts) == want
    counts.compact()
    assert totals(counts) == want and counts.committed() == {"one / é", "two"}
    assert not counts.commit("one / é", first) and not counts.commit("two", second)
    assert counts.commit("three", batch(spark)) and counts.commit("four", batch(spark, (INSERT, "a", "en", "1", 1, None)))
    counts.compact()
    counts.compact()
    assert TokenCounts(spark, f"file://{tmp_path}/t").committed() == {"one / é", "two", "three", "four"}
    assert totals(counts) == {("a", "en", "1"): (2, 13), ("b", None, "2"): (1, 0)}
    assert {r.level: r.n_tokens for r in rollup(counts.totals()).where("level = 'all'").collect()} == {"all": 13}


def test_a_bad_or_unfinished_batch_changes_nothing(spark, tmp_path):
    counts = TokenCounts(spark, f"file://{tmp_path}/t")
    with pytest.raises(Exception, match="unknown kind"):
        counts.commit("bad", batch(spark, ("other", "a", "en", "1", 1, 1)))
    assert counts.committed() == set() and totals(counts) == {}
    assert counts.commit("bad", batch(spark, (INSERT, "a", "en", "1", 1, None)))


def check_query(spark, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet{'/*.parquet' if folder != '/root/testdata/sf0.001' else ''}'")
    con.execute(ORACLE)
    key = lambda r: tuple(map(str, r))
    want = sorted(map(tuple, con.fetchall()), key=key)
    got = sorted(map(tuple, op9_token_counts(spark, folder).select("level", "source", "lang", "version", "n_docs", "n_tokens").collect()), key=key)
    assert got == want
    return got


def test_query_against_sql(spark):
    assert check_query(spark, "/root/testdata/sf0.001")


def test_query_with_nulls_repeats_and_no_rows(spark, tmp_path):
    rows = [(1, "a b", "s", "en"), (1, "a b", "s", "en"), (1, "a b", "t", None), (None, "a b", None, "en"), (None, "c d e", None, None), (None, "c d e", "s", "en"), (2, None, "s", "en"), (3, "", "s", "en"), (None, None, "s", "en"), (4, "a b", "s", "de")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").withColumn("times", F.lit(9))
    frame.write.parquet(f"{tmp_path}/a/documents.parquet")
    got = check_query(spark, f"{tmp_path}/a")
    assert [r[4] for r in got if r[0] == "all"] == [6]
    frame.limit(0).write.parquet(f"{tmp_path}/b/documents.parquet")
    assert check_query(spark, f"{tmp_path}/b") == []
