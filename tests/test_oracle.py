"""Every registered query of the engine against its SQL at the smallest scale."""

import pytest
from harness import compare, connect

from docmill.plans.catalogue import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_sql_has_queries():
    assert set(ORACLE_SQL) <= set(QUERIES) and set(QUERIES) - set(ORACLE_SQL) == {"chunk_pack", "chunk_split", "chunk_stats", "chunk_report", "chunk_embeddings"}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equals_sql(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], ORACLE_SQL[name], SF)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_has_rows(spark, name):
    assert QUERIES[name](spark, SF).count()


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 6
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
