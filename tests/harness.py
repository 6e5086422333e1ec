"""Runs a registered query and its SQL over the same tables and compares columns and rows."""

from __future__ import annotations

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(x):
    if isinstance(x, float):
        return round(x, 6) + 0.0
    return int(x) if isinstance(x, int) and not isinstance(x, bool) else x


def rows(names, found):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return [names[k] for k in order], sorted((tuple(_plain(r[k]) for k in order) for r in found), key=repr)


def compare(spark, con, name, query, sql, sf_dir):
    df = query(spark, sf_dir)
    names, got = rows(df.columns, df.collect())
    cur = con.execute(sql)
    want_names, want = rows([d[0] for d in cur.description], cur.fetchall())
    assert names == want_names, name
    assert len(got) == len(want), f"{name}: {len(got)} rows, {len(want)} by SQL"
    different = [(a, b) for a, b in zip(got, want, strict=True) if a != b]
    assert not different, f"{name}: {len(different)} rows differ, as {different[0]}"
    return got
