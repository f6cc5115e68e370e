"""Compares a registered query with its SQL in DuckDB, without regard to the order of rows."""

import duckdb

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _plain(x):
    if isinstance(x, float):
        return round(x, 9)
    return x


def same(spark, query, sql, sf=SF):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.sql(sql)
    df = query(spark, sf)
    names = sorted(df.columns)
    assert names == sorted(want.columns)
    place = [want.columns.index(c) for c in names]
    got = sorted(repr([_plain(x) for x in r]) for r in df.select(*names).collect())
    assert got == sorted(repr([_plain(r[i]) for i in place]) for r in want.fetchall())
    return len(got)
