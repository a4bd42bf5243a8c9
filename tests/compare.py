"""A query's rows against its SQL in DuckDB."""

import datetime
import math

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SF = "/root/testdata/sf0.001"


def plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else repr(x)
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    return str(x)


def same(spark, query, sql, sf=SF):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = query(spark, sf)
    want = con.sql(sql)
    names = sorted(want.columns)
    assert names == sorted(df.columns)
    place = [want.columns.index(n) for n in names]
    got = sorted(tuple(plain(r[n]) for n in names) for r in df.collect())
    assert got == sorted(tuple(plain(r[i]) for i in place) for r in want.fetchall())
