"""Runs DuckDB SQL on a folder of tables."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sql, sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return names, cursor.fetchall()


def compare(df, sql, sf_dir):
    """Equal column names and equal bags of rows."""
    names, rows = duck(sql, sf_dir)
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    place = [names.index(n) for n in order]
    got = sorted((tuple(r[n] for n in order) for r in df.collect()), key=str)
    want = sorted((tuple(r[i] for i in place) for r in rows), key=str)
    assert got == want
    return got
