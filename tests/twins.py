"""Spark results against DuckDB's."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def text(value):
    if value is None:
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float) or hasattr(value, "as_tuple"):
        return f"{float(value):.9g}"
    return str(value)


def compare(df, con, sql):
    names = sorted(df.columns)
    ours = sorted(tuple(text(r[c]) for c in names) for r in df.collect())
    found = con.sql(sql)
    assert sorted(found.columns) == names
    at = [found.columns.index(c) for c in names]
    theirs = sorted(tuple(text(r[i]) for i in at) for r in found.fetchall())
    assert len(ours) == len(theirs)
    assert ours == theirs
