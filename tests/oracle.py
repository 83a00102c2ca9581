"""Comparison of a registered query with its SQL in DuckDB."""

import os
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(folder, name)}.parquet'")
    return con


def compare(spark, con, folder, query, sql):
    """Row multisets and column names of both sides; None if equal."""
    frame = query(spark, folder)
    columns = sorted(frame.columns)
    ours = Counter(tuple(row) for row in frame.select(*columns).collect())
    result = con.execute(f"SELECT * FROM ({sql})")
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return f"columns {columns} against {sorted(names)}"
    order = [names.index(c) for c in columns]
    theirs = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    if ours != theirs:
        return f"only ours {list((ours - theirs).items())[:3]}, only theirs {list((theirs - ours).items())[:3]}"
    return None
