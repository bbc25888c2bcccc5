"""Compares a Spark result with the same query in DuckDB."""

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9) + 0.0
    if isinstance(v, list):
        return tuple(_plain(x) for x in v)
    return v


def rows_of(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in data), key=repr)


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
         "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "boolean": "BOOLEAN"}


def difference(df, con, sql):
    """None if both have the same columns, kinds of types and rows."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    kinds = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    wrong = {c: (t, kinds[c]) for c, t in df.dtypes if TYPES.get(t) != kinds[c]}
    if wrong:
        return f"types differ: {wrong}"
    got = [tuple(r) for r in df.collect()]
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)} rows"
    bad = [(x, y) for x, y in zip(a, b) if x != y or [type(v) for v in x] != [type(v) for v in y]]
    return f"{len(bad)} rows differ, columns {sorted(names)}, first {bad[0]}" if bad else None
