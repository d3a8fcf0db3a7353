"""Run a registered query and its oracle on the same tables and compare them row by row."""

import glob
import math
import os

import duckdb

from registry import all_oracles, all_queries


def oracle_connection(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(value):
    if isinstance(value, float):
        return None if math.isnan(value) else (0.0 if value == 0 else value)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([_norm(r[i]) for i in order] for r in rows), key=repr)


def compare(spark, sf_dir, name, con=None):
    """Return None when equal, else a text that says what differs."""
    con = con or oracle_connection(sf_dir)
    df = all_queries()[name](spark, sf_dir)
    got_cols = df.columns
    cursor = con.execute(all_oracles()[name])
    want_cols = [d[0] for d in cursor.description]
    if sorted(got_cols) != sorted(want_cols):
        return f"columns: only ours {set(got_cols) - set(want_cols)}, only oracle {set(want_cols) - set(got_cols)}"
    got = _rows(got_cols, [tuple(r) for r in df.collect()])
    want = _rows(want_cols, cursor.fetchall())
    if len(got) != len(want):
        return f"rows: {len(got)} != {len(want)}"
    names = sorted(got_cols)
    for g, w in zip(got, want):
        for c, x, y in zip(names, g, w):
            if x != y or type(x) is not type(y):
                return f"{c}: {x!r} != {y!r} in {dict(zip(names, g))} / {dict(zip(names, w))}"
    return None
