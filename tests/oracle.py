"""Run a registered query and its SQL twin over the same tables and compare the rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def duck(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    con.execute("SET TimeZone = 'UTC'")
    return con


def _cell(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark_df, con, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    names = spark_df.columns
    got = _rows(names, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    sql_names = [c[0] for c in cur.description]
    want = _rows(sql_names, cur.fetchall())
    if sorted(names) != sorted(sql_names):
        return f"columns {sorted(names)} vs {sorted(sql_names)}"
    if len(got) != len(want):
        return f"{len(got)} rows vs {len(want)}"
    if not got:
        return "both empty"
    for a, b in zip(got, want):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} vs {b}"
    return None
