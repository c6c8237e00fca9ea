"""Run registered queries against DuckDB and report differences."""

from __future__ import annotations

import math
import time
from decimal import Decimal

import duckdb

from brisalake.plans.lake import TABLES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def cell(v):
    if v is None:
        return None
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return int(v) if v == int(v) else v
    return v


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(cell(r[i]) for i in order) for r in records]
    return [columns[i] for i in order], sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def difference(spark, folder: str, name: str, fn, sql: str | None, con) -> tuple[str | None, float, int]:
    """(what differs or None, Spark seconds, rows)."""
    start = time.perf_counter()
    df = fn(spark, folder)
    got = df.collect()
    seconds = time.perf_counter() - start
    if sql is None:
        return None, seconds, len(got)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want_c, want = rows_of(names, cur.fetchall())
    got_c, have = rows_of(df.columns, [tuple(r) for r in got])
    if want_c != got_c:
        return f"columns {got_c} != {want_c}", seconds, len(have)
    if len(want) != len(have):
        return f"rows {len(have)} != {len(want)}", seconds, len(have)
    bad = [(a, b) for a, b in zip(have, want) if a != b]
    if bad:
        return f"{len(bad)} rows differ: {want_c} spark={bad[0][0]} oracle={bad[0][1]}", seconds, len(have)
    return None, seconds, len(have)
