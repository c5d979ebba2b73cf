"""Runs a registered query and its SQL twin and compares schema, rows and values."""

from __future__ import annotations

import math
import re
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def scans(df) -> Counter:
    """How often the plan of ``df`` scans each benchmark table."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return Counter(m for m in re.findall(r"FileScan parquet[^\n]*?/(\w+)\.parquet", plan) if m in TABLES)


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ("", "")
    if isinstance(value, bool):
        return ("b", str(value))
    if isinstance(value, float):
        return ("f", repr(value + 0.0))
    if isinstance(value, int):
        return ("i", str(value))
    return (type(value).__name__, str(value))


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def _close(a, b) -> bool:
    if len(a) != len(b):
        return False
    for x, y in zip(a, b):
        if x == y:
            continue
        if x[0] == y[0] == "f" and math.isclose(float(x[1]), float(y[1]), rel_tol=1e-9, abs_tol=1e-9):
            continue
        return False
    return True


def compare(df, con, sql: str) -> tuple[str, int]:
    """('' or what differs, number of rows)."""
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    want = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(got)
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}", len(got)
    a, b = _rows(df.columns, got), _rows(names, want)
    if a == b:
        return "", len(got)
    near = all(_close(x, y) for x, y in zip(a, b))
    for x, y in zip(a, b):
        if x != y:
            return f"{'ROUNDING ' if near else 'VALUES '}{x} != {y}", len(got)
    return "", len(got)
