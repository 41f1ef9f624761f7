"""Order-free comparison of a Spark result with DuckDB's."""

from __future__ import annotations

import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
}


def connect(base: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{base}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(v + 0.0)
    return repr(v)


def _sorted(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """None when equal, else the first difference in words."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    got = [tuple(row) for row in df.collect()]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    wrong = {c: (t, kinds[c]) for c, t in df.dtypes if KINDS.get(t) != kinds[c]}
    if wrong:
        return f"types {wrong}"
    if len(got) != len(expected):
        return f"rows {len(got)} != {len(expected)}"
    (cols, a), (_, b) = _sorted(df.columns, got), _sorted(names, expected)
    for x, y in zip(a, b):
        if x != y:
            return f"{cols}\n spark {x}\n duck  {y}"
    return None
