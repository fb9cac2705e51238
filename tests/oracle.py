"""Compare registered queries with their SQL, value by value."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, int):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(
        (tuple(_plain(r[i]) for i in order) for r in rows), key=lambda r: [(v is not None, str(type(v)), v) if v is not None else (False, "", "") for v in r]
    )


def differences(df, con, sql) -> str | None:
    """None if both give the same columns and rows, else what differs."""
    got_names, got = canonical(df.columns, [tuple(r) for r in df.collect()])
    con.execute(sql)
    want_names, want = canonical([d[0] for d in con.description], con.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}; only here {list(set(got) - set(want))[:2]}; only there {list(set(want) - set(got))[:2]}"
    for a, b in zip(got, want):
        if a != b:
            return f"{a} != {b}"
    return None
