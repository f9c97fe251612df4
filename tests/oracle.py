"""Comparing a query with its SQL in DuckDB: names, rows and values."""

import datetime as dt
import decimal
import glob
import os

import duckdb


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _value(x):
    if x is None:
        return "NULL"
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, decimal.Decimal):
        return f"dec {x.normalize():f}" if x else "dec 0"
    if isinstance(x, float):
        return f"float {x!r}"
    if isinstance(x, int):
        return f"int {x}"
    if isinstance(x, dt.datetime):
        return f"time {x.replace(tzinfo=None).isoformat()}"
    return f"{type(x).__name__} {x}"


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(tuple(_value(r[i]) for i in order) for r in rows)


def compare(con, df, sql):
    """None when equal, otherwise a description of the difference."""
    got_names, got = canonical(df.columns, df.collect())
    rel = con.execute(sql)
    want_names, want = canonical([d[0] for d in rel.description], rel.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if got != want:
        extra, lost = set(got) - set(want), set(want) - set(got)
        return f"{len(got)} rows, expected {len(want)}; extra {sorted(extra)[:3]}, missing {sorted(lost)[:3]}"
    if not got:
        return "no rows"
    return None
