"""Compare a query with its SQL on DuckDB: columns by name, rows without order."""

from __future__ import annotations

import datetime
import decimal
import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        if os.path.exists(f"{sf}/{name}.parquet"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def _value(v):
    if v is None:
        return ("null",)
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return ("n", repr(v + 0.0))
    if isinstance(v, int):
        return ("n", repr(float(v)))
    if isinstance(v, (datetime.datetime, datetime.date)):
        return ("t", v.replace(tzinfo=None).isoformat() if isinstance(v, datetime.datetime) else v.isoformat())
    return ("s", str(v))


def normalise(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_value(r[i]) for i in order) for r in rows)


def spark_result(df):
    return normalise(df.columns, [tuple(r) for r in df.collect()])


def sql_result(con, sql):
    rel = con.execute(sql)
    return normalise([d[0] for d in rel.description], rel.fetchall())


def difference(got, want) -> str | None:
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}: {got[1][:2]} / {want[1][:2]}"
    bad = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None
