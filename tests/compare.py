"""Runs registered queries against their SQL: same columns, same multiset of values."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        raise TypeError("results carry doubles, not decimals")
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value) if not isinstance(value, bool) else f"bool {value}"


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def kinds(df):
    alias = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
             "date": "DATE", "timestamp_ntz": "TIMESTAMP", "array<bigint>": "BIGINT[]"}
    return {name: alias.get(kind, kind) for name, kind in df.dtypes}


def difference(df, con, sql: str) -> str | None:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    expected = rows_of(names, cursor.fetchall())
    actual = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if actual[0] != expected[0]:
        return f"columns {actual[0]} != {expected[0]}"
    if kinds(df) != types:
        return f"types {kinds(df)} != {types}"
    if len(actual[1]) != len(expected[1]):
        return f"{len(actual[1])} rows != {len(expected[1])}"
    for a, e in zip(actual[1], expected[1]):
        if a != e:
            wrong = sum(x != y for x, y in zip(actual[1], expected[1]))
            return f"{wrong} rows differ, e.g. {a} != {e}"
    return None
