"""Compare a Spark result with DuckDB's on the same tables."""

from __future__ import annotations

import datetime as dt
import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE",
    "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(folder, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    return value.isoformat() if isinstance(value, (dt.date, dt.datetime)) else value


def check(df, con: duckdb.DuckDBPyConnection, sql: str) -> int:
    """Raise unless names, types and rows (as a multiset) agree; return the row count."""
    cursor = con.execute(sql)
    wanted = {d[0]: str(d[1]) for d in cursor.description}
    order = sorted(wanted)
    got = {f.name: KINDS[f.dataType.simpleString()] for f in df.schema.fields}
    assert got == wanted, (got, wanted)
    place = [list(wanted).index(c) for c in order]
    right = Counter(tuple(plain(r[i]) for i in place) for r in cursor.fetchall())
    left = Counter(tuple(plain(r[c]) for c in order) for r in df.collect())
    assert left == right, {
        "columns": order,
        "only_spark": list((left - right).items())[:3],
        "only_sql": list((right - left).items())[:3],
        "rows": (left.total(), right.total()),
    }
    return left.total()
