"""Compare registered queries with their SQL counterparts run by DuckDB."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

TYPE_NAMES = {
    "VARCHAR": "string",
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _value(value):
    if isinstance(value, float):
        return 0.0 if value == 0 else (None if math.isnan(value) else round(value, 9))
    if isinstance(value, (list, tuple)):
        return tuple(_value(v) for v in value)
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def compare(spark, connection, query, sql: str, sf_dir: str) -> str | None:
    """None if both give the same rows, else what differs."""
    frame = query(spark, sf_dir)
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(names)}"
    types = {d[0]: TYPE_NAMES.get(str(d[1]), str(d[1])) for d in cursor.description}
    if types != dict(frame.dtypes):
        return f"types {dict(frame.dtypes)} against {types}"
    wanted = rows_of(names, cursor.fetchall())
    if got == wanted:
        return None
    extra, missing = got - wanted, wanted - got
    return (
        f"{sum(got.values())} rows against {sum(wanted.values())}; "
        f"extra {list(extra)[:2]!r:.600}; missing {list(missing)[:2]!r:.600}"
    )
