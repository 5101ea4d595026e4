"""Run a registered query and its SQL over the same tables and compare them whole."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]
# Spark and SQL names of the types the queries return.
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _value(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str) -> list[str]:
    """What differs, empty if nothing does."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = _rows(names, result.fetchall())
    found = _rows(df.columns, [tuple(r) for r in df.collect()])
    problems = []
    if sorted(names) != sorted(df.columns):
        problems.append(f"columns {sorted(df.columns)} but SQL has {sorted(names)}")
    sql_types = {n: str(t) for n, t, *_ in con.execute(f"DESCRIBE {sql}").fetchall()}
    for name, kind in df.dtypes:
        if TYPES.get(kind, kind) != sql_types.get(name):
            problems.append(f"type of {name}: {kind} but SQL has {sql_types.get(name)}")
    if not expected:
        problems.append("SQL gives no rows")
    for label, rest in (("only Spark", found - expected), ("only SQL", expected - found)):
        if rest:
            problems.append(f"{label}: {sum(rest.values())} rows, e.g. {list(rest)[:3]}")
    return problems
