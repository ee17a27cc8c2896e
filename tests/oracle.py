"""Side-by-side run of the registered queries in Spark and DuckDB."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        path = f"{sf_dir}/{table}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return float(value)
    return value


def normal(columns: list[str], rows) -> tuple[list[str], list[str]]:
    """Column names and rows in an order that does not depend on the engine."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [repr(tuple(_plain(row[i]) for i in order)) for row in rows]
    return [columns[i] for i in order], sorted(plain)


def compare(spark, con, name, query, sql, sf_dir) -> str | None:
    """None where both engines agree, else what differs."""
    df = query(spark, sf_dir)
    got = normal(df.columns, [tuple(row) for row in df.collect()])
    result = con.execute(sql)
    want = normal([d[0] for d in result.description], result.fetchall())
    if got[0] != want[0]:
        return f"{name}: columns {got[0]} != {want[0]}"
    if got[1] == want[1]:
        return None
    only_got = [row for row in got[1] if row not in set(want[1])][:3]
    only_want = [row for row in want[1] if row not in set(got[1])][:3]
    return f"{name}: {len(got[1])} vs {len(want[1])} rows; {only_got} | {only_want}"
