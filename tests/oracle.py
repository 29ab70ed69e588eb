"""Comparison of a query's result with its SQL on DuckDB, rows in any order."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def compare(df, con, sql: str) -> tuple[int, str | None]:
    """(row count, difference or None)."""
    result = con.execute(sql)
    wanted_columns = [d[0] for d in result.description]
    wanted = rows_of(wanted_columns, result.fetchall())
    if sorted(df.columns) != sorted(wanted_columns):
        return 0, f"columns {sorted(df.columns)} against {sorted(wanted_columns)}"
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if len(got) != len(wanted):
        return len(got), f"{len(got)} rows against {len(wanted)}"
    bad = [(g, w) for g, w in zip(got, wanted) if g != w]
    if bad:
        return len(got), f"{len(bad)} rows differ, first {bad[0][0]} against {bad[0][1]}"
    return len(got), None
