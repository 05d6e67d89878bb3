"""Compare one registered query with its SQL twin, value by value."""

from __future__ import annotations

import math

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0) if value else "0.0"
    if isinstance(value, bool):
        return str(value)
    if value is None:
        return ""
    return str(value)


def normalised(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    """Readable differences; empty when both sides hold the same rows."""
    rel = con.sql(sql)
    want_names, want = normalised(rel.columns, rel.fetchall())
    got_names, got = normalised(df.columns, df.collect())
    if want_names != got_names:
        return [f"columns differ: {set(want_names) ^ set(got_names)}"]
    if len(want) != len(got):
        return [f"rows: spark {len(got)} sql {len(want)}"]
    extra, missing = sorted(set(got) - set(want)), sorted(set(want) - set(got))
    if not extra and not missing and got != want:
        return ["same distinct rows, different multiplicities"]
    out = [f"{len(extra)} rows differ"] if extra else []
    for a, b in list(zip(extra, missing))[:3]:
        out.append(str([(n, x, y) for n, x, y in zip(got_names, a, b) if x != y]))
    return out
