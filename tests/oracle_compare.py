"""Compare a Spark result with DuckDB rows: names, types, values, whatever the order."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return repr(v) if not isinstance(v, (bool, int)) else str(v)


def normal(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    """Empty when equal, else a few lines about what differs."""
    got_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    kinds = {d[0]: str(d[1]) for d in cur.description}
    want_rows = cur.fetchall()
    problems = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    spark_kinds = {
        "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
        "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
    }
    for f in df.schema:
        kind = spark_kinds.get(f.dataType.simpleString(), f.dataType.simpleString())
        if kind != kinds[f.name]:
            problems.append(f"type of {f.name}: {kind} != {kinds[f.name]}")
    got, want = normal(df.columns, got_rows), normal(names, want_rows)
    if len(got) != len(want):
        problems.append(f"{len(got)} rows != {len(want)}")
    if got != want:
        extra, missing = set(got) - set(want), set(want) - set(got)
        problems.append(f"only spark {sorted(extra)[:2]} only oracle {sorted(missing)[:2]}")
    return problems
