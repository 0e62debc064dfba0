"""Compare a Spark result with a DuckDB result, whatever the order of rows and columns."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import duckdb


def cell(value):
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    if isinstance(value, float) and value == int(value):
        return int(value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    found = [tuple(cell(row[i]) for i in order) for row in rows]
    return sorted(found, key=lambda r: tuple((v is None, str(v)) for v in r))


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def compare(df, con, sql: str) -> tuple[str, int]:
    """Empty text when equal, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    want = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(want)
    got = rows_of(df.columns, df.collect())
    fit = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
           "timestamp_ntz": "TIMESTAMP"}
    for name, kind in df.dtypes:
        if fit.get(kind) != kinds[name]:
            return f"type of {name}: {kind} != {kinds[name]}", len(want)
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}", len(want)
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} rows differ, first: {bad[0]}", len(want)
    return "", len(want)
