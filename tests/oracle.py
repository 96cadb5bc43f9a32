"""Compare a query with its SQL, value by value."""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def plain(value):
    """One spelling per value, whichever engine it came from."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float, Decimal)):
        return repr(float(value))
    if isinstance(value, datetime):
        return value.strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(value, date):
        return value.isoformat()
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark, con, sf_dir: str, run, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    frame = run(spark, sf_dir)
    mine = rows_of(frame.columns, [tuple(row) for row in frame.collect()])
    result = con.execute(sql)
    names = [column[0] for column in result.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(names)}"
    theirs = rows_of(names, result.fetchall())
    if mine == theirs:
        return None
    extra = sorted(set(mine) - set(theirs))[:2], sorted(set(theirs) - set(mine))[:2]
    return f"{len(mine)} rows against {len(theirs)}; only here {extra[0]}, only there {extra[1]}"
