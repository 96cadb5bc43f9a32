"""Registry of queries and of the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its name, with its SQL where SQL can say it."""
    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return register


def load_all() -> None:
    """Import every module that registers queries."""
    from silverlane.plans import (  # noqa: F401
        queries_clean, queries_gold, queries_logs, queries_quality, queries_rows, queries_schema, queries_sources,
        queries_streams,
    )
