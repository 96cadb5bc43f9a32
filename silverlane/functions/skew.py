"""Joining per-key facts back to rows when a few keys may hold most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlane.session import materialize

KEYS_PER_PARTITION = 4


def hot_limit(df: DataFrame, total_rows: int) -> int:
    """Rows from which a key is hot: a quarter of an even share of a shuffle partition."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, total_rows // (KEYS_PER_PARTITION * max(1, partitions)))


def attach_by_key(df: DataFrame, facts: DataFrame, key: str, total_rows: int, payload: list[str]) -> DataFrame:
    """Left-join ``facts`` (one row per ``key``, row count in ``n``) to ``df``.

    Keys above ``hot_limit`` are hot. There are fewer than KEYS_PER_PARTITION of them per shuffle partition whatever
    the data, so their facts are broadcast and their rows, like rows without a key, are not shuffled at all. The other
    rows meet their facts in a shuffle join in which no key fills a task.
    """
    limit = hot_limit(df, total_rows)
    hot = facts.filter(F.col("n") > limit).select(
        F.col(key).alias("_hot_key"), *[F.col(name).alias(f"_fact_{name}") for name in payload]
    )
    cold = facts.filter(F.col("n") <= limit).select(
        F.col(key).alias("_cold_key"), *[F.col(name).alias(f"_fact_{name}") for name in payload]
    )
    marked = df.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left")
    chosen = [*df.columns, *[F.col(f"_fact_{name}").alias(name) for name in payload]]
    settled = marked.filter(F.col("_hot_key").isNotNull() | F.col(key).isNull()).select(*chosen)
    keyed = df.filter(F.col(key).isNotNull()).join(
        F.broadcast(hot.select("_hot_key")), F.col(key) == F.col("_hot_key"), "left_anti"
    )
    return settled.unionByName(keyed.join(cold, F.col(key) == F.col("_cold_key"), "left").select(*chosen))


def attach_stored(df: DataFrame, facts: DataFrame, key: str, payload: list[str]) -> DataFrame:
    """``attach_by_key`` with facts that are costly to make: they are stored, and rows are counted from them.

    Rows whose key has no facts do not count; that only lowers the limit, and fewer keys than the bound can still be hot.
    """
    kept = materialize(facts, "facts")
    total = kept.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return attach_by_key(df, kept, key, total, payload)
