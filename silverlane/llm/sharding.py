"""Sharding by proportional stratified interleaving.

Rows of each source are shuffled by a seeded hash and ranked; row k of n gets the fraction (2k + 1) / 2n. Sorted by
that fraction all sources advance together, so any cut of the order holds every source in its overall share. The order
is cut into shards whose row counts differ by one at most.

No rank is taken in one task: a rank is the number of rows in lower hash buckets plus the place in the own bucket, and
the same holds for the global place, whose buckets are ranges of the fraction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverlane.llm.common import others, seeded_order, stored

SOURCE_BITS = 12
PLACE_BUCKETS = 8192
_HASH_BITS = 60


def interleave(df: DataFrame, shards: int, source: str, key: str, seed: int = 0, tie: tuple[str, ...] = ()) -> DataFrame:
    """Add ``shard`` (0 to shards - 1) and ``slot`` (0.. within the shard) to the rows of ``df``.

    A null source is a source of its own. Rows with equal ``key`` are ordered by the ``tie`` columns; rows that are
    equal in those too are interchangeable. With fewer rows than shards some shards are empty; an empty table gives
    an empty result. Columns of ``df`` named shard or slot are replaced; none may start with ``_il_``.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    name = F.when(F.col(source).isNull(), F.lit("null")).otherwise(F.concat(F.lit("of "), F.col(source).cast("string")))
    keyed = df.withColumns({"_il_source": name, "_il_hash": seeded_order(seed, key)}).withColumn(
        "_il_bucket", F.shiftright("_il_hash", _HASH_BITS - SOURCE_BITS).cast("int")
    )
    ranked = stored(_ranked(keyed, key, tie), "interleave")
    place = Window.orderBy("_il_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranked.groupBy("_il_range").agg(F.count("*").alias("_il_n")).select(
        F.col("_il_range").alias("_il_of"),
        F.coalesce(F.sum("_il_n").over(place), F.lit(0)).alias("_il_before"),
        F.sum("_il_n").over(Window.orderBy("_il_range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        .alias("_il_all"),
    )
    inside = Window.partitionBy("_il_range").orderBy("_il_fraction", "_il_source", "_il_hash", key, *tie)
    placed = ranked.join(ranges, F.col("_il_range") == F.col("_il_of")).withColumn(
        "_il_place", F.col("_il_before") + F.row_number().over(inside) - 1
    )
    shard = _divide(F.col("_il_place") * shards, F.col("_il_all"))
    first = _divide(shard * F.col("_il_all") + (shards - 1), F.lit(shards))
    return placed.select(
        *others(df, ("shard", "slot")), shard.cast("int").alias("shard"), (F.col("_il_place") - first).cast("long").alias("slot")
    )


def _ranked(keyed: DataFrame, key: str, tie: tuple[str, ...]) -> DataFrame:
    per_source = Window.partitionBy("_il_source")
    lower = per_source.orderBy("_il_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = keyed.groupBy("_il_source", "_il_bucket").agg(F.count("*").alias("_il_n")).select(
        F.col("_il_source").alias("_il_s"), F.col("_il_bucket").alias("_il_b"),
        F.coalesce(F.sum("_il_n").over(lower), F.lit(0)).alias("_il_before"),
        F.sum("_il_n").over(per_source).alias("_il_total"),
    )
    inside = Window.partitionBy("_il_source", "_il_bucket").orderBy("_il_hash", key, *tie)
    joined = keyed.join(
        buckets, (F.col("_il_source") == F.col("_il_s")) & (F.col("_il_bucket") == F.col("_il_b"))
    )
    rank = F.col("_il_before") + F.row_number().over(inside) - 1
    fraction = (2 * F.col("_il_rank") + 1) / (2 * F.col("_il_total"))
    return (
        joined.withColumn("_il_rank", rank)
        .withColumn("_il_fraction", fraction)
        .withColumn("_il_range", F.floor(F.col("_il_fraction") * PLACE_BUCKETS).cast("int"))
        .drop("_il_s", "_il_b", "_il_before", "_il_total", "_il_rank", "_il_bucket")
    )


def _divide(whole: Column, part: Column) -> Column:
    """Whole-number division of non-negative longs."""
    whole, part = whole.cast("long"), part.cast("long")
    return ((whole - F.pmod(whole, part)) / part).cast("long")
