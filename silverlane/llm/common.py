"""Shared steps: durable intermediate tables and bounded bitmaps."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlane.session import work_path

BROADCAST_KEYS = 1_000_000
BATCH_ROWS = 1000
BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"
# Words: everything but space, tab, line feed, vertical tab, form feed, carriage return.
WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back, so that lost executors cost no earlier stage."""
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark) -> None:
    """Send at most BATCH_ROWS rows at a time to Python, so that memory follows a few texts and not thousands.

    This lowers the session's ``spark.sql.execution.arrow.maxRecordsPerBatch``; a smaller one stays.
    """
    now = int(spark.conf.get(BATCH_KEY))
    if not 0 < now <= BATCH_ROWS:
        spark.conf.set(BATCH_KEY, str(BATCH_ROWS))


def give_back() -> None:
    """Return memory that this process has freed to the system. Workers live on from task to task and keep it otherwise."""
    for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
        pool.release_unused()


def read_table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text) -> F.Column:
    """Number of words of a text column, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def seeded_order(seed: int, *keys) -> F.Column:
    """A seeded position in [0, 2**60) that any engine with md5 can compute."""
    parts = [F.lit(str(seed))] + [F.coalesce(F.col(key).cast("string"), F.lit("~")) for key in keys]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("long")


def others(df: DataFrame, names: tuple[str, ...]) -> list[F.Column]:
    """The columns of ``df`` but those of some names, whatever their case."""
    return [F.col(f"`{c}`") for c in df.columns if c.lower() not in names]


def without_keys(docs: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows of ``docs`` whose key is not in ``keys``; rows without a key stay.

    Up to BROADCAST_KEYS keys are broadcast, so that whole texts are not shuffled; more are joined by a shuffle.
    """
    gone = stored(keys.select(F.col(key).alias("_gone")).filter("_gone IS NOT NULL").distinct(), "gone")
    side = F.broadcast(gone) if gone.count() <= BROADCAST_KEYS else gone
    return docs.join(side, F.col(key) == F.col("_gone"), "left_anti")
