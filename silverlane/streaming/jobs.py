"""Structured Streaming forms of validation, flagging and window alerts."""

from __future__ import annotations

import threading
from collections.abc import Callable
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from silverlane.functions.rules import ERRORS, Rule, with_errors
from silverlane.operators.suspicious import (
    WINDOW_MAX_COUNT, WINDOW_MAX_SUM, alert_columns, over_limits, suspicious_flags, window_totals,
)

PROGRESS_SCHEMA = "run_id string, batch_id bigint, input_rows bigint, late_rows bigint"
TRIGGER = "10 seconds"
FRAUD_DELAY = "30 seconds"
MARK_SCHEMA = "latest timestamp"
SALT, SALTS = "_salt", 64


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """Parquet files as a stream, by file arrival; ``path`` is a folder or a glob."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def with_event_time(stream: DataFrame, column: str) -> DataFrame:
    """A watermark needs a timestamp with a zone: plain times are read in the session's."""
    return stream.withColumn(column, F.col(column).cast("timestamp"))


def start_append(df: DataFrame, path: str, checkpoint: str, drain: bool = True) -> StreamingQuery:
    """Append to a parquet folder; ``drain`` takes what is there now and stops."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=TRIGGER)
    return writer.start(path)


def today() -> date:
    return datetime.now(timezone.utc).date()


def medallion_batch(
    rules: list[Rule], as_of: date | Callable[[], date], base: str
) -> Callable[[DataFrame, int], None]:
    """Batch function: validate, flag, and write rows to ``layer=silver`` or ``layer=quarantine``.

    ``as_of`` is a fixed day or, for a stream that runs on, a function asked again for every batch (``today``).

    Both layers come from one pass. Output is partitioned by batch id and a batch
    overwrites only its own partitions, so a replayed batch leaves one copy.
    """
    def process(batch: DataFrame, batch_id: int) -> None:
        day = as_of() if callable(as_of) else as_of
        checked = suspicious_flags(with_errors(batch, rules, day)).withColumns({
            "layer": F.when(F.size(ERRORS) == 0, F.lit("silver")).otherwise(F.lit("quarantine")),
            "batch_id": F.lit(batch_id),
        })
        (
            checked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("layer", "batch_id").parquet(base)
        )

    return process


def stream_medallion(
    stream: DataFrame, rules: list[Rule], as_of: date | Callable[[], date], base: str, checkpoint: str,
    drain: bool = True,
) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(medallion_batch(rules, as_of, base)).option(
        "checkpointLocation", checkpoint
    )
    return (writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=TRIGGER)).start()


def stream_fraud_windows(
    stream: DataFrame, timestamp: str = "timestamp", account: str = "account_id", amount: str = "amount",
    delay: str = FRAUD_DELAY, max_count: int = WINDOW_MAX_COUNT, max_sum: float = WINDOW_MAX_SUM,
) -> DataFrame:
    """Sliding-window alerts; a window is emitted once, when the watermark passes its end."""
    timed = with_event_time(stream, timestamp).withWatermark(timestamp, delay)
    return over_limits(window_totals(timed, timestamp, account, amount), max_count, max_sum).select(
        *alert_columns(account)
    )


def stream_dedupe(stream: DataFrame, keys: list[str], timestamp: str, delay: str) -> DataFrame:
    """First row per key; a key is remembered until the watermark passes it."""
    return with_event_time(stream, timestamp).withWatermark(timestamp, delay).dropDuplicatesWithinWatermark(keys)


def stream_dedupe_spread(stream: DataFrame, keys: list[str], timestamp: str, delay: str, salts: int = SALTS) -> DataFrame:
    """``stream_dedupe`` for keys that may hold most rows: once per key and input partition, then once per key.

    The first level spreads the copies of a key over up to ``salts`` state tasks, and the second sees at most that many
    of them while they are remembered. Copies closer than ``delay`` come out once, as with one level; a copy later than
    that may come out again or not, as there. A null key is a key like any other.
    """
    salted = with_event_time(stream, timestamp).withWatermark(timestamp, delay).withColumn(
        SALT, F.pmod(F.spark_partition_id(), F.lit(salts)))
    return salted.dropDuplicatesWithinWatermark([*keys, SALT]).drop(SALT).dropDuplicatesWithinWatermark(keys)


def _mark(spark: SparkSession, base: str, batch_id: int) -> datetime | None:
    """Latest event time of all batches up to ``batch_id``, None before any row came."""
    if batch_id < 0:
        return None
    row = spark.read.schema(MARK_SCHEMA).parquet(f"{base}/marks/batch_id={batch_id}").first()  # one row per batch
    return row and row["latest"]


def late_split_batch(base: str, timestamp: str, delay: str) -> Callable[[DataFrame, int], None]:
    """Batch function: rows behind the watermark go to ``arrival=late``, all others to ``arrival=on_time``.

    The watermark is Spark's: the latest event time of earlier batches, in whole milliseconds, less ``delay``. Rows at
    it are late, rows without a time never. A batch stores the latest time up to itself as one row and reads only the
    one before it, so a replayed batch finds the same watermark and overwrites its own output.
    """
    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _mark(spark, base, batch_id - 1)
        moment = F.col(timestamp).cast("timestamp")
        late = F.lit(False)
        if before is not None:
            edge = F.date_trunc("MILLISECOND", F.lit(before).cast("timestamp")) - F.expr(f"INTERVAL {delay}")
            late = F.coalesce(moment <= edge, F.lit(False))
        seen = Observation()
        (
            batch.observe(seen, F.max(moment).alias("latest"))
            .withColumns({"arrival": F.when(late, "late").otherwise("on_time"), "batch_id": F.lit(batch_id)})
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("arrival", "batch_id").parquet(f"{base}/rows")
        )
        known = [time for time in (before, seen.get["latest"]) if time is not None]
        mark = spark.createDataFrame([(max(known) if known else None,)], MARK_SCHEMA)
        mark.coalesce(1).write.mode("overwrite").parquet(f"{base}/marks/batch_id={batch_id}")

    return process


def stream_split_late(
    stream: DataFrame, timestamp: str, delay: str, base: str, checkpoint: str, drain: bool = True
) -> StreamingQuery:
    """Keep every row: late ones apart from those on time, without state and without a shuffle."""
    writer = stream.writeStream.foreachBatch(late_split_batch(base, timestamp, delay)).option(
        "checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=TRIGGER)).start()


def arrivals(spark: SparkSession, base: str, kind: str, schema: T.StructType) -> DataFrame:
    """Rows of ``stream_split_late`` that were ``late`` or ``on_time``, with the batch they came in."""
    stored = T.StructType([*schema.fields, T.StructField("arrival", T.StringType()), T.StructField("batch_id", T.LongType())])
    rows = spark.read.schema(stored).parquet(f"{base}/rows")
    return rows.filter(F.col("arrival") == kind).drop("arrival")


class ProgressLog(StreamingQueryListener):
    """Appends input rows and rows dropped as late of every micro-batch to a table, however long a stream runs.

    Rows are written every ``every`` batches and when a query ends; ``wait`` returns once a query's end is written.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 50):
        self.spark, self.path, self.every = spark, path, every
        self.rows: list[tuple] = []
        self.ended: dict[str, threading.Event] = {}
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:  # noqa: N802 - name given by Spark
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        late = sum(int(s.numRowsDroppedByWatermark) for s in p.stateOperators)
        self.rows.append((str(p.runId), int(p.batchId), int(p.numInputRows), late))
        if len(self.rows) >= self.every:
            self._write()

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._write()
        self.ended.setdefault(str(event.runId), threading.Event()).set()

    def _write(self) -> None:
        if self.rows:
            rows, self.rows = self.rows, []
            self.spark.createDataFrame(rows, PROGRESS_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        if not self.ended.setdefault(str(query.runId), threading.Event()).wait(seconds):
            raise TimeoutError("the end of the query was not reported")

    def close(self) -> None:
        self.spark.streams.removeListener(self)


def progress_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a ``ProgressLog``: run_id, batch_id, input_rows, late_rows."""
    return spark.read.schema(PROGRESS_SCHEMA).parquet(path)
