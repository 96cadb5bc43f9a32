"""Streaming queries: drain a file stream, then read what it wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from silverlane.functions.rules import ERRORS
from silverlane.operators.validation import transaction_rules
from silverlane.plans.queries_rows import MAX_COUNT, MAX_SUM, SUSPICIOUS_SQL, TRANSACTION_ERRORS_SQL, WINDOW_SQL
from silverlane.plans.registry import query
from silverlane.plans.views import FIN_TXN, ORDERS_TODAY, PAYMENTS, table, with_views
from silverlane.session import work_path
from silverlane.streaming import jobs

LATE_DELAY = "1 hour"


def _stream(spark, sf_dir, name: str, columns: list[tuple[str, str]]):
    schema = table(spark, sf_dir, name).schema
    stream = jobs.file_stream(spark, f"{sf_dir}/{name}.parquet*", schema)
    return stream.selectExpr(*[f"{expression} AS {alias}" for alias, expression in columns])


@query("stream_medallion", with_views(["fin_txn"], """
    SELECT row_seq, errors, suspicious_flags, CASE WHEN errors = '' THEN 'silver' ELSE 'quarantine' END AS layer
    FROM checked JOIN flagged ON row_seq = _row_seq""", checked=TRANSACTION_ERRORS_SQL, flagged=SUSPICIOUS_SQL))
def stream_medallion(spark, sf_dir):
    root = work_path(spark, "stream")
    running = jobs.stream_medallion(
        _stream(spark, sf_dir, "orders", FIN_TXN), transaction_rules(), ORDERS_TODAY, f"{root}/layers",
        f"{root}/checkpoint")
    running.awaitTermination()
    return spark.read.parquet(f"{root}/layers").select(
        F.col("_row_seq").alias("row_seq"), F.concat_ws("|", ERRORS).alias("errors"), "suspicious_flags", "layer")


@query("stream_fraud_windows", with_views(["payments"], """
    SELECT * FROM alerts WHERE window_end <= (SELECT max(timestamp) FROM payments) - INTERVAL 30 SECOND""",
    alerts=WINDOW_SQL))
def stream_fraud_windows(spark, sf_dir):
    """Same windows as the batch form, but for those the watermark has not closed."""
    root = work_path(spark, "stream")
    alerts = jobs.stream_fraud_windows(
        _stream(spark, sf_dir, "events", PAYMENTS), max_count=MAX_COUNT, max_sum=MAX_SUM)
    jobs.start_append(alerts, f"{root}/alerts", f"{root}/checkpoint").awaitTermination()
    found = spark.read.parquet(f"{root}/alerts")
    return found.withColumns({
        name: F.col(name).cast("timestamp_ntz") for name in ("window_start", "window_end")})


@query("stream_late_data", with_views(["payments"], """
    SELECT count(*) AS input_rows, count(*) FILTER (WHERE late) AS late_rows,
        count(*) FILTER (WHERE NOT late) AS accepted_rows
    FROM (SELECT event_id % 5 = 0 AND timestamp < (SELECT max(timestamp) FROM payments WHERE event_id % 5 <> 0)
        - INTERVAL 1 HOUR AS late FROM payments)"""))
def stream_late_data(spark, sf_dir):
    """A fifth of the events arrives after all others; most of it is too late."""
    root = work_path(spark, "stream")
    events = table(spark, sf_dir, "events")
    log = jobs.ProgressLog(spark, f"{root}/progress")
    for held_back in (False, True):
        part = events.filter((F.col("event_id") % 5 == 0) == F.lit(held_back))
        part.write.mode("append").parquet(f"{root}/in")
        stream = jobs.file_stream(spark, f"{root}/in", events.schema)
        kept = jobs.stream_dedupe(stream, ["event_id"], "ts", LATE_DELAY)
        running = jobs.start_append(kept, f"{root}/out", f"{root}/checkpoint")
        running.awaitTermination()
        log.wait(running)
    log.close()
    counted = jobs.progress_rows(spark, f"{root}/progress").agg(
        F.sum("input_rows").alias("input_rows"), F.sum("late_rows").alias("late_rows"))
    accepted = spark.read.parquet(f"{root}/out").agg(F.count(F.lit(1)).alias("accepted_rows"))
    return counted.withColumn("accepted_rows", accepted.scalar())


@query("stream_dedupe", "SELECT event_id, ts, user_id, event_type, value FROM events")
def stream_dedupe(spark, sf_dir):
    """Every third event arrives twice; each comes out once."""
    root = work_path(spark, "stream")
    events = table(spark, sf_dir, "events")
    events.unionByName(events.filter("event_id % 3 = 0")).write.parquet(f"{root}/in")
    stream = jobs.file_stream(spark, f"{root}/in", events.schema)
    kept = jobs.stream_dedupe(stream, ["event_id"], "ts", LATE_DELAY)
    jobs.start_append(kept, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out").select(
        "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value")


@query("stream_dedupe_hot", """
    SELECT DISTINCT CASE WHEN event_id % 10 = 0 THEN event_id ELSE -1 END AS dedupe_key, 1 AS copies FROM events""")
def stream_dedupe_hot(spark, sf_dir):
    """Nine tenths of the events share one key; it comes out once, like every other."""
    root = work_path(spark, "stream")
    keyed = _stream(spark, sf_dir, "events", [
        ("dedupe_key", "CASE WHEN event_id % 10 = 0 THEN event_id ELSE -1 END"), ("ts", "ts")])
    kept = jobs.stream_dedupe_spread(keyed, ["dedupe_key"], "ts", "3650 days")
    jobs.start_append(kept, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out").groupBy("dedupe_key").agg(F.count(F.lit(1)).alias("copies"))


@query("stream_late_rows", """
    SELECT event_id, ts, user_id, event_type, value,
        CASE WHEN event_id % 5 = 0 AND ts <= (SELECT max(ts) FROM events WHERE event_id % 5 <> 0) - INTERVAL 1 HOUR
        THEN 'late' ELSE 'on_time' END AS arrival FROM events""")
def stream_late_rows(spark, sf_dir):
    """A fifth of the events arrives after all others; those too late are kept apart, none is lost."""
    root = work_path(spark, "stream")
    events = table(spark, sf_dir, "events")
    for held_back in (False, True):
        part = events.filter((F.col("event_id") % 5 == 0) == F.lit(held_back))
        part.write.mode("append").parquet(f"{root}/in")
        stream = jobs.file_stream(spark, f"{root}/in", events.schema)
        jobs.stream_split_late(stream, "ts", LATE_DELAY, f"{root}/split", f"{root}/checkpoint").awaitTermination()
    late, on_time = (
        jobs.arrivals(spark, f"{root}/split", kind, events.schema).withColumn("arrival", F.lit(kind))
        for kind in ("late", "on_time"))
    return late.unionByName(on_time).select("event_id", "ts", "user_id", "event_type", "value", "arrival")
