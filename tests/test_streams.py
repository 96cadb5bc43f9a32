"""Late rows kept apart and duplicate removal under a hot key, against plain recomputation."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from silverlane.streaming import jobs

START = datetime(2024, 1, 1)
SCHEMA = "id bigint, ts timestamp, key string"


def _at(minutes: float) -> datetime:
    return START + timedelta(minutes=minutes)


def test_late_rows_are_kept_over_batches(spark, tmp_path):
    batches = [
        [(1, _at(0), "a"), (2, _at(60), "a"), (3, None, "a")],
        [(4, _at(49.9), "a"), (5, _at(50), None), (6, _at(50.1), "b"), (7, _at(10), "b")],
        [(8, None, "b")],
        [(9, _at(50), "b"), (10, _at(200), "c")],
        [(11, _at(189.99), None), (12, _at(190.01), "c")],
    ]
    late, latest = [], None
    for batch in batches:
        if latest is not None:
            late += [i for i, ts, _ in batch if ts is not None and ts <= latest - timedelta(minutes=10)]
        latest = max([ts for _, ts, _ in batch if ts is not None] + [latest or START])
    source = str(tmp_path / "in")
    for batch in batches:
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = jobs.file_stream(spark, source, spark.createDataFrame([], SCHEMA).schema)
        jobs.stream_split_late(
            stream, "ts", "10 minutes", str(tmp_path / "split"), str(tmp_path / "check")).awaitTermination()
    schema = spark.createDataFrame([], SCHEMA).schema
    found = {kind: sorted(r["id"] for r in jobs.arrivals(spark, str(tmp_path / "split"), kind, schema).collect())
             for kind in ("late", "on_time")}
    assert found["late"] == late == [4, 5, 7, 9, 11]
    assert sorted(found["late"] + found["on_time"]) == list(range(1, 13))


def test_replayed_batch_leaves_one_copy(spark, tmp_path):
    process = jobs.late_split_batch(str(tmp_path), "ts", "10 minutes")
    first = spark.createDataFrame([(1, _at(60), "a")], SCHEMA)
    second = spark.createDataFrame([(2, _at(0), "a"), (3, _at(90), "a")], SCHEMA)
    for batch, batch_id in ((first, 0), (second, 1), (second, 1)):
        process(batch, batch_id)
    rows = {kind: [tuple(r) for r in jobs.arrivals(spark, str(tmp_path), kind, first.schema).select("id", "batch_id").collect()]
            for kind in ("late", "on_time")}
    assert rows == {"late": [(2, 1)], "on_time": rows["on_time"]} and sorted(rows["on_time"]) == [(1, 0), (3, 1)]


def test_empty_stream_of_rows_without_time(spark, tmp_path):
    process = jobs.late_split_batch(str(tmp_path), "ts", "10 minutes")
    for batch_id, rows in enumerate(([], [(1, None, None)], [(2, _at(5), None)], [(3, _at(-60), None)])):
        process(spark.createDataFrame(rows, SCHEMA), batch_id)
    schema = spark.createDataFrame([], SCHEMA).schema
    assert [r["id"] for r in jobs.arrivals(spark, str(tmp_path), "late", schema).collect()] == [3]
    assert jobs.arrivals(spark, str(tmp_path), "on_time", schema).count() == 2


def test_hot_key_spreads_and_comes_out_once(spark, tmp_path):
    """One key with 90 % of the rows: the second level sees no more of them than there are input files."""
    rows = spark.range(20_000).select(
        "id", F.lit(START).alias("ts"),
        F.when(F.col("id") % 10 > 0, "hot").when(F.col("id") % 20 > 0, F.col("id").cast("string")).alias("key"))
    source = str(tmp_path / "in")
    rows.repartition(8).write.parquet(source)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        stream = jobs.file_stream(spark, source, rows.schema)
        running = jobs.start_append(
            jobs.stream_dedupe_spread(stream, ["key"], "ts", "1 hour"), str(tmp_path / "out"), str(tmp_path / "check"))
        running.awaitTermination()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    states = sorted(
        max(int(p["stateOperators"][i]["numRowsTotal"]) for p in running.recentProgress) for i in range(2))
    kept = spark.read.parquet(str(tmp_path / "out")).groupBy("key").count().collect()
    assert {r["key"] for r in kept} == {None, "hot", *[str(i) for i in range(10, 20_000, 20)]}
    assert all(r["count"] == 1 for r in kept)
    # One state per key below; above it the hot key and the null key have one per input partition that holds them.
    assert states[0] == len(kept) and len(kept) + 4 < states[1] <= len(kept) + 2 * 64
