"""Behaviour that plain fixtures do not show: odd money, odd CSV, odd dates, hot keys, failing checks."""

from __future__ import annotations

import hashlib
from datetime import date, datetime

from pyspark.sql import functions as F

from silverlane.columns import money_misfits
from silverlane.functions.rules import Rule, predicate
from silverlane.functions.skew import attach_by_key, hot_limit
from silverlane.functions.text import datetime_from_text
from silverlane.operators import aggregates, cleaning, enrichment
from silverlane.plans import pipeline
from silverlane.plans.registry import QUERIES, load_all
from silverlane.sources import readers, writers
from silverlane.streaming import jobs
from silverlane.sources.ingest import Source, ingest_sources

AT = datetime(2024, 2, 1, 6)
load_all()


def test_money_is_rounded_after_adding(spark):
    amounts = [0.004] * 1000 + [1e17, float("nan"), float("inf"), 1e30, None]
    df = spark.createDataFrame([("a", x) for x in amounts], "account_id string, amount double")
    row = aggregates.by_account(df).first()
    assert (row["amount_sum"], row["amount_count"]) == (1e17 + 4.0, 1004)
    small = aggregates.by_account(df.filter("amount < 1")).first()
    assert small["amount_sum"] == 4.0
    assert df.agg(money_misfits(F.col("amount"))).first()[0] == 3


def test_rules_read_text_as_money(spark):
    df = spark.createDataFrame([("£12.50",), ("bad",), ("-3",), (None,), ("1,000",)], "amount string")
    for rule, want in (
        (Rule("a", "amount", "greater_than", {"value": 0}), [True, False, False, False, True]),
        (Rule("b", "amount", "between", {"min_value": -5, "max_value": 20}), [True, False, True, False, False]),
        (Rule("c", "amount", "abs_less_than", {"value": 5}, nullable=True), [False, False, True, True, False]),
    ):
        assert [r[0] for r in df.select(predicate(rule, df.schema)).collect()] == want


def test_csv_round_trip(spark, tmp_path):
    rows = [(1, 'say "hi", ok'), (2, "two\nlines"), (3, ""), (4, None), (5, '"'), (6, "a\\b"), (7, 'x",""y')]
    df = spark.createDataFrame(rows, "id long, text string")
    writers.export_csv(df, str(tmp_path / "out"))
    back = readers.scan_csv(spark, str(tmp_path / "out"), "id long, text string", multi_line=True)
    assert sorted(map(tuple, back.collect())) == [(i, text or None) for i, text in rows]  # an empty field is null


def test_rejected_lines_are_kept_and_counted(spark, tmp_path):
    (tmp_path / "in.csv").write_text('id,text,amount\n1,"say ""hi"", ok",7\n3,ok,7,EXTRA\n4,ok,abc\n5,ok,9\n')
    source = Source("s", "csv", str(tmp_path / "in.csv"), "id long, text string, amount double")
    out = ingest_sources(spark, [source], str(tmp_path / "b"), AT, "r", rejects=str(tmp_path / "rejected")).first()
    assert (out["rows_ingested"], out["rows_rejected"], out["status"]) == (2, 2, "success")
    landed = readers.scan_layer(spark, f"{tmp_path}/b/s").select("id", "text", "amount").collect()
    assert sorted(map(tuple, landed)) == [(1, 'say "hi", ok', 7.0), (5, "ok", 9.0)]
    rejected = {(r["record"], r["reason"]) for r in spark.read.parquet(f"{tmp_path}/rejected/s").collect()}
    assert rejected == {("3,ok,7,EXTRA", "too_many_fields"), ("4,ok,abc", "missing_or_unreadable_field")}


def test_date_shapes(spark):
    shapes = {
        "2020-01-01T00:00:00Z": datetime(2020, 1, 1), "2024-01-31T12:30:00.5+00:00": datetime(2024, 1, 31, 12, 30, 0, 500000),
        "2024-01-31T12:30:00+02:00": datetime(2024, 1, 31, 10, 30), "2024-01-01 10:00": datetime(2024, 1, 1, 10),
        "2024-01-01 10:00:07": datetime(2024, 1, 1, 10, 0, 7), "15/02/2024": datetime(2024, 2, 15), "3/4/2024": datetime(2024, 3, 4),
        "2024/1/2": datetime(2024, 1, 2), "20240102": datetime(2024, 1, 2), "not a date": None, "2024-13-01": None,
    }
    df = spark.createDataFrame([(s,) for s in shapes], "s string")
    assert {r["s"]: r["d"] for r in df.select("s", datetime_from_text(F.col("s")).alias("d")).collect()} == shapes


def test_hot_and_null_keys_are_not_shuffled(spark):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id"))).alias("k"), "id")
    facts = df.filter("k IS NOT NULL").groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    out = attach_by_key(df, facts, "k", 20_000, ["top"])
    want = {r["k"]: r["top"] for r in facts.collect()}
    rows = out.collect()
    assert len(rows) == 20_000 and all(r["top"] == want.get(r["k"]) for r in rows)
    assert hot_limit(df, 20_000) < 6666


def test_a_broken_check_does_not_stop_the_run(spark, tmp_path, monkeypatch):
    (tmp_path / "in.csv").write_text("account_id,amount\nACC1,£12.50\nACC2,bad\n")

    def broken(*_args, **_kwargs):
        raise ValueError("no card")

    layout = pipeline.Layout(str(tmp_path / "out"))
    sources = [Source("transactions", "csv", str(tmp_path / "in.csv"))]
    plans = {"transactions": pipeline.QualityPlan(rules=[Rule("p", "amount", "greater_than", {"value": 0})])}
    out = pipeline.run_full_pipeline(spark, layout, sources, "r1", AT, plans)
    score = {r["check"]: r["score"] for r in out["data_quality"].collect()}
    assert score["business_rules"] == 0.5 and out["run"].count() == 1
    monkeypatch.setattr(pipeline, "stored_fields", broken)
    out = pipeline.run_full_pipeline(spark, layout, sources, "r2", AT, plans)
    assert [tuple(r) for r in out["data_quality"].collect()] == [("transactions", None, "overall", 0.0, False)]
    assert out["run"].count() == 1


def test_drift_against_the_run_before(spark, tmp_path):
    layout = pipeline.Layout(str(tmp_path / "out"))
    for run, text in (("r1", "account_id,amount\nACC1,5\nACC2,6\n"), ("r2", "account_id,amount\nACC1,5000\n,6\n")):
        (tmp_path / f"{run}.csv").write_text(text)
        at = datetime(2024, 2, 1 if run == "r1" else 2)
        out = pipeline.run_full_pipeline(spark, layout, [Source("s", "csv", str(tmp_path / f"{run}.csv"))], run, at)
        passed = {r["check"]: r["passed"] for r in out["data_quality"].collect()}
        assert passed["schema_validation"] == (run == "r1")


def test_long_files_are_hashed_in_pieces(spark, tmp_path):
    data = bytes(range(256)) * 40
    (tmp_path / "f.bin").write_bytes(data)
    whole = {r["length"]: r["file_hash"] for r in readers.file_fingerprints(spark, str(tmp_path)).collect()}
    assert whole == {len(data): hashlib.sha256(data).hexdigest()}
    parts = b"".join(hashlib.sha256(data[i : i + 4000]).digest() for i in range(0, len(data), 4000))
    cut = {r["length"]: r["file_hash"] for r in readers.file_fingerprints(spark, str(tmp_path), piece_bytes=4000).collect()}
    assert cut[len(data)] == hashlib.sha256(parts).hexdigest()


def test_late_rows_are_counted_over_all_batches(spark, tmp_path):
    """More batches than Spark keeps in memory."""
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        for i in range(9):  # one file per batch, an hour apart; the late row of a file is a day behind
            rows = [(i, datetime(2024, 1, 5, i), 1.0), (100 + i, datetime(2024, 1, 3, i), 1.0)]
            df = spark.createDataFrame(rows, "event_id long, ts timestamp, value double").coalesce(1)
            df.write.mode("append").parquet(str(tmp_path / "in"))
        log = jobs.ProgressLog(spark, str(tmp_path / "progress"), every=2)
        stream = jobs.file_stream(spark, str(tmp_path / "in"), df.schema, files_per_trigger=1)
        kept = jobs.stream_dedupe(stream, ["event_id"], "ts", "10 minutes")
        query = jobs.start_append(kept, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
        query.awaitTermination()
        log.wait(query)
        log.close()
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    row = jobs.progress_rows(spark, str(tmp_path / "progress")).agg(
        F.sum("input_rows").alias("rows"), F.sum("late_rows").alias("late")).first()
    # Lateness is judged by the watermark of two batches before, so the late rows of the first two files pass.
    assert (row["rows"], row["late"]) == (18, 7)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 11


def test_today_is_asked_for_every_batch(spark, tmp_path):
    days = iter([date(2024, 1, 1), date(2024, 1, 2)])
    rule = Rule("d", "transaction_date", "transaction_date")
    run = jobs.medallion_batch([rule], lambda: next(days), str(tmp_path))
    batch = spark.createDataFrame([("2024-01-02", 5.0)], "transaction_date string, amount double")
    run(batch, 0)
    run(batch, 1)
    layers = {r["batch_id"]: r["layer"] for r in spark.read.parquet(str(tmp_path)).collect()}
    assert layers == {0: "quarantine", 1: "silver"}


def test_nan_is_a_missing_amount(spark):
    rows = [(float(i),) for i in range(1, 21)] + [(float("nan"),), (None,)]
    df = spark.createDataFrame(rows, "amount double")
    flagged = enrichment.large_transaction_flag(df).filter("is_large_transaction").collect()
    assert [r["amount"] for r in flagged] == [20.0]
    ranks = {r["amount"]: r["amount_percentile"] for r in enrichment.amount_percentile(df.filter("amount <= 20")).collect()}
    assert ranks[20.0] == 1.0
    filled = cleaning.fill_money_zero(df).filter("amount = 0").count()
    assert filled == 2


def test_fingerprints_cover_every_customer(spark, tmp_path):
    keys = [*range(1, 400), *range(100_000, 100_400), 250_000]
    rows = [(k, f"Customer#{k}" if k % 50 else None, k % 3) for k in keys]
    df = spark.createDataFrame(rows, "c_custkey long, c_name string, c_nationkey int").repartition(5)
    df.write.parquet(str(tmp_path / "customer.parquet"))
    want = {}
    for key, name, nation in rows:
        want[nation, key // 100_000] = want.get((nation, key // 100_000), "") + (name or "") + "\n"
    found = QUERIES["file_fingerprint_all"](spark, str(tmp_path)).collect()
    assert {(r["c_nationkey"], r["key_range"]): (r["length"], r["file_hash"]) for r in found} == {
        file: (len(text), hashlib.sha256(text.encode()).hexdigest()) for file, text in want.items()}
