"""Sources, stored layers, whole runs, quality edge cases and streams."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from silverlane.functions.rules import Rule, with_errors
from silverlane.operators import metrics, quality, schema
from silverlane.operators.audit import cleanup_manifest, storage_tiering
from silverlane.operators.validation import transaction_rules
from silverlane.plans import pipeline
from silverlane.plans.views import FIN_TXN, ORDERS_TODAY, table
from silverlane.session import work_path
from silverlane.sources import readers, writers
from silverlane.sources.ingest import Source, add_ingest_metadata, ingest_sources
from silverlane.streaming import jobs

AT = datetime(2024, 2, 1, 6)


@pytest.fixture
def files(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    lines = ["account_id,transaction_id,transaction_date,amount,description,transaction_type,balance_after"]
    for i in range(40):
        lines.append(f"ACC00{i % 5},TXN{i:06d},2024-01-{i % 28 + 1:02d},{(i - 5) * 10.5},Tesco Supermarket,DEBIT,{i * 3.25}")
    (folder / "transactions.csv").write_text("\n".join(lines) + "\n")
    accounts = [
        {"account_id": f"ACC00{i}", "current_balance": i * 1000.5, "opening_date": "2020-01-01", "status": "ACTIVE"}
        for i in range(5)
    ]
    (folder / "accounts.json").write_text(json.dumps(accounts))
    (folder / "one.json").write_text(json.dumps(accounts[0]))
    (folder / "number.json").write_text("42")
    return folder


def test_json_document_shapes(spark, files):
    assert readers.scan_json(spark, str(files / "accounts.json")).count() == 5
    assert readers.scan_json(spark, str(files / "one.json")).count() == 1
    with pytest.raises(Exception):
        readers.scan_json(spark, str(files / "number.json")).count()


def test_row_hash_is_stable_and_ignores_metadata(spark, files):
    frame = readers.scan_csv(spark, str(files / "transactions.csv"))
    first = add_ingest_metadata(frame, AT)
    second = add_ingest_metadata(frame, datetime(2025, 1, 1), source_file="elsewhere")
    pick = lambda df: sorted(r[0] for r in df.select("_record_hash").collect())
    assert pick(first) == pick(second)
    order = [r["transaction_id"] for r in first.orderBy("_row_seq").collect()]
    assert order == sorted(order)


def test_failing_sources_do_not_stop_others(spark, files, tmp_path):
    sources = [
        Source("absent", "csv", str(files / "absent.csv")),
        Source("odd", "xml", "x"),
        Source.from_config({"name": "transactions", "type": "csv", "path": str(files / "transactions.csv")}),
    ]
    rows = {r["source_name"]: r for r in ingest_sources(spark, sources, str(tmp_path / "bronze"), AT, "r1").collect()}
    assert rows["absent"]["status"] == rows["odd"]["status"] == "failed"
    assert "Unsupported source type" in rows["odd"]["error"]
    assert rows["transactions"]["rows_ingested"] == 40


def _run(spark, files, base, run_id, **kwargs):
    sources = [
        Source("transactions", "csv", str(files / "transactions.csv")),
        Source("accounts", "json", str(files / "accounts.json")),
    ]
    return pipeline.run_full_pipeline(spark, pipeline.Layout(str(base)), sources, run_id, AT, **kwargs)


def test_full_run_and_repeat(spark, files, tmp_path):
    layout = pipeline.Layout(str(tmp_path / "out"))
    for run_id in ("run-1", "run-1", "run-2"):
        out = _run(spark, files, tmp_path / "out", run_id)
    stages = {r["source_name"]: r for r in out["transformation"].collect()}
    assert stages["transactions"]["status"] == stages["accounts"]["status"] == "success"
    assert (stages["transactions"]["original_rows"], stages["transactions"]["aggregations_created"]) == (40, 3)
    assert out["run"].first()["rows_ingested"] == 45
    # a repeated run replaces what it wrote, another run adds to it
    assert readers.scan_layer(spark, f"{layout.bronze}/transactions").count() == 80
    assert readers.scan_layer(spark, f"{layout.silver}/transactions", "run-1").count() == 40
    assert spark.read.parquet(layout.runs).count() == 2
    gold = readers.scan_layer(spark, f"{layout.gold}/by_category/transactions", "run-2").collect()
    assert [(r["transaction_category"], r["amount_count"], r["account_count"]) for r in gold] == [("Grocery", 40, 5)]
    checks = {(r["source_name"], r["check"]): r["passed"] for r in out["data_quality"].collect()}
    # raw rows meet the schema found in them
    assert checks["transactions", "schema_validation"] and checks["accounts", "schema_validation"]


def test_fail_on_error_marks_the_source(spark, files, tmp_path):
    plan = pipeline.QualityPlan(rules=[Rule("never", "amount", "greater_than", {"value": 1e9})], fail_on_error=True)
    out = _run(spark, files, tmp_path / "out", "r", plans={"transactions": plan})
    rows = {r["source_name"]: r for r in out["transformation"].collect()}
    assert rows["transactions"]["status"] == "failed"
    assert "Data quality validation failed" in rows["transactions"]["error"]
    assert rows["accounts"]["status"] == "success"
    assert out["run"].first()["status"] == "failed"


def test_no_landed_source_fails_the_run(spark, tmp_path):
    out = pipeline.run_full_pipeline(
        spark, pipeline.Layout(str(tmp_path)), [Source("gone", "csv", str(tmp_path / "gone"))], "r", AT)
    assert out["run"].first()["status"] == "failed"
    assert "transformation" not in out


def test_evolving_columns_are_merged_across_runs(spark, tmp_path):
    base = str(tmp_path)
    writers.write_layer(spark.range(3).withColumn("a", F.lit("x")), base, "s", AT, "r1")
    writers.write_layer(spark.range(2).withColumns({"a": F.lit("x"), "b": F.lit(1)}), base, "s", AT, "r2")
    merged = readers.scan_layer(spark, f"{base}/s")
    assert "b" in merged.columns and merged.count() == 5
    assert "b" not in readers.scan_layer(spark, f"{base}/s", "r1").columns


def test_cleanup_manifest_counts_old_files(spark, files):
    listed = readers.list_files(spark, str(files))
    assert cleanup_manifest(listed, datetime(2099, 1, 1)).first()["files"] == 4
    assert cleanup_manifest(listed, datetime(2000, 1, 1)).first()["files"] == 0


def test_missing_file_gets_its_path_hash(spark, files):
    prints = readers.file_fingerprints(spark, str(files))
    wanted = spark.createDataFrame([(prints.first()["path"],), ("gone.csv",)], "source_file string")
    found = {r["source_file"]: r["source_hash"] for r in readers.fingerprint_or_path_hash(wanted, prints).collect()}
    import hashlib
    assert found["gone.csv"] == hashlib.sha256(b"gone.csv").hexdigest()
    assert found[prints.first()["path"]] == prints.first()["file_hash"]


# ---- quality ----

def test_no_rules_and_empty_frame(spark):
    frame = spark.createDataFrame([], "a string, amount double")
    card = {r["check"]: r["score"] for r in quality.scorecard(frame, [], None, AT).collect()}
    assert card == {} or card["business_rules"] == 1.0
    results = quality.business_rule_results(frame, [Rule("r", "a", "not_null")]).first()
    assert (results["score"], results["passed"]) == (0.0, False)
    assert quality.duplicates(frame).first()["duplicate_rate"] == 0.0


def test_batch_quarantine_takes_all_or_nothing(spark):
    frame = spark.createDataFrame([("x",), (None,)], "a string")
    rules = [Rule("a:not_null", "a", "not_null")]
    assert quality.quarantine_rows(with_errors(frame, rules), "batch").count() == 2
    assert quality.quarantine_rows(with_errors(frame.filter("a is not null"), rules), "batch").count() == 0
    assert quality.quarantine_rows(with_errors(frame, rules), "row").count() == 1


def test_structural_mismatch_fails_every_row(spark):
    frame = spark.createDataFrame([("x", 1.0), ("y", 2.0)], "a string, amount double")
    fields = [{"field": "amount", "dtype": "int64", "nullable": False, "min_value": None, "max_value": None, "max_length": None}]
    assert quality.schema_check(frame, fields).first()["failed_rows"] == 2
    assert schema.schema_errors(frame, fields).first()["_errors"] == ["amount:dtype"]
    assert schema.validate_schema(frame, None).first()["check"] == "missing"


def test_unparsable_dates_are_left_out_of_freshness(spark):
    frame = spark.createDataFrame([("2024-01-31", "2024-01-01"), ("2024-01-30", "soon")], "a_date string, b_date string")
    rows = {r["column"]: (r["days_since_latest"], r["passed"]) for r in quality.freshness_business(frame, AT).collect()}
    assert rows == {"a_date": (1, True)}


# ---- runs ----

@pytest.mark.parametrize("statuses, expected", [
    ([], "unknown"), (["completed"] * 10, "healthy"), (["completed"] * 8 + ["failed"] * 2, "warning"),
    (["completed"] + ["failed"] * 2, "critical"),
])
def test_health(spark, statuses, expected):
    rows = [(f"r{i:02d}", s, datetime(2024, 1, 31, 12, i)) for i, s in enumerate(statuses)]
    runs = spark.createDataFrame(rows, "run_id string, status string, timestamp timestamp_ntz")
    assert metrics.pipeline_health(runs, AT).first()["status"] == expected
    if statuses:
        assert metrics.pipeline_health(runs, datetime(2024, 3, 1)).first()["status"] == "stale"


def test_storage_classes(spark):
    rows = [("bronze", datetime(2024, 1, 31)), ("bronze", datetime(2023, 12, 1)), ("silver", datetime(2020, 1, 1)),
            ("bronze", datetime(2010, 1, 1)), ("other", datetime(2010, 1, 1))]
    frame = spark.createDataFrame(rows, "layer string, modified_at timestamp_ntz")
    assert [r["storage_class"] for r in storage_tiering(frame, AT).collect()] == [
        "STANDARD", "STANDARD_IA", "GLACIER", "EXPIRED", "STANDARD"]


# ---- streams ----

def test_replayed_batch_leaves_one_copy(spark, sf_dir, tmp_path):
    rows = table(spark, sf_dir, "orders").selectExpr(*[f"{e} AS {n}" for n, e in FIN_TXN])
    process = jobs.medallion_batch(transaction_rules(), ORDERS_TODAY, str(tmp_path))
    for batch_id in (0, 1, 1):
        process(rows, batch_id)
    assert spark.read.parquet(str(tmp_path)).count() == 2 * rows.count()


def test_medallion_restarts_where_it_stopped(spark, sf_dir):
    root = work_path(spark, "restart")
    events = table(spark, sf_dir, "orders").selectExpr(*[f"{e} AS {n}" for n, e in FIN_TXN])
    events.limit(100).write.mode("append").parquet(f"{root}/in")
    for expected in (100, 150):
        stream = jobs.file_stream(spark, f"{root}/in", events.schema)
        jobs.stream_medallion(stream, transaction_rules(), date(2001, 8, 3), f"{root}/out", f"{root}/cp").awaitTermination()
        assert spark.read.parquet(f"{root}/out").count() == expected
        events.limit(50).write.mode("append").parquet(f"{root}/in")
