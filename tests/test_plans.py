"""Physical plans: no Python in the row path, pruned scans, no raw rows in one task."""

import re

import pytest

import __spark_entry__ as contract
from silverlane.operators import aggregates, cleaning, enrichment, metrics, suspicious
from silverlane.plans.views import table, view

QUERIES = contract.queries()
ROW_PATH = [
    "valid_iban", "valid_transaction_row", "suspicious_flags", "categorize_transactions", "date_parts", "parse_money",
    "parse_datetime", "metric_severity", "compliance_check", "storage_tiering",
]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ROW_PATH)
def test_row_operators_do_not_shuffle(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "Exchange hashpartitioning" not in text
    assert "Python" not in text and "Pandas" not in text


def test_scan_reads_only_needed_columns(spark, sf_dir):
    text = plan(aggregates.by_account(view(spark, sf_dir, "txn")))
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in text


def test_filter_reaches_the_scan(spark, sf_dir):
    text = plan(table(spark, sf_dir, "orders").filter("o_totalprice > 1000").select("o_orderkey"))
    assert "GreaterThan(o_totalprice,1000.0)" in text


@pytest.mark.parametrize("name", ["ffill_dates", "amount_percentile", "fill_median", "large_transaction_flag"])
def test_single_task_sees_one_row_per_bucket_only(spark, sf_dir, name):
    """A single-partition exchange may only carry pre-aggregated bucket rows."""
    text = plan(QUERIES[name](spark, sf_dir))
    for match in re.finditer(r"Exchange SinglePartition", text):
        below = text[match.end():match.end() + 400]
        assert re.search(r"(Hash|Sort)Aggregate\(keys?=\[", below)


def test_aggregates_combine_before_the_shuffle(spark, sf_dir):
    text = plan(aggregates.monthly_by_account(
        enrichment.large_transaction_flag(enrichment.categorize_transactions(view(spark, sf_dir, "txn_gaps"))),
        category_map=True))
    assert "partial_sum" in text and text.count("Exchange hashpartitioning") == 1


def test_deduplication_combines_before_the_shuffle(spark, sf_dir):
    text = plan(cleaning.dedupe_business(view(spark, sf_dir, "txn_dirty")))
    assert "HashAggregate" in text and "partial_min" in text


def test_latest_rows_are_cut_before_the_shuffle(spark, sf_dir):
    assert "WindowGroupLimit" in plan(metrics.latest_durations(view(spark, sf_dir, "ops")))
    assert "TakeOrderedAndProject" in plan(metrics.latest_runs(view(spark, sf_dir, "runs")))


def test_no_cross_joins(spark, sf_dir):
    for name in ("amount_percentile", "dq_scorecard", "kpi_snapshot", "enrich_dispatch"):
        text = plan(QUERIES[name](spark, sf_dir))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_sliding_windows_sum_panes_not_rows(spark, sf_dir):
    """Rows reach the first aggregation once; only panes are copied to the windows they lie in."""
    text = plan(QUERIES["window_fraud_alerts"](spark, sf_dir))
    below = text[text.index("Expand"):]
    assert text.count("Expand") == 1 and "partial_sum" in below and "partial_count" in below


def test_sliding_windows_equal_a_plain_count(spark):
    """Rows out of order, on pane borders, without amount, account or time."""
    rows = [(60 * i % 1000 + i % 3, f"A{i % 4}" if i % 11 else None, None if i % 5 == 0 else 1.25 * i) for i in range(400)]
    df = spark.createDataFrame(rows, "s int, account_id string, amount double").selectExpr(
        "CASE WHEN s % 13 > 0 THEN timestamp_seconds(s) END AS timestamp", "account_id", "amount")
    want = {}
    for s, account, amount in rows:
        for start in range(s // 60 * 60 - 240, s // 60 * 60 + 1, 60) if s % 13 else ():
            n, total = want.get((start, account), (0, None))
            want[start, account] = (n + 1, total if amount is None else (total or 0) + amount)
    got = suspicious.window_fraud_alerts(df, max_count=0, max_sum=0).selectExpr(
        "unix_timestamp(window_start) AS start", "account_id", "transaction_count AS n", "total_amount AS total").collect()
    assert {(r["start"], r["account_id"]): (r["n"], r["total"]) for r in got} == want and len(got) == len(want)
