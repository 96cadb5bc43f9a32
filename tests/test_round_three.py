"""Fewer scans and cheaper sorts on the way from raw rows to roll-ups, with the same rows."""

import math

from pyspark.sql import functions as F

from silverlane.functions.ordering import exact_quantiles
from silverlane.functions.text import KIND_BITS, value_kind
from silverlane.operators.aggregates import by_category, monthly_by_account
from silverlane.operators.cleaning import dedupe_business


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_medians_are_sought_only_where_values_are_missing(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, None), (9.0, 3.0)], "whole double, gaps double")
    found = exact_quantiles(df, {"whole": 0.5, "gaps": 0.5}, gaps_only=True)
    assert (found["whole"].value, found["whole"].nulls) == (None, 0)
    assert (found["gaps"].value, found["gaps"].nulls) == (2.0, 1)
    assert exact_quantiles(df, {"whole": 0.5})["whole"].value == 2.0


def test_copies_are_sorted_by_a_hash_and_stay_copies(spark):
    rows = [("a", 0.0, 1, "x"), ("a", -0.0, 0, "y"), ("b", math.nan, 2, "z"), ("b", -math.nan, 3, "w"), (None, None, 5, "v"),
            (None, None, 4, "u"), ("a", None, 6, "t")]
    df = spark.createDataFrame(rows, "name string, amount double, _row_seq long, _from string")
    kept = dedupe_business(df)
    assert kept.columns == [*df.columns, "_copies"]
    assert sorted((r._row_seq, r._from, r._copies) for r in kept.collect()) == [(0, "y", 2), (2, "z", 2), (4, "u", 2), (6, "t", 1)]
    assert "Sort [_hash" in plan_of(kept) or "Sort [_groupingexpression" in plan_of(kept)
    plain = dedupe_business(df.drop("_from"))
    assert sorted(plain.columns) == sorted(["name", "amount", "_row_seq", "_copies"]) and plain.count() == 4


def test_exact_amounts_are_made_once_a_row(spark):
    rows = [("1", "Fuel", 0.1), ("1", "Fuel", 0.2), ("2", "Fuel", math.nan), ("2", "Fuel", 1e30), ("2", "Fuel", None)]
    df = spark.createDataFrame(rows, "account_id string, transaction_category string, amount double").withColumns({
        "transaction_date": F.lit("2024-02-03").cast("timestamp_ntz"), "is_large_transaction": F.lit(False)})
    out = by_category(df, left_out=True)
    row = out.first()
    assert (row.amount_sum, row.amount_count, row.account_count, row.amounts_left_out) == (0.3, 4, 2, 2)
    monthly = monthly_by_account(df, category_map=True, left_out=True)
    got = sorted((r.account_id, r.year_month, r.amount_sum, r.category_counts["Fuel"]) for r in monthly.collect())
    assert got == [("1", "2024-02", 0.3, 2), ("2", "2024-02", 0.0, 3)]
    for table in (out, monthly):
        logical = table._jdf.queryExecution().optimizedPlan().toString()
        assert logical.count("as decimal(28,6))") == 1


def test_kinds_of_odd_texts(spark):
    texts = {"": "text", " ": "text", "true": "boolean", " FALSE ": "boolean", "truth": "text", "-5": "integer", "+": "text",
             ".5": "decimal", "2024-01-05": "datetime", "é1": "text", "İ": "text", "1e3": "decimal"}
    df = spark.createDataFrame([(t, KIND_BITS[k]) for t, k in texts.items()], "value string, bit int")
    wrong = df.filter(~value_kind(F.col("value")).eqNullSafe(F.col("bit"))).collect()
    assert wrong == []
