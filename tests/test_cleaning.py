"""Name roles, overrides and order of the cleaning steps."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from silverlane.operators import cleaning
from silverlane.operators.enrichment import balance_category, enrich, features_for

NOW = datetime(2024, 2, 1)


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(
        [
            (0, "a", None, "£1,000.50", None, 1, "2024-01-01", 3),
            (1, "b", "2024-01-02", None, "tea", None, "x", None),
            (2, "b", None, "oops", "tea", 4, "2024-01-03", 5),
            (3, "b", None, "oops", "tea", 4, "2024-01-03", 5),
            (4, None, "bad", "7", "tea", 9, None, 6),
        ],
        "_row_seq bigint, account_id string, booking_date string, amount string, note string, points int, "
        "updated_by string, paid int",
    )


def test_clean_small_frame(raw):
    rows = {r["_row_seq"]: r for r in cleaning.clean(raw, NOW).collect()}
    assert set(rows) == {0, 1, 2, 4}
    assert rows[2]["_copies"] == 2
    assert [rows[i]["amount"] for i in (0, 1, 2, 4)] == [1000.5, 0.0, None, 7.0]
    # the first date has nothing before it; text that is no date is lost after filling
    assert [rows[i]["booking_date"] for i in (0, 1, 2, 4)] == [None, datetime(2024, 1, 2), datetime(2024, 1, 2), None]
    assert rows[0]["note"] == "UNKNOWN" and rows[4]["account_id"] == "UNKNOWN"
    assert rows[1]["points"] == 4.0
    # the name of updated_by has "date" in it, that of paid has "id"
    assert rows[0]["updated_by"] == datetime(2024, 1, 1) and rows[1]["updated_by"] is None
    assert rows[0]["paid"] == "3.0"
    assert rows[2]["_data_quality_score"] == pytest.approx(6 / 7)


def test_overrides_win_over_names(raw):
    kept = cleaning.clean(raw, NOW, overrides={"updated_by": "keep", "paid": "keep"})
    types = dict(kept.dtypes)
    assert types["updated_by"] == "string" and types["paid"] == "int"


def test_stats_count_copies(raw):
    stats = cleaning.cleaning_stats(cleaning.clean(raw, NOW)).first()
    assert (stats["original_rows"], stats["final_rows"], stats["duplicates_removed"]) == (5, 4, 1)


def test_dedupe_keeps_metadata_of_the_first_row(spark):
    frame = spark.createDataFrame(
        [(3, "x", "late"), (1, "x", "early"), (2, None, "n1"), (4, None, "n2")], "_row_seq bigint, a string, _source_file string")
    rows = {r["a"]: (r["_source_file"], r["_row_seq"], r["_copies"]) for r in cleaning.dedupe_business(frame).collect()}
    assert rows == {"x": ("early", 1, 2), None: ("n1", 2, 2)}
    with pytest.raises(ValueError):
        cleaning.dedupe_business(frame.drop("_row_seq"))


def test_features_follow_source_and_columns(spark):
    frame = spark.createDataFrame(
        [(1, "shop", 10.0, datetime(2024, 1, 6))], "_row_seq bigint, description string, amount double, booking_date timestamp_ntz")
    assert features_for(frame, "transactions")[0] == "transaction_category"
    assert "transaction_category" not in features_for(frame, "accounts")
    row = enrich(frame, "transactions", NOW).first()
    assert (row["transaction_category"], row["is_large_transaction"], row["amount_percentile"]) == ("Retail", False, 1.0)
    assert (row["booking_day_of_week"], row["booking_is_weekend"]) == (5, True)


def test_balance_band_edges(spark):
    values = [-1.0, 0.0, 0.01, 1000.0, 1000.01, 10000.0, 50000.0, 50000.01, None]
    frame = spark.createDataFrame([(x,) for x in values], "balance double")
    bands = {r["balance"]: r["balance_category"] for r in balance_category(frame).collect()}
    assert [bands[x] for x in values] == [
        "Negative", "Negative", "Low", "Low", "Medium", "Medium", "High", "Very High", None]


def test_empty_frame(spark, raw):
    empty = raw.filter(F.lit(False))
    assert cleaning.clean(empty, NOW).count() == 0
    assert cleaning.cleaning_stats(cleaning.clean(empty, NOW)).first()["original_rows"] == 0
