"""Cleaning queries on rows with faults."""

from __future__ import annotations

from pyspark.sql import functions as F

from silverlane.operators import cleaning
from silverlane.plans.registry import query
from silverlane.plans.views import ORDERS_AS_OF, view, with_views

BUSINESS = ("account_id", "transaction_id", "transaction_date", "amount", "description", "transaction_type",
            "balance_after", "risk_points", "branch_id")
_SO_FAR = "OVER (ORDER BY _row_seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_CARRIED = f"last_value(transaction_date IGNORE NULLS) {_SO_FAR}"
_MONEY = "TRY_CAST(regexp_replace({0}, '[£$€,]', '', 'g') AS DOUBLE)"
_DATE = "CAST(try_strptime({0}, '%Y-%m-%d') AS TIMESTAMP)"

FILLED_SQL = f"""SELECT account_id, transaction_id, {_CARRIED} AS transaction_date, coalesce(amount, '0') AS amount,
    coalesce(description, 'UNKNOWN') AS description, transaction_type, coalesce(balance_after, 0) AS balance_after,
    coalesce(risk_points, (SELECT median(risk_points) FROM txn_dirty)) AS risk_points, branch_id, _row_seq
    FROM txn_dirty"""
TYPED_SQL = f"""SELECT account_id, transaction_id, {_DATE.format('transaction_date')} AS transaction_date,
    {_MONEY.format('amount')} AS amount, description, transaction_type, balance_after, risk_points,
    CAST(branch_id AS VARCHAR) AS branch_id, _row_seq FROM filled"""
_KEYS = ", ".join(BUSINESS)
_PRESENT = " + ".join(f"CASE WHEN {name} IS NULL THEN 0 ELSE 1 END" for name in BUSINESS)
CLEAN_SQL = f"""SELECT {_KEYS}, min(_row_seq) AS row_seq, count(*) AS copies,
    round(({_PRESENT}) / 9.0, 6) AS quality_score FROM typed GROUP BY ALL"""


def clean_sql(body: str) -> str:
    return with_views(["txn_dirty"], body, filled=FILLED_SQL, typed=TYPED_SQL, cleaned=CLEAN_SQL)


def _dirty(spark, sf_dir):
    return view(spark, sf_dir, "txn_dirty")


@query("null_profile", with_views(["txn_dirty"], " UNION ALL ".join(
    f"SELECT '{name}' AS \"column\", count(*) AS null_count FROM txn_dirty WHERE {name} IS NULL HAVING count(*) > 0"
    for name in BUSINESS)))
def null_profile(spark, sf_dir):
    return cleaning.null_profile(_dirty(spark, sf_dir))


@query("fill_money_zero", with_views(["txn_dirty"], """
    SELECT _row_seq AS row_seq, CASE WHEN amount IS NULL THEN '0' ELSE amount END AS amount,
        CASE WHEN balance_after IS NULL THEN 0.0 ELSE balance_after END AS balance_after FROM txn_dirty"""))
def fill_money_zero(spark, sf_dir):
    return cleaning.fill_money_zero(_dirty(spark, sf_dir)).select(
        F.col("_row_seq").alias("row_seq"), "amount", "balance_after")


@query("ffill_dates", with_views(
    ["txn_dirty"], f"SELECT _row_seq AS row_seq, {_CARRIED} AS transaction_date FROM txn_dirty"))
def ffill_dates(spark, sf_dir):
    return cleaning.fill_dates_forward(_dirty(spark, sf_dir)).select(
        F.col("_row_seq").alias("row_seq"), "transaction_date")


@query("fill_text_unknown", with_views(["txn_dirty"], """
    SELECT _row_seq AS row_seq, CASE WHEN description IS NULL THEN 'UNKNOWN' ELSE description END AS description
    FROM txn_dirty"""))
def fill_text_unknown(spark, sf_dir):
    return cleaning.fill_text_unknown(_dirty(spark, sf_dir)).select(F.col("_row_seq").alias("row_seq"), "description")


@query("fill_median", with_views(["txn_dirty"], """
    SELECT _row_seq AS row_seq, coalesce(risk_points, (SELECT median(risk_points) FROM txn_dirty)) AS risk_points,
        branch_id FROM txn_dirty"""))
def fill_median(spark, sf_dir):
    return cleaning.fill_median(_dirty(spark, sf_dir)).select(
        F.col("_row_seq").alias("row_seq"), "risk_points", "branch_id")


@query("parse_money", with_views(["txn_dirty"], f"""
    SELECT _row_seq AS row_seq, {_MONEY.format('amount')} AS amount, balance_after FROM txn_dirty"""))
def parse_money(spark, sf_dir):
    return cleaning.parse_money(_dirty(spark, sf_dir)).select(
        F.col("_row_seq").alias("row_seq"), "amount", "balance_after")


@query("parse_datetime", with_views(["txn_dirty"], f"""
    SELECT _row_seq AS row_seq, {_DATE.format('transaction_date')} AS transaction_date FROM txn_dirty"""))
def parse_datetime(spark, sf_dir):
    return cleaning.parse_datetimes(_dirty(spark, sf_dir)).select(
        F.col("_row_seq").alias("row_seq"), "transaction_date")


@query("date_parse_stats", with_views(["txn_dirty"], f"""
    SELECT 'transaction_date' AS "column", count({_DATE.format('transaction_date')}) AS parsed,
        count(*) FILTER (WHERE {_DATE.format('transaction_date')} IS NULL) AS failed FROM filled""",
    filled=FILLED_SQL))
def date_parse_stats(spark, sf_dir):
    return cleaning.date_parse_stats(cleaning.fill_dates_forward(_dirty(spark, sf_dir)))


@query("cast_ids", with_views(["txn_dirty"], """
    SELECT _row_seq AS row_seq, account_id, transaction_id, CAST(branch_id AS VARCHAR) AS branch_id FROM txn_dirty"""))
def cast_ids(spark, sf_dir):
    return cleaning.cast_ids(_dirty(spark, sf_dir)).select(
        F.col("_row_seq").alias("row_seq"), "account_id", "transaction_id", "branch_id")


@query("dedupe_business", with_views(["txn_dirty"], f"""
    SELECT {_KEYS}, _row_seq AS row_seq, copies FROM (
        SELECT *, row_number() OVER (PARTITION BY {_KEYS} ORDER BY _row_seq) AS place,
            count(*) OVER (PARTITION BY {_KEYS}) AS copies FROM txn_dirty) WHERE place = 1"""))
def dedupe_business(spark, sf_dir):
    kept = cleaning.dedupe_business(_dirty(spark, sf_dir))
    return kept.select(*BUSINESS, F.col("_row_seq").alias("row_seq"), F.col("_copies").alias("copies"))


@query("row_quality_score", with_views(["txn_dirty"], f"""
    SELECT _row_seq AS row_seq, round(({_PRESENT}) / 9.0, 6) AS quality_score FROM txn_dirty"""))
def row_quality_score(spark, sf_dir):
    return cleaning.row_quality_score(_dirty(spark, sf_dir)).select(
        F.col("_row_seq").alias("row_seq"), F.round("_data_quality_score", 6).alias("quality_score"))


@query("cleaning_stats", clean_sql("""
    SELECT CAST(sum(copies) AS BIGINT) AS original_rows, count(*) AS final_rows,
        CAST(sum(copies - 1) AS BIGINT) AS duplicates_removed,
        round(sum(quality_score) / count(*), 4) AS average_score FROM cleaned"""))
def cleaning_stats(spark, sf_dir):
    stats = cleaning.cleaning_stats(cleaning.clean(_dirty(spark, sf_dir), ORDERS_AS_OF))
    return stats.withColumn("average_score", F.round("average_score", 4))


@query("clean_transactions", clean_sql("SELECT * FROM cleaned"))
def clean_transactions(spark, sf_dir):
    """The whole raw-to-trusted step: fill, convert, deduplicate and score."""
    cleaned = cleaning.clean(_dirty(spark, sf_dir), ORDERS_AS_OF)
    return cleaned.select(
        *BUSINESS, F.col("_row_seq").alias("row_seq"), F.col("_copies").alias("copies"),
        F.round("_data_quality_score", 6).alias("quality_score"))


@query("parse_account_dates", with_views(["acct"], """
    SELECT account_id, TIMESTAMP '2020-01-01' AS created_date, TIMESTAMP '2024-01-31 12:30:00.5' AS last_updated
    FROM acct"""))
def parse_account_dates(spark, sf_dir):
    """Dates with and without a time and a zone; none is lost."""
    accounts = view(spark, sf_dir, "acct").select("account_id", "created_date", "last_updated")
    return cleaning.parse_datetimes(accounts)
