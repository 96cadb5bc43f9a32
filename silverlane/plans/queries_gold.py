"""Enrichment and roll-up queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlane.functions.rules import with_errors
from silverlane.functions.text import CATEGORY_WORDS
from silverlane.operators import aggregates, enrichment
from silverlane.operators.suspicious import suspicious_flags
from silverlane.operators.validation import transaction_rules
from silverlane.plans.queries_rows import SUSPICIOUS_SQL, TRANSACTION_ERRORS_SQL
from silverlane.plans.registry import query
from silverlane.plans.views import ORDERS_AS_OF, view, with_views

_CASES = " ".join(f"WHEN regexp_matches(lower(description), '{'|'.join(words)}') THEN '{c}'" for c, words in CATEGORY_WORDS)
CATEGORY_SQL = f"CASE WHEN description IS NULL THEN 'Unknown' {_CASES} ELSE 'Other' END"

# Rows as the trusted layer would hold them: category and large flag added.
SILVER_SQL = (
    f"SELECT *, {CATEGORY_SQL} AS transaction_category, "
    "coalesce(amount > (SELECT quantile_cont(amount, 0.95) FROM txn_gaps), false) AS large, "
    "CAST(amount AS DECIMAL(28,6)) AS exact FROM txn_gaps"
)
SUM_SQL = "CAST(round(coalesce(sum(exact), 0), 2) AS DOUBLE) AS amount_sum"
MEAN_SQL = "CAST(round(CAST(sum(exact) / count(exact) AS DECIMAL(38,6)), 2) AS DOUBLE) AS amount_mean"


def _silver(spark, sf_dir):
    return enrichment.categorize_transactions(enrichment.large_transaction_flag(view(spark, sf_dir, "txn_gaps")))


def _gold_sql(body: str) -> str:
    return with_views(["txn_gaps"], body, silver=SILVER_SQL)


@query("categorize_transactions", with_views(
    ["txn_gaps"], f"SELECT transaction_id, description, {CATEGORY_SQL} AS transaction_category FROM txn_gaps"))
def categorize_transactions(spark, sf_dir):
    return enrichment.categorize_transactions(view(spark, sf_dir, "txn_gaps")).select(
        "transaction_id", "description", "transaction_category")


@query("large_transaction_flag", _gold_sql(
    "SELECT transaction_id, amount, large AS is_large_transaction FROM silver"))
def large_transaction_flag(spark, sf_dir):
    return enrichment.large_transaction_flag(view(spark, sf_dir, "txn_gaps")).select(
        "transaction_id", "amount", "is_large_transaction")


@query("amount_percentile", with_views(["txn_gaps"], """
    SELECT t.transaction_id, t.amount, r.amount_percentile FROM txn_gaps t LEFT JOIN (
        SELECT amount, (min(place) + max(place)) / 2.0 / (SELECT count(amount) FROM txn_gaps) AS amount_percentile
        FROM (SELECT amount, row_number() OVER (ORDER BY amount) AS place FROM txn_gaps WHERE amount IS NOT NULL)
        GROUP BY amount) r ON t.amount = r.amount"""))
def amount_percentile(spark, sf_dir):
    return enrichment.amount_percentile(view(spark, sf_dir, "txn_gaps")).select(
        "transaction_id", "amount", "amount_percentile")


@query("date_parts", with_views(["txn_gaps"], """
    SELECT transaction_id, CAST(year(transaction_date) AS INTEGER) AS transaction_year,
        CAST(month(transaction_date) AS INTEGER) AS transaction_month,
        CAST(isodow(transaction_date) - 1 AS INTEGER) AS transaction_day_of_week,
        coalesce(isodow(transaction_date) >= 6, false) AS transaction_is_weekend FROM txn_gaps"""))
def date_parts(spark, sf_dir):
    return enrichment.date_parts(view(spark, sf_dir, "txn_gaps")).select(
        "transaction_id", *enrichment.date_part_names("transaction_date"))


@query("balance_category", with_views(["acct"], """
    SELECT account_number, balance, CASE WHEN balance <= 0 THEN 'Negative' WHEN balance <= 1000 THEN 'Low'
        WHEN balance <= 10000 THEN 'Medium' WHEN balance <= 50000 THEN 'High'
        WHEN balance > 50000 THEN 'Very High' END AS balance_category FROM acct"""))
def balance_category(spark, sf_dir):
    return enrichment.balance_category(view(spark, sf_dir, "acct")).select(
        "account_number", "balance", "balance_category")


@query("enrich_dispatch", _gold_sql("""
    SELECT s.transaction_id, s.transaction_category, s.large AS is_large_transaction, r.amount_percentile,
        CAST(year(s.transaction_date) AS INTEGER) AS transaction_year,
        CAST(month(s.transaction_date) AS INTEGER) AS transaction_month,
        CAST(isodow(s.transaction_date) - 1 AS INTEGER) AS transaction_day_of_week,
        coalesce(isodow(s.transaction_date) >= 6, false) AS transaction_is_weekend
    FROM silver s LEFT JOIN (
        SELECT amount, (min(place) + max(place)) / 2.0 / (SELECT count(amount) FROM txn_gaps) AS amount_percentile
        FROM (SELECT amount, row_number() OVER (ORDER BY amount) AS place FROM txn_gaps WHERE amount IS NOT NULL)
        GROUP BY amount) r ON s.amount = r.amount"""))
def enrich_dispatch(spark, sf_dir):
    df = view(spark, sf_dir, "txn_gaps")
    features = enrichment.features_for(df, "transactions")
    return enrichment.enrich(df, "transactions", ORDERS_AS_OF).select("transaction_id", *features)


@query("agg_monthly_by_account", _gold_sql(f"""
    SELECT account_id, strftime(transaction_date, '%Y-%m') AS year_month, {SUM_SQL}, {MEAN_SQL},
        count(amount) AS amount_count, round(stddev_samp(amount), 2) AS amount_std,
        count(*) FILTER (WHERE large) AS large_count
    FROM silver WHERE account_id IS NOT NULL GROUP BY 1, 2"""))
def agg_monthly_by_account(spark, sf_dir):
    return aggregates.monthly_by_account(_silver(spark, sf_dir))


@query("agg_monthly_category_counts", _gold_sql("""
    SELECT account_id, strftime(transaction_date, '%Y-%m') AS year_month, transaction_category,
        count(*) AS transactions
    FROM silver WHERE account_id IS NOT NULL GROUP BY 1, 2, 3"""))
def agg_monthly_category_counts(spark, sf_dir):
    """The counts as the gold table stores them, one map per account and month, read back as rows."""
    monthly = aggregates.monthly_by_account(_silver(spark, sf_dir), category_map=True)
    return monthly.select(
        "account_id", "year_month", F.explode("category_counts").alias("transaction_category", "transactions"))


@query("agg_monthly_category_rows", _gold_sql("""
    SELECT account_id, strftime(transaction_date, '%Y-%m') AS year_month, transaction_category,
        count(*) AS transactions
    FROM silver WHERE account_id IS NOT NULL GROUP BY 1, 2, 3"""))
def agg_monthly_category_rows(spark, sf_dir):
    return aggregates.monthly_category_counts(
        enrichment.categorize_transactions(view(spark, sf_dir, "txn_gaps")))


@query("agg_by_category", _gold_sql(f"""
    SELECT transaction_category, {SUM_SQL}, {MEAN_SQL}, count(amount) AS amount_count,
        round(min(amount), 2) AS amount_min, round(max(amount), 2) AS amount_max,
        count(DISTINCT account_id) AS account_count
    FROM silver GROUP BY 1"""))
def agg_by_category(spark, sf_dir):
    return aggregates.by_category(enrichment.categorize_transactions(view(spark, sf_dir, "txn_gaps")))


@query("agg_daily", _gold_sql(f"""
    SELECT CAST(transaction_date AS DATE) AS day, {SUM_SQL}, {MEAN_SQL}, count(amount) AS amount_count,
        count(DISTINCT account_id) AS account_count, count(*) FILTER (WHERE large) AS large_count
    FROM silver WHERE transaction_date IS NOT NULL GROUP BY 1"""))
def agg_daily(spark, sf_dir):
    return aggregates.daily(_silver(spark, sf_dir))


@query("agg_by_account", _gold_sql(f"""
    SELECT account_id, {SUM_SQL}, count(amount) AS amount_count, round(min(amount), 2) AS amount_min,
        round(max(amount), 2) AS amount_max
    FROM silver WHERE account_id IS NOT NULL GROUP BY 1"""))
def agg_by_account(spark, sf_dir):
    return aggregates.by_account(view(spark, sf_dir, "txn_gaps"))


@query("transaction_totals", with_views(["fin_txn"], """
    SELECT count(*) AS total_transactions, CAST(round(sum(CAST(amount AS DECIMAL(28,6))), 2) AS DOUBLE) AS total_amount,
        CAST(round(CAST(sum(CAST(amount AS DECIMAL(28,6))) / count(*) AS DECIMAL(38,6)), 2) AS DOUBLE) AS average_amount,
        count(suspicious_flags) AS suspicious_transactions,
        count(*) FILTER (WHERE amount > 10000) AS large_transactions FROM flagged""", flagged=SUSPICIOUS_SQL))
def transaction_totals(spark, sf_dir):
    return aggregates.transaction_totals(suspicious_flags(view(spark, sf_dir, "fin_txn")))


@query("kpi_snapshot", with_views(["fin_txn", "ops", "checks"], """
        SELECT 'validation_success_rate' AS kpi, round(avg(CASE WHEN errors = '' THEN 1.0 ELSE 0.0 END), 6) AS value
        FROM checked
        UNION ALL SELECT 'error_rate', round(avg(CASE WHEN errors = '' THEN 0.0 ELSE 1.0 END), 6) FROM checked
        UNION ALL SELECT 'suspicious_transaction_rate', round(count(suspicious_flags) / count(*), 6) FROM flagged
        UNION ALL SELECT 'compliance_check_success_rate', round(avg(CASE WHEN passed THEN 1.0 ELSE 0.0 END), 6)
        FROM checks
        UNION ALL SELECT 'sla_compliance_percent', round(100 * avg(CASE WHEN duration <= 300 THEN 1.0 ELSE 0.0 END), 6)
        FROM ops""", flagged=SUSPICIOUS_SQL, checked=TRANSACTION_ERRORS_SQL))
def kpi_snapshot(spark, sf_dir):
    checked = with_errors(view(spark, sf_dir, "fin_txn"), transaction_rules(), ORDERS_AS_OF)
    kpis = aggregates.kpi_snapshot(
        suspicious_flags(checked), view(spark, sf_dir, "ops"), view(spark, sf_dir, "checks"))
    return kpis.select("kpi", F.round("value", 6).alias("value"))


# Amounts no sum can take: beyond the decimal range, infinite, no number.
_EXTREMES = ("1e25", "'Infinity'", "'-Infinity'", "'NaN'", "-1e22")
_EXTREME = " ".join(f"WHEN _row_seq % 97 = {i} THEN CAST({value} AS DOUBLE)" for i, value in enumerate(_EXTREMES))
_EXTREME = f"CASE {_EXTREME} ELSE amount END"
_LEFT_OUT_SQL = "count(*) FILTER (WHERE NOT isfinite(wild) OR abs(wild) >= 1e22) AS amounts_left_out"


def _report_sql(name: str, key: str, wanted: str) -> str:
    return f"""SELECT '{name}' AS roll_up, {key} AS group_key, {SUM_SQL}, {_LEFT_OUT_SQL} FROM wild
        WHERE {wanted} GROUP BY ALL"""


@query("amounts_left_out", with_views(
    ["txn_gaps"], " UNION ALL ".join([
        _report_sql("by_category", "transaction_category", "true"),
        _report_sql("daily", "strftime(transaction_date, '%Y-%m-%d')", "transaction_date IS NOT NULL"),
        _report_sql("monthly_by_account", "account_id || '|' || coalesce(strftime(transaction_date, '%Y-%m'), '')",
                    "account_id IS NOT NULL"),
        _report_sql("by_account", "account_id", "account_id IS NOT NULL"),
        _report_sql("total", "'all'", "true"),
    ]),
    silver=SILVER_SQL, wild=f"""SELECT * REPLACE (
        CASE WHEN isfinite(wild) AND abs(wild) < 1e22 THEN CAST(wild AS DECIMAL(28,6)) END AS exact)
        FROM (SELECT *, {_EXTREME} AS wild FROM silver)"""))
def amounts_left_out(spark, sf_dir):
    """Every roll-up of amounts shows what its sums leave out."""
    wild = _silver(spark, sf_dir).withColumn("amount", F.expr(_EXTREME))
    tables = aggregates.gold_tables(wild, ORDERS_AS_OF) | {
        "by_account": aggregates.by_account(wild, left_out=True),
        "total": aggregates.transaction_totals(suspicious_flags(wild), left_out=True).withColumnRenamed(
            "total_amount", "amount_sum"),
    }
    keys = {
        "by_category": F.col("transaction_category"), "daily": F.col("day").cast("string"),
        "monthly_by_account": F.concat_ws("|", "account_id", F.coalesce("year_month", F.lit(""))),
        "by_account": F.col("account_id"), "total": F.lit("all"),
    }
    return reduce(DataFrame.unionByName, [
        table.select(F.lit(name).alias("roll_up"), keys[name].alias("group_key"), "amount_sum", "amounts_left_out")
        for name, table in tables.items()])
