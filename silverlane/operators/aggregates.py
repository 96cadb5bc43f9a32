"""Trusted layer -> rolled-up layer."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlane.columns import LEFT_OUT, MONEY_TYPE, money_count, money_mean, money_misfits, money_sum, ratio, to_pence
from silverlane.functions.text import CATEGORY_WORDS

LARGE_TOTAL = 10_000
CATEGORIES = tuple(name for name, _ in CATEGORY_WORDS) + ("Other", "Unknown")


def _with_exact(df: DataFrame) -> DataFrame:
    """The amount as an exact number in ``_exact``: made once a row, as that costs more than adding it."""
    return df.withColumn("_exact", F.col("amount").try_cast(MONEY_TYPE))


def _amount_totals() -> list[Column]:
    """Of a frame of ``_with_exact``."""
    amount, exact = F.col("amount"), F.col("_exact")
    return [
        money_sum(exact).alias("_total"), money_count(exact).alias("_added"), F.count(amount).alias("amount_count"),
        F.count_if(amount.isNotNull() & exact.isNull()).alias(LEFT_OUT),
    ]


def _shown(left_out: bool) -> list[str]:
    """The column a roll-up ends with when it shows how many amounts its sums leave out."""
    return [LEFT_OUT] if left_out else []


def _amount_columns() -> list[Column]:
    return [
        to_pence(F.col("_total")).alias("amount_sum"),
        money_mean(F.col("_total"), F.col("_added")).alias("amount_mean"),
        F.col("amount_count"),
    ]


def month_of(column: str = "transaction_date") -> Column:
    return F.date_format(column, "yyyy-MM")


def monthly_by_account(df: DataFrame, category_map: bool = False, left_out: bool = False) -> DataFrame:
    """Amount statistics per account and month.

    A missing date forms its own month; a missing account is dropped. The
    category counts come from the same aggregation, one counter per known
    category, so the map costs no second shuffle.
    """
    measures = [
        *_amount_totals(),
        F.round(F.stddev_samp("amount"), 2).alias("amount_std"),
        F.count_if("is_large_transaction").alias("large_count"),
    ]
    if category_map:
        measures += [F.count_if(F.col("transaction_category") == name).alias(f"_n_{name}") for name in CATEGORIES]
    moment = isinstance(df.schema["transaction_date"].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType))
    month = F.trunc("transaction_date", "month") if moment else month_of()  # formatted once a group
    grouped = (
        _with_exact(df.filter(F.col("account_id").isNotNull()))
        .groupBy("account_id", month.alias("_month"))
        .agg(*measures)
    )
    shown = month_of("_month") if moment else F.col("_month")
    columns = ["account_id", shown.alias("year_month"), *_amount_columns(), "amount_std", "large_count"]
    if category_map:
        entries = F.array(*[F.struct(F.lit(n).alias("k"), F.col(f"_n_{n}").alias("v")) for n in CATEGORIES])
        columns.append(F.map_from_entries(F.filter(entries, lambda e: e["v"] > 0)).alias("category_counts"))
    return grouped.select(*columns, *_shown(left_out))


def monthly_category_counts(df: DataFrame) -> DataFrame:
    """Rows per account, month and category, the long form of ``category_counts``."""
    return (
        df.filter(F.col("account_id").isNotNull() & F.col("transaction_category").isNotNull())
        .groupBy("account_id", month_of().alias("year_month"), "transaction_category")
        .agg(F.count(F.lit(1)).alias("transactions"))
    )


def by_category(df: DataFrame, approximate_accounts: bool = False, left_out: bool = False) -> DataFrame:
    """Amount statistics and distinct accounts per category."""
    accounts = F.approx_count_distinct("account_id") if approximate_accounts else F.count_distinct("account_id")
    return (
        _with_exact(df.filter(F.col("transaction_category").isNotNull()))
        .groupBy("transaction_category")
        .agg(
            *_amount_totals(), F.min("amount").alias("_min"), F.max("amount").alias("_max"),
            accounts.alias("account_count"),
        )
        .select(
            "transaction_category", *_amount_columns(),
            F.round("_min", 2).alias("amount_min"), F.round("_max", 2).alias("amount_max"), "account_count",
            *_shown(left_out),
        )
    )


def daily(df: DataFrame, left_out: bool = False) -> DataFrame:
    """Amount statistics, distinct accounts and large count per calendar day."""
    large = F.count_if("is_large_transaction") if "is_large_transaction" in df.columns else F.count(F.lit(1))
    return (
        _with_exact(df.filter(F.col("transaction_date").isNotNull()))
        .groupBy(F.to_date("transaction_date").alias("day"))
        .agg(*_amount_totals(), F.count_distinct("account_id").alias("account_count"), large.alias("large_count"))
        .select("day", *_amount_columns(), "account_count", "large_count", *_shown(left_out))
    )


def by_account(df: DataFrame, left_out: bool = False) -> DataFrame:
    """Sum, count, smallest and largest amount per account."""
    return (
        _with_exact(df.filter(F.col("account_id").isNotNull()))
        .groupBy("account_id")
        .agg(*_amount_totals(), F.min("amount").alias("_min"), F.max("amount").alias("_max"))
        .select(
            "account_id", to_pence(F.col("_total")).alias("amount_sum"), "amount_count",
            F.round("_min", 2).alias("amount_min"), F.round("_max", 2).alias("amount_max"), *_shown(left_out),
        )
    )


def transaction_totals(flagged: DataFrame, left_out: bool = False) -> DataFrame:
    """Volume, value, suspicious and large counts of a flagged frame, in one row."""
    totals = flagged.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        money_sum(F.col("amount")).alias("_total"),
        F.count("suspicious_flags").alias("suspicious_transactions"),
        F.count_if(F.col("amount") > LARGE_TOTAL).alias("large_transactions"),
        money_misfits(F.col("amount")).alias(LEFT_OUT),
    )
    return totals.select(
        "total_transactions", to_pence(F.col("_total")).alias("total_amount"),
        F.coalesce(money_mean(F.col("_total"), F.col("total_transactions")), F.lit(0.0)).alias("average_amount"),
        "suspicious_transactions", "large_transactions", *_shown(left_out),
    )


def kpi_snapshot(flagged: DataFrame, operations: DataFrame, checks: DataFrame, sla_seconds: float = 300) -> DataFrame:
    """Key figures as (kpi, value) rows.

    ``flagged`` has ``_errors`` and ``suspicious_flags`` per transaction,
    ``operations`` a ``duration`` per run step, ``checks`` a ``passed`` flag per
    compliance check.
    """
    def rows(frame: DataFrame, **figures: Column) -> DataFrame:
        wide = frame.agg(*[figure.alias(name) for name, figure in figures.items()])
        pairs = [F.struct(F.lit(name).alias("kpi"), F.col(name).alias("value")) for name in figures]
        return wide.select(F.inline(F.array(*pairs)))

    count = F.count(F.lit(1))
    bad = F.count_if(F.size("_errors") > 0)
    return (
        rows(
            flagged,
            validation_success_rate=ratio(count - bad, count),
            error_rate=ratio(bad, count),
            suspicious_transaction_rate=ratio(F.count("suspicious_flags"), count),
        )
        .unionByName(rows(checks, compliance_check_success_rate=ratio(F.count_if("passed"), count)))
        .unionByName(
            rows(operations, sla_compliance_percent=ratio(F.count_if(F.col("duration") <= sla_seconds), count) * 100)
        )
    )


def gold_tables(df: DataFrame, aggregated_at: datetime) -> dict[str, DataFrame]:
    """The roll-ups that fit the columns at hand, by name; each row tells how many amounts its sums leave out."""
    have = set(df.columns)
    tables: dict[str, DataFrame] = {}
    if {"account_id", "amount", "transaction_date", "is_large_transaction", "transaction_category"} <= have:
        tables["monthly_by_account"] = monthly_by_account(df, category_map=True, left_out=True)
    if {"transaction_category", "amount", "account_id"} <= have:
        tables["by_category"] = by_category(df, left_out=True)
    if {"transaction_date", "amount", "account_id"} <= have:
        tables["daily"] = daily(df, left_out=True)
    stamp = F.lit(aggregated_at).cast("timestamp_ntz")
    return {
        name: table.withColumns({"aggregation_type": F.lit(name), "_aggregation_timestamp": stamp})
        for name, table in tables.items()
    }
