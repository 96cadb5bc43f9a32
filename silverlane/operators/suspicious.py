"""Suspicious-transaction flags, in batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlane.columns import LEFT_OUT, MONEY_TYPE, money_misfits, money_sum, ratio, to_pence
from silverlane.functions.validators import plain_date

# Limits of the flags and of the sliding window alert.
LARGE_AMOUNT = 10000
ROUND_STEP = 1000
ROUND_FROM = 5000
WINDOW_LENGTH = "5 minutes"
WINDOW_SLIDE = "1 minute"
WINDOW_MAX_COUNT = 10
WINDOW_MAX_SUM = 50000


def suspicious_flags(df: DataFrame, amount: str = "amount", day: str = "transaction_date") -> DataFrame:
    """Add ``suspicious_flags``: the raised flags joined by ``|``, null for none."""
    value = F.col(amount).try_cast("double")
    on = plain_date(F.col(day), text=isinstance(df.schema[day].dataType, T.StringType))
    raised = F.concat_ws(
        "|",
        F.when(value > LARGE_AMOUNT, F.lit("LARGE_AMOUNT")),
        F.when((value % ROUND_STEP == 0) & (value >= ROUND_FROM), F.lit("ROUND_AMOUNT")),
        F.when(F.weekday(on) >= 5, F.lit("WEEKEND_TRANSACTION")),
    )
    return df.withColumn("suspicious_flags", F.when(raised != "", raised))


def suspicious_summary(flagged: DataFrame) -> DataFrame:
    count = F.count(F.lit(1))
    return flagged.agg(
        F.count("suspicious_flags").alias("suspicious_transactions"), count.alias("total_transactions"),
        F.round(ratio(F.count("suspicious_flags"), count), 6).alias("suspicious_rate"),
    )


def same_day_velocity(df: DataFrame, minimum: int = 2, left_out: bool = False) -> DataFrame:
    """Account-days with at least ``minimum`` transactions; ``left_out`` adds how many amounts a sum leaves out."""
    misfits = [money_misfits(F.col("amount")).alias(LEFT_OUT)] if left_out else []
    return (
        df.filter(F.col("account_id").isNotNull() & F.col("transaction_date").isNotNull())
        .groupBy("account_id", F.to_date("transaction_date").alias("day"))
        .agg(F.count(F.lit(1)).alias("transactions"), to_pence(money_sum(F.col("amount"))).alias("amount_sum"), *misfits)
        .filter(F.col("transactions") >= minimum)
    )


def window_totals(df: DataFrame, timestamp: str, account: str, amount: str) -> DataFrame:
    """Count and sum per account and sliding window; the same for batch and stream.

    Rows are summed once per account and pane, the slide of the windows; only panes are then given to every window they
    lie in. In a stream a row later than the watermark allows is lost with its pane, also to windows still open.
    """
    panes = df.groupBy(F.window(timestamp, WINDOW_SLIDE).alias("pane"), account).agg(
        F.count(F.lit(1)).alias("pane_count"), F.sum(F.col(amount).try_cast(MONEY_TYPE)).alias("pane_amount"))
    return panes.groupBy(F.window(F.window_time("pane"), WINDOW_LENGTH, WINDOW_SLIDE), account).agg(
        F.sum("pane_count").alias("transaction_count"), F.sum("pane_amount").alias("total_amount"))


def over_limits(totals: DataFrame, max_count: int = WINDOW_MAX_COUNT, max_sum: float = WINDOW_MAX_SUM) -> DataFrame:
    return totals.filter((F.col("transaction_count") > max_count) | (F.col("total_amount") > max_sum))


def alert_columns(account: str) -> list[Column]:
    return [
        F.col(account), F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        F.col("transaction_count"), to_pence(F.col("total_amount")).alias("total_amount"),
    ]


def window_fraud_alerts(
    df: DataFrame, timestamp: str = "timestamp", account: str = "account_id", amount: str = "amount",
    max_count: int = WINDOW_MAX_COUNT, max_sum: float = WINDOW_MAX_SUM,
) -> DataFrame:
    """Sliding windows whose count or sum passes its limit."""
    totals = window_totals(df, timestamp, account, amount)
    return over_limits(totals, max_count, max_sum).select(*alert_columns(account))
