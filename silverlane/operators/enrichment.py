"""Derived columns on trusted rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlane.functions.ordering import RankedValues, exact_quantiles, ranked_values
from silverlane.functions.skew import attach_by_key
from silverlane.functions.text import categorize

LARGE_SHARE = 0.95

# Upper bounds (included) of the balance bands.
BALANCE_BANDS = ((0, "Negative"), (1000, "Low"), (10000, "Medium"), (50000, "High"))
TOP_BALANCE_BAND = "Very High"


def categorize_transactions(df: DataFrame, column: str = "description") -> DataFrame:
    return df.withColumn("transaction_category", categorize(F.col(column)))


def _amount(df: DataFrame, column: str) -> Column:
    """The column with NaN as null."""
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(column), F.col(column))
    return F.col(column)


def _above(df: DataFrame, column: str, limit: float | None) -> Column:
    return F.lit(False) if limit is None else F.coalesce(_amount(df, column) > F.lit(limit), F.lit(False))


def large_transaction_flag(df: DataFrame, column: str = "amount", share: float = LARGE_SHARE) -> DataFrame:
    """True above the exact 95th percentile; false for a missing amount or one that is no number."""
    limit = exact_quantiles(df.select(column), {column: share})[column].value
    return df.withColumn("is_large_transaction", _above(df, column, limit))


def _attach_percentile(df: DataFrame, column: str, ranked: RankedValues) -> DataFrame:
    average_rank = (F.col("upto") - F.col("n") + F.col("upto") + 1) / 2
    ranks = ranked.table.select(
        F.col("value").alias(column), "n", (average_rank / F.lit(float(max(1, ranked.rows)))).alias("amount_percentile")
    )
    return attach_by_key(df, ranks, column, ranked.rows, ["amount_percentile"])


def amount_percentile(df: DataFrame, column: str = "amount", buckets: int | None = None) -> DataFrame:
    """Rank of each amount as a share of all, ties sharing their average rank."""
    return _attach_percentile(df, column, ranked_values(df.select(column), column, buckets))


def amount_features(
    df: DataFrame, column: str = "amount", share: float = LARGE_SHARE, buckets: int | None = None
) -> DataFrame:
    """Percentile and large flag from one ranking of the amounts."""
    ranked = ranked_values(df.select(column), column, buckets)
    flagged = df.withColumn("is_large_transaction", _above(df, column, ranked.quantile(share)))
    return _attach_percentile(flagged, column, ranked)


def date_columns(df: DataFrame) -> list[str]:
    moments = (T.TimestampType, T.TimestampNTZType)
    return [f.name for f in df.schema.fields if "date" in f.name.lower() and isinstance(f.dataType, moments)]


def date_part_names(column: str) -> list[str]:
    base = column.replace("_date", "").replace("date", "")
    return [f"{base}_year", f"{base}_month", f"{base}_day_of_week", f"{base}_is_weekend"]


def date_parts(df: DataFrame) -> DataFrame:
    """Year, month, weekday (Monday 0) and weekend flag of every date column."""
    parts = {}
    for name in date_columns(df):
        year, month, weekday, weekend = date_part_names(name)
        parts[year] = F.year(name)
        parts[month] = F.month(name)
        parts[weekday] = F.weekday(name)
        parts[weekend] = F.coalesce(F.weekday(name) >= 5, F.lit(False))
    return df.withColumns(parts) if parts else df


def balance_category(df: DataFrame, column: str = "balance") -> DataFrame:
    band = F.when(F.col(column).isNull(), F.lit(None).cast("string"))
    for upper, label in BALANCE_BANDS:
        band = band.when(F.col(column) <= upper, F.lit(label))
    return df.withColumn("balance_category", band.otherwise(F.lit(TOP_BALANCE_BAND)))


def features_for(df: DataFrame, source_name: str, balance_column: str = "balance") -> list[str]:
    """Names of the columns ``enrich`` adds for this source, in order."""
    source, features = source_name.lower(), []
    if "transaction" in source and "description" in df.columns:
        features.append("transaction_category")
    if "amount" in df.columns:
        features += ["is_large_transaction", "amount_percentile"]
    for name in date_columns(df):
        features += date_part_names(name)
    if "account" in source and balance_column in df.columns:
        features.append("balance_category")
    return features


def enrich(
    df: DataFrame, source_name: str, enriched_at: datetime, balance_column: str = "balance", buckets: int | None = None
) -> DataFrame:
    """Add every feature that fits the source's name and columns."""
    features = features_for(df, source_name, balance_column)
    out = df
    if "amount_percentile" in features:
        out = amount_features(out, buckets=buckets)
    if "transaction_category" in features:
        out = categorize_transactions(out)
    out = date_parts(out)
    if "balance_category" in features:
        out = balance_category(out, balance_column)
    return out.select(
        *df.columns, *features, F.lit(enriched_at).cast("timestamp_ntz").alias("_enrichment_timestamp")
    )
