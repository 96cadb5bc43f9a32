"""Raw layer -> trusted layer: fill, convert, deduplicate, score."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlane.columns import COPIES, ROW_SEQ, business_columns, fill_role, metadata_columns, parse_role
from silverlane.functions.ordering import carry_forward, exact_quantiles
from silverlane.functions.text import DATETIME_SHAPES, to_datetime, to_money

Overrides = dict[str, str] | None


def _with_role(df: DataFrame, role: str, overrides: Overrides = None) -> list[str]:
    return [field.name for field in df.schema.fields if fill_role(field, overrides) == role]


def _unpivot(row: DataFrame, names: list[str], value: str) -> DataFrame:
    """One wide row to (column, value) rows."""
    pairs = [F.struct(F.lit(name).alias("column"), F.col(f"`{name}`").alias(value)) for name in names]
    return row.select(F.inline(F.array(*pairs)))


def null_profile(df: DataFrame) -> DataFrame:
    """Null count per column, for columns that have any."""
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in df.columns])
    return _unpivot(counts, df.columns, "null_count").filter(F.col("null_count") > 0)


def fill_money_zero(df: DataFrame, overrides: Overrides = None) -> DataFrame:
    types = dict(df.dtypes)

    def known(name: str) -> Column:
        return F.when(~F.isnan(name), F.col(name)) if types[name] in ("double", "float") else F.col(name)

    filled = {
        name: F.coalesce(known(name), F.lit("0" if types[name] == "string" else 0).cast(types[name]))
        for name in _with_role(df, "zero", overrides)
    }
    return df.withColumns(filled) if filled else df


def fill_dates_forward(df: DataFrame, overrides: Overrides = None, buckets: int | None = None) -> DataFrame:
    return carry_forward(df, _with_role(df, "carry", overrides), ROW_SEQ, buckets)


def fill_text_unknown(df: DataFrame, overrides: Overrides = None) -> DataFrame:
    filled = {name: F.coalesce(F.col(name), F.lit("UNKNOWN")) for name in _with_role(df, "unknown", overrides)}
    return df.withColumns(filled) if filled else df


def fill_median(df: DataFrame, overrides: Overrides = None) -> DataFrame:
    """Fill remaining columns with their exact median.

    A whole-number column that has nulls becomes double, since a median may lie
    between two values; one without nulls keeps its type.
    """
    types = {field.name: field.dataType for field in df.schema.fields}
    targets = _with_role(df, "median", overrides)
    if not targets:
        return df
    as_number: dict[str, Column] = {}
    for name in targets:
        moment = isinstance(types[name], (T.TimestampType, T.TimestampNTZType))
        as_number[name] = F.unix_micros(F.col(name).cast("timestamp")) if moment else F.col(name)
    numbers = df.select(*[value.alias(name) for name, value in as_number.items()])
    filled: dict[str, Column] = {}
    for name, median in exact_quantiles(numbers, {name: 0.5 for name in targets}, gaps_only=True).items():
        if median.nulls == 0 or median.value is None:
            continue
        if isinstance(types[name], (T.TimestampType, T.TimestampNTZType)):
            middle = F.timestamp_micros(F.lit(int(median.value))).cast(types[name])
            filled[name] = F.coalesce(F.col(name), middle)
        else:
            filled[name] = F.coalesce(F.col(name).cast("double"), F.lit(median.value))
    return df.withColumns(filled) if filled else df


def fill_nulls(df: DataFrame, overrides: Overrides = None, buckets: int | None = None) -> DataFrame:
    """All four fills; each column has exactly one role, so their order is free."""
    medians = fill_median(df, overrides)
    return fill_text_unknown(fill_money_zero(fill_dates_forward(medians, overrides, buckets), overrides), overrides)


def _convert(df: DataFrame, role: str, change, overrides: Overrides) -> DataFrame:
    fields = [f for f in df.schema.fields if parse_role(f.name, overrides) == role]
    changed = {f.name: change(F.col(f.name), f.dataType) for f in fields}
    return df.withColumns(changed) if changed else df


def parse_money(df: DataFrame, overrides: Overrides = None) -> DataFrame:
    return _convert(df, "money", to_money, overrides)


def parse_datetimes(df: DataFrame, overrides: Overrides = None, shapes: tuple = DATETIME_SHAPES) -> DataFrame:
    return _convert(df, "datetime", lambda column, dtype: to_datetime(column, dtype, shapes), overrides)


def cast_ids(df: DataFrame, overrides: Overrides = None) -> DataFrame:
    return _convert(df, "id", lambda column, dtype: column.cast("string"), overrides)


def convert_types(df: DataFrame, overrides: Overrides = None, shapes: tuple = DATETIME_SHAPES) -> DataFrame:
    return cast_ids(parse_datetimes(parse_money(df, overrides), overrides, shapes), overrides)


def date_parse_stats(df: DataFrame, overrides: Overrides = None, shapes: tuple = DATETIME_SHAPES) -> DataFrame:
    """Parsed and failed counts per date-time column of a filled, unparsed frame."""
    names = [f.name for f in df.schema.fields if parse_role(f.name, overrides) == "datetime"]
    parsed = parse_datetimes(df.select(*names), overrides, shapes)
    measures = []
    for name in names:
        measures.append(
            F.struct(F.count(F.col(name)).alias("parsed"), F.count_if(F.col(name).isNull()).alias("failed")).alias(name)
        )
    return _unpivot(parsed.agg(*measures), names, "found").select("column", "found.parsed", "found.failed")


def dedupe_business(df: DataFrame) -> DataFrame:
    """Keep the first of rows equal in all business columns; nulls are equal.

    Copies collapse before the shuffle. ``_copies`` tells how many rows each kept
    row stands for. Rows are sorted for that; a hash as the first key spares most
    comparisons of whole columns.
    """
    business, metadata = business_columns(df), metadata_columns(df)
    if ROW_SEQ not in metadata:
        raise ValueError(f"keep-first needs {ROW_SEQ} to know which row came first")
    hashed = [name for name in business if isinstance(df.schema[name].dataType, T.AtomicType)]
    grouped = df.groupBy(*([F.xxhash64(*[F.col(f"`{name}`") for name in hashed]).alias("_hash")] if hashed else []), *business)
    copies = F.count(F.lit(1)).alias(COPIES)
    if metadata == [ROW_SEQ]:
        return grouped.agg(F.min(ROW_SEQ).alias(ROW_SEQ), copies).drop("_hash")
    first = F.min_by(F.struct(*metadata), F.col(ROW_SEQ)).alias("_first")
    kept = grouped.agg(first, copies)
    return kept.select(*[F.col(f"_first.{n}").alias(n) if n in metadata else F.col(n) for n in df.columns], COPIES)


def quality_score(df: DataFrame) -> Column:
    """Share of business columns of a row that have a value."""
    names = business_columns(df)
    present = sum((F.col(name).isNotNull().cast("int") for name in names), F.lit(0))
    return present / F.lit(float(len(names)))


def row_quality_score(df: DataFrame) -> DataFrame:
    return df.withColumn("_data_quality_score", quality_score(df))


def clean(
    df: DataFrame, cleaned_at: datetime, overrides: Overrides = None,
    shapes: tuple = DATETIME_SHAPES, buckets: int | None = None,
) -> DataFrame:
    """Fill, convert, deduplicate and score a raw frame that carries ``_row_seq``."""
    converted = convert_types(fill_nulls(df, overrides, buckets), overrides, shapes)
    kept = row_quality_score(dedupe_business(converted))
    return kept.withColumn("_cleaning_timestamp", F.lit(cleaned_at).cast("timestamp_ntz"))


def cleaning_measures() -> list[Column]:
    """Aggregates over a cleaned frame: rows before and after, copies, mean score."""
    return [
        F.coalesce(F.sum(COPIES), F.lit(0)).alias("original_rows"),
        F.count(F.lit(1)).alias("final_rows"),
        F.coalesce(F.sum(F.col(COPIES) - 1), F.lit(0)).alias("duplicates_removed"),
        F.avg("_data_quality_score").alias("average_score"),
    ]


def cleaning_stats(cleaned: DataFrame) -> DataFrame:
    return cleaned.agg(*cleaning_measures())
