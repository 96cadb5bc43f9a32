"""Column naming contract: metadata columns and the roles a name implies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW_SEQ = "_row_seq"
COPIES = "_copies"
LEFT_OUT = "amounts_left_out"

# Name fragments that decide how a column is filled and parsed.
ZERO_FILL_NAMES = ("amount", "balance")
CARRY_FILL_NAMES = ("date",)
MONEY_TYPE = "decimal(28,6)"
MONEY_NAMES = ("amount", "balance", "fee", "charge")
TIME_NAMES = ("date", "time", "timestamp")
ID_NAMES = ("id",)


def is_metadata(name: str) -> bool:
    return name.startswith("_")


def business_columns(df: DataFrame) -> list[str]:
    return [name for name in df.columns if not is_metadata(name)]


def metadata_columns(df: DataFrame) -> list[str]:
    return [name for name in df.columns if is_metadata(name)]


def _mentions(name: str, fragments: tuple[str, ...]) -> bool:
    lowered = name.lower()
    return any(fragment in lowered for fragment in fragments)


def fill_role(field: T.StructField, overrides: dict[str, str] | None = None) -> str:
    """How nulls of a column are filled: zero, carry, unknown, median or keep."""
    if overrides and field.name in overrides:
        return overrides[field.name]
    if field.name == ROW_SEQ:
        return "keep"
    if _mentions(field.name, ZERO_FILL_NAMES):
        return "zero"
    if _mentions(field.name, CARRY_FILL_NAMES):
        return "carry"
    if isinstance(field.dataType, T.StringType):
        return "unknown"
    if isinstance(field.dataType, (T.NumericType, T.TimestampType, T.TimestampNTZType)):
        return "median"
    return "keep"


def parse_role(name: str, overrides: dict[str, str] | None = None) -> str:
    """How a business column is converted: money, datetime, id or keep."""
    if overrides and name in overrides:
        return overrides[name]
    if is_metadata(name):
        return "keep"
    if _mentions(name, MONEY_NAMES):
        return "money"
    if _mentions(name, TIME_NAMES):
        return "datetime"
    if _mentions(name, ID_NAMES):
        return "id"
    return "keep"


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as a double, 0 when there is nothing to divide by."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double")).otherwise(F.lit(0.0))


def money_sum(column: Column) -> Column:
    """Sum of a money column, not yet rounded; 0 for no values.

    Values are added as decimals of six places, so the sum does not depend on the order of tasks. What is no number or
    beyond 10**22 is left out; ``money_misfits`` counts it.
    """
    return F.coalesce(F.sum(column.try_cast(MONEY_TYPE)), F.lit(0).cast("decimal(38,6)"))


def money_count(column: Column) -> Column:
    """Number of values in a money sum."""
    return F.count(column.try_cast(MONEY_TYPE))


def to_pence(total: Column) -> Column:
    """A money sum as it is shown."""
    return F.round(total, 2).cast("double")


def money_misfits(column: Column) -> Column:
    """Number of values a money sum leaves out: NaN, infinite or too large."""
    return F.count_if(column.isNotNull() & column.try_cast(MONEY_TYPE).isNull())


def money_mean(total: Column, count: Column) -> Column:
    """Mean to two places from an exact sum; null when there are no values."""
    return F.when(count > 0, F.round((total / count).cast("decimal(38,6)"), 2)).cast("double")
