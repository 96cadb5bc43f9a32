"""Parsing and classifying text columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words of each category, tried in this order, first hit wins.
CATEGORY_WORDS = (
    ("Grocery", ("supermarket", "grocery", "tesco", "sainsbury", "asda", "morrisons", "aldi", "lidl")),
    ("Fuel", ("petrol", "fuel", "gas station", "shell", "bp", "esso")),
    ("Restaurant", ("restaurant", "cafe", "mcdonald", "kfc", "pizza", "takeaway")),
    ("Retail", ("amazon", "ebay", "shop", "store", "retail", "purchase")),
    ("Utilities", ("electric", "gas", "water", "council tax", "utility")),
    ("Transport", ("train", "bus", "taxi", "uber", "transport", "parking")),
    ("Healthcare", ("pharmacy", "hospital", "doctor", "medical", "health")),
    ("Entertainment", ("cinema", "theatre", "netflix", "spotify", "entertainment")),
    ("ATM", ("atm", "cash withdrawal", "cashpoint")),
    ("Transfer", ("transfer", "payment to", "standing order", "direct debit")),
    ("Fee", ("fee", "charge", "overdraft", "interest")),
)

# Accepted date-time shapes, each a guard pattern and a format.
# The guard keeps text that cannot parse away from the parser, which would
# otherwise raise and catch an exception for every such row.
DATETIME_SHAPES = (
    (r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ T][0-9]{1,2}:[0-9]{1,2}(:[0-9]{1,2}([.][0-9]{1,6})?)?)?\z",
     "yyyy-M-d[ ]['T'][H:m][:s][.SSSSSS]"),
    (r"^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}\z", "yyyy/M/d"),
    (r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}\z", "M/d/yyyy"),
    (r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}\z", "d/M/yyyy"),
    (r"^[0-9]{8}\z", "yyyyMMdd"),
)
ZONED_PATTERN = (
    r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}[ T][0-9]{1,2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?"
    r"(Z|[+-][0-9]{2}:?[0-9]{2})\z"
)

NUMBER_PATTERN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\z"
INTEGER_PATTERN = r"^[+-]?[0-9]{1,18}\z"
BOOLEAN_WORDS = ("true", "false")


def categorize(description: Column) -> Column:
    """Spending category of a description; Unknown for null, Other for no hit.

    The words are plain text, so substring tests do what a pattern would, faster.
    """
    lowered = F.lower(description)
    branches = [
        (reduce(Column.__or__, [lowered.contains(word) for word in words]), category)
        for category, words in CATEGORY_WORDS
    ]
    chain = F.when(branches[0][0], F.lit(branches[0][1]))
    for hit, category in branches[1:]:
        chain = chain.when(hit, F.lit(category))
    return chain.otherwise(F.when(description.isNull(), F.lit("Unknown")).otherwise(F.lit("Other")))


def money_from_text(column: Column) -> Column:
    """Number behind currency marks and thousands commas; null when not a number."""
    bare = F.trim(F.regexp_replace(column, "[£$€,]", ""))
    return F.when(bare.rlike(NUMBER_PATTERN), bare.try_cast("double"))


def to_money(column: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return money_from_text(column)
    return column.try_cast("double")


def datetime_from_text(column: Column, shapes: tuple = DATETIME_SHAPES) -> Column:
    """Timestamp from the first shape that fits the text; null when none does.

    A stamp with a zone or offset is shown in UTC. Of 3/4/2024 the month comes first; of 15/4/2024 it cannot.
    """
    bare = F.trim(column)
    plain = [F.when(bare.rlike(guard), F.try_to_timestamp(bare, F.lit(layout))) for guard, layout in shapes]
    zoned = F.when(bare.rlike(ZONED_PATTERN), F.try_to_timestamp(bare)).cast("timestamp_ntz")
    in_utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), zoned)
    return F.coalesce(*[stamp.cast("timestamp_ntz") for stamp in plain], in_utc)


def to_datetime(column: Column, dtype: T.DataType, shapes: tuple = DATETIME_SHAPES) -> Column:
    """Convert any column to a timestamp; whole numbers count nanoseconds since 1970."""
    if isinstance(dtype, T.StringType):
        return datetime_from_text(column, shapes)
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        return column.cast("timestamp_ntz")
    if isinstance(dtype, T.NumericType):
        return F.timestamp_micros((column / 1000).try_cast("bigint")).cast("timestamp_ntz")
    return F.lit(None).cast("timestamp_ntz")


# One bit per kind of value, so an aggregate can collect kinds in one number.
KIND_BITS = {"integer": 1, "decimal": 2, "datetime": 4, "boolean": 8, "text": 16}


def value_kind(column: Column) -> Column:
    """What a text value reads as, as its bit in KIND_BITS; null for null.

    Most text starts with a letter and is settled by its first character.
    """
    bare = F.trim(column)
    first = F.ascii(bare)
    bit = {name: F.lit(value) for name, value in KIND_BITS.items()}
    boolean = first.isin(*map(ord, "tTfF")) & F.lower(bare).isin(*BOOLEAN_WORDS)
    return (
        F.when(column.isNull(), F.lit(None).cast("int"))
        .when(~first.isin(*map(ord, "0123456789+.-")), F.when(boolean, bit["boolean"]).otherwise(bit["text"]))
        .when(bare.rlike(INTEGER_PATTERN), bit["integer"])
        .when(bare.rlike(NUMBER_PATTERN), bit["decimal"])
        .when(datetime_from_text(column).isNotNull(), bit["datetime"])
        .otherwise(bit["text"])
    )


def kinds_found(column: Column) -> Column:
    """Aggregate: the bits of all kinds a text column holds; 0 for no values."""
    return F.coalesce(F.bit_or(value_kind(column)), F.lit(0))
