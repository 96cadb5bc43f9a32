"""Row validation against the banking schemas."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlane.columns import ratio
from silverlane.functions.rules import ERRORS, Rule, predicate
from silverlane.functions.skew import attach_stored

# Field rules of the three schemas.
TRANSACTION_TYPES = ("CREDIT", "DEBIT", "TRANSFER", "PAYMENT", "WITHDRAWAL", "DEPOSIT")
TITLES = ("Mr", "Mrs", "Miss", "Ms", "Dr", "Prof", "Rev")
RISK_RATINGS = ("LOW", "MEDIUM", "HIGH", "VERY_HIGH")
ACCOUNT_TYPES = ("CURRENT", "SAVINGS", "BUSINESS", "ISA", "MORTGAGE")
ACCOUNT_CURRENCIES = ("GBP", "EUR", "USD")
ACCOUNT_STATUSES = ("ACTIVE", "INACTIVE", "CLOSED", "SUSPENDED")
TRANSACTION_ID_PATTERN = r"^[A-Z0-9\-_]+\z"
CUSTOMER_ID_PATTERN = r"^[A-Z0-9]+\z"
PERSON_NAME_PATTERN = r"^[A-Za-z\s\-\']+\z"
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}\z"
PHONE_PATTERN = r"^(\+44|0)[1-9][0-9]{8,9}\z"
POSTCODE_PATTERN = r"^[A-Z]{1,2}[0-9][A-Z0-9]?\s?[0-9][A-Z]{2}\z"
ACCOUNT_ID_PATTERN = r"^ACC[0-9]{10}\z"
ACCOUNT_IBAN_PATTERN = r"^GB[0-9]{2}[A-Z]{4}[0-9]{14}\z"
BALANCE_LOW, BALANCE_HIGH = -999999.99, 999999999.99


def _field(column: str, required: bool, *checks: tuple) -> list[Rule]:
    """Rules of one field: a missing required value is one error of its own kind."""
    rules = [Rule(f"{column}:not_null", column, "not_null")] if required else []
    for check, *params in checks:
        rules.append(Rule(f"{column}:{check}", column, check, params[0] if params else {}, nullable=True))
    return rules


def transaction_rules() -> list[Rule]:
    return [
        *_field("transaction_id", True, ("length_between", {"min_value": 1, "max_value": 50}),
                ("regex", {"pattern": TRANSACTION_ID_PATTERN})),
        *_field("account_number", True, ("account_number",)),
        *_field("sort_code", True, ("sort_code",)),
        *_field("amount", True, ("amount_range",)),
        *_field("currency", True, ("currency",)),
        *_field("transaction_date", True, ("transaction_date",)),
        *_field("transaction_type", True, ("in_set", {"values": TRANSACTION_TYPES})),
        *_field("description", False, ("max_length", {"value": 255})),
        *_field("counterparty_name", False, ("max_length", {"value": 100})),
        *_field("counterparty_account", False, ("account_or_iban",)),
    ]


def customer_rules() -> list[Rule]:
    """Row rules of a customer; uniqueness of the id is ``unique_key_violations``."""
    name_length = ("length_between", {"min_value": 1, "max_value": 50})
    name_letters = ("regex", {"pattern": PERSON_NAME_PATTERN})
    return [
        *_field("customer_id", True, ("length_between", {"min_value": 1, "max_value": 20}),
                ("regex", {"pattern": CUSTOMER_ID_PATTERN})),
        *_field("title", False, ("in_set", {"values": TITLES})),
        *_field("first_name", True, name_length, name_letters),
        *_field("last_name", True, name_length, name_letters),
        *_field("date_of_birth", True, ("date_of_birth",)),
        *_field("email", False, ("regex", {"pattern": EMAIL_PATTERN})),
        *_field("phone", False, ("regex", {"pattern": PHONE_PATTERN})),
        *_field("postcode", False, ("regex", {"pattern": POSTCODE_PATTERN})),
        *_field("risk_rating", True, ("in_set", {"values": RISK_RATINGS})),
    ]


def account_rules() -> list[Rule]:
    return [
        *_field("account_id", True, ("regex", {"pattern": ACCOUNT_ID_PATTERN})),
        *_field("account_number", True, ("account_number",)),
        *_field("sort_code", True, ("sort_code",)),
        *_field("iban", False, ("regex", {"pattern": ACCOUNT_IBAN_PATTERN})),
        *_field("account_type", True, ("in_set", {"values": ACCOUNT_TYPES})),
        *_field("balance", False, ("between", {"min_value": BALANCE_LOW, "max_value": BALANCE_HIGH})),
        *_field("currency", True, ("in_set", {"values": ACCOUNT_CURRENCIES})),
        *_field("status", True, ("in_set", {"values": ACCOUNT_STATUSES})),
        *_field("created_date", False, ("date_time",)),
        *_field("last_updated", False, ("date_time",)),
    ]


def drop_uncheckable_optional(df: DataFrame, rules: list[Rule]) -> list[Rule]:
    """Rules without those on optional fields the frame does not have."""
    required = {rule.column for rule in rules if rule.check == "not_null"}
    return [rule for rule in rules if rule.column in df.columns or rule.column in required]


def unexpected_columns(df: DataFrame, rules: list[Rule]) -> list[str]:
    """Business columns no rule knows, for schemas that allow no extra fields."""
    known = {rule.column for rule in rules}
    return [name for name in df.columns if not name.startswith("_") and name not in known]


def key_counts(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def unique_key_violations(df: DataFrame, key: str) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return key_counts(df, key).filter(F.col("n") > 1)


def flag_duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Mark every row whose key another row holds too."""
    repeated = unique_key_violations(df, key).withColumn("_repeated", F.lit(True))
    marked = attach_stored(df, repeated, key, ["_repeated"])
    return marked.withColumn("is_duplicate_key", F.coalesce("_repeated", F.lit(False))).drop("_repeated")


def validation_errors_summary(df: DataFrame, rules: list[Rule], as_of: date | datetime | None = None) -> DataFrame:
    """Rows per broken rule: one counter per rule in one aggregation."""
    def broken(rule: Rule) -> Column:
        holds = predicate(rule, df.schema, as_of)
        return F.count(F.lit(1)) if holds is None else F.count_if(~holds)

    wide = df.agg(*[broken(rule).alias(f"r{i}") for i, rule in enumerate(rules)])
    structs = [
        F.struct(F.lit(rule.name).alias("error"), F.col(f"r{i}").alias("failures")) for i, rule in enumerate(rules)
    ]
    return wide.select(F.inline(F.array(*structs))).filter(F.col("failures") > 0)


def split_valid_invalid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    return validated.filter(F.size(ERRORS) == 0), validated.filter(F.size(ERRORS) > 0)


def validity_counts(validated: DataFrame) -> DataFrame:
    """Valid and invalid row counts and the valid share, in one row."""
    total, invalid = F.count(F.lit(1)), F.count_if(F.size(ERRORS) > 0)
    return validated.agg(
        total.alias("total_records"), (total - invalid).alias("valid_records"), invalid.alias("invalid_records"),
        F.round(ratio(total - invalid, total), 6).alias("quality_score"), (invalid == 0).alias("is_valid"),
    )
