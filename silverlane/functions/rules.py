"""Declared row rules compiled to boolean columns."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlane.functions import validators as v
from silverlane.functions.text import to_datetime, to_money

ERRORS = "_errors"
DATE_TIME_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})\z"


@dataclass(frozen=True)
class Rule:
    """One check on one column. With ``nullable`` a missing value passes."""

    name: str
    column: str
    check: str
    params: dict[str, Any] = field(default_factory=dict)
    nullable: bool = False

    @staticmethod
    def from_config(config: dict[str, Any]) -> "Rule":
        """A rule from its configuration entry {name, column, check, ...params}."""
        params = {k: x for k, x in config.items() if k not in ("name", "column", "check", "nullable")}
        return Rule(config["name"], config["column"], config["check"], params, config.get("nullable", False))


@dataclass(frozen=True)
class _Target:
    column: Column
    dtype: T.DataType
    as_of: date | datetime | None

    @property
    def is_text(self) -> bool:
        return isinstance(self.dtype, T.StringType)

    @property
    def number(self) -> Column:
        """The value to compare with numbers: text is read as money, unreadable text is no number."""
        return to_money(self.column, self.dtype) if self.is_text else self.column

    @property
    def day(self) -> date:
        if self.as_of is None:
            raise ValueError("this rule compares with today: give as_of")
        return self.as_of.date() if isinstance(self.as_of, datetime) else self.as_of


def _moment(value: Any) -> Column:
    return F.lit(str(value)).cast("timestamp_ntz")


def _date_range(t: _Target, min_date: Any, max_date: Any) -> Column:
    return to_datetime(t.column, t.dtype).between(_moment(min_date), _moment(max_date))


def _date_span(t: _Target, years: int) -> Column:
    return _date_range(t, t.day - timedelta(days=365 * years), t.day)


CHECKS: dict[str, Callable[..., Column]] = {
    "not_null": lambda t: t.column.isNotNull(),
    "greater_than": lambda t, value: t.number > F.lit(value),
    "at_least": lambda t, value: t.number >= F.lit(value),
    "at_most": lambda t, value: t.number <= F.lit(value),
    "between": lambda t, min_value, max_value: t.number.between(F.lit(min_value), F.lit(max_value)),
    "abs_less_than": lambda t, value: F.abs(t.number) < F.lit(value),
    "in_set": lambda t, values: t.column.isin(*values),
    "regex": lambda t, pattern: t.column.rlike(pattern),
    "length_between": lambda t, min_value, max_value: F.length(t.column).between(min_value, max_value),
    "max_length": lambda t, value: F.length(t.column) <= value,
    "date_range": _date_range,
    "date_span": _date_span,
    "date_time": lambda t: t.column.rlike(DATE_TIME_PATTERN) if t.is_text else t.column.isNotNull(),
    "sort_code": lambda t: v.valid_sort_code(t.column),
    "account_number": lambda t: v.valid_account_number(t.column),
    "iban": lambda t: v.valid_iban(t.column),
    "swift_bic": lambda t: v.valid_swift_bic(t.column),
    "account_or_iban": lambda t: v.valid_account_number(t.column) | v.valid_iban(t.column),
    "currency": lambda t: v.valid_currency(t.column),
    "amount_range": lambda t: v.valid_amount_range(t.column, numeric=not t.is_text),
    "transaction_date": lambda t: v.valid_transaction_date(t.column, t.day, text=t.is_text),
    "date_of_birth": lambda t: v.valid_date_of_birth(t.column, t.day, text=t.is_text),
}


def predicate(rule: Rule, schema: T.StructType, as_of: date | datetime | None = None) -> Column | None:
    """The rule as a column that is true or false, never null.

    None when it cannot be checked: the column is absent or the check unknown.
    """
    if rule.column not in schema.names or rule.check not in CHECKS:
        return None
    target = _Target(F.col(rule.column), schema[rule.column].dataType, as_of)
    holds = F.coalesce(CHECKS[rule.check](target, **rule.params), F.lit(False))
    return F.col(rule.column).isNull() | holds if rule.nullable else holds


def errors(schema: T.StructType, rules: list[Rule], as_of: date | datetime | None = None) -> Column:
    """Names of the rules a row breaks, in rule order.

    A rule that cannot be checked counts as broken.
    """
    if len({rule.name for rule in rules}) < len(rules):
        raise ValueError("rule names must differ")
    codes = []
    for rule in rules:
        holds = predicate(rule, schema, as_of)
        codes.append(F.lit(rule.name) if holds is None else F.when(~holds, F.lit(rule.name)))
    if not codes:
        return F.array().cast("array<string>")
    # Unlike array_compact this stays in generated code; codes are distinct anyway.
    return F.array_except(F.array(*codes), F.array(F.lit(None).cast("string")))


def with_errors(df: DataFrame, rules: list[Rule], as_of: date | datetime | None = None) -> DataFrame:
    return df.withColumn(ERRORS, errors(df.schema, rules, as_of))
