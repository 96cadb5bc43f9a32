"""UK banking field checks as boolean expressions that are never null.

Every check takes a column and answers true or false; a missing value is false.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Field formats, limits and code lists.
SORT_CODE_PATTERN = r"^[0-9]{2}-[0-9]{2}-[0-9]{2}\z"
ACCOUNT_NUMBER_PATTERN = r"^[0-9]{8}\z"
IBAN_PATTERN = r"^[A-Z]{2}[0-9]{2}[A-Z0-9]{4}[0-9]{7}[A-Z0-9]{0,16}\z"
BIC_PATTERN = r"^[A-Z]{6}[A-Z0-9]{2}([A-Z0-9]{3})?\z"
PLAIN_DATE_PATTERN = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z"
MIN_AMOUNT = "0.01"
MAX_AMOUNT = "1000000.00"
CURRENCIES = (
    "GBP", "USD", "EUR", "JPY", "CHF", "CAD", "AUD", "NZD",
    "SEK", "NOK", "DKK", "PLN", "CZK", "HUF", "SGD", "HKD",
)
MAX_YEARS_BACK = 10
MIN_AGE = 18
MAX_AGE = 120


def _known(check: Column) -> Column:
    return F.coalesce(check, F.lit(False))


def valid_sort_code(column: Column) -> Column:
    return _known(column.rlike(SORT_CODE_PATTERN))


def valid_account_number(column: Column) -> Column:
    return _known(column.rlike(ACCOUNT_NUMBER_PATTERN))


def valid_iban(column: Column) -> Column:
    """Format plus the remainder-97 test of ISO 13616.

    The remainder is folded over the characters, a letter counting as two
    digits. Only codes of the right shape get that far.
    """
    compact = F.upper(F.replace(column, F.lit(" "), F.lit("")))
    turned = F.concat(F.substring(compact, 5, 40), F.substring(compact, 1, 4))

    def append(remainder: Column, char: Column) -> Column:
        digit = F.ascii(char) - ord("0")
        letter = F.ascii(char) - ord("A") + 10
        return F.when(digit < 10, (remainder * 10 + digit) % 97).otherwise((remainder * 100 + letter) % 97)

    remainder = F.aggregate(F.split(turned, ""), F.lit(0), append)
    return _known(F.when(compact.rlike(IBAN_PATTERN), remainder == 1).otherwise(F.lit(False)))


def valid_swift_bic(column: Column) -> Column:
    return _known(F.upper(column).rlike(BIC_PATTERN))


def valid_amount_range(column: Column, numeric: bool = False, low: str = MIN_AMOUNT, high: str = MAX_AMOUNT) -> Column:
    """Amount within limits, both included.

    A numeric column is compared as it is; text is read as an exact decimal, so
    0.00999... is not rounded up into the range.
    """
    if numeric:
        return _known(column.between(float(low), float(high)))
    exact = column.try_cast("decimal(38,18)")
    return _known(exact.between(F.lit(low).cast("decimal(38,18)"), F.lit(high).cast("decimal(38,18)")))


def valid_currency(column: Column) -> Column:
    return _known(F.upper(column).isin(*CURRENCIES))


def plain_date(column: Column, text: bool = True) -> Column:
    """Calendar date of a YYYY-MM-DD text (or of a date-like column)."""
    if not text:
        return column.cast("date")
    return F.when(column.rlike(PLAIN_DATE_PATTERN), F.try_to_date(column, "yyyy-M-d"))


def valid_transaction_date(column: Column, as_of: date, text: bool = True) -> Column:
    """Not after ``as_of`` and not before 1 January ten years earlier."""
    earliest = date(as_of.year - MAX_YEARS_BACK, 1, 1)
    return _known(plain_date(column, text).between(F.lit(earliest), F.lit(as_of)))


def completed_age(born: Column, as_of: date) -> Column:
    before_birthday = (F.month(born) > as_of.month) | (
        (F.month(born) == as_of.month) & (F.dayofmonth(born) > as_of.day)
    )
    return F.lit(as_of.year) - F.year(born) - before_birthday.cast("int")


def valid_date_of_birth(column: Column, as_of: date, text: bool = True) -> Column:
    """Between 18 and 120 completed years old on ``as_of``."""
    return _known(completed_age(plain_date(column, text), as_of).between(MIN_AGE, MAX_AGE))
