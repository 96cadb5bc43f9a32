"""Field checks, row validation and suspicious-activity queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from silverlane.functions import validators
from silverlane.functions.rules import DATE_TIME_PATTERN, ERRORS, Rule, with_errors
from silverlane.operators import suspicious, validation
from silverlane.operators.quality import business_rule_results
from silverlane.plans.registry import query
from silverlane.plans.views import ORDERS_AS_OF, ORDERS_TODAY, view, with_views

_TODAY = "DATE '2001-08-03'"


def _date_sql(column: str) -> str:
    return (
        f"CASE WHEN regexp_matches({column}, '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}\\z') "
        f"THEN CAST(try_strptime({column}, '%Y-%m-%d') AS DATE) END"
    )


def _full(column: str, pattern: str) -> str:
    """Whether a whole value has a pattern of the library, whose anchors a full match does not need."""
    body = pattern.removeprefix("^").removesuffix("\\z").replace("'", "''")
    return f"coalesce(regexp_full_match({column}, '{body}'), false)"


def _among(column: str, values: tuple[str, ...]) -> str:
    return f"{column} IN ({', '.join(repr(value) for value in values)})"


def _iban_sql(column: str) -> str:
    """ISO 13616 by folding over the characters."""
    code = f"upper(replace({column}, ' ', ''))"
    values = (
        f"list_transform(string_split(substr({code}, 5) || substr({code}, 1, 4), ''), lambda c: "
        "CASE WHEN c BETWEEN '0' AND '9' THEN ascii(c) - 48 ELSE ascii(c) - 55 END)"
    )
    fold = f"list_reduce({values}, lambda a, x: CASE WHEN x < 10 THEN (a * 10 + x) % 97 ELSE (a * 100 + x) % 97 END)"
    return f"CASE WHEN {_full(code, validators.IBAN_PATTERN)} THEN {fold} = 1 ELSE false END"


CURRENCY_SQL = f"coalesce({_among('upper({0})', validators.CURRENCIES)}, false)"
SORT_CODE_SQL = _full("sort_code", validators.SORT_CODE_PATTERN)
ACCOUNT_SQL = _full("account_number", validators.ACCOUNT_NUMBER_PATTERN)
DATE_SQL = f"coalesce({_date_sql('transaction_date')} BETWEEN DATE '1991-01-01' AND {_TODAY}, false)"
AGE_SQL = f"coalesce(date_sub('year', {_date_sql('date_of_birth')}, {_TODAY}) BETWEEN 18 AND 120, false)"


def _field_query(name: str, column: str, check, sql: str) -> None:
    @query(name, with_views(["field_values"], f"SELECT transaction_id, {column}, {sql} AS valid FROM field_values"))
    def run(spark, sf_dir):
        return view(spark, sf_dir, "field_values").select("transaction_id", column, check(F.col(column)).alias("valid"))


_field_query("valid_sort_code", "sort_code", validators.valid_sort_code, SORT_CODE_SQL)
_field_query("valid_account_number", "account_number", validators.valid_account_number, ACCOUNT_SQL)
_field_query("valid_iban", "iban", validators.valid_iban, _iban_sql("iban"))
_field_query("valid_swift_bic", "bic", validators.valid_swift_bic,
             _full("upper(bic)", validators.BIC_PATTERN))
_field_query("valid_amount_range", "amount_text", validators.valid_amount_range,
             "coalesce(TRY_CAST(amount_text AS DECIMAL(38,18)) BETWEEN {0} AND {1}, false)".format(validators.MIN_AMOUNT, validators.MAX_AMOUNT))
_field_query("valid_currency", "currency", validators.valid_currency, CURRENCY_SQL.format("currency"))
_field_query("valid_transaction_date", "transaction_date",
             lambda c: validators.valid_transaction_date(c, ORDERS_TODAY), DATE_SQL)
_field_query("valid_date_of_birth", "date_of_birth",
             lambda c: validators.valid_date_of_birth(c, ORDERS_TODAY), AGE_SQL)


def _errors_sql(view_name: str, key: str, fields: list[tuple[str, str | None, list[tuple[str, str]]]]) -> str:
    """Error codes per row; fields are (column, required, [(code, holds)])."""
    codes = []
    for column, required, checks in fields:
        if required:
            codes.append(f"CASE WHEN {column} IS NULL THEN '{column}:not_null' END")
        codes += [
            f"CASE WHEN {column} IS NOT NULL AND NOT coalesce({holds}, false) THEN '{column}:{code}' END"
            for code, holds in checks
        ]
    return f"SELECT {key}, concat_ws('|', {', '.join(codes)}) AS errors FROM {view_name}"


TRANSACTION_ERRORS_SQL = _errors_sql("fin_txn", "_row_seq AS row_seq", [
    ("transaction_id", True, [("length_between", "length(transaction_id) BETWEEN 1 AND 50"),
                              ("regex", _full("transaction_id", validation.TRANSACTION_ID_PATTERN))]),
    ("account_number", True, [("account_number", ACCOUNT_SQL)]),
    ("sort_code", True, [("sort_code", SORT_CODE_SQL)]),
    ("amount", True, [("amount_range", f"amount BETWEEN {validators.MIN_AMOUNT} AND {validators.MAX_AMOUNT}")]),
    ("currency", True, [("currency", CURRENCY_SQL.format("currency"))]),
    ("transaction_date", True, [("transaction_date", DATE_SQL)]),
    ("transaction_type", True,
     [("in_set", _among("transaction_type", validation.TRANSACTION_TYPES))]),
    ("description", False, [("max_length", "length(description) <= 255")]),
    ("counterparty_name", False, [("max_length", "length(counterparty_name) <= 100")]),
    ("counterparty_account", False,
     [("account_or_iban", 
      f"{_full('counterparty_account', validators.ACCOUNT_NUMBER_PATTERN)} OR {_iban_sql('counterparty_account')}")]),
])

def _name_checks(column: str) -> list[tuple[str, str]]:
    return [("length_between", f"length({column}) BETWEEN 1 AND 50"),
            ("regex", _full(column, validation.PERSON_NAME_PATTERN))]


CUSTOMER_ERRORS_SQL = _errors_sql("cust", "customer_id, email", [
    ("customer_id", True, [("length_between", "length(customer_id) BETWEEN 1 AND 20"),
                           ("regex", _full("customer_id", validation.CUSTOMER_ID_PATTERN))]),
    ("title", False, [("in_set", _among("title", validation.TITLES))]),
    ("first_name", True, _name_checks("first_name")),
    ("last_name", True, _name_checks("last_name")),
    ("date_of_birth", True, [("date_of_birth", AGE_SQL)]),
    ("email", False, [("regex", _full("email", validation.EMAIL_PATTERN))]),
    ("phone", False, [("regex", _full("phone", validation.PHONE_PATTERN))]),
    ("postcode", False, [("regex", _full("postcode", validation.POSTCODE_PATTERN))]),
    ("risk_rating", True, [("in_set", _among("risk_rating", validation.RISK_RATINGS))]),
])

ACCOUNT_ERRORS_SQL = _errors_sql("acct", "account_id", [
    ("account_id", True, [("regex", _full("account_id", validation.ACCOUNT_ID_PATTERN))]),
    ("account_number", True, [("account_number", ACCOUNT_SQL)]),
    ("sort_code", True, [("sort_code", SORT_CODE_SQL)]),
    ("iban", False, [("regex", _full("iban", validation.ACCOUNT_IBAN_PATTERN))]),
    ("account_type", True, [("in_set", _among("account_type", validation.ACCOUNT_TYPES))]),
    ("balance", False, [("between", f"balance BETWEEN {validation.BALANCE_LOW} AND {validation.BALANCE_HIGH}")]),
    ("currency", True, [("in_set", _among("currency", validation.ACCOUNT_CURRENCIES))]),
    ("status", True, [("in_set", _among("status", validation.ACCOUNT_STATUSES))]),
    ("created_date", False, [("date_time", _full("created_date", DATE_TIME_PATTERN))]),
    ("last_updated", False, [("date_time", _full("last_updated", DATE_TIME_PATTERN))]),
])


def _checked(spark, sf_dir, name: str, rules: list[Rule]):
    return with_errors(view(spark, sf_dir, name), rules, ORDERS_AS_OF)


def _joined_errors():
    return F.concat_ws("|", ERRORS).alias("errors")


@query("valid_transaction_row", with_views(["fin_txn"], TRANSACTION_ERRORS_SQL))
def valid_transaction_row(spark, sf_dir):
    checked = _checked(spark, sf_dir, "fin_txn", validation.transaction_rules())
    return checked.select(F.col("_row_seq").alias("row_seq"), _joined_errors())


@query("valid_customer_row", with_views(["cust"], CUSTOMER_ERRORS_SQL))
def valid_customer_row(spark, sf_dir):
    checked = _checked(spark, sf_dir, "cust", validation.customer_rules())
    return checked.select("customer_id", "email", _joined_errors())


@query("valid_account_row", with_views(["acct"], ACCOUNT_ERRORS_SQL))
def valid_account_row(spark, sf_dir):
    checked = _checked(spark, sf_dir, "acct", validation.account_rules())
    return checked.select("account_id", _joined_errors())


@query("unique_key_violations", with_views(
    ["cust"], "SELECT customer_id, count(*) AS n FROM cust GROUP BY 1 HAVING count(*) > 1"))
def unique_key_violations(spark, sf_dir):
    return validation.unique_key_violations(view(spark, sf_dir, "cust"), "customer_id")


@query("unique_key_rows", with_views(["txn_dirty"], """
    SELECT transaction_id, _row_seq AS row_seq, count(*) OVER (PARTITION BY transaction_id) > 1 AS is_duplicate_key
    FROM txn_dirty"""))
def unique_key_rows(spark, sf_dir):
    rows = view(spark, sf_dir, "txn_dirty").select("transaction_id", F.col("_row_seq").alias("row_seq"))
    return validation.flag_duplicate_keys(rows, "transaction_id")


@query("validation_errors_summary", with_views(["fin_txn"], """
    SELECT error, count(*) AS failures FROM (SELECT unnest(string_split(errors, '|')) AS error FROM checked
    WHERE errors <> '') GROUP BY 1""", checked=TRANSACTION_ERRORS_SQL))
def validation_errors_summary(spark, sf_dir):
    return validation.validation_errors_summary(
        view(spark, sf_dir, "fin_txn"), validation.transaction_rules(), ORDERS_AS_OF)


@query("split_valid_invalid", with_views(["fin_txn"], """
    SELECT count(*) AS total_records, count(*) FILTER (WHERE errors = '') AS valid_records,
        count(*) FILTER (WHERE errors <> '') AS invalid_records,
        round(count(*) FILTER (WHERE errors = '') / count(*), 6) AS quality_score,
        count(*) FILTER (WHERE errors <> '') = 0 AS is_valid FROM checked""", checked=TRANSACTION_ERRORS_SQL))
def split_valid_invalid(spark, sf_dir):
    return validation.validity_counts(_checked(spark, sf_dir, "fin_txn", validation.transaction_rules()))


def _expectation(name: str, rule: Rule, holds: str) -> None:
    sql = f"""SELECT '{rule.name}' AS rule, count(*) FILTER (WHERE {holds}) AS passed_rows, count(*) AS total_rows,
        round(count(*) FILTER (WHERE {holds}) / count(*), 6) AS score,
        count(*) FILTER (WHERE {holds}) / count(*) >= 0.95 AS passed FROM fin_txn"""

    @query(name, with_views(["fin_txn"], sql))
    def run(spark, sf_dir):
        results = business_rule_results(view(spark, sf_dir, "fin_txn"), [rule])
        return results.withColumn("score", F.round("score", 6))


_expectation("expect_regex", Rule("sort_code_matches", "sort_code", "regex",
                                  {"pattern": validators.SORT_CODE_PATTERN}), SORT_CODE_SQL)
_expectation("expect_between", Rule("amount_between", "amount", "between", {"min_value": 0.01, "max_value": 1000000}),
             "amount BETWEEN 0.01 AND 1000000")
_expectation("expect_in_set", Rule("currency_in_set", "currency", "in_set", {"values": validation.ACCOUNT_CURRENCIES}),
             _among("currency", validation.ACCOUNT_CURRENCIES))


SUSPICIOUS_SQL = """
    SELECT *, nullif(concat_ws('|', CASE WHEN amount > 10000 THEN 'LARGE_AMOUNT' END,
        CASE WHEN amount >= 5000 AND fmod(amount, 1000) = 0 THEN 'ROUND_AMOUNT' END,
        CASE WHEN isodow(try_strptime(transaction_date, '%Y-%m-%d')) >= 6 THEN 'WEEKEND_TRANSACTION' END), '')
        AS suspicious_flags FROM fin_txn"""


@query("suspicious_flags", with_views(
    ["fin_txn"], "SELECT _row_seq AS row_seq, amount, transaction_date, suspicious_flags FROM flagged",
    flagged=SUSPICIOUS_SQL))
def suspicious_flags(spark, sf_dir):
    return suspicious.suspicious_flags(view(spark, sf_dir, "fin_txn")).select(
        F.col("_row_seq").alias("row_seq"), "amount", "transaction_date", "suspicious_flags")


@query("suspicious_summary", with_views(["fin_txn"], """
    SELECT count(*) FILTER (WHERE f) AS suspicious_transactions, count(*) AS total_transactions,
        round(count(*) FILTER (WHERE f) / count(*), 6) AS suspicious_rate
    FROM (SELECT coalesce(amount > 10000 OR (amount >= 5000 AND fmod(amount, 1000) = 0), false)
        OR coalesce(isodow(try_strptime(transaction_date, '%Y-%m-%d')) >= 6, false) AS f FROM fin_txn)"""))
def suspicious_summary(spark, sf_dir):
    return suspicious.suspicious_summary(suspicious.suspicious_flags(view(spark, sf_dir, "fin_txn")))


@query("same_day_velocity", with_views(["payments"], """
    SELECT account_id, CAST(timestamp AS DATE) AS day, count(*) AS transactions,
        CAST(round(sum(CAST(amount AS DECIMAL(28,6))), 2) AS DOUBLE) AS amount_sum
    FROM payments GROUP BY 1, 2 HAVING count(*) >= 2"""))
def same_day_velocity(spark, sf_dir):
    payments = view(spark, sf_dir, "payments").withColumnRenamed("timestamp", "transaction_date")
    return suspicious.same_day_velocity(payments)


# The documented limits (10 payments, 50000) select nothing in these sparse events.
MAX_COUNT, MAX_SUM = 1, 300
WINDOW_SQL = f"""
    SELECT account_id, start AS window_start, start + INTERVAL 5 MINUTE AS window_end, count(*) AS transaction_count,
        CAST(round(sum(CAST(amount AS DECIMAL(28,6))), 2) AS DOUBLE) AS total_amount
    FROM (SELECT account_id, amount, date_trunc('minute', timestamp) - to_minutes(back) AS start
        FROM payments, unnest([0, 1, 2, 3, 4]) AS u(back))
    GROUP BY 1, 2, 3 HAVING count(*) > {MAX_COUNT} OR sum(CAST(amount AS DECIMAL(28,6))) > {MAX_SUM}"""


@query("window_fraud_alerts", with_views(["payments"], WINDOW_SQL))
def window_fraud_alerts(spark, sf_dir):
    return suspicious.window_fraud_alerts(view(spark, sf_dir, "payments"), max_count=MAX_COUNT, max_sum=MAX_SUM)
