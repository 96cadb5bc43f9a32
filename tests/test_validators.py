"""Truth tables of the field checks and the golden transactions."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from silverlane.functions import validators as v
from silverlane.functions.rules import Rule, predicate, with_errors
from silverlane.functions.text import categorize, datetime_from_text, money_from_text, value_kind
from silverlane.operators.suspicious import suspicious_flags, suspicious_summary
from silverlane.operators.validation import transaction_rules, unexpected_columns, account_rules, validity_counts
from silverlane.plans.pipeline import financial_validation

TODAY = date(2024, 6, 15)


def _ask(spark, check, values, dtype="string"):
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(values)], f"i int, x {dtype}")
    return [r[0] for r in frame.orderBy("i").select(check(F.col("x"))).collect()]


TABLES = {
    "sort_code": (v.valid_sort_code, {"12-34-56": True, "123456": False, "12-34-5a": False, "12-34-56\n": False, "": False, None: False}),
    "account_number": (v.valid_account_number, {"12345678": True, "1234567": False, "123456789": False, "1234567x": False, None: False}),
    "iban": (v.valid_iban, {
        "GB82WEST12345698765432": True, "gb82 west 1234 5698 7654 32": True, "DE89370400440532013000": True,
        "MT84MALT011000012345MTLCAST001S": True, "GB82WEST12345698765433": False, "GB82": False, "": False,
        "1282WEST12345698765432": False, None: False}),
    "bic": (v.valid_swift_bic, {"ABCDGB2L": True, "abcdgb2lxxx": True, "ABC": False, "ABCDGB2LX": False, None: False}),
    "currency": (v.valid_currency, {"GBP": True, "gbp": True, "XXX": False, "": False, None: False}),
    "amount": (v.valid_amount_range, {
        "100.50": True, "0.01": True, "1000000": True, "0": False, "1000000.01": False, "-1": False, "abc": False,
        "0.00999999999999": False, None: False}),
    "date": (lambda c: v.valid_transaction_date(c, TODAY), {
        "2024-06-15": True, "2024-6-5": True, "2014-01-01": True, "2013-12-31": False, "2024-06-16": False,
        "2024-02-30": False, "15/06/2024": False, None: False}),
    "birth": (lambda c: v.valid_date_of_birth(c, TODAY), {
        "2006-06-15": True, "2006-06-16": False, "1903-06-16": True, "1903-06-15": False, "bad": False, None: False}),
    "category": (categorize, {
        "Tesco Supermarket": "Grocery", "Shell Petrol Station": "Fuel", "Netflix Subscription": "Entertainment",
        "ATM Withdrawal": "ATM", "Amazon Purchase": "Retail", "Electricity Bill": "Utilities", "Costa Coffee": "Fee",
        "Salary Payment": "Other", "Online Shopping": "Retail", "Cash Withdrawal": "ATM", None: "Unknown"}),
    "money": (money_from_text, {
        "£1,234.50": 1234.5, "€ 7": 7.0, "-3": -3.0, "1e3": 1000.0, "12d": None, "bad": None, "": None, None: None}),
    "kind": (value_kind, {
        "12": 1, "-1.5": 2, "2024-01-31": 4, "TRUE": 8, "x": 16, "-": 16, "": 16, None: None}),
}


@pytest.mark.parametrize("name", sorted(TABLES))
def test_truth_table(spark, name):
    check, table = TABLES[name]
    assert _ask(spark, check, list(table)) == list(table.values())


def test_datetime_shapes(spark):
    table = {
        "2024-1-5": datetime(2024, 1, 5), "2024-01-05 3:04:05": datetime(2024, 1, 5, 3, 4, 5),
        "2024-01-05T03:04:05.25": datetime(2024, 1, 5, 3, 4, 5, 250000), "2024/01/05": datetime(2024, 1, 5),
        "1/5/2024": datetime(2024, 1, 5), "20240105": datetime(2024, 1, 5), "2024-02-30": None, "soon": None,
        "2024-01-05T": None,
    }
    assert _ask(spark, datetime_from_text, list(table)) == list(table.values())


def test_numeric_amounts(spark):
    found = _ask(spark, lambda c: v.valid_amount_range(c, numeric=True),
                 [0.01, 1000000.0, 0.0, 1000000.01, None, float("nan")], "double")
    assert found == [True, True, False, False, False, False]


GOLDEN = [
    ("TXN001", "12345678", "12-34-56", 150.50, "2024-01-15", "DEBIT", None, None),
    ("TXN002", "87654321", "65-43-21", 2500.00, "2024-01-15", "CREDIT", "98765432", None),
    ("TXN003", "11111111", "11-11-11", 15000.00, "2024-01-16", "TRANSFER", "12121212", "LARGE_AMOUNT|ROUND_AMOUNT"),
    ("TXN004", "22222222", "22-22-22", 75.25, "2024-01-16", "PAYMENT", None, None),
    ("TXN005", "33333333", "33-33-33", 500.00, "2024-01-17", "WITHDRAWAL", None, None),
    ("TXN006", "44444444", "44-44-44", 10000.00, "2024-01-20", "DEPOSIT", "34343434", "ROUND_AMOUNT|WEEKEND_TRANSACTION"),
    ("TXN007", "55555555", "55-55-55", 25000.00, "2024-01-21", "TRANSFER", "GB82WEST12345698765432",
     "LARGE_AMOUNT|ROUND_AMOUNT|WEEKEND_TRANSACTION"),
    ("TXN008", "66666666", "66-66-66", 100.00, "2024-01-22", "PAYMENT", None, None),
    ("TXN009", "77777777", "77-77-77", 1000.00, "2024-01-23", "DEBIT", None, None),
    ("TXN010", "88888888", "88-88-88", 50000.00, "2024-01-24", "TRANSFER", "56565656", "LARGE_AMOUNT|ROUND_AMOUNT"),
]


@pytest.fixture
def golden(spark):
    rows = spark.createDataFrame(
        GOLDEN,
        "transaction_id string, account_number string, sort_code string, amount double, transaction_date string, "
        "transaction_type string, counterparty_account string, expected string")
    return rows.withColumns({
        "currency": F.lit("GBP"), "description": F.lit("Payment"), "counterparty_name": F.lit("Party")})


def test_golden_flags(golden):
    rows = suspicious_flags(golden).collect()
    assert all(r["suspicious_flags"] == r["expected"] for r in rows)
    summary = suspicious_summary(suspicious_flags(golden)).first()
    assert (summary["suspicious_transactions"], summary["total_transactions"], summary["suspicious_rate"]) == (4, 10, 0.4)


def test_golden_flow(golden, spark, tmp_path):
    out = financial_validation(golden, datetime(2024, 2, 1), str(tmp_path / "audit"))
    assert out["quality"].first()["quality_score"] == 1.0
    severity = {r["metric_name"]: r["severity"] for r in out["metrics"].collect()}
    assert severity == {"transactions_data_quality": "LOW", "risk_suspicious_transactions": "CRITICAL"}
    assert out["alerts"].first()["severity"] == "CRITICAL"
    logged = spark.read.parquet(str(tmp_path / "audit")).collect()
    assert {r["action"] for r in logged} == {"INGEST", "VALIDATE", "SUSPICIOUS_ACTIVITY_CHECK"}
    assert len({r["event_id"] for r in logged}) == 3


def test_repeated_flow_replaces_its_audit_rows(golden, spark, tmp_path):
    for _ in range(2):
        financial_validation(golden, datetime(2024, 2, 1), str(tmp_path / "audit"), "run-7")
    assert spark.read.parquet(str(tmp_path / "audit")).count() == 3


def test_missing_column_breaks_required_rules(spark, golden):
    checked = with_errors(golden.drop("currency"), transaction_rules(), TODAY)
    assert "currency:not_null" in checked.first()["_errors"]
    assert validity_counts(checked).first()["valid_records"] == 0


def test_extra_columns_are_named(golden):
    assert unexpected_columns(golden.select("sort_code", "amount"), account_rules()) == ["amount"]


def test_uncheckable_rule_has_no_predicate(golden):
    assert predicate(Rule("r", "nowhere", "not_null"), golden.schema) is None
    assert predicate(Rule("r", "amount", "resembles"), golden.schema) is None
