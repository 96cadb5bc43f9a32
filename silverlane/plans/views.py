"""Bank-shaped views of the test tables.

Each view is a base table and a list of (name, expression). The expressions are
plain SQL that Spark and the checking database read the same way, so both sides
start from the same rows.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

# The moments "today" stands for.
ORDERS_AS_OF = datetime(2001, 8, 3)
ORDERS_TODAY = date(2001, 8, 3)
EVENTS_AS_OF = datetime(2024, 2, 1)
INGESTED_AT = datetime(2024, 2, 1, 6, 0, 0)

# Sample descriptions.
PHRASES = (
    "Salary Payment", "Tesco Supermarket", "Costa Coffee", "Shell Petrol Station", "ATM Withdrawal",
    "Amazon Purchase", "Netflix Subscription", "Electricity Bill", "Pizza Takeaway", "City Taxi",
    "High Street Pharmacy", "Standing Order Rent", "Overdraft Interest", "Council Tax", "Online Shopping",
    "Cash Withdrawal",
)


def _choose(key: str, values: tuple[str, ...]) -> str:
    """CASE that picks a value by ``key`` modulo their number."""
    arms = " ".join(f"WHEN {i} THEN '{value}'" for i, value in enumerate(values))
    return f"CASE ({key}) % {len(values)} {arms} END"


def _text(expression: str) -> str:
    return f"CAST({expression} AS STRING)"


def _padded(prefix: str, key: str, width: int) -> str:
    return f"'{prefix}' || lpad({_text(key)}, {width}, '0')"


def _day(expression: str) -> str:
    return _text(f"CAST({expression} AS DATE)")


def _iban(sort6: str, account8: str) -> str:
    """UK IBAN of bank WEST with its check digits."""
    number = f"CAST('32142829' || {sort6} || {account8} || '161100' AS DECIMAL(38,0))"
    check = f"lpad({_text(f'98 - CAST({number} % 97 AS INT)')}, 2, '0')"
    return f"'GB' || {check} || 'WEST' || {sort6} || {account8}"


_ACCOUNT8 = "lpad(CAST(o_custkey * 7919 % 100000000 AS STRING), 8, '0')"
_SORT6 = "'1234' || lpad(CAST(o_custkey % 100 AS STRING), 2, '0')"
_C_ACCOUNT8 = "lpad(CAST(c_custkey * 7919 % 100000000 AS STRING), 8, '0')"
_C_SORT6 = "'1234' || lpad(CAST(c_custkey % 100 AS STRING), 2, '0')"

TXN = [
    ("account_id", _padded("ACC", "o_custkey", 10)),
    ("transaction_id", _padded("TXN", "o_orderkey", 10)),
    ("transaction_date", "o_orderdate"),
    ("amount", "o_totalprice"),
    ("description", _choose("o_orderkey", PHRASES)),
    ("transaction_type", _choose("o_orderkey", ("CREDIT", "DEBIT"))),
    ("_row_seq", "o_orderkey"),
]

# Typed rows with missing values in every column a roll-up looks at.
TXN_GAPS = [
    ("account_id", f"CASE WHEN o_orderkey % 91 = 0 THEN NULL ELSE {_padded('ACC', 'o_custkey', 10)} END"),
    ("transaction_id", _padded("TXN", "o_orderkey", 10)),
    ("transaction_date", "CASE WHEN o_orderkey % 60 = 0 THEN NULL ELSE o_orderdate END"),
    ("amount",
     "CASE WHEN o_orderkey % 70 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN 25000.0E0 ELSE o_totalprice END"),
    ("description", f"CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE {_choose('o_orderkey', PHRASES)} END"),
    ("transaction_type", _choose("o_orderkey", ("CREDIT", "DEBIT"))),
    ("_row_seq", "o_orderkey"),
]

# Raw text rows with faults; every row whose key ends in 00 arrives a second time.
_DIRTY = [
    ("account_id", _padded("ACC", "o_custkey", 10)),
    ("transaction_id", _padded("TXN", "o_orderkey", 10)),
    ("transaction_date",
     f"CASE WHEN o_orderkey % 60 = 0 THEN NULL WHEN o_orderkey % 83 = 0 THEN 'not a date' ELSE {_day('o_orderdate')} END"),
    ("amount",
     "CASE WHEN o_orderkey % 70 = 0 THEN NULL WHEN o_orderkey % 97 = 0 THEN 'bad' "
     "ELSE '£' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) END"),
    ("description", f"CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE {_choose('o_orderkey', PHRASES)} END"),
    ("transaction_type", _choose("o_orderkey", ("CREDIT", "DEBIT"))),
    ("balance_after", "CASE WHEN o_orderkey % 45 = 0 THEN NULL ELSE o_totalprice / 4 END"),
    ("risk_points", "CASE WHEN o_orderkey % 40 = 0 THEN NULL ELSE (o_orderkey * 37 % 1000) / 4.0E0 END"),
    ("branch_id", "o_custkey % 17"),
]

# Text rows of three sources whose columns come, go and change type over the years.
_YEAR = "CAST(extract(year FROM o_orderdate) AS INT)"
TXN_YEARLY = [
    ("schema_name", f"'source-' || {_text('o_custkey % 3')}"),
    ("snapshot", _YEAR),
    ("account_id", _padded("ACC", "o_custkey", 10)),
    ("reference",
     f"CASE WHEN {_YEAR} < 1998 THEN {_text('o_orderkey')} ELSE 'R' || {_text('o_orderkey')} END"),
    ("amount", _text("CAST(o_totalprice AS DECIMAL(18,2))")),
    ("fee", f"CASE WHEN {_YEAR} >= 1997 THEN CAST(o_orderkey % 40 AS DOUBLE) / 4 END"),
    ("risk_points", f"CASE WHEN {_YEAR} < 2000 THEN o_orderkey % 1000 END"),
    ("description",
     f"CASE WHEN {_YEAR} % 2 = 1 AND o_orderkey % 50 = 0 THEN NULL ELSE {_choose('o_orderkey', PHRASES)} END"),
]

_FIN_AMOUNT = (
    "CASE WHEN o_orderkey % 17 = 0 THEN 0.0E0 WHEN o_orderkey % 71 = 0 THEN 1000000.01E0 "
    "WHEN o_orderkey % 5 = 0 THEN CAST(o_orderkey % 60 AS DOUBLE) * 1000 ELSE CAST(floor(o_totalprice / 20) AS DOUBLE) + 0.25E0 END"
)
FIN_TXN = [
    ("transaction_id",
     f"CASE WHEN o_orderkey % 47 = 0 THEN NULL WHEN o_orderkey % 43 = 0 THEN 'txn ' || {_text('o_orderkey')} "
     f"ELSE {_padded('TXN', 'o_orderkey', 10)} END"),
    ("account_number", f"CASE WHEN o_orderkey % 11 = 0 THEN 'X' || substr({_ACCOUNT8}, 2, 7) ELSE {_ACCOUNT8} END"),
    ("sort_code",
     f"CASE WHEN o_orderkey % 13 = 0 THEN {_SORT6} ELSE '12-34-' || lpad({_text('o_custkey % 100')}, 2, '0') END"),
    ("amount", _FIN_AMOUNT),
    ("currency", f"CASE WHEN o_orderkey % 19 = 0 THEN 'XXX' ELSE {_choose('o_orderkey', ('GBP', 'EUR', 'usd', 'CHF'))} END"),
    ("transaction_date",
     f"CASE WHEN o_orderkey % 46 = 0 THEN '1980-01-01' WHEN o_orderkey % 23 = 0 THEN '2035-01-01' "
     f"WHEN o_orderkey % 53 = 0 THEN '2001-1-5' WHEN o_orderkey % 59 = 0 THEN '2001-02-30' ELSE {_day('o_orderdate')} END"),
    ("transaction_type",
     f"CASE WHEN o_orderkey % 29 = 0 THEN 'REFUND' ELSE "
     f"{_choose('o_orderkey', ('CREDIT', 'DEBIT', 'TRANSFER', 'PAYMENT', 'WITHDRAWAL', 'DEPOSIT'))} END"),
    ("description", f"CASE WHEN o_orderkey % 31 = 0 THEN repeat('x', 256) ELSE {_choose('o_orderkey', PHRASES)} END"),
    ("counterparty_name",
     f"CASE WHEN o_orderkey % 37 = 0 THEN repeat('n', 101) WHEN o_orderkey % 7 = 0 THEN NULL "
     f"ELSE 'Party ' || {_text('o_custkey')} END"),
    ("counterparty_account",
     f"CASE WHEN o_orderkey % 41 = 0 THEN 'GB00WEST00000000000000' WHEN o_orderkey % 3 = 0 THEN NULL "
     f"WHEN o_orderkey % 3 = 1 THEN {_ACCOUNT8} ELSE {_iban(_SORT6, _ACCOUNT8)} END"),
    ("_row_seq", "o_orderkey"),
]

# The same faults field by field, plus codes only the field checks look at.
FIELDS = [
    ("transaction_id", _padded("TXN", "o_orderkey", 10)),
    ("sort_code",
     f"CASE o_orderkey % 9 WHEN 0 THEN {_SORT6} WHEN 1 THEN NULL WHEN 2 THEN '12-34-5' || chr(10) "
     f"WHEN 3 THEN ' 12-34-56' ELSE '12-34-' || lpad({_text('o_custkey % 100')}, 2, '0') END"),
    ("account_number",
     f"CASE o_orderkey % 8 WHEN 0 THEN substr({_ACCOUNT8}, 1, 7) WHEN 1 THEN NULL WHEN 2 THEN {_ACCOUNT8} || '0' "
     f"ELSE {_ACCOUNT8} END"),
    ("iban",
     f"CASE o_orderkey % 10 WHEN 0 THEN NULL WHEN 1 THEN 'GB82WEST12345698765433' WHEN 2 THEN 'gb82 west 1234 5698 7654 32' "
     f"WHEN 3 THEN 'MT84MALT011000012345MTLCAST001S' WHEN 4 THEN 'GB82' WHEN 5 THEN 'DE89370400440532013000' "
     f"ELSE {_iban(_SORT6, _ACCOUNT8)} END"),
    ("bic", _choose("o_orderkey", ("ABCDGB2L", "abcdgb2lxxx", "ABC", "ABCDGB2LX", "ABCD1B2L"))),
    ("amount_text", _choose("o_orderkey", ("100.50", "0.01", "0", "1000000", "1000000.01", "0.009", "-5", "abc", "1E3"))),
    ("currency", _choose("o_orderkey", ("GBP", "eur", "XXX", "", "HKD"))),
    ("transaction_date",
     f"CASE o_orderkey % 11 WHEN 0 THEN '2001-08-04' WHEN 1 THEN '1990-12-31' WHEN 2 THEN '1991-1-1' "
     f"WHEN 3 THEN '2001-02-30' WHEN 4 THEN NULL WHEN 5 THEN '2001/01/01' ELSE {_day('o_orderdate')} END"),
    ("date_of_birth",
     f"CASE o_orderkey % 6 WHEN 0 THEN '1983-08-03' WHEN 1 THEN '1983-08-04' WHEN 2 THEN '1880-08-04' "
     f"WHEN 3 THEN '1881-01-01' WHEN 4 THEN NULL ELSE CAST(1900 + o_custkey % 100 AS STRING) || '-08-03' END"),
]

ACCT = [
    ("account_id", f"CASE WHEN c_custkey % 17 = 0 THEN {_padded('AC', 'c_custkey', 10)} ELSE {_padded('ACC', 'c_custkey', 10)} END"),
    ("account_number", f"CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE {_C_ACCOUNT8} END"),
    ("sort_code",
     f"CASE WHEN c_custkey % 23 = 0 THEN {_C_SORT6} ELSE '12-34-' || lpad({_text('c_custkey % 100')}, 2, '0') END"),
    ("iban", f"CASE WHEN c_custkey % 29 = 0 THEN NULL WHEN c_custkey % 31 = 0 THEN 'FR00' ELSE {_iban(_C_SORT6, _C_ACCOUNT8)} END"),
    ("account_type", _choose("c_custkey", ("CURRENT", "SAVINGS", "BUSINESS", "ISA", "MORTGAGE", "PREMIUM"))),
    ("balance", "CASE WHEN c_custkey % 37 = 0 THEN NULL WHEN c_custkey % 41 = 0 THEN 1000000000.0E0 ELSE c_acctbal * 9 END"),
    ("currency", f"CASE WHEN c_custkey % 43 = 0 THEN 'JPY' ELSE {_choose('c_custkey', ('GBP', 'EUR', 'USD'))} END"),
    ("status", _choose("c_custkey", ("ACTIVE", "INACTIVE", "CLOSED", "SUSPENDED", "PENDING"))),
    ("created_date", "CASE WHEN c_custkey % 7 = 0 THEN '2020-01-01' ELSE '2020-01-01T00:00:00Z' END"),
    ("last_updated", "'2024-01-31T12:30:00.5+00:00'"),
]

CUST = [
    ("customer_id",
     f"CASE WHEN c_custkey % 53 = 0 THEN {_padded('CUST', 'c_custkey + 1', 8)} WHEN c_custkey % 59 = 0 THEN 'cust-1' "
     f"ELSE {_padded('CUST', 'c_custkey', 8)} END"),
    ("title", _choose("c_custkey", ("Mr", "Mrs", "Miss", "Ms", "Dr", "Prof", "Rev", "Sir"))),
    ("first_name", _choose("c_custkey", ("Anne-Marie", "John", "O''Neil", "J0hn", "Mary Jane"))),
    ("last_name", f"CASE WHEN c_custkey % 61 = 0 THEN NULL WHEN c_custkey % 67 = 0 THEN repeat('z', 51) ELSE {_choose('c_custkey', ('Smith', 'Jones', 'De La Cruz'))} END"),
    ("date_of_birth", "CAST(1870 + c_custkey % 130 AS STRING) || '-08-0' || CAST(1 + c_custkey % 9 AS STRING)"),
    ("email", f"CASE WHEN c_custkey % 11 = 0 THEN 'nobody' WHEN c_custkey % 13 = 0 THEN NULL ELSE 'user' || {_text('c_custkey')} || '@bank.example' END"),
    ("phone", _choose("c_custkey", ("+447911123456", "02079460000", "0012345678", "+44791112"))),
    ("postcode", _choose("c_custkey", ("CV1 2NJ", "SW1A1AA", "cv1 2nj", "12345"))),
    ("risk_rating",
     "CASE c_mktsegment WHEN 'BUILDING' THEN 'LOW' WHEN 'MACHINERY' THEN 'MEDIUM' WHEN 'HOUSEHOLD' THEN 'HIGH' "
     "WHEN 'FURNITURE' THEN 'VERY_HIGH' ELSE 'NONE' END"),
]

RUNS = [
    ("run_id", _padded("RUN", "event_id", 12)),
    ("pipeline_name", f"'pipeline-' || {_text('user_id % 9')}"),
    ("status",
     "CASE WHEN event_type = 'error' THEN 'failed' WHEN event_id % 31 = 0 THEN 'completed_with_warnings' ELSE 'completed' END"),
    ("timestamp", "ts"),
    ("duration_seconds", "CASE WHEN event_id % 6 = 0 THEN NULL ELSE value END"),
    ("rows_processed", "CASE WHEN event_id % 10 = 0 THEN NULL ELSE event_id * 7 % 1000 END"),
]

OPS = [
    ("measurement_id", "event_id"),
    ("operation", _choose("user_id", ("ingestion", "transformation", "validation", "transaction_processing", "export"))),
    ("timestamp", "ts"),
    ("duration", "value * 4"),
]

AUDIT = [
    ("timestamp", "ts"),
    ("user_id", f"'user-' || {_text('user_id')}"),
    ("action", _choose("event_id", ("read", "READ", "write", "validate", "transform", "audit", "anonymize"))),
    ("resource", f"'table-' || {_text('event_id % 20')}"),
    ("data_classification", _choose("user_id", ("PUBLIC", "INTERNAL", "CONFIDENTIAL", "RESTRICTED", "TOP_SECRET"))),
    ("compliance_level",
     _choose("event_id * 7 + user_id", ("PCI_DSS", "GDPR", "SOX", "BASEL_III", "FCA_RULES", "MIFID_II"))),
    ("record_count", "event_id * 13 % 5000"),
    ("success", "event_type <> 'error'"),
    ("error_message", "CASE WHEN event_type = 'error' THEN 'failed' END"),
]

LINEAGE = [
    ("source_file", f"'file-' || {_text('event_id')}"),
    ("destination_table", _choose("event_id", ("silver", "gold", "quarantine"))),
    ("processing_time", "ts"),
    ("retention_days", "CASE event_id % 4 WHEN 0 THEN 7 WHEN 1 THEN 14 WHEN 2 THEN 90 ELSE 2555 END"),
    ("data_quality_score", "value / 500"),
]

INVENTORY = [
    ("dataset", f"'dataset-' || {_text('event_id')}"),
    ("dataset_kind",
     _choose("event_id", ("transaction_data", "customer_data", "audit_logs", "metrics_data", "quarantine_data",
                          "temp_files", "unlisted"))),
    ("created_at", "ts"),
]

OBJECTS = [
    ("path", f"'object-' || {_text('o_orderkey')}"),
    ("layer", _choose("o_orderkey", ("bronze", "silver", "gold", "quarantine"))),
    ("modified_at", "o_orderdate"),
]

METRICS = [
    ("metric_id", "event_id"),
    ("metric_name", f"'metric-' || {_text('user_id')}"),
    ("metric_type", _choose("event_id", ("OPERATIONAL", "COMPLIANCE", "RISK", "PERFORMANCE", "DATA_QUALITY"))),
    ("compliance_level",
     f"CASE WHEN event_id % 35 = 1 THEN NULL ELSE {_choose('user_id', ('GDPR', 'SOX', 'FCA_RULES'))} END"),
    ("value", "CASE WHEN event_id % 5 = 1 THEN CAST(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS DOUBLE) ELSE value / 100 END"),
    ("threshold", "CASE WHEN event_id % 5 = 1 THEN 1.0E0 ELSE 0.25E0 END"),
    ("high_is_bad", "event_id % 5 IN (0, 2, 3)"),
    ("timestamp", "ts"),
]

MEASUREMENTS = [
    ("dataset", f"'dataset-' || {_text('user_id')}"),
    ("timestamp", "ts"),
    ("total_records", "event_id % 900 + 100"),
    ("invalid_records", "event_id * 7 % 100"),
    ("quality_score", "CASE WHEN value > 100 THEN 1.0E0 ELSE value / 100 END"),
]

CHECKS = [
    ("timestamp", "ts"),
    ("compliance_level", _choose("user_id", ("GDPR", "SOX", "FCA_RULES", "MIFID_II"))),
    ("check_name", f"'check-' || {_text('event_id')}"),
    ("passed", "event_type <> 'error'"),
    ("affected_records", "event_id * 3 % 700"),
]

RISKS = [
    ("risk_type", f"'risk-' || {_text('event_id')}"),
    ("risk_score", "value / 500"),
    ("threshold", "0.125E0"),
    ("affected_entities", "user_id"),
    ("timestamp", "ts"),
]

STAGES = [
    ("run_id", _text("CAST(floor(event_id / 6) AS BIGINT)")),
    ("stage", _choose("event_id", ("ingestion", "transformation", "data_quality"))),
    ("status", "CASE WHEN event_id % 29 = 0 THEN 'failed' ELSE 'completed' END"),
    ("rows", "event_id * 11 % 3000"),
    ("passed", "CASE WHEN event_id % 3 = 2 THEN event_type <> 'error' END"),
]

PAYMENTS = [
    ("event_id", "event_id"),
    ("timestamp", "ts"),
    ("account_id", "user_id"),
    ("amount", "value"),
]

VIEWS: dict[str, tuple[str, list[tuple[str, str]]]] = {
    "txn": ("orders", TXN), "txn_gaps": ("orders", TXN_GAPS), "txn_yearly": ("orders", TXN_YEARLY),
    "fin_txn": ("orders", FIN_TXN), "field_values": ("orders", FIELDS),
    "acct": ("customer", ACCT), "cust": ("customer", CUST), "runs": ("events", RUNS), "ops": ("events", OPS),
    "audit_log": ("events", AUDIT), "lineage_steps": ("events", LINEAGE), "inventory": ("events", INVENTORY),
    "objects": ("orders", OBJECTS), "metric_log": ("events", METRICS), "measurements": ("events", MEASUREMENTS),
    "checks": ("events", CHECKS), "risks": ("events", RISKS), "stages": ("events", STAGES),
    "payments": ("events", PAYMENTS),
}

SECOND_COPY = 1_000_000_000_000


def _projection(columns: list[tuple[str, str]]) -> list[str]:
    return [f"{expression} AS {name}" for name, expression in columns]


def _select(view: str) -> str:
    table, columns = VIEWS[view]
    return f"SELECT {', '.join(_projection(columns))} FROM {table}"


def _dirty_select() -> str:
    body = ", ".join(_projection(_DIRTY))
    return (
        f"SELECT {body}, o_orderkey AS _row_seq FROM orders UNION ALL "
        f"SELECT {body}, o_orderkey + {SECOND_COPY} AS _row_seq FROM orders WHERE o_orderkey % 100 = 0"
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == "txn_dirty":
        orders = table(spark, sf_dir, "orders")
        first = orders.selectExpr(*_projection(_DIRTY), "o_orderkey AS _row_seq")
        again = orders.filter("o_orderkey % 100 = 0").selectExpr(
            *_projection(_DIRTY), f"o_orderkey + {SECOND_COPY} AS _row_seq"
        )
        return first.unionByName(again)
    base, columns = VIEWS[name]
    return table(spark, sf_dir, base).selectExpr(*_projection(columns))


def with_views(names: list[str], body: str, **extra: str) -> str:
    """SQL with the named views (and extra named selects) in front of ``body``."""
    parts = [f"{n} AS ({_dirty_select() if n == 'txn_dirty' else _select(n)})" for n in names]
    parts += [f"{n} AS ({sql})" for n, sql in extra.items()]
    return f"WITH {', '.join(parts)} {body}"
