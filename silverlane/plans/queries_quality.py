"""Scorecard and quarantine queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from silverlane.functions.rules import ERRORS, Rule, with_errors
from silverlane.operators import quality
from silverlane.operators.validation import transaction_rules
from silverlane.plans.queries_rows import TRANSACTION_ERRORS_SQL
from silverlane.plans.registry import query
from silverlane.plans.views import INGESTED_AT, ORDERS_AS_OF, view, with_views
from silverlane.session import work_path
from silverlane.sources.writers import write_quarantine

# The rules of the sample configuration and of the sample tests.
CONFIG_RULES = [
    Rule.from_config({"name": "transaction_amount_positive", "column": "amount", "check": "greater_than", "value": 0}),
    Rule.from_config({"name": "account_id_not_null", "column": "account_id", "check": "not_null"}),
    Rule.from_config({"name": "transaction_date_valid", "column": "transaction_date", "check": "date_range",
                      "min_date": "1996-01-01", "max_date": "2030-12-31"}),
]
EXTRA_RULES = [
    Rule("account_id_pattern", "account_id", "regex", {"pattern": r"^ACC[0-9]{3}\z"}),
    Rule("amount_abs_cap", "amount", "abs_less_than", {"value": 100000}),
    Rule("date_span", "transaction_date", "date_span", {"years": 5}),
]
ODD_RULES = [Rule("no_such_column", "nowhere", "not_null"), Rule("no_such_check", "amount", "resembles")]

SNAPSHOT = [
    {"field": "account_id", "dtype": "object", "nullable": False, "min_value": None, "max_value": None, "max_length": 13},
    {"field": "amount", "dtype": "float64", "nullable": True, "min_value": 1000.0, "max_value": 500000.0, "max_length": None},
]
LANDED_AT = datetime(2001, 8, 2, 12, 0, 0)


def _rule_sql(view_name: str, name: str, holds: str, by: str = "") -> str:
    key, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    return f"""SELECT {key}'{name}' AS rule, count(*) FILTER (WHERE {holds}) AS passed_rows, count(*) AS total_rows,
        count(*) FILTER (WHERE {holds}) / count(*) AS score,
        count(*) FILTER (WHERE {holds}) / count(*) >= 0.95 AS passed FROM {view_name} {group}"""


_POSITIVE, _HAS_ACCOUNT = "amount > 0", "account_id IS NOT NULL"
_IN_RANGE = "transaction_date BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '2030-12-31'"
_RULE_ROWS_SQL = " UNION ALL ".join([
    _rule_sql("txn_gaps", "transaction_amount_positive", _POSITIVE),
    _rule_sql("txn_gaps", "account_id_not_null", _HAS_ACCOUNT),
    _rule_sql("txn_gaps", "transaction_date_valid", _IN_RANGE),
    _rule_sql("txn_gaps", "no_such_column", "false"),
    _rule_sql("txn_gaps", "no_such_check", "false"),
])


def _landed(spark, sf_dir):
    return view(spark, sf_dir, "txn_gaps").withColumn(
        quality.INGEST_TIME, F.lit(LANDED_AT).cast("timestamp_ntz"))


@query("dq_schema_check", with_views(["txn_gaps"], """
    SELECT count(*) FILTER (WHERE bad) AS failed_rows, CAST(CASE WHEN bool_or(bad) THEN 0 ELSE 1 END AS DOUBLE) AS score,
        NOT bool_or(bad) AS passed
    FROM (SELECT account_id IS NULL OR coalesce(length(account_id) > 13, false)
        OR coalesce(amount < 1000 OR amount > 500000, false) AS bad FROM txn_gaps)"""))
def dq_schema_check(spark, sf_dir):
    return quality.schema_check(view(spark, sf_dir, "txn_gaps"), SNAPSHOT)


@query("dq_business_rules", with_views(
    ["txn_gaps"], f"SELECT rule, passed_rows, total_rows, round(score, 6) AS score, passed FROM ({_RULE_ROWS_SQL})"))
def dq_business_rules(spark, sf_dir):
    results = quality.business_rule_results(view(spark, sf_dir, "txn_gaps"), CONFIG_RULES + ODD_RULES)
    return results.withColumn("score", F.round("score", 6))


@query("dq_business_rules_score", with_views(
    ["txn_gaps"], f"SELECT round(avg(score), 6) AS score, avg(score) >= 0.95 AS passed FROM ({_RULE_ROWS_SQL})"))
def dq_business_rules_score(spark, sf_dir):
    results = quality.business_rule_results(view(spark, sf_dir, "txn_gaps"), CONFIG_RULES + ODD_RULES)
    return quality.business_rules_score(results).withColumn("score", F.round("score", 6))


def _one_rule(name: str, rule: Rule, holds: str) -> None:
    sql = _rule_sql("txn_gaps", rule.name, holds)

    @query(name, with_views(
        ["txn_gaps"], f"SELECT rule, passed_rows, total_rows, round(score, 6) AS score, passed FROM ({sql})"))
    def run(spark, sf_dir):
        results = quality.business_rule_results(view(spark, sf_dir, "txn_gaps"), [rule], ORDERS_AS_OF)
        return results.withColumn("score", F.round("score", 6))


_one_rule("account_id_pattern_rule", EXTRA_RULES[0], "regexp_full_match(account_id, 'ACC[0-9]{3}')")
_one_rule("amount_abs_cap", EXTRA_RULES[1], "abs(amount) < 100000")
_one_rule("date_span_rule", EXTRA_RULES[2],
          "transaction_date BETWEEN TIMESTAMP '2001-08-03' - INTERVAL 1825 DAY AND TIMESTAMP '2001-08-03'")

_GAP_COLUMNS = ("account_id", "transaction_id", "transaction_date", "amount", "description", "transaction_type")
_COMPLETE_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS non_null_count, count(*) AS total_count, "
    f"count({c}) / count(*) AS completeness FROM txn_gaps" for c in _GAP_COLUMNS)


@query("dq_completeness", with_views(["txn_gaps"], f"""
    SELECT "column", non_null_count, total_count, round(completeness, 6) AS completeness FROM ({_COMPLETE_SQL})"""))
def dq_completeness(spark, sf_dir):
    rows = quality.completeness(view(spark, sf_dir, "txn_gaps"))
    return rows.withColumn("completeness", F.round("completeness", 6))


@query("dq_completeness_score", with_views(["txn_gaps"], f"""
    SELECT round(avg(completeness), 6) AS score, avg(completeness) >= 0.9 AS passed FROM ({_COMPLETE_SQL})"""))
def dq_completeness_score(spark, sf_dir):
    score = quality.completeness_score(quality.completeness(view(spark, sf_dir, "txn_gaps")))
    return score.withColumn("score", F.round("score", 6))


_DIRTY_KEYS = ("account_id, transaction_id, transaction_date, amount, description, transaction_type, balance_after, "
               "risk_points, branch_id")


@query("dq_duplicates", with_views(["txn_dirty"], f"""
    SELECT count(*) AS total_rows, count(*) FILTER (WHERE place > 1) AS duplicate_count,
        round(count(*) FILTER (WHERE place > 1) / count(*), 6) AS duplicate_rate,
        count(*) FILTER (WHERE place > 1) / count(*) < 0.01 AS passed
    FROM (SELECT row_number() OVER (PARTITION BY {_DIRTY_KEYS} ORDER BY _row_seq) AS place FROM txn_dirty)"""))
def dq_duplicates(spark, sf_dir):
    found = quality.duplicates(view(spark, sf_dir, "txn_dirty"))
    return found.withColumn("duplicate_rate", F.round("duplicate_rate", 6))


def _kind_sql(column: str) -> str:
    return (
        f"CASE WHEN {column} IS NULL THEN NULL WHEN TRY_CAST({column} AS BIGINT) IS NOT NULL THEN 'integer' "
        f"WHEN TRY_CAST({column} AS DOUBLE) IS NOT NULL THEN 'decimal' "
        f"WHEN TRY_CAST({column} AS TIMESTAMP) IS NOT NULL THEN 'datetime' "
        f"WHEN lower({column}) IN ('true', 'false') THEN 'boolean' ELSE 'text' END"
    )


_DIRTY_TEXT = ("account_id", "transaction_id", "transaction_date", "amount", "description", "transaction_type")


@query("dq_type_consistency", with_views(["txn_dirty"], " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count(DISTINCT {_kind_sql(c)}) AS INTEGER) AS kinds, "
    f"count(DISTINCT {_kind_sql(c)}) <= 1 AS passed FROM txn_dirty" for c in _DIRTY_TEXT)))
def dq_type_consistency(spark, sf_dir):
    return quality.type_consistency(view(spark, sf_dir, "txn_dirty"))


@query("dq_freshness_ingest", """
    SELECT round(epoch(TIMESTAMP '2001-08-03' - max(landed)) / 3600, 4) AS hours_since_ingestion,
        TIMESTAMP '2001-08-03' - max(landed) < INTERVAL 24 HOUR AS passed
    FROM (SELECT CAST('2001-08-02 12:00:00' AS TIMESTAMP) AS landed FROM orders)""")
def dq_freshness_ingest(spark, sf_dir):
    return quality.freshness_ingest(_landed(spark, sf_dir), ORDERS_AS_OF)


@query("dq_freshness_business", with_views(["txn_gaps"], """
    SELECT 'transaction_date' AS "column",
        CAST(floor(epoch(TIMESTAMP '2001-08-03' - max(transaction_date)) / 86400) AS BIGINT) AS days_since_latest,
        TIMESTAMP '2001-08-03' - max(transaction_date) < INTERVAL 7 DAY AS passed FROM txn_gaps"""))
def dq_freshness_business(spark, sf_dir):
    return quality.freshness_business(view(spark, sf_dir, "txn_gaps"), ORDERS_AS_OF)


_CARD_SQL = {
    "counts": f"""SELECT count(*) AS n, count(*) FILTER (WHERE {_POSITIVE}) AS positive,
        count(account_id) AS accounts, count(*) FILTER (WHERE {_IN_RANGE}) AS dated,
        {' + '.join(f'count({c}) / count(*)' for c in _GAP_COLUMNS)} AS complete,
        count(*) - count(DISTINCT ({', '.join(_GAP_COLUMNS)})) AS copies,
        bool_or(account_id IS NULL OR coalesce(amount < 1000 OR amount > 500000, false)) AS bad_schema,
        max(transaction_date) AS latest FROM txn_gaps""",
    "parts": """SELECT n, CASE WHEN bad_schema THEN 0.0 ELSE 1.0 END AS s1,
        (positive / n + accounts / n + dated / n) / 3 AS s2, complete / 6 AS s3,
        (CASE WHEN copies / n < 0.01 THEN 1 ELSE 0 END + 1) / 2 AS s4,
        (1 + CASE WHEN TIMESTAMP '2001-08-03' - latest < INTERVAL 7 DAY THEN 1 ELSE 0 END) / 2 AS s5 FROM counts""",
    "card": """SELECT n AS total_rows, 'schema_validation' AS "check", s1 AS score, s1 >= 1 AS passed FROM parts
        UNION ALL SELECT n, 'business_rules', s2, s2 >= 0.95 FROM parts
        UNION ALL SELECT n, 'completeness', s3, s3 >= 0.9 FROM parts
        UNION ALL SELECT n, 'consistency', s4, s4 >= 0.9 FROM parts
        UNION ALL SELECT n, 'freshness', s5, s5 >= 0.8 FROM parts
        UNION ALL SELECT n, 'overall', (s1 + s2 + s3 + s4 + s5) / 5, (s1 + s2 + s3 + s4 + s5) / 5 >= 0.95 FROM parts""",
}


def _card(spark, sf_dir):
    return quality.scorecard(_landed(spark, sf_dir), CONFIG_RULES, SNAPSHOT, ORDERS_AS_OF)


@query("dq_scorecard", with_views(
    ["txn_gaps"], 'SELECT total_rows, "check", round(score, 6) AS score, passed FROM card', **_CARD_SQL))
def dq_scorecard(spark, sf_dir):
    return _card(spark, sf_dir).withColumn("score", F.round("score", 6))


@query("quality_report", with_views(["txn_gaps"], """
    SELECT total_rows, "check", round(score, 6) AS score, passed, CASE WHEN passed THEN NULL ELSE CASE "check" """ + " ".join(f"WHEN '{check}' THEN '{advice}'" for check, advice in quality.RECOMMENDATIONS.items()) + """
        END END AS recommendation
    FROM card""", **_CARD_SQL))
def quality_report(spark, sf_dir):
    return quality.quality_report(_card(spark, sf_dir)).withColumn("score", F.round("score", 6))


@query("quarantine_rows", with_views(
    ["fin_txn"], "SELECT row_seq, errors FROM checked WHERE errors <> ''", checked=TRANSACTION_ERRORS_SQL))
def quarantine_rows(spark, sf_dir):
    checked = with_errors(view(spark, sf_dir, "fin_txn"), transaction_rules(), ORDERS_AS_OF)
    return quality.quarantine_rows(checked).select(
        F.col("_row_seq").alias("row_seq"), F.concat_ws("|", ERRORS).alias("errors"))


@query("quarantine_batch", with_views(
    ["fin_txn"], "SELECT row_seq, errors FROM checked WHERE (SELECT count(*) FROM checked WHERE errors <> '') > 0",
    checked=TRANSACTION_ERRORS_SQL))
def quarantine_batch(spark, sf_dir):
    checked = with_errors(view(spark, sf_dir, "fin_txn"), transaction_rules(), ORDERS_AS_OF)
    return quality.quarantine_rows(checked, mode="batch").select(
        F.col("_row_seq").alias("row_seq"), F.concat_ws("|", ERRORS).alias("errors"))


@query("quarantine_reprocess", with_views(["fin_txn"], """
    SELECT row_seq FROM checked JOIN fin_txn ON row_seq = _row_seq
    WHERE errors = 'transaction_date:transaction_date' AND transaction_date = '2035-01-01'""",
    checked=TRANSACTION_ERRORS_SQL))
def quarantine_reprocess(spark, sf_dir):
    """Rows held for a date in the future are released once that day has come."""
    base = work_path(spark, "quarantine")
    checked = with_errors(view(spark, sf_dir, "fin_txn"), transaction_rules(), ORDERS_AS_OF)
    write_quarantine(quality.quarantine_rows(checked), base, "transactions", INGESTED_AT, "run-1")
    held = spark.read.parquet(base)
    # Ten years back from 2036 would reject every order date, so only rows dated 2035 can pass.
    released, _ = quality.reprocess_quarantine(held, transaction_rules(), datetime(2036, 1, 1))
    return released.select(F.col("_row_seq").alias("row_seq"))


_SOURCE = "'source-' || CAST(branch_id % 4 AS VARCHAR)"
_DIRTY_COLUMNS = ("account_id", "transaction_id", "transaction_date", "amount", "description", "transaction_type",
                  "balance_after", "risk_points", "branch_id")
_SOURCE_CARD = {
    "named": f"SELECT *, {_SOURCE} AS source_name FROM txn_dirty",
    "kinds": "SELECT source_name, " + " AND ".join(
        f"count(DISTINCT {_kind_sql(c)}) <= 1" for c in _DIRTY_TEXT) + " AS one_kind FROM named GROUP BY 1",
    "copied": f"""SELECT source_name, sum(c - 1) / sum(c) AS rate FROM (
        SELECT source_name, count(*) AS c FROM named GROUP BY source_name, {_DIRTY_KEYS}) GROUP BY 1""",
    "counts": f"""SELECT source_name, count(*) AS n, count(account_id) / count(*) AS accounts,
        count(*) FILTER (WHERE TRY_CAST(replace(amount, '£', '') AS DOUBLE) > 0) / count(*) AS positive,
        count(*) FILTER (WHERE CAST(try_strptime(transaction_date, '%Y-%m-%d') AS TIMESTAMP)
            BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '2030-12-31') / count(*) AS dated,
        ({' + '.join(f'count({c}) / count(*)' for c in _DIRTY_COLUMNS)}) / 9 AS complete,
        count(*) FILTER (WHERE transaction_date = 'not a date') AS unparsed,
        max(try_strptime(transaction_date, '%Y-%m-%d')) AS latest FROM named GROUP BY 1""",
    "parts": """SELECT source_name, n, 0.0 AS s1, (positive + accounts + dated) / 3 AS s2, complete AS s3,
        (CASE WHEN rate < 0.01 THEN 1 ELSE 0 END + CASE WHEN one_kind THEN 1 ELSE 0 END) / 2 AS s4,
        CASE WHEN unparsed > 0 THEN 1.0 WHEN TIMESTAMP '2001-08-03' - latest < INTERVAL 7 DAY THEN 1.0
            ELSE 0.0 END AS s5
        FROM counts JOIN kinds USING (source_name) JOIN copied USING (source_name)""",
    "card": """SELECT source_name, n AS total_rows, 'schema_validation' AS "check", s1 AS score, s1 >= 1 AS passed
        FROM parts UNION ALL SELECT source_name, n, 'business_rules', s2, s2 >= 0.95 FROM parts
        UNION ALL SELECT source_name, n, 'completeness', s3, s3 >= 0.9 FROM parts
        UNION ALL SELECT source_name, n, 'consistency', s4, s4 >= 0.9 FROM parts
        UNION ALL SELECT source_name, n, 'freshness', s5, s5 >= 0.8 FROM parts
        UNION ALL SELECT source_name, n, 'overall', (s1 + s2 + s3 + s4 + s5) / 5,
            (s1 + s2 + s3 + s4 + s5) / 5 >= 0.95 FROM parts""",
}


@query("bronze_quality_assessment", with_views(
    ["txn_dirty"], 'SELECT source_name, total_rows, "check", round(score, 6) AS score, passed FROM card',
    **_SOURCE_CARD))
def bronze_quality_assessment(spark, sf_dir):
    raw = view(spark, sf_dir, "txn_dirty").withColumn(
        "_source_name", F.concat(F.lit("source-"), (F.col("branch_id") % 4).cast("string")))
    cards = quality.scorecard(raw, CONFIG_RULES, None, ORDERS_AS_OF, by=["_source_name"])
    return cards.withColumnRenamed("_source_name", "source_name").withColumn("score", F.round("score", 6))
