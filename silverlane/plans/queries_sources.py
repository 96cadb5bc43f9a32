"""Source, sink and end-to-end queries: write the test tables out, read them back."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from silverlane.functions.rules import ERRORS, Rule, with_errors
from silverlane.operators.metrics import compliance_metrics
from silverlane.operators.quality import quarantine_rows
from silverlane.operators.suspicious import suspicious_flags
from silverlane.operators.validation import transaction_rules
from silverlane.operators.aggregates import gold_tables
from silverlane.operators.enrichment import enrich
from silverlane.plans import pipeline
from silverlane.plans.queries_clean import CLEAN_SQL, FILLED_SQL, TYPED_SQL
from silverlane.plans.queries_gold import CATEGORY_SQL, MEAN_SQL, SILVER_SQL, SUM_SQL
from silverlane.plans.queries_rows import SUSPICIOUS_SQL, TRANSACTION_ERRORS_SQL
from silverlane.plans.registry import query
from silverlane.plans.views import INGESTED_AT, ORDERS_AS_OF, table, view, with_views
from silverlane.session import work_path
from silverlane.sources import ranges, readers, writers
from silverlane.sources.ingest import Source, add_ingest_metadata, ingest_sources

_TXN_COLUMNS = "account_id, transaction_id, transaction_date, amount, description, transaction_type"
_TXN = [name.strip() for name in _TXN_COLUMNS.split(",")]
_ACCT_COLUMNS = ("account_id, account_number, sort_code, iban, account_type, balance, currency, status, created_date, "
                 "last_updated")
_ACCT = [name.strip() for name in _ACCT_COLUMNS.split(",")]
RUN = "run-1"


def _txn(spark, sf_dir):
    return view(spark, sf_dir, "txn").select(*_TXN)


_TXN_TYPES = ("account_id string, transaction_id string, transaction_date timestamp_ntz, amount double, "
              "description string, transaction_type string")
# Both engines read this: every third description gets a comma, quotes and a line break.
_QUOTED = """CASE WHEN CAST(substr(transaction_id, 4) AS BIGINT) % 3 = 0
    THEN description || ', "' || transaction_id || '"' || chr(10) || 'end' ELSE description END"""


@query("scan_csv", with_views(["txn"], f"SELECT {_TXN_COLUMNS.replace('description', _QUOTED + ' AS description')} FROM txn"))
def scan_csv(spark, sf_dir):
    path = work_path(spark, "csv")
    writers.export_csv(_txn(spark, sf_dir).withColumn("description", F.expr(_QUOTED)), path)
    return readers.scan_csv(spark, path, _TXN_TYPES, multi_line=True)


@query("scan_csv_ranges", with_views(["txn"], f"SELECT {_TXN_COLUMNS.replace('description', _QUOTED + ' AS description')} FROM txn"))
def scan_csv_ranges(spark, sf_dir):
    """The same files by ranges of 256 kB, so that several tasks share a file."""
    path = work_path(spark, "csv")
    writers.export_csv(_txn(spark, sf_dir).withColumn("description", F.expr(_QUOTED)), path)
    return ranges.scan_csv_ranges(spark, path, _TXN_TYPES, range_bytes=256 << 10)


# Every fifth line has a field too many, every seventh an amount that is none.
_LINE = """CAST(o_orderkey AS STRING) || ',' || CASE WHEN o_orderkey % 7 = 0 THEN 'none' ELSE '12.5' END ||
    CASE WHEN o_orderkey % 5 = 0 THEN ',extra' ELSE '' END"""


@query("scan_csv_rejected", f"""
    SELECT {_LINE.replace('STRING', 'VARCHAR')} AS record, CASE WHEN o_orderkey % 5 = 0 THEN 'too_many_fields'
        ELSE 'missing_or_unreadable_field' END AS reason
    FROM orders WHERE o_orderkey % 5 = 0 OR o_orderkey % 7 = 0""")
def scan_csv_rejected(spark, sf_dir):
    """Lines that do not fit the schema, with the reason."""
    path = work_path(spark, "lines")
    lines = table(spark, sf_dir, "orders").select(F.expr(_LINE).alias("value"))
    lines.write.text(path)
    scanned = readers.scan_csv(spark, path, "o_orderkey bigint, amount double", keep_rejected=True, header=False)
    return readers.split_rejected(scanned)[1]


@query("scan_json", with_views(["acct"], f"SELECT {_ACCT_COLUMNS} FROM acct"))
def scan_json(spark, sf_dir):
    path = work_path(spark, "json")
    view(spark, sf_dir, "acct").write.json(path)
    return readers.scan_json(spark, path, lines=True).select(*_ACCT)


def _as_document(parts):
    yield pd.DataFrame({"value": ["["]})
    comma = ""
    for part in parts:
        if len(part):
            yield pd.DataFrame({"value": comma + part["value"].str.cat(sep="\n,")}, index=[0])
            comma = ","
    yield pd.DataFrame({"value": ["]"]})


@query("scan_json_document", with_views(["acct"], f"SELECT {_ACCT_COLUMNS} FROM acct"))
def scan_json_document(spark, sf_dir):
    """Lists of objects in documents, by ranges of 256 kB, so that several tasks share a document."""
    path = work_path(spark, "json")
    accounts = view(spark, sf_dir, "acct").select(*_ACCT)
    accounts.select(F.to_json(F.struct(*_ACCT)).alias("value")).mapInPandas(_as_document, "value string").write.text(path)
    return ranges.scan_json_ranges(spark, path, accounts.schema, range_bytes=256 << 10)


@query("scan_object_store", with_views(["txn"], f"SELECT {_TXN_COLUMNS} FROM txn"))
def scan_object_store(spark, sf_dir):
    root = work_path(spark, "store")
    rows = _txn(spark, sf_dir)
    for kind in ("CREDIT", "DEBIT"):
        rows.filter(F.col("transaction_type") == kind).write.parquet(f"{root}/raw/{kind.lower()}/day")
    return readers.scan_object_store(spark, f"{root}/raw", "parquet", glob="*.parquet")


@query("scan_object_store_csv", with_views(["txn"], f"""
    SELECT {_TXN_COLUMNS.replace('description', _QUOTED + ' AS description')}, 'row' AS kind FROM txn
    UNION ALL SELECT NULL, NULL, NULL, NULL, 'lost,' || o_orderkey || ',,none,,', NULL, 'missing_or_unreadable_field'
    FROM orders WHERE o_orderkey % 11 = 0"""))
def scan_object_store_csv(spark, sf_dir):
    """CSV under two folders of a store, with quotes, line breaks in quotes and lines that do not fit."""
    root = work_path(spark, "store")
    rows = _txn(spark, sf_dir).withColumn("description", F.expr(_QUOTED))
    for kind in ("CREDIT", "DEBIT"):
        writers.export_csv(rows.filter(F.col("transaction_type") == kind), f"{root}/raw/{kind.lower()}/day")
    fields = {"account_id": "'lost'", "transaction_id": "o_orderkey", "amount": "'none'"}
    faulty = table(spark, sf_dir, "orders").filter("o_orderkey % 11 = 0").selectExpr(
        *[f"CAST({fields.get(name, 'NULL')} AS STRING) AS {name}" for name in _TXN])
    writers.export_csv(faulty, f"{root}/raw/other")
    scanned = readers.scan_object_store(
        spark, f"{root}/raw", "csv", _TXN_TYPES, glob="*.csv", multi_line=True, keep_rejected=True)
    good, bad = readers.split_rejected(scanned)
    return good.withColumn("kind", F.lit("row")).unionByName(
        bad.select(F.col("record").alias("description"), F.col("reason").alias("kind")), allowMissingColumns=True)


@query("scan_bronze", with_views(["txn"], f"SELECT {_TXN_COLUMNS}, 2024 AS year, 2 AS month FROM txn"))
def scan_bronze(spark, sf_dir):
    base = work_path(spark, "bronze")
    path, _ = writers.write_layer(_txn(spark, sf_dir), base, "transactions", INGESTED_AT, RUN)
    return readers.scan_layer(spark, path, RUN).drop("_run_id")


@query("multi_source_ingest", with_views(["txn", "acct"], """
    SELECT 'transactions' AS source_name, 'csv' AS source_type, count(*) AS rows_ingested, 'success' AS status FROM txn
    UNION ALL SELECT 'accounts', 'json', count(*), 'success' FROM acct
    UNION ALL SELECT 'payments', 's3', count(*), 'success' FROM events
    UNION ALL SELECT 'absent', 'csv', NULL, 'failed' UNION ALL SELECT 'odd', 'xml', NULL, 'failed'"""))
def multi_source_ingest(spark, sf_dir):
    root = work_path(spark, "ingest")
    writers.export_csv(_txn(spark, sf_dir), f"{root}/in/transactions")
    view(spark, sf_dir, "acct").write.json(f"{root}/in/accounts")
    table(spark, sf_dir, "events").write.parquet(f"{root}/in/payments/2024")
    sources = [
        Source("transactions", "csv", f"{root}/in/transactions", _TXN_TYPES),
        Source("accounts", "json", f"{root}/in/accounts", lines=True),
        Source("payments", "s3", f"{root}/in/payments", glob="*.parquet"),
        Source("absent", "csv", f"{root}/in/absent"),
        Source("odd", "xml", f"{root}/in/odd"),
    ]
    results = ingest_sources(spark, sources, f"{root}/bronze", INGESTED_AT, RUN)
    return results.select("source_name", "source_type", "rows_ingested", "status")


@query("add_ingest_metadata", """
    SELECT TIMESTAMP '2024-02-01 06:00:00' AS ingested_at, count(*) AS rows_landed,
        count(DISTINCT (o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority))
        AS distinct_hashes, count(*) AS hashed_rows, count(*) AS distinct_positions FROM orders""")
def add_ingest_metadata_query(spark, sf_dir):
    """Every row gets a hash of its business values, the same for equal rows, and its own position."""
    landed = add_ingest_metadata(table(spark, sf_dir, "orders"), INGESTED_AT)
    return landed.filter(F.col("_source_file").contains("orders.parquet")).groupBy(
        F.col("_ingestion_timestamp").alias("ingested_at")
    ).agg(
        F.count(F.lit(1)).alias("rows_landed"), F.count_distinct("_record_hash").alias("distinct_hashes"),
        F.count_if(F.length("_record_hash") == 64).alias("hashed_rows"),
        F.count_distinct("_row_seq").alias("distinct_positions"))


# Both engines read this: files of very unlike sizes.
_FILE = """CASE WHEN o_orderkey % 16 < 8 THEN 'b' WHEN o_orderkey % 16 < 12 THEN 'c' WHEN o_orderkey % 16 < 14 THEN 'a'
    WHEN o_orderkey % 16 < 15 THEN 'e' ELSE 'd' END"""
SPLIT_BYTES = "spark.sql.files.maxPartitionBytes"


@query("source_order", f"""
    SELECT o_orderkey, file, row_number() OVER (ORDER BY file, o_totalprice, o_orderkey) - 1 AS row_seq
    FROM (SELECT *, {_FILE} AS file FROM orders)""")
def source_order(spark, sf_dir):
    """CSV files of unlike sizes, the larger ones in several splits: rows are numbered by file name and place."""
    root = work_path(spark, "ordered")
    rows = table(spark, sf_dir, "orders").withColumn("file", F.expr(_FILE))
    rows.repartition("file").sortWithinPartitions("file", "o_totalprice", "o_orderkey").select(
        "o_orderkey", "o_totalprice", F.col("file").alias("name"), "file").write.partitionBy("file").csv(f"{root}/in", header=True)
    before = spark.conf.get(SPLIT_BYTES)
    try:
        spark.conf.set(SPLIT_BYTES, str(64 << 10))
        source = Source("orders", "csv", f"{root}/in/*/*.csv", "o_orderkey bigint, o_totalprice double, name string")
        path = ingest_sources(spark, [source], f"{root}/bronze", INGESTED_AT, RUN).first()["output_path"]
    finally:
        spark.conf.set(SPLIT_BYTES, before)
    return readers.scan_layer(spark, path, RUN).select(
        "o_orderkey", F.col("name").alias("file"), F.col("_row_seq").alias("row_seq"))


@query("write_bronze", with_views(["txn"], """
    SELECT transaction_id, amount, 'run-1' AS run_id, 2024 AS year, 2 AS month, true AS has_hash FROM txn"""))
def write_bronze(spark, sf_dir):
    base = work_path(spark, "bronze")
    landed = add_ingest_metadata(_txn(spark, sf_dir), INGESTED_AT, source_file="transactions")
    path, _ = writers.write_layer(landed, base, "transactions", INGESTED_AT, RUN)
    return spark.read.parquet(path).select(
        "transaction_id", "amount", F.col("_run_id").alias("run_id"), "year", "month",
        F.col("_record_hash").isNotNull().alias("has_hash"))


_SILVER_ROWS = f"""SELECT transaction_id, transaction_category, large AS is_large_transaction,
    2024 AS year, 2 AS month FROM silver"""


def _store_silver(spark, sf_dir, base):
    enriched = enrich(view(spark, sf_dir, "txn_gaps"), "transactions", ORDERS_AS_OF)
    path, _ = writers.write_layer(enriched, f"{base}/silver", "transactions", INGESTED_AT, RUN)
    return readers.scan_layer(spark, path, RUN)


@query("write_silver", with_views(["txn_gaps"], _SILVER_ROWS, silver=SILVER_SQL))
def write_silver(spark, sf_dir):
    stored = _store_silver(spark, sf_dir, work_path(spark, "layers"))
    return stored.select("transaction_id", "transaction_category", "is_large_transaction", "year", "month")


@query("write_gold", with_views(["txn_gaps"], f"""
    SELECT strftime(CAST(transaction_date AS DATE), '%Y-%m-%d') AS item, {SUM_SQL}, 'daily' AS aggregation_type,
        'transactions' AS source_name FROM silver WHERE transaction_date IS NOT NULL GROUP BY 1
    UNION ALL SELECT transaction_category, {SUM_SQL}, 'by_category', 'transactions' FROM silver GROUP BY 1
    UNION ALL SELECT account_id || ' ' || coalesce(strftime(transaction_date, '%Y-%m'), 'none'), {SUM_SQL},
        'monthly_by_account', 'transactions' FROM silver WHERE account_id IS NOT NULL GROUP BY 1""",
    silver=SILVER_SQL))
def write_gold(spark, sf_dir):
    base = work_path(spark, "layers")
    tables = gold_tables(_store_silver(spark, sf_dir, base), INGESTED_AT)
    paths = writers.write_gold(tables, f"{base}/gold", "transactions", INGESTED_AT, RUN)
    item = {
        "daily": F.col("day").cast("string"),
        "by_category": F.col("transaction_category"),
        "monthly_by_account": F.concat_ws(" ", "account_id", F.coalesce("year_month", F.lit("none"))),
    }
    stored = [
        spark.read.parquet(paths[kind]).select(
            column.alias("item"), "amount_sum", "aggregation_type", "source_name")
        for kind, column in item.items()
    ]
    return stored[0].unionByName(stored[1]).unionByName(stored[2])


@query("write_quarantine", with_views(["fin_txn"], """
    SELECT row_seq, errors, 'transactions' AS source_name, DATE '2024-02-01' AS quarantine_date
    FROM checked WHERE errors <> ''""", checked=TRANSACTION_ERRORS_SQL))
def write_quarantine(spark, sf_dir):
    base = work_path(spark, "quarantine")
    checked = with_errors(view(spark, sf_dir, "fin_txn"), transaction_rules(), ORDERS_AS_OF)
    writers.write_quarantine(quarantine_rows(checked), base, "transactions", INGESTED_AT, RUN)
    return spark.read.parquet(base).select(
        F.col("_row_seq").alias("row_seq"), F.concat_ws("|", ERRORS).alias("errors"), "source_name",
        "quarantine_date")


@query("export_csv", with_views(
    ["fin_txn"], "SELECT _row_seq AS row_seq, amount, suspicious_flags FROM flagged", flagged=SUSPICIOUS_SQL))
def export_csv(spark, sf_dir):
    path = work_path(spark, "flagged")
    flagged = suspicious_flags(view(spark, sf_dir, "fin_txn")).select(
        F.col("_row_seq").alias("row_seq"), "amount", "suspicious_flags")
    writers.export_csv(flagged, path)
    return readers.scan_csv(spark, path, "row_seq bigint, amount double, suspicious_flags string")


@query("export_report_json", with_views(["audit_log", "checks"], """
    SELECT 'audit' AS report, count(*) AS records FROM audit_log
    UNION ALL SELECT 'metrics', count(*) FROM checks"""))
def export_report_json(spark, sf_dir):
    path = work_path(spark, "reports")
    metrics = compliance_metrics(view(spark, sf_dir, "checks"))
    writers.export_report_json({"audit": view(spark, sf_dir, "audit_log"), "metrics": metrics}, path)
    counts = [
        readers.scan_json(spark, f"{path}/{name}", lines=True).agg(F.count(F.lit(1)).alias("records"))
        .select(F.lit(name).alias("report"), "records")
        for name in ("audit", "metrics")
    ]
    return counts[0].unionByName(counts[1])


@query("file_fingerprint", """
    SELECT c_nationkey, CAST(sum(strlen(coalesce(c_name, '')) + 1) AS BIGINT) AS length,
        sha256(string_agg(coalesce(c_name, '') || chr(10), '' ORDER BY c_custkey)) AS file_hash
    FROM customer GROUP BY 1""")
def file_fingerprint(spark, sf_dir):
    """Every customer in text files, one per nation, hashed as files."""
    path = work_path(spark, "files")
    names = table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", "c_name")
    dealt = names.repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey")
    dealt.drop("c_custkey").write.partitionBy("c_nationkey").text(path)
    prints = readers.file_fingerprints(spark, path)
    return prints.select(
        F.regexp_extract("path", "c_nationkey=([0-9]+)", 1).cast("int").alias("c_nationkey"), "length", "file_hash")


FILE_KEYS = 100_000


@query("file_fingerprint_all", f"""
    SELECT c_nationkey, c_custkey // {FILE_KEYS} AS key_range, CAST(sum(strlen(coalesce(c_name, '')) + 1) AS BIGINT) AS length,
        sha256(string_agg(coalesce(c_name, '') || chr(10), '' ORDER BY c_custkey)) AS file_hash
    FROM customer GROUP BY 1, 2""")
def file_fingerprint_all(spark, sf_dir):
    """Every customer in text files, one per nation and range of FILE_KEYS keys, hashed as files."""
    path = work_path(spark, "files")
    names = table(spark, sf_dir, "customer").select(
        "c_nationkey", F.floor(F.col("c_custkey") / FILE_KEYS).alias("key_range"), "c_custkey", "c_name")
    dealt = names.repartition("c_nationkey", "key_range").sortWithinPartitions("c_nationkey", "key_range", "c_custkey")
    dealt.drop("c_custkey").write.partitionBy("c_nationkey", "key_range").text(path)
    prints = readers.file_fingerprints(spark, path)
    return prints.select(
        F.regexp_extract("path", "c_nationkey=([0-9]+)", 1).cast("int").alias("c_nationkey"),
        F.regexp_extract("path", "key_range=([0-9]+)", 1).cast("long").alias("key_range"), "length", "file_hash")


# ---- end to end ----

_DIRTY_COLUMNS = ("account_id", "transaction_id", "transaction_date", "amount", "description", "transaction_type",
                  "balance_after", "risk_points", "branch_id")
_DIRTY_SCHEMA = (
    "account_id string, transaction_id string, transaction_date string, amount string, description string, "
    "transaction_type string, balance_after double, risk_points double, branch_id bigint, _order bigint"
)
PLAN = pipeline.QualityPlan(
    rules=[Rule("transaction_amount_positive", "amount", "greater_than", {"value": 0}),
           Rule("account_id_not_null", "account_id", "not_null")],
    fields=[
        {"field": "amount", "dtype": "float64", "nullable": False, "min_value": None, "max_value": None,
         "max_length": None},
        {"field": "transaction_date", "dtype": "datetime64[ns]", "nullable": False, "min_value": None,
         "max_value": None, "max_length": None},
    ],
)


def _landed_dirty(spark, sf_dir, layout):
    """Raw faulty rows as a stored raw layer, in their given order."""
    raw = view(spark, sf_dir, "txn_dirty").withColumns({
        "_ingestion_timestamp": F.lit(INGESTED_AT).cast("timestamp_ntz"),
        "_record_hash": F.sha2(F.to_json(F.struct(*_DIRTY_COLUMNS)), 256),
    })
    writers.write_layer(raw, layout.bronze, "transactions", INGESTED_AT, RUN)


@query("transform_pipeline", with_views(["txn_dirty"], f"""
    SELECT transaction_category, {SUM_SQL}, {MEAN_SQL}, count(amount) AS amount_count,
        round(min(amount), 2) AS amount_min, round(max(amount), 2) AS amount_max,
        count(DISTINCT account_id) AS account_count FROM categorized GROUP BY 1""",
    filled=FILLED_SQL, typed=TYPED_SQL, cleaned=CLEAN_SQL,
    categorized=f"SELECT *, {CATEGORY_SQL} AS transaction_category, CAST(amount AS DECIMAL(28,6)) AS exact FROM cleaned"))
def transform_pipeline(spark, sf_dir):
    """Raw layer to trusted layer to roll-ups; shows the stored category roll-up."""
    layout = pipeline.Layout(work_path(spark, "pipeline"))
    _landed_dirty(spark, sf_dir, layout)
    pipeline.run_transformation(spark, layout, ["transactions"], RUN, INGESTED_AT, {"transactions": PLAN})
    return readers.scan_layer(spark, f"{layout.gold}/by_category/transactions", RUN).select(
        "transaction_category", "amount_sum", "amount_mean", "amount_count", "amount_min", "amount_max",
        "account_count")


@query("transform_results", with_views(["txn_dirty"], """
    SELECT 'transactions' AS source_name, CAST(sum(copies) AS BIGINT) AS original_rows, count(*) AS final_rows,
        count(*) FILTER (WHERE amount IS NULL OR transaction_date IS NULL) AS quarantined_rows,
        3 AS aggregations_created, false AS data_quality_passed, 'success' AS status FROM cleaned""",
    filled=FILLED_SQL, typed=TYPED_SQL, cleaned=CLEAN_SQL))
def transform_results(spark, sf_dir):
    layout = pipeline.Layout(work_path(spark, "pipeline"))
    _landed_dirty(spark, sf_dir, layout)
    results = pipeline.run_transformation(spark, layout, ["transactions"], RUN, INGESTED_AT, {"transactions": PLAN})
    return results.drop("error", "amounts_left_out")


@query("full_pipeline", with_views(["txn", "acct"], """
    SELECT 'run-1' AS run_id, (SELECT count(*) FROM txn) + (SELECT count(*) FROM acct) AS rows_ingested,
        (SELECT count(*) FROM txn) + (SELECT count(*) FROM acct) AS rows_transformed, 'failed' AS status"""))
def full_pipeline(spark, sf_dir):
    """CSV and JSON sources through every stage; shows the appended run record."""
    root = work_path(spark, "full")
    writers.export_csv(_txn(spark, sf_dir), f"{root}/in/transactions")
    view(spark, sf_dir, "acct").write.json(f"{root}/in/accounts")
    sources = [
        Source("transactions", "csv", f"{root}/in/transactions"),
        Source("accounts", "json", f"{root}/in/accounts", lines=True),
    ]
    out = pipeline.run_full_pipeline(
        spark, pipeline.Layout(f"{root}/out"), sources, RUN, INGESTED_AT, {"transactions": PLAN})
    return out["run"].select("run_id", "rows_ingested", "rows_transformed", "status")


@query("financial_validation", with_views(["fin_txn"], """
    SELECT 'transactions_data_quality' AS metric_name, quality AS value, CASE WHEN quality < 0.475 THEN 'CRITICAL'
        WHEN quality < 0.7125 THEN 'HIGH' WHEN quality < 0.95 THEN 'MEDIUM' ELSE 'LOW' END AS severity
    FROM (SELECT round(count(*) FILTER (WHERE errors = '') / count(*), 6) AS quality FROM checked)
    UNION ALL SELECT 'risk_suspicious_transactions', rate, CASE WHEN rate > 0.1 THEN 'CRITICAL'
        WHEN rate > 0.075 THEN 'HIGH' WHEN rate > 0.05 THEN 'MEDIUM' ELSE 'LOW' END
    FROM (SELECT round(count(suspicious_flags) / count(*), 6) AS rate FROM flagged)""",
    checked=TRANSACTION_ERRORS_SQL, flagged=SUSPICIOUS_SQL))
def financial_validation(spark, sf_dir):
    """The validation flow on faulty transactions; shows the metrics it records."""
    out = pipeline.financial_validation(view(spark, sf_dir, "fin_txn"), ORDERS_AS_OF)
    return out["metrics"].select("metric_name", "value", "severity")


@query("full_pipeline_dirty", with_views(["txn_dirty"], """
    SELECT 'transactions' AS source_name, count(*) AS total_rows, round((
        count(*) FILTER (WHERE TRY_CAST(replace(amount, '£', '') AS DOUBLE) > 0) + count(account_id))
        / (2.0 * count(*)), 6) AS rule_score, 'success' AS transformed, 1 AS run_records FROM txn_dirty"""))
def full_pipeline_dirty(spark, sf_dir):
    """Faulty CSV rows through every stage: the amount rule scores text amounts and the run ends with a record."""
    root = work_path(spark, "full-dirty")
    writers.export_csv(view(spark, sf_dir, "txn_dirty").drop("_row_seq"), f"{root}/in")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in view(spark, sf_dir, "txn_dirty").drop("_row_seq").schema)
    sources = [Source("transactions", "csv", f"{root}/in", schema)]
    out = pipeline.run_full_pipeline(
        spark, pipeline.Layout(f"{root}/out"), sources, RUN, INGESTED_AT, {"transactions": PLAN})
    cards = out["data_quality"].filter(F.col("check") == "business_rules").withColumnRenamed("total_rows", "rows")
    return cards.select(
        "source_name", F.col("rows").alias("total_rows"), F.round("score", 6).alias("rule_score"),
        out["transformation"].select("status").scalar().alias("transformed"),
        out["run"].agg(F.count(F.lit(1))).scalar().cast("int").alias("run_records"))
