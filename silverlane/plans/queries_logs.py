"""Audit, retention and operational-metric queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from silverlane.operators import audit, metrics
from silverlane.operators.suspicious import suspicious_flags, suspicious_summary
from silverlane.plans.queries_rows import SUSPICIOUS_SQL
from silverlane.plans.registry import query
from silverlane.plans.views import EVENTS_AS_OF, ORDERS_AS_OF, view, with_views
from silverlane.session import work_path
from silverlane.sources.writers import write_log

PERIOD = datetime(2024, 1, 5), datetime(2024, 1, 20)
HEALTH_AT = datetime(2024, 1, 30, 18, 0, 0)
SUMMARY_HOURS = 168

_MOMENT = "strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%f')"
_CONTENT = f"concat_ws(':', resource, action, CAST(record_count AS VARCHAR), {_MOMENT})"


@query("audit_append", with_views(["audit_log"], f"""
    SELECT sha256(concat_ws('|', {_CONTENT}, user_id, data_classification, compliance_level)) AS event_id,
        user_id, action, resource, record_count, sha256({_CONTENT}) AS data_hash, success, error_message
    FROM audit_log"""))
def audit_append(spark, sf_dir):
    path = f"{work_path(spark, 'audit')}/audit_events"
    write_log(audit.audit_events(view(spark, sf_dir, "audit_log")), path, "run-1")
    return spark.read.parquet(path).select(
        "event_id", "user_id", "action", "resource", "record_count", "data_hash", "success", "error_message")


def _lineage(spark, sf_dir):
    steps = view(spark, sf_dir, "lineage_steps").withColumns({
        "transformations": F.array(F.lit("clean"), F.lit("enrich")),
        "compliance_checks": F.array(F.lit("schema")),
    })
    return audit.lineage_records(steps)


@query("lineage_append", with_views(["lineage_steps"], """
    SELECT source_file, sha256(source_file) AS source_hash, destination_table, processing_time,
        processing_time + to_days(CAST(retention_days AS INTEGER)) AS retention_date, data_quality_score,
        CAST(2 AS INTEGER) AS transformation_count FROM lineage_steps"""))
def lineage_append(spark, sf_dir):
    path = f"{work_path(spark, 'lineage')}/lineage"
    write_log(_lineage(spark, sf_dir), path, "run-1")
    return spark.read.parquet(path).select(
        "source_file", "source_hash", "destination_table", "processing_time", "retention_date", "data_quality_score",
        F.size("transformations").alias("transformation_count"))


def _quoted(values: list[str]) -> str:
    return ", ".join(repr(value) for value in values)


_COMPLIANT = "CASE compliance_level " + " ".join(
    f"WHEN '{level}' THEN data_classification IN ({_quoted(rule['allowed_classifications'])}) "
    f"AND action IN ({_quoted(rule['allowed_actions'])})"
    for level, rule in audit.COMPLIANCE_RULES.items()
) + " ELSE false END"


@query("compliance_check", with_views(["audit_log"], f"""
    SELECT timestamp, user_id, action, data_classification, compliance_level, {_COMPLIANT} AS compliant
    FROM audit_log"""))
def compliance_check(spark, sf_dir):
    return audit.compliance_check(view(spark, sf_dir, "audit_log")).select(
        "timestamp", "user_id", "action", "data_classification", "compliance_level", "compliant")


_PERIOD_SQL = "timestamp BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20'"


@query("audit_report", with_views(["audit_log"], f"""
    SELECT count(*) AS total_events, count(*) FILTER (WHERE success) AS successful_events,
        count(*) FILTER (WHERE NOT success) AS failed_events,
        CASE WHEN count(*) = 0 THEN 0 ELSE round(count(*) FILTER (WHERE success) / count(*), 6) END AS success_rate,
        'GDPR' AS compliance_level
    FROM audit_log WHERE {_PERIOD_SQL} AND compliance_level = 'GDPR'"""))
def audit_report(spark, sf_dir):
    return audit.audit_report(view(spark, sf_dir, "audit_log"), *PERIOD, level="GDPR")


def _audit_by(name: str, column: str) -> None:
    @query(name, with_views(
        ["audit_log"], f"SELECT {column}, count(*) AS events FROM audit_log WHERE {_PERIOD_SQL} GROUP BY 1"))
    def run(spark, sf_dir):
        return audit.audit_by(audit.audit_period(view(spark, sf_dir, "audit_log"), *PERIOD), column)


_audit_by("audit_by_action", "action")
_audit_by("audit_by_classification", "data_classification")


@query("retention_expired", with_views(["lineage_steps"], """
    SELECT source_file, destination_table, retention_date,
        CAST(floor(epoch(TIMESTAMP '2024-02-01' - retention_date) / 86400) AS BIGINT) AS days_overdue
    FROM (SELECT *, processing_time + to_days(CAST(retention_days AS INTEGER)) AS retention_date FROM lineage_steps)
    WHERE retention_date < TIMESTAMP '2024-02-01'"""))
def retention_expired(spark, sf_dir):
    return audit.retention_expired(_lineage(spark, sf_dir), EVENTS_AS_OF).drop("lineage_id")


RETENTION_AT = datetime(2024, 4, 20)


@query("retention_by_policy", with_views(["inventory"], """
    SELECT dataset, dataset_kind, age AS age_days, age - days AS days_overdue FROM (
        SELECT *, CAST(floor(epoch(TIMESTAMP '2024-04-20' - created_at) / 86400) AS BIGINT) AS age,
            CASE WHEN dataset_kind IN ('transaction_data', 'customer_data', 'audit_logs') THEN 2555
                WHEN dataset_kind IN ('metrics_data', 'quarantine_data') THEN 90
                WHEN dataset_kind = 'temp_files' THEN 7 END AS days FROM inventory) WHERE age > days"""))
def retention_by_policy(spark, sf_dir):
    return audit.retention_by_policy(view(spark, sf_dir, "inventory"), RETENTION_AT).select(
        "dataset", "dataset_kind", "age_days", "days_overdue")


@query("storage_tiering", with_views(["objects"], """
    SELECT path, layer, age AS age_days, CASE
        WHEN layer = 'bronze' AND age >= 2555 THEN 'EXPIRED' WHEN layer = 'bronze' AND age >= 90 THEN 'GLACIER'
        WHEN layer = 'bronze' AND age >= 30 THEN 'STANDARD_IA' WHEN layer = 'silver' AND age >= 365 THEN 'GLACIER'
        WHEN layer = 'silver' AND age >= 90 THEN 'STANDARD_IA' WHEN layer = 'gold' AND age >= 365 THEN 'STANDARD_IA'
        ELSE 'STANDARD' END AS storage_class
    FROM (SELECT *, CAST(floor(epoch(TIMESTAMP '2001-08-03' - modified_at) / 86400) AS BIGINT) AS age FROM objects)"""))
def storage_tiering(spark, sf_dir):
    return audit.storage_tiering(view(spark, sf_dir, "objects"), ORDERS_AS_OF).select(
        "path", "layer", "age_days", "storage_class")


@query("cleanup_manifest", with_views(["objects"], """
    SELECT count(*) AS files, CAST(coalesce(sum(length), 0) AS BIGINT) / 1048576 AS megabytes
    FROM (SELECT *, CAST(length(path) AS BIGINT) * 1024 AS length FROM objects)
    WHERE modified_at < TIMESTAMP '2001-08-03' - INTERVAL 365 DAY"""))
def cleanup_manifest(spark, sf_dir):
    """Stored objects a clean-up would remove; their size is made up from their path."""
    files = view(spark, sf_dir, "objects").withColumn("length", F.length("path").cast("long") * 1024)
    return audit.cleanup_manifest(files, ORDERS_AS_OF, 365)


# ---- runs and operations ----

_NEWEST = "ORDER BY timestamp DESC, run_id DESC"


@query("run_success_rate", with_views(["runs"], f"""
    SELECT count(*) AS recent_runs, count(*) FILTER (WHERE status = 'completed') AS successful_runs,
        round(count(*) FILTER (WHERE status = 'completed') / count(*), 6) AS success_rate
    FROM (SELECT * FROM runs {_NEWEST} LIMIT 20)"""))
def run_success_rate(spark, sf_dir):
    return metrics.run_success_rate(view(spark, sf_dir, "runs"))


@query("runs_daily", with_views(["runs"], """
    SELECT CAST(timestamp AS DATE) AS day, count(*) AS total_runs,
        count(*) FILTER (WHERE status = 'completed') AS successful_runs,
        count(*) FILTER (WHERE status = 'failed') AS failed_runs,
        CAST(coalesce(sum(rows_processed), 0) AS BIGINT) AS total_rows_processed,
        CAST(coalesce(sum(CAST(duration_seconds AS DECIMAL(18,3))), 0) AS DOUBLE) AS total_processing_time
    FROM runs GROUP BY 1"""))
def runs_daily(spark, sf_dir):
    return metrics.runs_daily(view(spark, sf_dir, "runs"))


@query("runs_by_pipeline", with_views(["runs"], """
    SELECT pipeline_name, count(*) AS total_runs, max(timestamp) FILTER (WHERE status = 'completed')
        AS last_successful_run, count(*) FILTER (WHERE status = 'failed' AND successes_after = 0 AND status <> 'completed')
        AS consecutive_failures,
        CAST(round(CAST(sum(CAST(duration_seconds AS DECIMAL(18,3))) / count(duration_seconds) AS DECIMAL(38,6)), 3)
            AS DOUBLE) AS avg_processing_time
    FROM (SELECT *, count(*) FILTER (WHERE status = 'completed') OVER (PARTITION BY pipeline_name
        ORDER BY timestamp DESC, run_id DESC) AS successes_after FROM runs) GROUP BY 1"""))
def runs_by_pipeline(spark, sf_dir):
    return metrics.runs_by_pipeline(view(spark, sf_dir, "runs"))


@query("run_history_tail", with_views(["runs"], f"SELECT * FROM runs {_NEWEST} LIMIT 100"))
def run_history_tail(spark, sf_dir):
    return metrics.latest_runs(view(spark, sf_dir, "runs"))


@query("performance_history_tail", with_views(["runs"], f"""
    SELECT run_id, timestamp, pipeline_name, duration_seconds, coalesce(rows_processed, 0) AS rows_processed, status
    FROM runs WHERE duration_seconds IS NOT NULL {_NEWEST} LIMIT 1000"""))
def performance_history_tail(spark, sf_dir):
    return metrics.latest_performance(view(spark, sf_dir, "runs"))


@query("pipeline_health", with_views(["runs"], """
    SELECT CASE WHEN n = 0 THEN 'stale' WHEN good / n >= 0.9 THEN 'healthy' WHEN good / n >= 0.7 THEN 'warning'
        ELSE 'critical' END AS status, round(good / n, 6) AS success_rate, n AS recent_runs, good AS successful_runs,
        bad AS failed_runs, (SELECT status FROM runs ORDER BY timestamp DESC LIMIT 1) AS last_run_status,
        (SELECT max(timestamp) FROM runs) AS last_run_time
    FROM (SELECT count(*) AS n, count(*) FILTER (WHERE status = 'completed') AS good,
        count(*) FILTER (WHERE status = 'failed') AS bad FROM runs
        WHERE timestamp > TIMESTAMP '2024-01-29 18:00:00')"""))
def pipeline_health(spark, sf_dir):
    return metrics.pipeline_health(view(spark, sf_dir, "runs"), HEALTH_AT)


_LIMIT = "CASE operation WHEN 'transformation' THEN 600.0 WHEN 'validation' THEN 180.0 ELSE 300.0 END"


@query("latency_alerts", with_views(["ops"], f"""
    SELECT measurement_id, operation, duration, CAST(threshold AS DOUBLE) AS threshold,
        CASE WHEN duration > 2 * threshold THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
        'PERFORMANCE' AS alert_type, 'SOX' AS compliance_level
    FROM (SELECT *, {_LIMIT} AS threshold FROM ops) WHERE duration > threshold"""))
def latency_alerts(spark, sf_dir):
    return metrics.latency_alerts(view(spark, sf_dir, "ops")).drop("timestamp")


_RECENT_OPS = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY operation
    ORDER BY timestamp DESC, measurement_id DESC) AS place FROM ops) WHERE place <= 100"""
_MEAN_TIME = ("CAST(round(CAST(sum(CAST(duration AS DECIMAL(18,3))) / count(*) AS DECIMAL(38,6)), 3) AS DOUBLE)")


@query("sla_compliance", with_views(["ops"], f"""
    SELECT operation, {_MEAN_TIME} AS average_time, max(duration) AS max_time, CAST(300 AS DOUBLE) AS sla_threshold,
        round(count(*) FILTER (WHERE duration <= 300) / count(*), 6) AS compliance_rate,
        count(*) FILTER (WHERE duration <= 300) / count(*) >= 0.95 AS compliant, count(*) AS measurements
    FROM recent GROUP BY 1""", recent=_RECENT_OPS))
def sla_compliance(spark, sf_dir):
    return metrics.sla_compliance(view(spark, sf_dir, "ops"))


@query("performance_summary", with_views(["ops"], f"""
    SELECT operation, {_MEAN_TIME} AS avg_time, min(duration) AS min_time, max(duration) AS max_time,
        count(*) AS measurements FROM recent GROUP BY 1""", recent=_RECENT_OPS))
def performance_summary(spark, sf_dir):
    return metrics.performance_summary(view(spark, sf_dir, "ops"))


_SEVERITY = """CASE WHEN high_is_bad THEN
        CASE WHEN value > 2 * threshold THEN 'CRITICAL' WHEN value > 1.5 * threshold THEN 'HIGH'
            WHEN value > threshold THEN 'MEDIUM' ELSE 'LOW' END
    ELSE CASE WHEN value < 0.5 * threshold THEN 'CRITICAL' WHEN value < 0.75 * threshold THEN 'HIGH'
            WHEN value < threshold THEN 'MEDIUM' ELSE 'LOW' END END"""
_RATED = f"SELECT *, {_SEVERITY} AS severity FROM metric_log"


def _rated(spark, sf_dir):
    return metrics.metric_severity(view(spark, sf_dir, "metric_log"))


@query("metric_severity", with_views(
    ["metric_log"], "SELECT metric_id, value, threshold, high_is_bad, severity FROM rated", rated=_RATED))
def metric_severity(spark, sf_dir):
    return _rated(spark, sf_dir).select("metric_id", "value", "threshold", "high_is_bad", "severity")


@query("quality_alerts", with_views(["measurements"], """
    SELECT *, round(invalid_records / total_records, 6) AS error_rate,
        CASE WHEN quality_score < 0.8 THEN 'HIGH' ELSE 'MEDIUM' END AS severity, invalid_records AS affected_records,
        'DATA_QUALITY' AS alert_type FROM measurements WHERE quality_score < 0.95"""))
def quality_alerts(spark, sf_dir):
    return metrics.quality_alerts(view(spark, sf_dir, "measurements"))


@query("compliance_alerts", with_views(["checks"], """
    SELECT timestamp, compliance_level, check_name, affected_records, 'CRITICAL' AS severity,
        'COMPLIANCE' AS alert_type FROM checks WHERE NOT passed"""))
def compliance_alerts(spark, sf_dir):
    return metrics.compliance_alerts(view(spark, sf_dir, "checks"))


@query("risk_alerts", with_views(["risks"], """
    SELECT *, CASE WHEN risk_score > 0.25 THEN 'CRITICAL' WHEN risk_score > 0.1875 THEN 'HIGH' ELSE 'MEDIUM' END
        AS severity, 'RISK' AS alert_type FROM risks WHERE risk_score > 0.125"""))
def risk_alerts(spark, sf_dir):
    return metrics.risk_alerts(view(spark, sf_dir, "risks"))


@query("suspicious_rate_metric", with_views(["fin_txn"], """
    SELECT 'suspicious_transaction_rate' AS metric_name, rate AS value, CAST(0.05 AS DOUBLE) AS threshold,
        CASE WHEN rate > 0.1 THEN 'CRITICAL' WHEN rate > 0.075 THEN 'HIGH' WHEN rate > 0.05 THEN 'MEDIUM'
            ELSE 'LOW' END AS severity
    FROM (SELECT round(count(suspicious_flags) / count(*), 6) AS rate FROM flagged)""", flagged=SUSPICIOUS_SQL))
def suspicious_rate_metric(spark, sf_dir):
    return metrics.suspicious_rate_metric(suspicious_summary(suspicious_flags(view(spark, sf_dir, "fin_txn"))))


@query("metrics_summary", with_views(["metric_log"], """
    SELECT metric_type, count(*) AS metrics, CAST(round(CAST(sum(CAST(value AS DECIMAL(18,6))) / count(*)
        AS DECIMAL(38,9)), 4) AS DOUBLE) AS avg_value,
        count(*) FILTER (WHERE severity IN ('HIGH', 'CRITICAL')) AS alerts
    FROM rated WHERE timestamp >= TIMESTAMP '2024-02-01' - INTERVAL 168 HOUR GROUP BY 1""", rated=_RATED))
def metrics_summary(spark, sf_dir):
    return metrics.metrics_summary(_rated(spark, sf_dir), EVENTS_AS_OF, SUMMARY_HOURS)


@query("alert_counts", with_views(["metric_log"], """
    SELECT severity, count(*) AS alerts FROM rated WHERE severity <> 'LOW' GROUP BY 1""", rated=_RATED))
def alert_counts(spark, sf_dir):
    return metrics.alert_counts(_rated(spark, sf_dir).filter(F.col("severity") != "LOW"))


@query("compliance_report", with_views(["metric_log"], """
    SELECT coalesce(compliance_level, 'UNKNOWN') AS compliance_level, count(*) FILTER (WHERE value = 1) AS passed,
        count(*) FILTER (WHERE value <> 1) AS failed FROM metric_log WHERE metric_type = 'COMPLIANCE' GROUP BY 1"""))
def compliance_report(spark, sf_dir):
    return metrics.compliance_report(view(spark, sf_dir, "metric_log"))


@query("recent_serious_alerts", with_views(["metric_log"], """
    SELECT metric_id AS alert_id, compliance_level, severity, timestamp FROM rated
    WHERE severity IN ('HIGH', 'CRITICAL') ORDER BY timestamp DESC, metric_id DESC LIMIT 10""", rated=_RATED))
def recent_serious_alerts(spark, sf_dir):
    alerts = _rated(spark, sf_dir).select(
        F.col("metric_id").alias("alert_id"), "compliance_level", "severity", "timestamp")
    return metrics.recent_serious_alerts(alerts)


@query("stage_totals", with_views(["stages"], """
    SELECT run_id, CAST(coalesce(sum(rows) FILTER (WHERE stage = 'ingestion'), 0) AS BIGINT) AS rows_ingested,
        CAST(coalesce(sum(rows) FILTER (WHERE stage = 'transformation'), 0) AS BIGINT) AS rows_transformed,
        CASE WHEN count(*) FILTER (WHERE status = 'failed') > 0
            OR count(*) FILTER (WHERE stage = 'data_quality' AND NOT passed) > 0 THEN 'failed' ELSE 'completed' END
            AS status FROM stages GROUP BY 1"""))
def stage_totals(spark, sf_dir):
    return metrics.stage_totals(view(spark, sf_dir, "stages"))
