"""Run, performance, quality and risk metrics over append-only tables."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverlane.columns import ratio
from silverlane.functions.severity import CRITICAL, HIGH, MEDIUM, severity_high_is_bad, severity_low_is_bad
from silverlane.functions.skew import attach_stored

# Thresholds and history lengths.
MAX_DURATIONS = {"ingestion": 300.0, "transformation": 600.0, "validation": 180.0}
DEFAULT_MAX_DURATION = 300.0
SLA_SECONDS: dict[str, float] = {}
DEFAULT_SLA_SECONDS = 300.0
SLA_SHARE = 0.95
MIN_QUALITY = 0.95
LOW_QUALITY = 0.8
MAX_SUSPICIOUS_RATE = 0.05
RECENT_RUNS = 20
KEPT_RUNS = 100
KEPT_PERFORMANCE = 1000
KEPT_DURATIONS = 100
HEALTH_HOURS = 24
HEALTHY, WARNING = 0.9, 0.7
RECENT_ALERTS = 10


def _at(moment: datetime) -> Column:
    return F.lit(moment).cast("timestamp_ntz")


def _newest(*keys: str) -> list[Column]:
    return [F.col(key).desc() for key in keys]


def latest_runs(runs: DataFrame, count: int = KEPT_RUNS) -> DataFrame:
    """The newest runs; run_id settles equal times."""
    return runs.orderBy(*_newest("timestamp", "run_id")).limit(count)


def latest_performance(runs: DataFrame, count: int = KEPT_PERFORMANCE) -> DataFrame:
    """The newest performance records, of runs that report a duration."""
    timed = runs.filter(F.col("duration_seconds").isNotNull())
    return latest_runs(timed, count).select(
        "run_id", "timestamp", "pipeline_name", "duration_seconds",
        F.coalesce("rows_processed", F.lit(0)).alias("rows_processed"), "status",
    )


def run_success_rate(runs: DataFrame, recent: int = RECENT_RUNS) -> DataFrame:
    """Completed share of the newest runs."""
    good = F.count_if(F.col("status") == "completed")
    return latest_runs(runs, recent).agg(
        F.count(F.lit(1)).alias("recent_runs"), good.alias("successful_runs"),
        F.round(ratio(good, F.count(F.lit(1))), 6).alias("success_rate"),
    )


def runs_daily(runs: DataFrame) -> DataFrame:
    return runs.groupBy(F.to_date("timestamp").alias("day")).agg(
        F.count(F.lit(1)).alias("total_runs"),
        F.count_if(F.col("status") == "completed").alias("successful_runs"),
        F.count_if(F.col("status") == "failed").alias("failed_runs"),
        F.coalesce(F.sum("rows_processed"), F.lit(0)).alias("total_rows_processed"),
        F.coalesce(F.sum(F.col("duration_seconds").cast("decimal(18,3)")), F.lit(0)).cast("double")
        .alias("total_processing_time"),
    )


def runs_by_pipeline(runs: DataFrame) -> DataFrame:
    """Totals, last success and failures since then, per pipeline.

    Failures are counted after the last success in (time, run_id) order. The
    last success goes back to the runs of its pipeline without gathering a busy
    pipeline in one task.
    """
    position = F.struct("timestamp", "run_id")
    good = F.col("status") == "completed"
    facts = runs.groupBy("pipeline_name").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.when(good, position)).alias("_last")
    )
    return (
        attach_stored(runs, facts, "pipeline_name", ["_last"])
        .groupBy("pipeline_name")
        .agg(
            F.count(F.lit(1)).alias("total_runs"),
            F.max(F.when(good, F.col("timestamp"))).alias("last_successful_run"),
            F.count_if(
                (F.col("status") == "failed") & (F.col("_last").isNull() | (position > F.col("_last")))
            ).alias("consecutive_failures"),
            F.round(
                (F.sum(F.col("duration_seconds").cast("decimal(18,3)")) / F.count("duration_seconds"))
                .cast("decimal(38,6)"), 3
            ).cast("double").alias("avg_processing_time"),
        )
    )


def pipeline_health(runs: DataFrame, as_of: datetime, hours: int = HEALTH_HOURS) -> DataFrame:
    """Health of the last day in one row: unknown, stale, healthy, warning or critical."""
    recent = F.col("timestamp") > _at(as_of - timedelta(hours=hours))
    position = F.struct("timestamp", "run_id")
    totals = runs.agg(
        F.count(F.lit(1)).alias("all_runs"),
        F.count_if(recent).alias("recent_runs"),
        F.count_if(recent & (F.col("status") == "completed")).alias("successful_runs"),
        F.count_if(recent & (F.col("status") == "failed")).alias("failed_runs"),
        F.max_by("status", position).alias("last_run_status"),
        F.max("timestamp").alias("last_run_time"),
    )
    rate = ratio(F.col("successful_runs"), F.col("recent_runs"))
    health = (
        F.when(F.col("all_runs") == 0, F.lit("unknown"))
        .when(F.col("recent_runs") == 0, F.lit("stale"))
        .when(rate >= HEALTHY, F.lit("healthy"))
        .when(rate >= WARNING, F.lit("warning"))
        .otherwise(F.lit("critical"))
    )
    return totals.select(
        health.alias("status"), F.round(rate, 6).alias("success_rate"), "recent_runs", "successful_runs",
        "failed_runs", "last_run_status", "last_run_time",
    )


def _limit_for(limits: dict[str, float], default: float) -> Column:
    limit = F.lit(default)
    for operation, seconds in limits.items():
        limit = F.when(F.col("operation") == operation, F.lit(seconds)).otherwise(limit)
    return limit


def latency_alerts(
    operations: DataFrame, limits: dict[str, float] = MAX_DURATIONS, default: float = DEFAULT_MAX_DURATION
) -> DataFrame:
    """Measurements above the limit of their operation; HIGH above twice the limit."""
    limit = _limit_for(limits, default)
    return operations.withColumn("threshold", limit).filter(F.col("duration") > F.col("threshold")).withColumns({
        "severity": F.when(F.col("duration") > F.col("threshold") * 2, F.lit(HIGH)).otherwise(F.lit(MEDIUM)),
        "alert_type": F.lit("PERFORMANCE"),
        "compliance_level": F.lit("SOX"),
    })


def latest_durations(operations: DataFrame, kept: int = KEPT_DURATIONS) -> DataFrame:
    """The newest measurements of each operation.

    The rank filter also runs before the shuffle, so a busy operation sends no
    more than ``kept`` rows per task.
    """
    order = Window.partitionBy("operation").orderBy(*_newest("timestamp", "measurement_id"))
    return operations.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= kept).drop("_n")


def _mean_seconds() -> Column:
    return F.round(
        (F.sum(F.col("duration").cast("decimal(18,3)")) / F.count("duration")).cast("decimal(38,6)"), 3
    ).cast("double")


def sla_compliance(
    operations: DataFrame, slas: dict[str, float] = SLA_SECONDS, default: float = DEFAULT_SLA_SECONDS
) -> DataFrame:
    """Share of recent measurements within the SLA, per operation."""
    recent = latest_durations(operations).withColumn("_sla", _limit_for(slas, default))
    rate = ratio(F.count_if(F.col("duration") <= F.col("_sla")), F.count(F.lit(1)))
    return recent.groupBy("operation").agg(
        _mean_seconds().alias("average_time"), F.max("duration").alias("max_time"),
        F.max("_sla").alias("sla_threshold"), F.round(rate, 6).alias("compliance_rate"),
        (rate >= SLA_SHARE).alias("compliant"), F.count(F.lit(1)).alias("measurements"),
    )


def performance_summary(operations: DataFrame) -> DataFrame:
    return latest_durations(operations).groupBy("operation").agg(
        _mean_seconds().alias("avg_time"), F.min("duration").alias("min_time"), F.max("duration").alias("max_time"),
        F.count(F.lit(1)).alias("measurements"),
    )


def metric_severity(metrics: DataFrame) -> DataFrame:
    """Add ``severity`` by the ladder of each metric's ``high_is_bad`` flag."""
    value, threshold = F.col("value"), F.col("threshold")
    return metrics.withColumn(
        "severity",
        F.when(F.col("high_is_bad"), severity_high_is_bad(value, threshold))
        .otherwise(severity_low_is_bad(value, threshold)),
    )


def quality_alerts(measurements: DataFrame, minimum: float = MIN_QUALITY) -> DataFrame:
    """Datasets below the quality threshold, with their error rate."""
    return measurements.filter(F.col("quality_score") < minimum).withColumns({
        "error_rate": F.round(ratio(F.col("invalid_records"), F.col("total_records")), 6),
        "severity": F.when(F.col("quality_score") < LOW_QUALITY, F.lit(HIGH)).otherwise(F.lit(MEDIUM)),
        "affected_records": F.col("invalid_records"),
        "alert_type": F.lit("DATA_QUALITY"),
    })


def compliance_metrics(checks: DataFrame) -> DataFrame:
    """One metric per compliance check: 1 or 0, HIGH when it failed."""
    passed = F.col("passed")
    return checks.withColumns({
        "metric_name": F.concat_ws("_", F.lit("compliance"), "compliance_level", "check_name"),
        "metric_type": F.lit("COMPLIANCE"),
        "value": F.when(passed, 1.0).otherwise(0.0),
        "threshold": F.lit(1.0),
        "severity": F.when(passed, F.lit("LOW")).otherwise(F.lit(HIGH)),
    })


def compliance_alerts(checks: DataFrame) -> DataFrame:
    """One CRITICAL alert per failed compliance check."""
    return compliance_metrics(checks).filter(F.col("value") == 0.0).select(
        "timestamp", "compliance_level", "check_name", "affected_records",
        F.lit(CRITICAL).alias("severity"), F.lit("COMPLIANCE").alias("alert_type"),
    )


def risk_alerts(risks: DataFrame) -> DataFrame:
    """Risk scores above their threshold, by the high-is-bad ladder."""
    score, threshold = F.col("risk_score"), F.col("threshold")
    return risks.filter(score > threshold).withColumns({
        "severity": severity_high_is_bad(score, threshold),
        "alert_type": F.lit("RISK"),
    })


def suspicious_rate_metric(summary: DataFrame, threshold: float = MAX_SUSPICIOUS_RATE) -> DataFrame:
    """The suspicious rate as a risk metric with its severity."""
    return summary.select(
        F.lit("suspicious_transaction_rate").alias("metric_name"), F.col("suspicious_rate").alias("value"),
        F.lit(threshold).alias("threshold"),
        severity_high_is_bad(F.col("suspicious_rate"), F.lit(threshold)).alias("severity"),
    )


def metrics_summary(metrics: DataFrame, as_of: datetime, hours: int = 24) -> DataFrame:
    """Per metric type of the last hours: count, mean value, HIGH and CRITICAL count."""
    recent = metrics.filter(F.col("timestamp") >= _at(as_of - timedelta(hours=hours)))
    mean = (F.sum(F.col("value").cast("decimal(18,6)")) / F.count("value")).cast("decimal(38,9)")
    return recent.groupBy("metric_type").agg(
        F.count(F.lit(1)).alias("metrics"), F.round(mean, 4).cast("double").alias("avg_value"),
        F.count_if(F.col("severity").isin(HIGH, CRITICAL)).alias("alerts"),
    )


def alert_counts(alerts: DataFrame) -> DataFrame:
    """Alerts per severity, of all time."""
    return alerts.groupBy("severity").agg(F.count(F.lit(1)).alias("alerts"))


def compliance_report(metrics: DataFrame) -> DataFrame:
    """Passed and failed compliance checks per level."""
    checks = metrics.filter(F.col("metric_type") == "COMPLIANCE")
    return checks.groupBy(F.coalesce("compliance_level", F.lit("UNKNOWN")).alias("compliance_level")).agg(
        F.count_if(F.col("value") == 1.0).alias("passed"), F.count_if(F.col("value") != 1.0).alias("failed")
    )


def recent_serious_alerts(alerts: DataFrame, count: int = RECENT_ALERTS) -> DataFrame:
    """The newest HIGH and CRITICAL alerts."""
    serious = alerts.filter(F.col("severity").isin(HIGH, CRITICAL))
    return serious.orderBy(*_newest("timestamp", "alert_id")).limit(count)


def stage_totals(stages: DataFrame) -> DataFrame:
    """Rows per stage and final status of every run.

    ``stages`` has run_id, stage (ingestion, transformation or data_quality),
    status, rows and passed. A run fails when a stage failed or a source did not
    pass its quality check.
    """
    def rows_of(stage: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("stage") == stage, F.col("rows"))), F.lit(0))

    failed = F.bool_or((F.col("status") == "failed") | ((F.col("stage") == "data_quality") & ~F.col("passed")))
    return stages.groupBy("run_id").agg(
        rows_of("ingestion").alias("rows_ingested"), rows_of("transformation").alias("rows_transformed"),
        F.when(failed, F.lit("failed")).otherwise(F.lit("completed")).alias("status"),
    )
