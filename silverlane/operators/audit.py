"""Audit, lineage, compliance and retention over append-only log tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlane.columns import ratio

# Compliance rules, retention days and storage tiers.
COMPLIANCE_RULES = {
    "FCA_RULES": {
        "allowed_classifications": ["PUBLIC", "INTERNAL", "CONFIDENTIAL", "RESTRICTED"],
        "allowed_actions": ["READ", "write", "validate", "transform", "audit"],
    },
    "GDPR": {
        "allowed_classifications": ["PUBLIC", "INTERNAL"],
        "allowed_actions": ["read", "validate", "anonymize"],
    },
    "SOX": {
        "allowed_classifications": ["PUBLIC", "INTERNAL", "CONFIDENTIAL"],
        "allowed_actions": ["read", "validate", "audit"],
    },
}
COMPLIANCE_LEVELS = ("PCI_DSS", "GDPR", "SOX", "BASEL_III", "FCA_RULES", "MIFID_II")
CLASSIFICATIONS = ("PUBLIC", "INTERNAL", "CONFIDENTIAL", "RESTRICTED", "TOP_SECRET")
RETENTION_DAYS = 2555
RETENTION_POLICIES = {
    "transaction_data": 2555,
    "customer_data": 2555,
    "audit_logs": 2555,
    "metrics_data": 90,
    "quarantine_data": 90,
    "temp_files": 7,
}
# layer: days until infrequent access, until archive, until expiry
STORAGE_TIERS = {"bronze": (30, 90, 2555), "silver": (90, 365, None), "gold": (365, None, None)}
DAY_MICROS = 86_400_000_000


def _micros(moment: Column) -> Column:
    return F.unix_micros(moment.cast("timestamp"))


def _at(moment: datetime) -> Column:
    return F.lit(moment).cast("timestamp_ntz")


def whole_days(later: Column, earlier: Column) -> Column:
    return F.floor((_micros(later) - _micros(earlier)) / DAY_MICROS)


def audit_events(actions: DataFrame, source_system: str = "silverlane") -> DataFrame:
    """Audit rows for performed actions.

    ``actions`` has timestamp, user_id, action, resource, data_classification,
    compliance_level, record_count, success, error_message and optionally a
    ``metadata`` map. The hash covers resource, action, count and time; the id is
    a hash as well, so a repeated run has the same ids.
    """
    moment = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    content = F.concat_ws(":", "resource", "action", F.col("record_count").cast("string"), moment)
    metadata = F.col("metadata") if "metadata" in actions.columns else F.lit(None).cast("map<string,string>")
    return actions.select(
        F.sha2(F.concat_ws("|", content, "user_id", "data_classification", "compliance_level"), 256).alias("event_id"),
        "timestamp", "user_id", "action", "resource", "data_classification", "compliance_level",
        F.lit(source_system).alias("source_system"), F.lit(None).cast("string").alias("destination_system"),
        "record_count", F.sha2(content, 256).alias("data_hash"), "success", "error_message",
        metadata.alias("metadata"),
    )


def lineage_records(steps: DataFrame, retention_days: int = RETENTION_DAYS) -> DataFrame:
    """Lineage rows with their retention date.

    A row without ``source_hash`` (its file is gone) gets the hash of its path.
    ``retention_days`` may also be a column of the input.
    """
    days = F.col("retention_days") if "retention_days" in steps.columns else F.lit(retention_days)
    keep = _micros(F.col("processing_time")) + days.cast("bigint") * DAY_MICROS
    known = F.col("source_hash") if "source_hash" in steps.columns else F.lit(None).cast("string")
    return steps.select(
        F.sha2(F.concat_ws("|", "source_file", "destination_table", F.col("processing_time").cast("string")), 256)
        .alias("lineage_id"),
        "source_file", F.coalesce(known, F.sha2("source_file", 256)).alias("source_hash"),
        "transformations", "destination_table", "processing_time", "data_quality_score", "compliance_checks",
        F.timestamp_micros(keep).cast("timestamp_ntz").alias("retention_date"),
    )


def compliance_rules(spark: SparkSession, rules: dict = COMPLIANCE_RULES) -> DataFrame:
    rows = [(level, r["allowed_classifications"], r["allowed_actions"]) for level, r in rules.items()]
    return spark.createDataFrame(
        rows, "compliance_level string, allowed_classifications array<string>, allowed_actions array<string>"
    )


def compliance_check(events: DataFrame, rules: dict = COMPLIANCE_RULES) -> DataFrame:
    """Add ``compliant``: classification and action are both allowed at the level.

    The rule table has one row per configured level, so it is broadcast.
    """
    table = F.broadcast(compliance_rules(events.sparkSession, rules))
    allowed = F.array_contains("allowed_classifications", F.col("data_classification")) & F.array_contains(
        "allowed_actions", F.col("action")
    )
    return (
        events.join(table, "compliance_level", "left")
        .withColumn("compliant", F.coalesce(allowed, F.lit(False)))
        .drop("allowed_classifications", "allowed_actions")
    )


def audit_period(events: DataFrame, start: datetime, end: datetime, level: str | None = None) -> DataFrame:
    """Events of a period, both ends included, optionally of one level."""
    chosen = events.filter(F.col("timestamp").between(_at(start), _at(end)))
    return chosen.filter(F.col("compliance_level") == level) if level else chosen


def audit_report(events: DataFrame, start: datetime, end: datetime, level: str | None = None) -> DataFrame:
    count, good = F.count(F.lit(1)), F.count_if("success")
    return audit_period(events, start, end, level).agg(
        count.alias("total_events"), good.alias("successful_events"), (count - good).alias("failed_events"),
        F.round(ratio(good, count), 6).alias("success_rate"), F.lit(level or "ALL").alias("compliance_level"),
    )


def audit_by(events: DataFrame, column: str) -> DataFrame:
    """Event count per action or per classification."""
    return events.groupBy(column).agg(F.count(F.lit(1)).alias("events"))


def retention_expired(lineage: DataFrame, as_of: datetime) -> DataFrame:
    """Lineage past its retention date with whole days overdue."""
    now = _at(as_of)
    return lineage.filter(now > F.col("retention_date")).select(
        "lineage_id", "source_file", "destination_table", "retention_date",
        whole_days(now, F.col("retention_date")).alias("days_overdue"),
    )


def retention_by_policy(inventory: DataFrame, as_of: datetime, policies: dict[str, int] = RETENTION_POLICIES) -> DataFrame:
    """Datasets older than the policy of their kind. One broadcast row per policy."""
    table = inventory.sparkSession.createDataFrame(list(policies.items()), "dataset_kind string, retention_days int")
    age = whole_days(_at(as_of), F.col("created_at"))
    return (
        inventory.join(F.broadcast(table), "dataset_kind")
        .withColumn("age_days", age)
        .filter(F.col("age_days") > F.col("retention_days"))
        .withColumn("days_overdue", F.col("age_days") - F.col("retention_days"))
    )


def storage_tiering(inventory: DataFrame, as_of: datetime, tiers: dict = STORAGE_TIERS) -> DataFrame:
    """Storage class of every object by its layer and age in days."""
    age = F.col("age_days")
    tier = F.lit("STANDARD")
    for layer, (infrequent, archive, expiry) in tiers.items():
        for days, name in ((infrequent, "STANDARD_IA"), (archive, "GLACIER"), (expiry, "EXPIRED")):
            if days is not None:
                tier = F.when((F.col("layer") == layer) & (age >= days), F.lit(name)).otherwise(tier)
    aged = inventory.withColumn("age_days", whole_days(_at(as_of), F.col("modified_at")))
    return aged.withColumn("storage_class", tier)


def cleanup_candidates(files: DataFrame, as_of: datetime, days_to_keep: int = 30) -> DataFrame:
    """Files last modified before the cut-off; ``files`` comes from ``list_files``."""
    limit = F.timestamp_micros(_micros(_at(as_of)) - F.lit(days_to_keep * DAY_MICROS)).cast("timestamp_ntz")
    return files.filter(F.col("modified_at") < limit)


def cleanup_manifest(files: DataFrame, as_of: datetime, days_to_keep: int = 30) -> DataFrame:
    """Number and size of the files a clean-up would remove."""
    return cleanup_candidates(files, as_of, days_to_keep).agg(
        F.count(F.lit(1)).alias("files"),
        (F.coalesce(F.sum("length"), F.lit(0)) / 1048576).alias("megabytes"),
    )
