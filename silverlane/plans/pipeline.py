"""End-to-end flows: ingest, transform, full run and financial validation."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlane.columns import LEFT_OUT, money_misfits
from silverlane.functions.rules import Rule, with_errors
from silverlane.operators.aggregates import gold_tables
from silverlane.operators.audit import audit_events
from silverlane.operators.cleaning import clean, cleaning_measures
from silverlane.operators.enrichment import enrich
from silverlane.operators.metrics import metric_severity, risk_alerts, stage_totals
from silverlane.operators.quality import THRESHOLD, quarantine_rows, scorecard
from silverlane.operators.schema import latest_schemas, schema_errors
from silverlane.operators.suspicious import suspicious_flags, suspicious_summary
from silverlane.operators.validation import transaction_rules, validity_counts
from silverlane.session import materialize
from silverlane.sources.ingest import Source, ingest_sources
from silverlane.sources.readers import scan_layer
from silverlane.sources.writers import write_gold, write_layer, write_log, write_quarantine

LOG = logging.getLogger(__name__)
STORED_ONLY = ("_run_id", "year", "month")
TRANSFORM_SCHEMA = (
    "source_name string, original_rows bigint, final_rows bigint, quarantined_rows bigint, "
    "aggregations_created int, data_quality_passed boolean, status string, error string, amounts_left_out bigint"
)
CARD_SCHEMA = "source_name string, total_rows bigint, check string, score double, passed boolean"
STAGE_SCHEMA = "run_id string, stage string, source_name string, status string, rows bigint, passed boolean"


@dataclass(frozen=True)
class Layout:
    """Where the layers and logs of one pipeline are stored."""

    base: str

    @property
    def bronze(self) -> str:
        return f"{self.base}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.base}/silver"

    @property
    def gold(self) -> str:
        return f"{self.base}/gold"

    @property
    def quarantine(self) -> str:
        return f"{self.base}/quarantine"

    @property
    def rejects(self) -> str:
        return f"{self.base}/rejected_lines"

    @property
    def runs(self) -> str:
        return f"{self.base}/logs/pipeline_runs"

    @property
    def audit(self) -> str:
        return f"{self.base}/logs/audit_events"

    @property
    def schemas(self) -> str:
        return f"{self.base}/logs/schema_versions"

    @property
    def metadata(self) -> str:
        return f"{self.base}/logs/run_metadata"


@dataclass(frozen=True)
class QualityPlan:
    """What a source must meet.

    ``fields`` describes the cleaned rows, one field row per column; without it
    their schema check scores 0. Raw rows are held against the stored snapshot.
    """

    rules: list[Rule] = field(default_factory=list)
    fields: list[Any] | None = None
    threshold: float = THRESHOLD
    fail_on_error: bool = False


def read_bronze(spark: SparkSession, layout: Layout, name: str, run_id: str) -> DataFrame:
    return scan_layer(spark, f"{layout.bronze}/{name}", run_id).drop(*STORED_ONLY)


def transform_source(
    spark: SparkSession, layout: Layout, name: str, run_id: str, at: datetime, plan: QualityPlan,
    overrides: dict[str, str] | None = None,
) -> tuple:
    """Raw rows of one source to trusted rows and roll-ups; returns a result row."""
    # Quantiles, ranks and checks each scan the cleaned rows, so they are stored once.
    cleaned = materialize(clean(read_bronze(spark, layout, name, run_id), at, overrides), f"cleaned-{name}")
    misfits = money_misfits(F.col("amount")) if "amount" in cleaned.columns else F.lit(0).cast("bigint")
    counts = cleaned.agg(*cleaning_measures(), misfits.alias(LEFT_OUT)).first()
    if counts[LEFT_OUT]:
        LOG.warning("sums of %s leave out %d amounts that are no finite number below 10^22", name, counts[LEFT_OUT])
    card = scorecard(cleaned.drop("_copies"), plan.rules, plan.fields, at, plan.threshold, distinct=True)
    passed = card.filter(F.col("check") == "overall").first()["passed"]
    if plan.fail_on_error and not passed:
        raise ValueError(f"Data quality validation failed: {name}")
    quarantined = 0
    if not passed and (plan.fields or plan.rules):
        # Fields declared for the source decide which rows go; without any, its business rules do.
        checked = schema_errors(cleaned, plan.fields) if plan.fields else with_errors(cleaned, plan.rules, at)
        quarantined = write_quarantine(quarantine_rows(checked), layout.quarantine, name, at, run_id)["rows"]
    silver_path, _ = write_layer(enrich(cleaned.drop("_copies"), name, at), layout.silver, name, at, run_id)
    tables = gold_tables(scan_layer(spark, silver_path, run_id), at)
    write_gold(tables, layout.gold, name, at, run_id)
    return (name, counts["original_rows"], counts["final_rows"], quarantined, len(tables), passed, "success", None,
            counts[LEFT_OUT])


def run_transformation(
    spark: SparkSession, layout: Layout, names: list[str], run_id: str, at: datetime,
    plans: dict[str, QualityPlan] | None = None,
) -> DataFrame:
    """Transform the named sources of a run; a failing one is recorded and the others go on."""
    results = []
    for name in names:
        try:
            plan = (plans or {}).get(name, QualityPlan())
            results.append(transform_source(spark, layout, name, run_id, at, plan))
        except Exception as problem:  # noqa: BLE001 - any failure of one source must not stop the rest
            message = str(problem).split("\n")[0]
            results.append((name, None, None, None, None, None, "failed", message, None))
    return spark.createDataFrame(results, TRANSFORM_SCHEMA)


def stored_fields(spark: SparkSession, layout: Layout, name: str, run_id: str) -> list[Any]:
    """Schema stored by the latest run before this one, or by this one if it is the first: one row per column."""
    stored = spark.read.parquet(f"{layout.schemas}/{name}")
    earlier = latest_schemas(stored.filter(F.col("_run_id") != run_id)).collect()
    return earlier or latest_schemas(stored.filter(F.col("_run_id") == run_id)).collect()


def _raw_card(
    spark: SparkSession, layout: Layout, name: str, run_id: str, at: datetime, plan: QualityPlan
) -> DataFrame:
    raw = read_bronze(spark, layout, name, run_id)
    fields = stored_fields(spark, layout, name, run_id)
    card = scorecard(raw, plan.rules, fields, at, plan.threshold, fingerprint="_record_hash")
    return card.select(F.lit(name).alias("source_name"), "total_rows", "check", "score", "passed")


def _card_rows(cards: dict[str, DataFrame]) -> list[tuple]:
    """Six rows per source. All sources are one action; only if it breaks off is each tried alone."""
    if not cards:
        return []
    try:
        return [tuple(row) for row in reduce(DataFrame.unionByName, cards.values()).collect()]
    except Exception as problem:  # noqa: BLE001 - a broken check of one source must not stop the rest
        if len(cards) > 1:
            return [row for name, card in cards.items() for row in _card_rows({name: card})]
        return [_broken_card(next(iter(cards)), problem)]


def _broken_card(name: str, problem: Exception) -> tuple:
    LOG.warning("quality check of %s broke off: %s", name, str(problem).split("\n")[0])
    return (name, None, "overall", 0.0, False)


def bronze_quality(
    spark: SparkSession, layout: Layout, names: list[str], run_id: str, at: datetime, plans: dict[str, QualityPlan]
) -> DataFrame:
    """Scorecard of every landed source; stored row hashes stand for whole rows.

    Raw rows are held against the schema of the run before, or of this run when there is none. Cards are evaluated
    once, all sources side by side in one action. A source whose check breaks off fails overall with score 0 and no row
    count; why is logged as a warning.
    """
    cards, broken = {}, []
    for name in names:
        try:
            cards[name] = _raw_card(spark, layout, name, run_id, at, plans.get(name, QualityPlan()))
        except Exception as problem:  # noqa: BLE001 - as above
            broken.append(_broken_card(name, problem))
    return spark.createDataFrame(_card_rows(cards) + broken, CARD_SCHEMA)


def _stage_status(status: Column) -> Column:
    return F.when(status == "success", "completed").otherwise("failed")


def run_full_pipeline(
    spark: SparkSession, layout: Layout, sources: list[Source], run_id: str, at: datetime,
    plans: dict[str, QualityPlan] | None = None,
) -> dict[str, DataFrame]:
    """Ingest, transform and assess; the run and its stages go to the logs.

    Returns the ingest and transform results, the scorecards and the run record.
    The per-source results are small: one row per configured source. A source
    without rows has nothing to transform.
    """
    plans = plans or {}
    ingested = ingest_sources(spark, sources, layout.bronze, at, run_id, layout.schemas, layout.rejects)
    landed = [row["source_name"] for row in ingested.filter("status = 'success' AND rows_ingested > 0").collect()]
    stages = ingested.select(
        F.lit(run_id).alias("run_id"), F.lit("ingestion").alias("stage"), "source_name",
        _stage_status(F.col("status")).alias("status"), F.col("rows_ingested").alias("rows"),
        F.lit(None).cast("boolean").alias("passed"),
    )
    out = {"ingestion": ingested}
    if landed:
        transformed = run_transformation(spark, layout, landed, run_id, at, plans)
        quality = bronze_quality(spark, layout, landed, run_id, at, plans)
        stages = stages.unionByName(transformed.select(
            F.lit(run_id).alias("run_id"), F.lit("transformation").alias("stage"), "source_name",
            _stage_status(F.col("status")).alias("status"), F.col("original_rows").alias("rows"),
            F.lit(None).cast("boolean").alias("passed"),
        )).unionByName(quality.filter(F.col("check") == "overall").select(
            F.lit(run_id).alias("run_id"), F.lit("data_quality").alias("stage"), "source_name",
            # A check that broke off has no row count.
            F.when(F.col("total_rows").isNull(), "failed").otherwise("completed").alias("status"),
            F.col("total_rows").alias("rows"), "passed",
        ))
        out |= {"transformation": transformed, "data_quality": quality}
    # The run looks at whole stages: a source that fails is recorded and the others go on.
    whole = F.when(F.col("stage") == "ingestion", F.lit("completed" if landed else "failed")).otherwise("completed")
    record = stage_totals(stages.withColumn("status", whole)).withColumns({
        "pipeline_name": F.lit("full-pipeline"), "timestamp": F.lit(at).cast("timestamp_ntz"),
    })
    write_log(record, layout.runs, run_id)
    write_log(stages.withColumn("written_at", F.lit(at).cast("timestamp_ntz")), layout.metadata, run_id)
    out["run"] = spark.read.parquet(layout.runs).filter(F.col("_run_id") == run_id).drop("_run_id")
    return out


def financial_validation(
    transactions: DataFrame, at: datetime, audit_path: str | None = None, run_id: str = "validation"
) -> dict[str, DataFrame]:
    """Validate and flag transactions; derive quality, risk and audit rows.

    One projection adds errors and flags; every measure reads that frame.
    """
    rules = transaction_rules()
    checked = suspicious_flags(with_errors(transactions, rules, at))
    quality = validity_counts(checked)
    summary = suspicious_summary(checked)
    stamp = F.lit(at).cast("timestamp_ntz")
    risks = summary.select(
        F.lit("suspicious_transactions").alias("risk_type"), F.col("suspicious_rate").alias("risk_score"),
        F.lit(0.05).alias("threshold"), F.col("suspicious_transactions").alias("affected_entities"),
        stamp.alias("timestamp"),
    )
    metrics = metric_severity(quality.select(
        F.lit("transactions_data_quality").alias("metric_name"), F.lit("DATA_QUALITY").alias("metric_type"),
        F.col("quality_score").alias("value"), F.lit(0.95).alias("threshold"), F.lit(False).alias("high_is_bad"),
    ).unionByName(risks.select(
        F.lit("risk_suspicious_transactions").alias("metric_name"), F.lit("RISK").alias("metric_type"),
        F.col("risk_score").alias("value"), "threshold", F.lit(True).alias("high_is_bad"),
    )))

    def action(frame: DataFrame, user: str, what: str, resource: str, kind: str, count) -> DataFrame:
        return frame.select(
            stamp.alias("timestamp"), F.lit(user).alias("user_id"), F.lit(what).alias("action"),
            F.lit(resource).alias("resource"), F.lit(kind).alias("data_classification"),
            F.lit("FCA_RULES").alias("compliance_level"), F.col(count).alias("record_count"),
            F.lit(True).alias("success"), F.lit(None).cast("string").alias("error_message"),
        )

    events = audit_events(
        action(quality, "pipeline", "INGEST", "transaction-source", "CONFIDENTIAL", "total_records")
        .unionByName(action(quality, "pipeline", "VALIDATE", "transactions", "CONFIDENTIAL", "total_records"))
        .unionByName(
            action(summary, "aml", "SUSPICIOUS_ACTIVITY_CHECK", "transaction-monitoring", "RESTRICTED",
                   "suspicious_transactions").filter(F.col("record_count") > 0)
        )
    )
    if audit_path:
        write_log(events, audit_path, run_id)
    return {
        "transactions": checked, "quality": quality, "suspicious": summary, "metrics": metrics,
        "alerts": risk_alerts(risks), "audit": events,
    }
