"""Data-quality scorecard and row-level quarantine."""

from __future__ import annotations

from datetime import date, datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlane.columns import business_columns, ratio
from silverlane.functions.rules import ERRORS, Rule, errors, predicate
from silverlane.functions.text import kinds_found, to_datetime
from silverlane.operators.schema import failed_rows

# Pass marks of the checks and advice for failed ones.
RULE_PASS = 0.95
COMPLETENESS_PASS = 0.9
DUPLICATE_LIMIT = 0.01
CONSISTENCY_PASS = 0.9
FRESHNESS_PASS = 0.8
FRESH_HOURS = 24
FRESH_DAYS = 7
THRESHOLD = 0.95
STRICT_THRESHOLD = 0.98
RECOMMENDATIONS = {
    "schema_validation": "Review and update schema definitions to match incoming data structure",
    "completeness": "Investigate data sources for missing values and implement data collection improvements",
    "consistency": "Implement data standardization processes to ensure consistency",
    "freshness": "Review data ingestion schedules to ensure timely data delivery",
    "business_rules": "Review business rules and data validation logic",
}

INGEST_TIME = "_ingestion_timestamp"


def _rows(wide: DataFrame, by: list[str], structs: list[Column]) -> DataFrame:
    """One wide row per group to one row per struct."""
    return wide.select(*by, F.inline(F.array(*structs)))


def _total() -> Column:
    return F.count(F.lit(1))


def _passed_rows(df: DataFrame, rule: Rule, as_of) -> Column:
    holds = predicate(rule, df.schema, as_of)
    return F.lit(0).cast("bigint") if holds is None else F.count_if(holds)


def business_rule_results(
    df: DataFrame, rules: list[Rule], as_of: date | datetime | None = None, by: list[str] | None = None
) -> DataFrame:
    """Passing rows, score and pass mark per rule; an uncheckable rule scores 0."""
    by = by or []
    wide = df.groupBy(*by).agg(
        _total().alias("total_rows"), *[_passed_rows(df, r, as_of).alias(f"r{i}") for i, r in enumerate(rules)]
    )
    structs = []
    for i, rule in enumerate(rules):
        score = ratio(F.col(f"r{i}"), F.col("total_rows"))
        structs.append(F.struct(
            F.lit(rule.name).alias("rule"), F.col(f"r{i}").alias("passed_rows"), F.col("total_rows"),
            score.alias("score"), (score >= RULE_PASS).alias("passed"),
        ))
    return _rows(wide, by, structs)


def business_rules_score(results: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Mean score over all rules; 1 for no rules."""
    mean = F.coalesce(F.avg("score"), F.lit(1.0))
    return results.groupBy(*(by or [])).agg(mean.alias("score"), (mean >= RULE_PASS).alias("passed"))


def completeness(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Share of rows with a value, per business column."""
    by = by or []
    names = [name for name in business_columns(df) if name not in by]
    wide = df.groupBy(*by).agg(
        _total().alias("_rows_total"), *[F.count(F.col(n)).alias(f"n{i}") for i, n in enumerate(names)]
    )
    return _rows(wide, by, [
        F.struct(
            F.lit(name).alias("column"), F.col(f"n{i}").alias("non_null_count"),
            F.col("_rows_total").alias("total_count"),
            ratio(F.col(f"n{i}"), F.col("_rows_total")).alias("completeness"),
        )
        for i, name in enumerate(names)
    ])


def completeness_score(per_column: DataFrame) -> DataFrame:
    mean = F.avg("completeness")
    return per_column.agg(mean.alias("score"), (mean >= COMPLETENESS_PASS).alias("passed"))


def duplicates(df: DataFrame, by: list[str] | None = None, fingerprint: str | None = None) -> DataFrame:
    """Later copies of equal rows and their share.

    A stored row hash (``fingerprint``) lets the scan read that one column
    instead of every business column.
    """
    by = by or []
    key = [fingerprint] if fingerprint else [name for name in business_columns(df) if name not in by]
    copies = df.groupBy(*by, *key).agg(_total().alias("_n"))
    counted = copies.groupBy(*by).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_count"),
    )
    rate = ratio(F.col("duplicate_count"), F.col("total_rows"))
    return counted.withColumns({"duplicate_rate": rate, "passed": rate < DUPLICATE_LIMIT})


def _text_columns(df: DataFrame, by: list[str]) -> list[str]:
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return [name for name in business_columns(df) if name in text and name not in by]


def _kinds(name: str) -> Column:
    return F.bit_count(kinds_found(F.col(name)))


def type_consistency(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """How many kinds of value each text column mixes; more than one is an issue."""
    by = by or []
    names = _text_columns(df, by)
    wide = df.groupBy(*by).agg(*[_kinds(name).alias(f"k{i}") for i, name in enumerate(names)])
    return _rows(wide, by, [
        F.struct(F.lit(name).alias("column"), F.col(f"k{i}").alias("kinds"), (F.col(f"k{i}") <= 1).alias("passed"))
        for i, name in enumerate(names)
    ])


def _seconds_until(as_of: datetime, moment: Column) -> Column:
    micros = F.unix_micros(F.lit(as_of).cast("timestamp_ntz").cast("timestamp")) - F.unix_micros(
        moment.cast("timestamp")
    )
    return micros / 1e6


def freshness_ingest(df: DataFrame, as_of: datetime) -> DataFrame:
    """Hours since the last ingest; fresh below a day."""
    hours = _seconds_until(as_of, F.max(INGEST_TIME)) / 3600
    return df.agg(
        F.round(hours, 4).alias("hours_since_ingestion"), F.coalesce(hours < FRESH_HOURS, F.lit(False)).alias("passed")
    )


def _date_names(df: DataFrame, by: list[str]) -> list[str]:
    return [name for name in business_columns(df) if "date" in name.lower() and name not in by]


def _date_measures(df: DataFrame, names: list[str]) -> list[Column]:
    measures = []
    for i, name in enumerate(names):
        parsed = to_datetime(F.col(name), df.schema[name].dataType)
        measures += [
            F.max(parsed).alias(f"latest{i}"),
            F.count_if(F.col(name).isNotNull() & parsed.isNull()).alias(f"unparsed{i}"),
        ]
    return measures


def _days_since(as_of: datetime, moment: Column) -> Column:
    return F.floor(_seconds_until(as_of, moment) / 86400)


def freshness_business(df: DataFrame, as_of: datetime, by: list[str] | None = None) -> DataFrame:
    """Whole days since the latest value of each date column; fresh below a week.

    A column with text that is no date is left out.
    """
    by = by or []
    names = _date_names(df, by)
    wide = df.groupBy(*by).agg(_total().alias("_rows_total"), *_date_measures(df, names))
    structs = []
    for i, name in enumerate(names):
        days = _days_since(as_of, F.col(f"latest{i}"))
        structs.append(F.struct(
            F.lit(name).alias("column"), days.alias("days_since_latest"),
            F.coalesce(days < FRESH_DAYS, F.lit(False)).alias("passed"), F.col(f"unparsed{i}").alias("unparsed"),
        ))
    return _rows(wide, by, structs).filter(F.col("unparsed") == 0).drop("unparsed")


def schema_check(df: DataFrame, fields: list[Any] | None) -> DataFrame:
    """1 when columns and rows all meet the schema, else 0; 0 too when there is no schema."""
    failed = failed_rows(df, fields)
    met = (failed == 0) if fields else F.lit(False)
    return df.agg(failed.alias("failed_rows"), F.when(met, 1.0).otherwise(0.0).alias("score"), met.alias("passed"))


def _mean(parts: list[Column], empty: float) -> Column:
    return sum(parts[1:], parts[0]) / len(parts) if parts else F.lit(empty)


def scorecard(
    df: DataFrame, rules: list[Rule], fields: list[Any] | None, as_of: datetime,
    threshold: float = THRESHOLD, by: list[str] | None = None, fingerprint: str | None = None, distinct: bool = False,
) -> DataFrame:
    """Score and verdict of the five checks and overall, per group of ``by``.

    ``distinct`` says that copies are gone already, so none are counted.

    ``fields`` are the field rows of the schema to meet, None for no schema.

    Everything but the duplicate count is one aggregation without a shuffle of
    rows. The two results have one row per group and are put together by it.
    """
    by = by or []
    names = [name for name in business_columns(df) if name not in by]
    text, dates = _text_columns(df, by), _date_names(df, by)
    measures = [
        _total().alias("_rows_total"),
        failed_rows(df, fields).alias("_schema_failed"),
        *[_passed_rows(df, rule, as_of).alias(f"r{i}") for i, rule in enumerate(rules)],
        *[F.count(F.col(name)).alias(f"n{i}") for i, name in enumerate(names)],
        *[_kinds(name).alias(f"k{i}") for i, name in enumerate(text)],
        *_date_measures(df, dates),
    ]
    has_ingest = INGEST_TIME in df.columns
    if has_ingest:
        measures.append(F.max(INGEST_TIME).alias("_latest_ingest"))
    wide = df.groupBy(*by).agg(*measures)
    if distinct:
        joined = wide.withColumn("_few_copies", F.lit(True))
    else:
        copies = duplicates(df, by, fingerprint).select(*by, F.col("passed").alias("_few_copies"))
        joined = wide.join(copies, by) if by else wide.withColumn("_few_copies", copies.scalar())

    total = F.col("_rows_total")
    schema_score = F.when(F.col("_schema_failed") == 0, 1.0).otherwise(0.0) if fields else F.lit(0.0)
    rule_score = _mean([ratio(F.col(f"r{i}"), total) for i in range(len(rules))], 1.0)
    complete_score = _mean([ratio(F.col(f"n{i}"), total) for i in range(len(names))], 1.0)
    one_kind = F.lit(True)
    for i in range(len(text)):
        one_kind = one_kind & (F.col(f"k{i}") <= 1)
    consistent_score = (F.col("_few_copies").cast("int") + one_kind.cast("int")) / 2
    fresh, checked = F.lit(0), F.lit(0)
    if has_ingest:
        hours = _seconds_until(as_of, F.col("_latest_ingest")) / 3600
        fresh, checked = fresh + F.coalesce(hours < FRESH_HOURS, F.lit(False)).cast("int"), checked + 1
    for i in range(len(dates)):
        usable = F.col(f"unparsed{i}") == 0
        recent = F.coalesce(_days_since(as_of, F.col(f"latest{i}")) < FRESH_DAYS, F.lit(False))
        fresh, checked = fresh + (usable & recent).cast("int"), checked + usable.cast("int")
    fresh_score = F.when(checked > 0, fresh / checked).otherwise(1.0)

    scored = joined.select(
        *by, total.alias("total_rows"), schema_score.alias("s1"), rule_score.alias("s2"), complete_score.alias("s3"),
        consistent_score.alias("s4"), fresh_score.alias("s5"),
    ).withColumn("s6", (F.col("s1") + F.col("s2") + F.col("s3") + F.col("s4") + F.col("s5")) / 5)
    marks = (
        ("schema_validation", "s1", 1.0), ("business_rules", "s2", RULE_PASS), ("completeness", "s3", COMPLETENESS_PASS),
        ("consistency", "s4", CONSISTENCY_PASS), ("freshness", "s5", FRESHNESS_PASS), ("overall", "s6", threshold),
    )
    return _rows(scored, [*by, "total_rows"], [
        F.struct(F.lit(name).alias("check"), F.col(s).alias("score"), (F.col(s) >= mark).alias("passed"))
        for name, s, mark in marks
    ])


def quality_report(card: DataFrame) -> DataFrame:
    """The scorecard with advice next to every failed check."""
    advice = F.lit(None).cast("string")
    for check, text in RECOMMENDATIONS.items():
        advice = F.when((F.col("check") == check) & ~F.col("passed"), F.lit(text)).otherwise(advice)
    return card.withColumn("recommendation", advice)


def quarantine_rows(validated: DataFrame, mode: str = "row") -> DataFrame:
    """Rows to set aside: those with errors, or all rows of a batch that has any."""
    if mode == "row":
        return validated.filter(F.size(ERRORS) > 0)
    if mode == "batch":
        any_error = validated.agg(F.coalesce(F.bool_or(F.size(ERRORS) > 0), F.lit(False))).scalar()
        return validated.filter(any_error)
    raise ValueError(f"unknown quarantine mode: {mode}")


def reprocess_quarantine(
    quarantined: DataFrame, rules: list[Rule], as_of: date | datetime
) -> tuple[DataFrame, DataFrame]:
    """Check quarantined rows again: (released, still held)."""
    again = quarantined.drop(ERRORS).withColumn(ERRORS, errors(quarantined.schema, rules, as_of))
    return again.filter(F.size(ERRORS) == 0).drop(ERRORS), again.filter(F.size(ERRORS) > 0)
