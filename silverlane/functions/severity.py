"""Severity ladders for metrics and alerts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOW, MEDIUM, HIGH, CRITICAL = "LOW", "MEDIUM", "HIGH", "CRITICAL"


def severity_low_is_bad(value: Column, threshold: Column) -> Column:
    """Ladder for scores that should stay at or above their threshold."""
    return (
        F.when(value < threshold * 0.5, F.lit(CRITICAL))
        .when(value < threshold * 0.75, F.lit(HIGH))
        .when(value < threshold, F.lit(MEDIUM))
        .otherwise(F.lit(LOW))
    )


def severity_high_is_bad(value: Column, threshold: Column) -> Column:
    """Ladder for rates and risks that should stay at or below their threshold."""
    return (
        F.when(value > threshold * 2, F.lit(CRITICAL))
        .when(value > threshold * 1.5, F.lit(HIGH))
        .when(value > threshold, F.lit(MEDIUM))
        .otherwise(F.lit(LOW))
    )
