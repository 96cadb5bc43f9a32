"""Writers for the stored layers, quarantine and exports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

COMPRESSION = "snappy"


def _replace_partitions(df: DataFrame, path: str, *partitions: str) -> None:
    """Write partitions, replacing those a repeated run wrote before."""
    (
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", COMPRESSION)
        .partitionBy(*partitions).parquet(path)
    )


def write_layer(
    df: DataFrame, base: str, name: str, written_at: datetime, run_id: str, measures: list | None = None
) -> tuple[str, dict]:
    """Write to ``base/name`` by year and month of writing and run; returns path and measures.

    Earlier runs stay as they are. Measures are observed in the tasks that
    write, so no second pass counts rows.
    """
    path = f"{base}/{name}"
    seen = Observation(f"{name}-{run_id}")
    rows = df.observe(seen, *(measures or [F.count(F.lit(1)).alias("rows")])).withColumns({
        "year": F.lit(written_at.year), "month": F.lit(f"{written_at.month:02d}"), "_run_id": F.lit(run_id),
    })
    _replace_partitions(rows, path, "year", "month", "_run_id")
    return path, seen.get


def write_gold(tables: dict[str, DataFrame], base: str, name: str, written_at: datetime, run_id: str) -> dict[str, str]:
    """One folder per aggregate and source."""
    paths = {}
    for kind, table in tables.items():
        paths[kind], _ = write_layer(table.withColumn("source_name", F.lit(name)), f"{base}/{kind}", name, written_at, run_id)
    return paths


def write_quarantine(bad: DataFrame, base: str, source_name: str, quarantined_at: datetime, run_id: str) -> dict:
    """Write bad rows with their ``_errors`` by source, day and run."""
    seen = Observation(f"quarantine-{source_name}-{run_id}")
    rows = bad.observe(seen, F.count(F.lit(1)).alias("rows")).withColumns({
        "_quarantined_at": F.lit(quarantined_at).cast("timestamp_ntz"), "source_name": F.lit(source_name),
        "quarantine_date": F.lit(quarantined_at.date()), "_run_id": F.lit(run_id),
    })
    _replace_partitions(rows, base, "source_name", "quarantine_date", "_run_id")
    return seen.get


def write_log(rows: DataFrame, path: str, run_id: str) -> None:
    """Add a run's rows to a log table; a repeated run replaces its own."""
    _replace_partitions(rows.withColumn("_run_id", F.lit(run_id)), path, "_run_id")


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, one part per task; quotes inside quoted text are doubled, as ``scan_csv`` reads them."""
    df.write.mode("overwrite").options(header=True, quote='"', escape='"').csv(path)


def export_report_json(tables: dict[str, DataFrame], path: str) -> None:
    """Log tables as JSON lines, one folder per table."""
    for name, table in tables.items():
        table.write.mode("overwrite").json(f"{path}/{name}")
