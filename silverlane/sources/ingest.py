"""Landing sources in the raw layer."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlane.columns import ROW_SEQ, business_columns
from silverlane.operators.schema import schema_profile
from silverlane.sources.ranges import has_compressed, scan_csv_ranges, scan_json_ranges
from silverlane.sources.readers import (
    CORRUPT, SOURCE_FILE, scan_csv, scan_json, scan_layer, scan_object_store, split_rejected,
)
from silverlane.sources.writers import write_layer, write_log

MAX_BROADCAST_FILES = 100_000
RESULT_SCHEMA = (
    "source_name string, source_type string, rows_ingested bigint, rows_rejected bigint, output_path string, status string, error string"
)


@dataclass(frozen=True)
class Source:
    """One configured source: type csv, json or object_store (also written s3)."""

    name: str
    type: str
    path: str
    schema: T.StructType | str | None = None
    file_format: str = "parquet"
    glob: str | None = None
    lines: bool = False
    multi_line: bool = False

    @staticmethod
    def from_config(config: dict[str, Any]) -> "Source":
        known = {k: config[k] for k in ("schema", "file_format", "glob", "lines", "multi_line") if k in config}
        return Source(config["name"], config["type"], config["path"], **known)


def in_source_order(df: DataFrame, columns: list[Column], same_rows: DataFrame | None = None) -> DataFrame:
    """``columns``, and under ``_row_seq`` the number of each row: files by path, rows as they stand in their file.

    Spark packs splits of files into tasks by size, so the place in a task says nothing about the order of files. Rows
    are counted per split (one more pass, over one column where that is enough), the counts added up over the
    splits in order, and each row gets the sum before its split and its place in the split. Frames that do not come
    straight from several files are numbered by task and place; a ``_row_seq`` that is there is kept. ``same_rows`` is counted in place of an observed ``df``,
    whose observation would else be taken from both passes.
    """
    if ROW_SEQ in df.columns:
        return df.select(*columns, ROW_SEQ)
    place = F.monotonically_increasing_id()
    files = df.inputFiles()
    try:
        df.select("_metadata.file_path")
    except AnalysisException:
        files = []
    if len(files) < 2:
        return df.select(*columns, place.alias(ROW_SEQ))
    split = [F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block"), place.alias("_place")]
    # Which lines do not fit shows only when all fields are read; otherwise one will do.
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
    plain = plain if same_rows is not None else plain[:1]
    counted = (df if same_rows is None else same_rows).select(*split, F.hash(*plain).alias("_seen") if plain else F.lit(0).alias("_seen"))
    splits = counted.groupBy("_path", "_block").agg(
        F.count_if(F.col("_seen") >= F.lit(-(1 << 31))).alias("_n"), F.min("_place").alias("_first"))
    earlier = Window.orderBy("_path", "_block").rowsBetween(Window.unboundedPreceding, -1)  # one row per split
    splits = splits.select(
        F.col("_path").alias("_in"), F.col("_block").alias("_at"), "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    names = [c for c in df.select(*columns).columns]
    joined = df.select(*columns, *split).join(
        F.broadcast(splits) if len(files) <= MAX_BROADCAST_FILES else splits,
        (F.col("_path") == F.col("_in")) & (F.col("_block") == F.col("_at")))
    return joined.select(*[f"`{c}`" for c in names], (F.col("_before") + F.col("_place") - F.col("_first")).alias(ROW_SEQ))


def add_ingest_metadata(
    df: DataFrame, ingested_at: datetime, source_file: str | None = None, same_rows: DataFrame | None = None
) -> DataFrame:
    """Add time, source file, row hash and row order.

    The hash covers business columns only, so the same row always gets the same
    hash. Row order is that of ``in_source_order``, which a stored layer keeps.
    """
    names = business_columns(df)
    origin = F.lit(source_file) if source_file else F.col(SOURCE_FILE if SOURCE_FILE in df.columns else "_metadata.file_path")
    return in_source_order(df, [
        *[F.col(f"`{name}`") for name in names],
        F.lit(ingested_at).cast("timestamp_ntz").alias("_ingestion_timestamp"),
        origin.alias("_source_file"),
        F.sha2(F.to_json(F.struct(*names)), 256).alias("_record_hash"),
    ], same_rows)


def read_source(spark: SparkSession, source: Source) -> DataFrame:
    """Rows of a source; those of CSV, from a folder or a store, with the text of lines that do not fit.

    CSV with line breaks in quotes and JSON documents are read by byte ranges, unless a file is compressed.
    """
    stored_as = source.file_format if source.type in ("object_store", "s3") else source.type
    if (stored_as == "csv" and source.multi_line) or (stored_as == "json" and not source.lines):
        if not has_compressed(spark, source.path, source.glob):
            if stored_as == "csv":
                return scan_csv_ranges(spark, source.path, source.schema, keep_rejected=True, glob=source.glob, places=True)
            return scan_json_ranges(spark, source.path, source.schema, glob=source.glob, places=True)
    if source.type == "csv":
        return scan_csv(spark, source.path, source.schema, source.multi_line, keep_rejected=True)
    if source.type == "json":
        return scan_json(spark, source.path, source.schema, source.lines)
    if source.type in ("object_store", "s3"):
        return scan_object_store(
            spark, source.path, source.file_format, source.schema, source.glob, source.multi_line,
            keep_rejected=True, lines=source.lines)
    raise ValueError(f"Unsupported source type: {source.type}")


def ingest_sources(
    spark: SparkSession, sources: list[Source], bronze: str, ingested_at: datetime, run_id: str,
    schemas: str | None = None, rejects: str | None = None,
) -> DataFrame:
    """Land every source; a failing one is recorded and the others go on.

    Lines of a CSV source that do not fit its schema are counted, and stored with a reason where ``rejects`` says.

    With ``schemas`` the schema found in each source is added to that table, one
    snapshot per ingest time.
    """
    results = []
    for source in sources:
        try:
            scanned, lost, same_rows = read_source(spark, source), None, None
            if CORRUPT in scanned.columns:
                lost = Observation(f"rejected-{source.name}-{run_id}")
                _, rejected = split_rejected(scanned)
                observed = scanned.observe(lost, F.count(CORRUPT).alias("rows"))
                same_rows, scanned = (d.filter(F.col(CORRUPT).isNull()).drop(CORRUPT) for d in (scanned, observed))
            landed = add_ingest_metadata(scanned, ingested_at, same_rows=same_rows)
            path, seen = write_layer(landed, bronze, source.name, ingested_at, run_id)
            lost_rows = lost.get["rows"] if lost else 0
            if lost_rows and rejects:
                write_log(rejected, f"{rejects}/{source.name}", run_id)
            if schemas:
                stored = scan_layer(spark, path, run_id).drop("year", "month")
                snapshot = schema_profile(stored).select(
                    F.lit(source.name).alias("schema_name"), F.lit(int(ingested_at.timestamp())).alias("snapshot"), "*"
                )
                write_log(snapshot, f"{schemas}/{source.name}", run_id)
            results.append((source.name, source.type, seen["rows"], lost_rows, path, "success", None))
        except Exception as problem:  # noqa: BLE001 - any failure of one source must not stop the rest
            message = str(problem).split("\n")[0]
            results.append((source.name, source.type, None, None, None, "failed", message))
    return spark.createDataFrame(results, RESULT_SCHEMA)
