"""Readers for the raw sources and the stored layers."""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlane.columns import ROW_SEQ

CORRUPT = "_corrupt_record"
SOURCE_FILE = "_source_file"


def scan_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, multi_line: bool = False,
    keep_rejected: bool = False, header: bool = True, **options,
) -> DataFrame:
    """CSV, with a header unless said otherwise, quoted by ``"`` with ``""`` inside quotes. An empty field is null.

    A given schema saves the extra pass that infers one. With ``multi_line`` quoted text may hold line breaks; a file
    is then one task. With ``keep_rejected`` lines that do not fit the schema keep their text in ``_corrupt_record``,
    which is null for all others; ``split_rejected`` takes the two apart. ``options`` are those of Spark's file sources.
    """
    reader = spark.read.options(
        header=header, encoding="UTF-8", enforceSchema=not header, quote='"', escape='"', multiLine=multi_line,
        **options,
    )
    if schema is None:
        schema = reader.option("inferSchema", True).csv(path).schema
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if keep_rejected:
        # Whether a line fits must not depend on the columns a query happens to read.
        reader = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, columnPruning=False)
        fields = T.StructType([*fields.fields, T.StructField(CORRUPT, T.StringType())])
    return reader.schema(fields).csv(path)


def split_rejected(scanned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that fit, and (record, reason) of the lines that do not."""
    width = sum(c not in (CORRUPT, SOURCE_FILE, ROW_SEQ) for c in scanned.columns)
    texts = ", ".join(f"c{i} string" for i in range(width + 1))
    extra = F.from_csv(F.col(CORRUPT), F.lit(texts), {"escape": '"'})[f"c{width}"]
    # Spark reads the text of a bad line only along with a field; the hash of all fields is always above its least value.
    parsed = F.hash(*[c for c in scanned.columns if c != CORRUPT]) >= F.lit(-(1 << 31))
    rejected = scanned.filter(F.col(CORRUPT).isNotNull() & parsed).select(
        F.col(CORRUPT).alias("record"),
        F.when(extra.isNotNull(), "too_many_fields").otherwise("missing_or_unreadable_field").alias("reason"),
    )
    return scanned.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), rejected


def scan_json(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, lines: bool = False
) -> DataFrame:
    """A JSON document (list of objects or one object) or, with ``lines``, one object per line.

    A document is one task per file; ``lines`` files are split like any text.
    Anything but objects is an error.
    """
    reader = spark.read.option("multiLine", not lines).option("mode", "FAILFAST")
    df = (reader.schema(schema) if schema is not None else reader).json(path)
    if df.columns == [CORRUPT] or not df.columns:
        raise ValueError(f"not a JSON object or list of objects: {path}")
    return df


def scan_object_store(
    spark: SparkSession, uri: str, file_format: str, schema: T.StructType | str | None = None, glob: str | None = None,
    multi_line: bool = False, keep_rejected: bool = False, lines: bool = True,
) -> DataFrame:
    """Every matching file under a prefix, whatever the folder depth.

    CSV files are read as ``scan_csv`` does, with the same quotes, and with the text of lines that do not fit if
    ``keep_rejected``; JSON files as objects, one per line unless ``lines`` is false. Other formats know no such lines.
    """
    options = {"recursiveFileLookup": True} | ({"pathGlobFilter": glob} if glob else {})
    if file_format == "csv":
        return scan_csv(spark, uri, schema, multi_line, keep_rejected, **options)
    reader = spark.read.format(file_format).options(**options)
    if file_format == "json":
        reader = reader.option("multiLine", not lines)
    return (reader.schema(schema) if schema is not None else reader).load(uri)


def scan_layer(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    """A stored layer (or one parquet file), optionally of one run.

    Files of one run share their columns, so only that run's folders are listed
    and read. Across runs columns may differ and are merged.
    """
    if run_id:
        return spark.read.option("basePath", path).parquet(f"{path}/year=*/month=*/_run_id={run_id}")
    return spark.read.option("mergeSchema", True).parquet(path)


def list_files(spark: SparkSession, *paths: str) -> DataFrame:
    """Path, size and modification time of every file under the paths.

    ``content`` is not selected, so no file is opened.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    return files.select(
        "path", "length", F.col("modificationTime").cast("timestamp_ntz").alias("modified_at")
    )


PIECE_BYTES = 64 << 20


def file_fingerprints(spark: SparkSession, *paths: str, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """SHA-256 of every file under the paths.

    Files are hashed in pieces of ``piece_bytes``, each by whichever task gets it. A file of one piece has the hash of
    its content; a longer one the hash of its pieces' hashes, in order. Spark does not list empty files.
    """
    files = list_files(spark, *paths).select("path", "length")
    last = F.greatest(F.lit(0), F.ceil(F.col("length") / piece_bytes) - 1)
    pieces = files.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last))).repartition("path", "piece")

    def hashed(batches):
        for batch in batches:
            hashes = []
            for path, piece in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                store, name = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
                with store.open_input_file(name) as file:
                    file.seek(piece * piece_bytes)
                    hashes.append(hashlib.sha256(file.read(piece_bytes)).digest())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hashes)], names=["path", "length", "piece", "hash"])

    found = pieces.mapInArrow(hashed, "path string, length bigint, piece bigint, hash binary")
    ordered = F.array_sort(F.collect_list(F.struct("piece", "hash")))
    grouped = found.groupBy("path", "length").agg(ordered.alias("pieces"))
    joined = F.aggregate("pieces", F.lit(b""), lambda whole, p: F.concat(whole, p["hash"]))
    return grouped.select(
        "path", "length",
        F.when(F.size("pieces") == 1, F.lower(F.hex(F.col("pieces")[0]["hash"]))).otherwise(F.sha2(joined, 256)).alias("file_hash"),
    )


def fingerprint_or_path_hash(wanted: DataFrame, fingerprints: DataFrame) -> DataFrame:
    """File hash per ``source_file``; the hash of the path where no file was found."""
    found = fingerprints.select(F.col("path").alias("source_file"), "file_hash")
    return wanted.join(found, "source_file", "left").select(
        *wanted.columns, F.coalesce("file_hash", F.sha2("source_file", 256)).alias("source_hash")
    )
