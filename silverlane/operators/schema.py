"""Schema profiles, snapshots, differences and validation.

A field table has one row per schema, snapshot and column:
``schema_name, snapshot, field, dtype, nullable, min_value, max_value, max_length, rows``.
"""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlane.columns import is_metadata
from silverlane.functions.rules import ERRORS, Rule, errors, predicate
from silverlane.functions.text import KIND_BITS, kinds_found

FIELD_KEYS = ["schema_name", "snapshot"]


def dtype_name(dtype: T.DataType) -> str:
    """Portable name of a column type: int64, float64, object, datetime64[ns] or bool."""
    if isinstance(dtype, T.IntegralType):
        return "int64"
    if isinstance(dtype, (T.FractionalType, T.DecimalType)):
        return "float64"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "datetime64[ns]"
    if isinstance(dtype, T.BooleanType):
        return "bool"
    return "object"


def _inferred_dtype(kinds: Column, nulls: Column) -> Column:
    """Type a text column would load as, from the kinds of its values."""
    integer, decimal, boolean = KIND_BITS["integer"], KIND_BITS["decimal"], KIND_BITS["boolean"]
    numbers = kinds.bitwiseOR(F.lit(integer | decimal)) == integer | decimal
    return (
        F.when((kinds == integer) & (nulls == 0), F.lit("int64"))
        .when(numbers, F.lit("float64"))
        .when((kinds == boolean) & (nulls == 0), F.lit("bool"))
        .otherwise(F.lit("object"))
    )


def schema_profile(df: DataFrame, by: list[str] | None = None, infer_text: bool = False) -> DataFrame:
    """Type, nulls, numeric range and longest text of every column.

    One aggregation for all columns (per group of ``by``), then one row per
    column. With ``infer_text`` text columns get the type their values read as.
    """
    by = by or []
    fields = [f for f in df.schema.fields if f.name not in by and not is_metadata(f.name)]
    measures = [F.count(F.lit(1)).alias("_rows_total")]
    structs = []
    nothing = F.lit(None).cast("double")
    for i, f in enumerate(fields):
        column, text = F.col(f.name), isinstance(f.dataType, T.StringType)
        numeric = isinstance(f.dataType, T.NumericType)
        number = column.try_cast("double") if numeric or (text and infer_text) else None
        measures.append(F.count(column).alias(f"n{i}"))
        if number is not None:
            measures += [F.min(number).alias(f"low{i}"), F.max(number).alias(f"high{i}")]
        if text:
            measures.append(F.max(F.length(column)).alias(f"len{i}"))
        if text and infer_text:
            measures.append(kinds_found(column).alias(f"kinds{i}"))
        nulls = F.col("_rows_total") - F.col(f"n{i}")
        dtype: Column = F.lit(dtype_name(f.dataType))
        low = F.col(f"low{i}") if number is not None else nothing
        high = F.col(f"high{i}") if number is not None else nothing
        length = F.col(f"len{i}") if text else F.lit(None).cast("int")
        if text and infer_text:
            dtype = _inferred_dtype(F.col(f"kinds{i}"), nulls)
            is_number = dtype.isin("int64", "float64")
            low, high, length = F.when(is_number, low), F.when(is_number, high), F.when(dtype == "object", length)
        structs.append(F.struct(
            F.lit(f.name).alias("field"), dtype.alias("dtype"), (nulls > 0).alias("nullable"),
            low.alias("min_value"), high.alias("max_value"), length.alias("max_length"),
            F.col("_rows_total").alias("rows"), F.col(f"n{i}").alias("non_null"),
        ))
    return df.groupBy(*by).agg(*measures).select(*by, F.inline(F.array(*structs)))


def present_fields(profile: DataFrame) -> DataFrame:
    """Drop columns without any value, which a snapshot of that data would not have."""
    return profile.filter(F.col("non_null") > 0)


def latest_schemas(stored: DataFrame) -> DataFrame:
    """Field rows of the newest snapshot of every schema."""
    newest = stored.groupBy("schema_name").agg(F.max("snapshot").alias("snapshot"))
    return stored.join(newest, FIELD_KEYS, "left_semi")


def schema_diff(fields: DataFrame) -> DataFrame:
    """Changes of every schema between consecutive snapshots.

    Rows of (schema_name, snapshot, field, change, old_value, new_value), where
    change is added, removed, type_changed, nullable_changed or
    constraint_changed and snapshot is the newer one.
    """
    snapshots = fields.select(*FIELD_KEYS).distinct()
    order = Window.partitionBy("schema_name").orderBy("snapshot")
    steps = snapshots.withColumn("previous", F.lag("snapshot").over(order)).filter(F.col("previous").isNotNull())
    facts = ["dtype", "nullable", "min_value", "max_value", "max_length"]
    new = fields.join(steps.select(*FIELD_KEYS), FIELD_KEYS, "left_semi").select(
        *FIELD_KEYS, "field", *[F.col(c).alias(f"new_{c}") for c in facts], F.lit(True).alias("in_new")
    )
    old = (
        fields.withColumnRenamed("snapshot", "previous")
        .join(steps, ["schema_name", "previous"])
        .select(*FIELD_KEYS, "field", *[F.col(c).alias(f"old_{c}") for c in facts], F.lit(True).alias("in_old"))
    )
    pairs = new.join(old, [*FIELD_KEYS, "field"], "full_outer")
    both = F.col("in_new").isNotNull() & F.col("in_old").isNotNull()

    def differs(name: str) -> Column:
        return ~F.col(f"new_{name}").eqNullSafe(F.col(f"old_{name}"))

    def change(when: Column, kind: str, before: Column, after: Column) -> Column:
        return F.when(when, F.struct(
            F.lit(kind).alias("change"), before.cast("string").alias("old_value"), after.cast("string").alias("new_value")
        ))

    none = F.lit(None).cast("string")
    limits = differs("min_value") | differs("max_value") | differs("max_length")
    changes = F.array_compact(F.array(
        change(F.col("in_old").isNull(), "added", none, F.col("new_dtype")),
        change(F.col("in_new").isNull(), "removed", F.col("old_dtype"), none),
        change(both & differs("dtype"), "type_changed", F.col("old_dtype"), F.col("new_dtype")),
        change(both & differs("nullable"), "nullable_changed", F.col("old_nullable"), F.col("new_nullable")),
        change(both & limits & ~differs("dtype"), "constraint_changed", none, none),
    ))
    return pairs.select(*FIELD_KEYS, "field", F.inline(changes))


def schema_evolution_report(fields: DataFrame) -> DataFrame:
    """Change counts and version of every snapshot of every schema.

    A removed field or changed type raises the major number, an added field the
    minor one, any other change the patch. The first snapshot is 1.0.0.
    """
    kinds = ("added", "removed", "type_changed", "nullable_changed", "constraint_changed")
    counts = schema_diff(fields).groupBy(*FIELD_KEYS).agg(
        *[F.count_if(F.col("change") == kind).alias(kind) for kind in kinds]
    )
    report = fields.groupBy(*FIELD_KEYS).agg(F.count(F.lit(1)).alias("field_count")).join(counts, FIELD_KEYS, "left")
    report = report.fillna(0, subset=list(kinds))
    breaking = F.col("removed") + F.col("type_changed") > 0
    growing = ~breaking & (F.col("added") > 0)
    touched = ~breaking & ~growing & (F.col("nullable_changed") + F.col("constraint_changed") > 0)

    def running(flag: Column, *within: str) -> Column:
        order = Window.partitionBy("schema_name", *within).orderBy("snapshot")
        return F.sum(flag.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))

    numbered = (
        report.withColumn("_major", running(breaking) + 1)
        .withColumn("_minor", running(growing, "_major"))
        .withColumn("_patch", running(touched, "_major", "_minor"))
    )
    version = F.concat_ws(".", *[F.col(c).cast("string") for c in ("_major", "_minor", "_patch")])
    return numbered.select(*FIELD_KEYS, "field_count", *kinds, version.alias("version"))


def schema_compile(fields: list[Any]) -> list[Rule]:
    """Row rules of a schema given as field rows (one per column)."""
    rules = []
    for f in fields:
        name = f["field"]
        if not f["nullable"]:
            rules.append(Rule(f"{name}:not_null", name, "not_null"))
        if f["min_value"] is not None:
            rules.append(Rule(f"{name}:min_value", name, "at_least", {"value": f["min_value"]}, nullable=True))
        if f["max_value"] is not None:
            rules.append(Rule(f"{name}:max_value", name, "at_most", {"value": f["max_value"]}, nullable=True))
        text = f["dtype"] == "object" or f["dtype"].startswith("string")
        if text and f["max_length"] is not None:
            rules.append(Rule(f"{name}:max_length", name, "max_length", {"value": f["max_length"]}, nullable=True))
    return rules


def dtype_matches(expected: str, dtype: T.DataType) -> bool:
    """Whether a column type meets a schema's type name; unknown names mean text."""
    for prefix in ("int", "float", "datetime", "bool"):
        if expected.startswith(prefix):
            return dtype_name(dtype).startswith(prefix)
    return dtype_name(dtype) == "object"


def structural_failures(df: DataFrame, fields: list[Any]) -> dict[str, str]:
    """Fields whose column is missing or of another type, with the failing check."""
    types = {f.name: f.dataType for f in df.schema.fields}
    found = {}
    for f in fields:
        if f["field"] not in types:
            found[f["field"]] = "missing_column"
        elif not dtype_matches(f["dtype"], types[f["field"]]):
            found[f["field"]] = "dtype"
    return found


def validate_schema(df: DataFrame, fields: list[Any] | None) -> DataFrame:
    """Failures per field and check; a missing schema fails as ``schema:missing``.

    A missing column or a wrong type counts once for every row.
    """
    total = F.count(F.lit(1))
    if not fields:
        row = df.agg(total.alias("failures"))
        return row.select(F.lit("schema").alias("field"), F.lit("missing").alias("check"), "failures")
    structural = structural_failures(df, fields)
    found = [(field, check, total) for field, check in structural.items()]
    for rule in schema_compile([f for f in fields if f["field"] not in structural]):
        found.append((rule.column, rule.name.split(":")[1], F.count_if(~predicate(rule, df.schema))))
    if not found:
        return df.agg(total.alias("failures")).select(
            F.lit("schema").alias("field"), F.lit("none").alias("check"), "failures").filter("false")
    wide = df.agg(*[failures.alias(f"m{i}") for i, (_, _, failures) in enumerate(found)])
    structs = [
        F.struct(F.lit(field).alias("field"), F.lit(check).alias("check"), F.col(f"m{i}").alias("failures"))
        for i, (field, check, _) in enumerate(found)
    ]
    return wide.select(F.inline(F.array(*structs))).filter(F.col("failures") > 0)


def failed_rows(df: DataFrame, fields: list[Any] | None) -> Column:
    """Aggregate counting rows that do not meet a schema; all of them without one."""
    total = F.count(F.lit(1))
    if not fields or structural_failures(df, fields):
        return total
    rules = schema_compile(fields)
    return F.count_if(reduce(Column.__or__, [~predicate(rule, df.schema) for rule in rules], F.lit(False)))


def schema_errors(df: DataFrame, fields: list[Any]) -> DataFrame:
    """Rows with ``_errors``; a missing column or wrong type is an error of every row."""
    structural = structural_failures(df, fields)
    codes = F.array(*[F.lit(f"{field}:{check}") for field, check in structural.items()]).cast("array<string>")
    rules = schema_compile([f for f in fields if f["field"] not in structural])
    return df.withColumn(ERRORS, F.concat(codes, errors(df.schema, rules)))
