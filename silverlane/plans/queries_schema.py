"""Schema profile, difference and validation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from silverlane.functions.rules import errors
from silverlane.operators import schema
from silverlane.plans.registry import query
from silverlane.plans.views import view, with_views
from silverlane.session import work_path
from silverlane.sources.writers import write_log

_NUMBER, _TEXT, _TIME = "number", "text", "time"
_GAP_FIELDS = (
    ("account_id", _TEXT), ("transaction_id", _TEXT), ("transaction_date", _TIME), ("amount", _NUMBER),
    ("description", _TEXT), ("transaction_type", _TEXT),
)
_DTYPES = {_NUMBER: "float64", _TEXT: "object", _TIME: "datetime64[ns]"}


def _profile_sql(column: str, kind: str) -> str:
    low, high = (f"min({column})", f"max({column})") if kind == _NUMBER else ("NULL::DOUBLE", "NULL::DOUBLE")
    length = f"CAST(max(length({column})) AS INTEGER)" if kind == _TEXT else "NULL::INTEGER"
    return (
        f"SELECT '{column}' AS field, '{_DTYPES[kind]}' AS dtype, count({column}) < count(*) AS nullable, "
        f"{low} AS min_value, {high} AS max_value, {length} AS max_length, count(*) AS rows, "
        f"count({column}) AS non_null FROM txn_gaps"
    )


@query("schema_profile", with_views(["txn_gaps"], " UNION ALL ".join(_profile_sql(c, k) for c, k in _GAP_FIELDS)))
def schema_profile(spark, sf_dir):
    return schema.schema_profile(view(spark, sf_dir, "txn_gaps"))


_KEYS = ["schema_name", "snapshot"]


def _yearly_fields(spark, sf_dir):
    """Field rows of every source and year, as loading that year's data would find them."""
    return schema.present_fields(
        schema.schema_profile(view(spark, sf_dir, "txn_yearly"), by=_KEYS, infer_text=True))


def _schema_table(spark, sf_dir):
    """The schema table those field rows are stored in: comparing snapshots never scans data again."""
    path = f"{work_path(spark, 'schemas')}/schema_versions"
    write_log(_yearly_fields(spark, sf_dir), path, "run-1")
    return spark.read.parquet(path).drop("_run_id")


def _yearly_sql() -> str:
    """Field facts per source and year, type names included, in plain SQL."""
    def field(name: str, dtype: str, low: str, high: str, length: str, where: str = "") -> str:
        return (
            f"SELECT schema_name, snapshot, '{name}' AS field, {dtype} AS dtype, count({name}) < count(*) AS nullable, "
            f"{low} AS min_value, {high} AS max_value, {length} AS max_length, count(*) AS rows, "
            f"count({name}) AS non_null FROM txn_yearly GROUP BY 1, 2 HAVING count({name}) > 0"
        )

    none, chars = "NULL::DOUBLE", "CAST(max(length({0})) AS INTEGER)"
    number = "TRY_CAST({0} AS DOUBLE)"
    early = "any_value(snapshot) < 1998"
    ref_low, ref_high = f"min({number.format('reference')})", f"max({number.format('reference')})"
    ref_length = chars.format("reference")
    return " UNION ALL ".join([
        field("account_id", "'object'", none, none, chars.format("account_id")),
        field("reference", f"CASE WHEN {early} THEN 'int64' ELSE 'object' END",
              f"CASE WHEN {early} THEN {ref_low} END", f"CASE WHEN {early} THEN {ref_high} END",
              f"CASE WHEN {early} THEN NULL ELSE {ref_length} END"),
        field("amount", "'float64'", f"min({number.format('amount')})", f"max({number.format('amount')})",
              "NULL::INTEGER"),
        field("fee", "'float64'", "min(fee)", "max(fee)", "NULL::INTEGER"),
        field("risk_points", "'int64'", "CAST(min(risk_points) AS DOUBLE)", "CAST(max(risk_points) AS DOUBLE)",
              "NULL::INTEGER"),
        field("description", "'object'", none, none, chars.format("description")),
    ])


_FIELD_COLUMNS = "schema_name, snapshot, field, dtype, nullable, min_value, max_value, max_length, rows, non_null"


@query("schema_profile_by_source", with_views(
    ["txn_yearly"], f"SELECT {_FIELD_COLUMNS} FROM fields", fields=_yearly_sql()))
def schema_profile_by_source(spark, sf_dir):
    return _yearly_fields(spark, sf_dir)


@query("schema_store", with_views(
    ["txn_yearly"], f"SELECT {_FIELD_COLUMNS} FROM fields WHERE snapshot = "
    "(SELECT max(f.snapshot) FROM fields f WHERE f.schema_name = fields.schema_name)", fields=_yearly_sql()))
def schema_store(spark, sf_dir):
    """Every snapshot goes to the schema table; the newest of each schema is read back."""
    return schema.latest_schemas(_schema_table(spark, sf_dir))


_STEPS_SQL = """SELECT schema_name, snapshot, lag(snapshot) OVER (PARTITION BY schema_name ORDER BY snapshot) AS previous
    FROM (SELECT DISTINCT schema_name, snapshot FROM fields)"""
_PAIRS_SQL = """SELECT coalesce(n.schema_name, o.schema_name) AS schema_name, coalesce(n.snapshot, o.snapshot) AS snapshot,
        coalesce(n.field, o.field) AS field, n.field AS new_field, o.field AS old_field, n.dtype AS new_dtype,
        o.dtype AS old_dtype, n.nullable AS new_null, o.nullable AS old_null,
        (n.min_value, n.max_value, n.max_length) IS DISTINCT FROM (o.min_value, o.max_value, o.max_length) AS moved
    FROM (SELECT fields.* FROM fields JOIN steps USING (schema_name, snapshot) WHERE previous IS NOT NULL) n
    FULL JOIN (SELECT fields.* REPLACE (steps.snapshot AS snapshot) FROM fields JOIN steps
        ON fields.schema_name = steps.schema_name AND fields.snapshot = steps.previous) o
    ON n.schema_name = o.schema_name AND n.snapshot = o.snapshot AND n.field = o.field"""
_DIFF_SQL = """SELECT schema_name, snapshot, field, 'added' AS change, NULL AS old_value, new_dtype AS new_value
        FROM pairs WHERE old_field IS NULL
    UNION ALL SELECT schema_name, snapshot, field, 'removed', old_dtype, NULL FROM pairs WHERE new_field IS NULL
    UNION ALL SELECT schema_name, snapshot, field, 'type_changed', old_dtype, new_dtype FROM pairs
        WHERE old_dtype <> new_dtype
    UNION ALL SELECT schema_name, snapshot, field, 'nullable_changed', CAST(old_null AS VARCHAR),
        CAST(new_null AS VARCHAR) FROM pairs WHERE old_null <> new_null
    UNION ALL SELECT schema_name, snapshot, field, 'constraint_changed', NULL, NULL FROM pairs
        WHERE old_dtype = new_dtype AND moved"""
_DIFF_PARTS = {"fields": _yearly_sql(), "steps": _STEPS_SQL, "pairs": _PAIRS_SQL, "diff": _DIFF_SQL}


@query("schema_diff", with_views(["txn_yearly"], "SELECT * FROM diff", **_DIFF_PARTS))
def schema_diff(spark, sf_dir):
    return schema.schema_diff(_schema_table(spark, sf_dir))


_KINDS = ("added", "removed", "type_changed", "nullable_changed", "constraint_changed")
_REPORT_SQL = f"""SELECT f.schema_name, f.snapshot, any_value(f.field_count) AS field_count,
    {', '.join(f"count(*) FILTER (WHERE change = '{k}') AS {k}" for k in _KINDS)}
    FROM (SELECT schema_name, snapshot, count(*) AS field_count FROM fields GROUP BY 1, 2) f
    LEFT JOIN diff USING (schema_name, snapshot) GROUP BY 1, 2"""
_LEVEL_SQL = """SELECT *, CASE WHEN removed + type_changed > 0 THEN 3 WHEN added > 0 THEN 2
    WHEN nullable_changed + constraint_changed > 0 THEN 1 ELSE 0 END AS level FROM report"""
_MAJOR_SQL = """SELECT *, 1 + sum(CASE WHEN level = 3 THEN 1 ELSE 0 END)
    OVER (PARTITION BY schema_name ORDER BY snapshot) AS major FROM leveled"""
_MINOR_SQL = """SELECT *, sum(CASE WHEN level = 2 THEN 1 ELSE 0 END)
    OVER (PARTITION BY schema_name, major ORDER BY snapshot) AS minor FROM majors"""
_VERSION_SQL = f"""SELECT schema_name, snapshot, field_count, {', '.join(_KINDS)},
    CAST(major AS BIGINT)::VARCHAR || '.' || CAST(minor AS BIGINT)::VARCHAR || '.' ||
    CAST(sum(CASE WHEN level = 1 THEN 1 ELSE 0 END)
        OVER (PARTITION BY schema_name, major, minor ORDER BY snapshot) AS BIGINT)::VARCHAR AS version FROM minors"""


@query("schema_evolution_report", with_views(
    ["txn_yearly"], _VERSION_SQL, **_DIFF_PARTS, report=_REPORT_SQL, leveled=_LEVEL_SQL, majors=_MAJOR_SQL,
    minors=_MINOR_SQL))
def schema_evolution_report(spark, sf_dir):
    return schema.schema_evolution_report(_schema_table(spark, sf_dir))


# A snapshot as an earlier load would have stored it, for rows that drifted since.
FIELDS = [
    {"field": "account_id", "dtype": "object", "nullable": False, "min_value": None, "max_value": None, "max_length": 13},
    {"field": "amount", "dtype": "float64", "nullable": False, "min_value": 5000.0, "max_value": 400000.0,
     "max_length": None},
    {"field": "description", "dtype": "string", "nullable": True, "min_value": None, "max_value": None, "max_length": 17},
    {"field": "transaction_date", "dtype": "datetime64[ns]", "nullable": True, "min_value": None, "max_value": None,
     "max_length": None},
    {"field": "transaction_type", "dtype": "int64", "nullable": True, "min_value": None, "max_value": None,
     "max_length": None},
    {"field": "channel", "dtype": "object", "nullable": True, "min_value": None, "max_value": None, "max_length": None},
]
_BROKEN = (
    ("account_id:not_null", "account_id IS NULL"), ("account_id:max_length", "length(account_id) > 13"),
    ("amount:not_null", "amount IS NULL"), ("amount:min_value", "amount < 5000"),
    ("amount:max_value", "amount > 400000"), ("description:max_length", "length(description) > 17"),
)


@query("schema_compile", with_views(["txn_gaps"], "SELECT transaction_id, concat_ws('|', " + ", ".join(
    f"CASE WHEN {broken} THEN '{code}' END" for code, broken in _BROKEN) + ") AS errors FROM txn_gaps"))
def schema_compile(spark, sf_dir):
    df = view(spark, sf_dir, "txn_gaps")
    usable = [f for f in FIELDS if f["field"] in ("account_id", "amount", "description", "transaction_date")]
    found = errors(df.schema, schema.schema_compile(usable))
    return df.select("transaction_id", F.concat_ws("|", found).alias("errors"))


@query("schema_validate", with_views(["txn_gaps"], " UNION ALL ".join(
    f"SELECT '{code.split(':')[0]}' AS field, '{code.split(':')[1]}' AS \"check\", count(*) AS failures FROM txn_gaps "
    f"WHERE {broken} HAVING count(*) > 0" for code, broken in (
        *_BROKEN, ("transaction_type:dtype", "true"), ("channel:missing_column", "true")))))
def schema_validate(spark, sf_dir):
    return schema.validate_schema(view(spark, sf_dir, "txn_gaps"), FIELDS)
