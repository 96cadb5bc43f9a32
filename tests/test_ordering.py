"""Quantiles, ranks, carry-forward and hot-key joins against brute force."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from silverlane.functions import ordering
from silverlane.functions.ordering import bucket_of, carry_forward, exact_quantiles, ranked_values, value_ranks
from silverlane.functions.skew import attach_by_key
from silverlane.operators.enrichment import amount_percentile
from silverlane.operators.validation import flag_duplicate_keys


def _values(kind: str, n: int = 4000) -> list:
    rng = random.Random(7)
    if kind == "smooth":
        return [rng.uniform(-500, 2000) for _ in range(n)]
    if kind == "hot":
        return [100.0 if i % 3 == 0 else round(rng.uniform(0, 200), 2) for i in range(n)]
    if kind == "tail":
        return [rng.lognormvariate(0, 6) for _ in range(n)]
    if kind == "constant":
        return [5.0] * n
    if kind == "gaps":
        return [None if i % 4 == 0 else float(rng.randint(0, 50)) for i in range(n)]
    if kind == "outlier":
        return [float(i) for i in range(n - 1)] + [1e12]
    return [None] * 20


KINDS = ["smooth", "hot", "tail", "constant", "gaps", "outlier", "empty"]


def _frame(spark, values):
    rows = list(enumerate(values))
    return spark.createDataFrame(rows, "_row_seq bigint, amount double").repartition(7)


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("fraction", [0.0, 0.5, 0.95, 1.0])
@pytest.mark.parametrize("max_rows", [50, 1_000_000])
def test_exact_quantile(spark, kind, fraction, max_rows):
    values = _values(kind)
    expected = pd.Series(values, dtype="float64").quantile(fraction)
    found = exact_quantiles(_frame(spark, values), {"amount": fraction}, max_rows)["amount"]
    assert found.nulls == sum(v is None for v in values)
    if pd.isna(expected):
        assert found.value is None
    else:
        assert found.value == pytest.approx(expected, rel=1e-12)


@pytest.mark.parametrize("kind", KINDS)
def test_percentile_matches_average_rank(spark, kind):
    values = _values(kind)
    expected = pd.Series(values, dtype="float64").rank(pct=True)
    found = {r["_row_seq"]: r["amount_percentile"] for r in amount_percentile(_frame(spark, values), buckets=40).collect()}
    assert len(found) == len(values)
    for i, want in enumerate(expected):
        if pd.isna(want):
            assert found[i] is None
        else:
            assert found[i] == pytest.approx(want, rel=1e-12)


def test_value_ranks_are_whole(spark):
    values = _values("hot")
    rows = value_ranks(_frame(spark, values), "amount", buckets=64).collect()
    assert sum(r["n"] for r in rows) == len(values)
    assert max(r["upto"] for r in rows) == len(values)
    for r in rows[:50]:
        assert r["upto"] == sum(v <= r["value"] for v in values)


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("fraction", [0.0, 0.5, 0.95, 1.0])
def test_quantile_from_ranks(spark, kind, fraction):
    expected = pd.Series(_values(kind), dtype="float64").quantile(fraction)
    found = ranked_values(_frame(spark, _values(kind)), "amount", buckets=40).quantile(fraction)
    assert found is None if pd.isna(expected) else found == pytest.approx(expected, rel=1e-12)


def test_outliers_do_not_fill_one_bucket(spark, monkeypatch):
    """Even values and one far away, or a dense clump between far values: no part above three times the mean."""
    placed = {}
    resplit = ordering._resplit
    monkeypatch.setattr(ordering, "_resplit", lambda *args: placed.setdefault("rows", resplit(*args)))
    far = spark.range(1_000_000).selectExpr("CAST(id AS DOUBLE) AS amount").union(
        spark.range(1).selectExpr("1e12D AS amount"))
    clump = spark.range(300_000).selectExpr(
        "CASE WHEN id % 100 = 0 THEN id * 1e9D WHEN id % 3 = 0 THEN 7D ELSE 1 + id / 1e9D END AS amount")
    for df in (far, clump):
        placed.clear()
        ranked = ranked_values(df, "amount", buckets=200)
        parts = [row["count"] for row in placed["rows"].groupBy("bucket", "part").count().collect()]
        assert max(parts) < 3 * sum(parts) / 200 and len(parts) < 4 * 200 + 32
        want = pd.Series([row["amount"] for row in df.collect()]).rank(method="max")
        top = ranked.table.agg(F.max("upto"), F.sum("n"), F.count("value")).first()
        assert top[0] == top[1] == len(want) == ranked.rows and top[2] == want.nunique()
        assert ranked.table.agg(F.sum("upto")).first()[0] == want.drop_duplicates().sum()


@pytest.mark.parametrize("buckets", [1, 5, 64])
def test_carry_forward(spark, buckets):
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        # a long gap in the middle must be filled from far away, leading nulls must stay
        missing = i < 5 or 1000 < i < 2200 or rng.random() < 0.2
        rows.append((i * 1000 if i < 1500 else i * 10_000_000, None if missing else f"d{i}", None if i % 2 else i))
    frame = spark.createDataFrame(rows, "_row_seq bigint, a_date string, b_date bigint").repartition(6)
    expected = pd.DataFrame(rows, columns=["k", "a", "b"]).ffill()
    found = carry_forward(frame, ["a_date", "b_date"], buckets=buckets).orderBy("_row_seq").collect()
    assert [r["a_date"] for r in found] == [None if pd.isna(x) else x for x in expected["a"]]
    assert [r["b_date"] for r in found] == [None if pd.isna(x) else int(x) for x in expected["b"]]


def test_carry_forward_leaves_complete_columns_alone(spark):
    frame = spark.createDataFrame([(1, "x"), (2, "y")], "_row_seq bigint, a_date string")
    assert carry_forward(frame, ["a_date"]) is frame


def test_bucket_never_falls(spark):
    edges = [0.0, 1.0, 1.5, 100.0, 1e9]
    values = sorted(random.Random(1).lognormvariate(1, 5) for _ in range(2000)) + [1e9, 2e9]
    frame = spark.createDataFrame([(v,) for v in [-5.0, 0.0, *values]], "v double")
    buckets = [r[0] for r in frame.orderBy("v").select(bucket_of("v", edges, 50)).collect()]
    assert buckets == sorted(buckets)
    assert len(set(buckets)) >= 3


def test_hot_key_rows_all_arrive_and_spread(spark):
    rows = [(i, "hot" if i % 3 else f"k{i}") for i in range(9000)] + [(9000, None)]
    frame = spark.createDataFrame(rows, "id bigint, key string")
    facts = frame.filter("key is not null").groupBy("key").agg(F.count(F.lit(1)).alias("n")).withColumn("twice", F.col("n") * 2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = attach_by_key(frame, facts, "key", len(rows), ["twice"])
        found = {r["id"]: r["twice"] for r in joined.collect()}
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(found) == len(rows)
    assert found[9000] is None
    assert all(found[i] == (12000 if key == "hot" else 2) for i, key in rows[:-1])
    assert max(r["count"] for r in sizes) < 6000


def test_flag_duplicate_keys(spark):
    rows = [(i, "same" if i < 500 else f"k{i // 2}") for i in range(1001)]
    frame = spark.createDataFrame(rows, "id bigint, key string")
    counts = pd.Series([k for _, k in rows]).value_counts()
    found = {r["id"]: r["is_duplicate_key"] for r in flag_duplicate_keys(frame, "key").collect()}
    assert found == {i: bool(counts[k] > 1) for i, k in rows}
