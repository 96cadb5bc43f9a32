"""Global order without a global sort: quantiles, ranks and carry-forward.

A window without a partition would pull every row into one task. These helpers
cut the value range into buckets whose ids grow with the value, do the work per
bucket, and combine buckets through one small row each. Bucket edges are plain
numbers in the plan, so a retried task puts each row in the same bucket.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from silverlane.columns import ROW_SEQ
from silverlane.session import materialize

MIN_EDGES, MAX_EDGES = 16, 32
SKETCH_ACCURACY = 10_000
MAX_BRACKET_ROWS = 1_000_000
MAX_ROUNDS = 6
RESPLIT_FROM = 2
VALUES_PER_STEP = 16


def default_buckets(df: DataFrame) -> int:
    """Four buckets per shuffle partition, so uneven ones average out."""
    return 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _number(column: str) -> Column:
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def edge_measures(column: str, buckets: int) -> list[Column]:
    """Aggregates that ``edge_values`` turns into bucket edges."""
    edges = min(MAX_EDGES, max(MIN_EDGES, buckets // 8))
    steps = [i / edges for i in range(1, edges)]
    return [
        F.min(_number(column)).alias("low"),
        F.max(_number(column)).alias("high"),
        F.percentile_approx(_number(column), steps, SKETCH_ACCURACY).alias("mid"),
    ]


def edge_values(measured: Row) -> list[float]:
    """Distinct approximate quantiles of a column: at most MAX_EDGES + 1 numbers."""
    if measured["low"] is None:
        return []
    return sorted({measured["low"], measured["high"], *measured["mid"]})


def bucket_of(column: str, edges: list[float], buckets: int) -> Column:
    """Bucket id that never falls as the column grows.

    A decision tree finds the interval between two edges, which a linear step
    then divides, so the number of buckets is not limited by the tree.
    """
    if len(edges) < 2:
        return F.lit(0).cast("bigint")
    intervals = len(edges) - 1
    fine = max(1, math.ceil(buckets / intervals))
    value = f"CAST(`{column}` AS DOUBLE)"

    def tree(first: int, last: int) -> str:
        if last - first == 1:
            low, high = edges[first], edges[last]
            step = f"floor(({value} - {low!r}D) * {fine / (high - low)!r}D)"
            return f"{first * fine}L + greatest(0L, least({fine - 1}L, {step}))"
        middle = (first + last) // 2
        return f"CASE WHEN {value} < {edges[middle]!r}D THEN {tree(first, middle)} ELSE {tree(middle, last)} END"

    return F.expr(tree(0, intervals))


@dataclass
class Quantile:
    value: float | None
    rows: int
    nulls: int


@dataclass
class _Bracket:
    """Value range known to hold the wanted ranks, and the row count below it."""

    low: float
    high: float
    below: int
    inside: int
    ranks: tuple[int, int]
    share: float

    def holds(self, column: Column) -> Column:
        return column.between(F.lit(self.low), F.lit(self.high))


def exact_quantiles(
    df: DataFrame, fractions: dict[str, float], max_rows: int = MAX_BRACKET_ROWS, gaps_only: bool = False
) -> dict[str, Quantile]:
    """Exact quantiles with linear interpolation, for several columns at once.

    Sketches only narrow the range to look in; the counts that decide are exact.
    Rows are scanned a few times but only the values inside the narrowed range
    are shuffled, already counted per value. With ``gaps_only`` a column without
    nulls gets no value, which saves its scans.
    """
    if not fractions:
        return {}
    columns = list(fractions)
    measures = [F.count(F.lit(1)).alias("rows")]
    for i, name in enumerate(columns):
        value = _number(name)
        measures += [
            F.count(value).alias(f"n{i}"),
            F.min(value).alias(f"low{i}"),
            F.max(value).alias(f"high{i}"),
        ]
    first = df.agg(*measures).first()
    brackets: dict[str, _Bracket] = {}
    results: dict[str, Quantile] = {}
    for i, name in enumerate(columns):
        count = first[f"n{i}"]
        results[name] = Quantile(None, first["rows"], first["rows"] - count)
        if count and not (gaps_only and count == first["rows"]):
            position = (count - 1) * fractions[name]
            brackets[name] = _Bracket(
                first[f"low{i}"], first[f"high{i}"], 0, count,
                (math.floor(position), math.ceil(position)), position - math.floor(position),
            )
    wide = [name for name, b in brackets.items() if b.inside > max_rows]
    for _ in range(MAX_ROUNDS):
        if not wide:
            break
        wide = [name for name in _narrow(df, brackets, wide) if brackets[name].inside > max_rows]
    for name, low, high in _order_values(df, brackets):
        share = brackets[name].share
        results[name].value = low if share == 0 else low + (high - low) * share
    return results


def _narrow(df: DataFrame, brackets: dict[str, _Bracket], names: list[str]) -> list[str]:
    """One narrowing round; returns the columns whose range at least halved.

    A range that does not shrink holds few values many times over, and those
    collapse to one row each when they are counted.
    """
    slack = 5 / SKETCH_ACCURACY
    sketches = []
    for name in names:
        b = brackets[name]
        low = max(0.0, (b.ranks[0] - b.below) / b.inside - slack)
        high = min(1.0, (b.ranks[1] - b.below) / b.inside + slack)
        inside = F.when(b.holds(_number(name)), _number(name))
        sketches.append(F.percentile_approx(inside, [low, high], SKETCH_ACCURACY).alias(name))
    proposed = df.agg(*sketches).first()
    checks = []
    for i, name in enumerate(names):
        low, high = proposed[name]
        value = _number(name)
        checks += [
            F.count_if(value < F.lit(low)).alias(f"below{i}"),
            F.count_if(value.between(F.lit(low), F.lit(high))).alias(f"inside{i}"),
        ]
    counted = df.agg(*checks).first()
    halved = []
    for i, name in enumerate(names):
        b = brackets[name]
        below, inside = counted[f"below{i}"], counted[f"inside{i}"]
        if below <= b.ranks[0] and b.ranks[1] < below + inside and inside < b.inside:
            if inside * 2 <= b.inside:
                halved.append(name)
            b.low, b.high = proposed[name]
            b.below, b.inside = below, inside
    return halved


def _order_values(df: DataFrame, brackets: dict[str, _Bracket]) -> list[tuple[str, float, float]]:
    """The two order statistics each quantile lies between."""
    if not brackets:
        return []
    names = list(brackets)
    entries = []
    offset = F.lit(0).cast("bigint")
    low_rank = high_rank = F.lit(0).cast("bigint")
    for i, name in enumerate(names):
        b = brackets[name]
        entries.append(F.when(b.holds(_number(name)), F.struct(F.lit(i).alias("slot"), _number(name).alias("value"))))
        here = F.col("slot") == i
        offset = F.when(here, F.lit(b.below)).otherwise(offset)
        low_rank = F.when(here, F.lit(b.ranks[0])).otherwise(low_rank)
        high_rank = F.when(here, F.lit(b.ranks[1])).otherwise(high_rank)
    counted = (
        df.select(F.inline(F.array_compact(F.array(*entries))))
        .groupBy("slot", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    order = Window.partitionBy("slot").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = counted.withColumn("upto", F.sum("n").over(order) + offset)

    def spans(rank: Column) -> Column:
        return (F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank)

    picked = (
        placed.filter(spans(low_rank) | spans(high_rank))
        .groupBy("slot")
        .agg(F.min("value").alias("low"), F.max("value").alias("high"))
        .collect()  # one row per column
    )
    return [(names[row["slot"]], row["low"], row["high"]) for row in picked]


@dataclass
class RankedValues:
    """Distinct values of a column with ``n`` rows holding each and ``upto`` rows at or below it."""

    table: DataFrame
    rows: int

    def quantile(self, fraction: float) -> float | None:
        """Exact quantile with linear interpolation, read from the ranks; None for no values."""
        if not self.rows:
            return None
        position = (self.rows - 1) * fraction
        low, high = math.floor(position), math.ceil(position)

        def spans(rank: int) -> Column:
            return (F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank)

        value = F.col("value").cast("double")
        found = self.table.filter(spans(low) | spans(high)).agg(F.min(value).alias("low"), F.max(value).alias("high")).first()
        share = position - low
        return found["low"] if share == 0 else found["low"] + (found["high"] - found["low"]) * share


def _resplit(counted: DataFrame, sizes: list[Row], buckets: int) -> DataFrame:
    """Cut buckets with over twice their share of the distinct values; ``part`` is the place inside a bucket.

    Outliers stretch an interval until nearly all its values share one linear step. Such a bucket is cut again at
    quantiles of its own distinct values. There are fewer cuts than twice the buckets, whatever the data.
    """
    share = max(1.0, sum(row["values"] for row in sizes) / buckets)
    # Numbers of parts are powers of two, so a few sketches serve all buckets.
    wanted = [
        (row["bucket"], 1 << math.ceil(math.log2(row["values"] / share)))
        for row in sizes if row["values"] > RESPLIT_FROM * share
    ]
    if not wanted:
        return counted.withColumn("part", F.lit(0))
    full = counted.sparkSession.createDataFrame(wanted, "bucket bigint, parts int")
    value = F.col("value").cast("double")
    cuts = []
    for parts in sorted({parts for _, parts in wanted}):
        steps = [i / parts for i in range(1, parts)]
        sketch = F.percentile_approx(
            F.when(F.col("parts") == parts, value), steps, max(SKETCH_ACCURACY, VALUES_PER_STEP * parts))
        cuts.append(sketch)
    edges = counted.join(F.broadcast(full), "bucket").groupBy("bucket").agg(F.coalesce(*cuts).alias("edges"))
    steps = [1 << i for i in reversed(range(max(parts for _, parts in wanted).bit_length()))]
    place = F.aggregate(
        F.array(*[F.lit(step) for step in steps]), F.lit(0),
        lambda at, step: F.when(
            (at + step <= F.size("edges")) & (F.try_element_at("edges", at + step) <= value), at + step).otherwise(at))
    return counted.join(F.broadcast(edges), "bucket", "left").select(
        "value", "n", "bucket", F.when(F.col("edges").isNull(), 0).otherwise(place).alias("part"))


def ranked_values(df: DataFrame, column: str, buckets: int | None = None) -> RankedValues:
    """Ranks of a column's distinct values, NaN and null left out.

    ``df`` is read twice: for bucket edges, and to count its values, which are stored. Ranks are stored too.
    """
    buckets = buckets or default_buckets(df)
    edges = edge_values(df.agg(*edge_measures(column, buckets)).first())
    counted = materialize(
        df.filter(_number(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bucket", bucket_of("value", edges, buckets)), "values")
    sizes = counted.groupBy("bucket").agg(  # at most buckets + MAX_EDGES rows
        F.count(F.lit(1)).alias("values"), F.sum("n").alias("rows")).collect()
    placed = _resplit(counted, sizes, buckets)
    in_order = Window.orderBy("bucket", "part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("bucket", "part")
        .agg(F.sum("n").alias("bucket_rows"))
        # one row per part, fewer than 4 x buckets + MAX_EDGES rows
        .select("bucket", "part", F.coalesce(F.sum("bucket_rows").over(in_order), F.lit(0)).alias("before"))
    )
    running = Window.partitionBy("bucket", "part").orderBy("value").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranks = (
        placed.withColumn("in_bucket", F.sum("n").over(running))
        .join(F.broadcast(offsets), ["bucket", "part"])
        .select("value", "n", (F.col("before") + F.col("in_bucket")).alias("upto"))
    )
    return RankedValues(materialize(ranks, "ranks"), sum(row["rows"] for row in sizes))


def value_ranks(df: DataFrame, column: str, buckets: int | None = None) -> DataFrame:
    """Per distinct value: ``n`` rows holding it and ``upto`` rows at or below it."""
    return ranked_values(df, column, buckets).table


def carry_forward(df: DataFrame, columns: list[str], order: str = ROW_SEQ, buckets: int | None = None) -> DataFrame:
    """Replace nulls by the last value before them in row order; leading nulls stay.

    Rows are only shuffled when one of the columns has a null.
    """
    if not columns:
        return df
    buckets = buckets or default_buckets(df)
    missing = F.count_if(reduce(Column.__or__, [F.col(name).isNull() for name in columns])).alias("missing")
    measured = df.agg(missing, *edge_measures(order, buckets)).first()
    if measured["missing"] == 0:
        return df
    bucket = "_order_bucket"
    placed = df.withColumn(bucket, bucket_of(order, edge_values(measured), buckets))
    so_far = Window.partitionBy(bucket).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = placed.withColumns({name: F.last(name, ignorenulls=True).over(so_far) for name in columns})

    last_rows = (
        placed.select(bucket, order, *columns)
        .groupBy(bucket)
        .agg(*[F.max_by(name, F.when(F.col(name).isNotNull(), F.col(order))).alias(name) for name in columns])
    )
    earlier = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    carried = last_rows.select(
        bucket,
        # one row per bucket, at most buckets + MAX_EDGES rows
        *[F.last(name, ignorenulls=True).over(earlier).alias(f"_carried_{name}") for name in columns],
    )
    filled = within.join(F.broadcast(carried), bucket, "left")
    return filled.select(
        *[
            F.coalesce(F.col(name), F.col(f"_carried_{name}")).alias(name) if name in columns else F.col(name)
            for name in df.columns
        ]
    )
