"""Mixing sources to target weights: capped water-filling and seeded repetitions.

A budget of words is shared over the sources by weight. A source whose share is above ``max_epochs`` times its size is
held there and the excess goes to the others by weight, until no share is above its limit. A source then repeats every
row whole as often as its share allows; the rest is taken in a seeded row order, the last row of it in part.

Only DataFrame functions run here. The driver sees two sums per round, never a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverlane.llm.common import WORD_PATTERN, others, seeded_order, stored

ORDER_BITS = 12
ADDED = ("size", "source_size", "target", "taken")
_HASH_BITS = 60


def _name(source: str) -> Column:
    return F.when(F.col(source).isNull(), F.lit("null")).otherwise(F.concat(F.lit("of "), F.col(source).cast("string")))


def cycled_weights(sources: DataFrame, cycle: tuple[float, ...]) -> Column:
    """Weights that repeat over the sources by code point, null last. One row per source reaches the window."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return F.element_at(F.array(*[F.lit(float(w)) for w in cycle]), (F.pmod(place, F.lit(len(cycle))) + 1).cast("int"))


def water_fill(sources: DataFrame, budget: float, max_epochs: float) -> DataFrame:
    """Add ``target`` to rows of (source_size, weight).

    With a weight of 0 or no size the target is 0. If the budget is more than all limits together, every source with a
    weight stands at its limit.
    """
    limit, level = F.col("source_size") * F.lit(float(max_epochs)), None
    while True:
        held = F.lit(False) if level is None else limit * F.lit(level[1]) < F.lit(level[0]) * F.col("weight")
        row = sources.agg(
            F.sum(F.when(held, limit)).alias("held"), F.sum(F.when(~held, F.col("weight"))).alias("weight")
        ).first()
        rest, weight = budget - (row["held"] or 0.0), row["weight"] or 0.0
        if weight == 0.0 or level == (rest, weight):
            break
        level = (rest, weight)
    if level is None:
        return sources.withColumn("target", F.lit(0.0))
    over = limit * F.lit(level[1]) < F.lit(level[0]) * F.col("weight")
    return sources.withColumn("target", F.when(over, limit).otherwise(F.lit(level[0]) * F.col("weight") / F.lit(level[1])))


def mix_sources(
    df: DataFrame, size: Column, source: str, key: str, share: float, max_epochs: float,
    cycle: tuple[float, ...] = (1.0,), seed: int = 0, weights: DataFrame | None = None,
) -> DataFrame:
    """Add ``size, source_size, target, taken`` to the rows of ``df``.

    ``weights`` (source, weight) sets weights by source, 0 for a source it does not name; without it they cycle over
    the sources. A null source is a source of its own; a row of size 0 takes nothing. Rows with equal ``key`` are
    ordered by size. An empty table gives an empty result. Columns of ``df`` of the added names are replaced; none may
    start with ``_mix_``.
    """
    sized = df.withColumns({"_mix_size": size, "_mix_source": _name(source), "_mix_hash": seeded_order(seed, key)})
    sized = sized.withColumn("_mix_bucket", F.shiftright("_mix_hash", _HASH_BITS - ORDER_BITS).cast("int"))
    words = stored(
        sized.groupBy("_mix_source", "_mix_bucket").agg(
            F.sum("_mix_size").alias("words"), F.first(F.col(source).cast("string")).alias("source")
        ), "mix-words",
    )
    totals = words.groupBy("_mix_source").agg(F.first("source").alias("source"), F.sum("words").alias("source_size"))
    if weights is None:
        totals = totals.withColumn("weight", cycled_weights(totals, cycle))
    else:
        given = weights.select(_name("source").alias("_mix_source"), F.col("weight").cast("double").alias("weight"))
        totals = totals.join(given, "_mix_source", "left").fillna(0.0, ["weight"])
    totals = stored(totals, "mix-sources")
    whole = totals.agg(F.sum("source_size")).first()[0] or 0
    targets = water_fill(totals, share * whole, max_epochs)

    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    before = Window.partitionBy("_mix_s").orderBy("_mix_b").rowsBetween(Window.unboundedPreceding, -1)
    plan = (
        words.select(F.col("_mix_source").alias("_mix_s"), F.col("_mix_bucket").alias("_mix_b"), "words")
        .join(targets.select("_mix_source", "source_size", "target"), F.col("_mix_s") == F.col("_mix_source"))
        .select(
            "_mix_s", "_mix_b", F.col("source_size").alias("_mix_total"), F.col("target").alias("_mix_target"),
            epochs.cast("long").alias("_mix_epochs"),
            F.coalesce(F.sum("words").over(before), F.lit(0)).alias("_mix_before"),
        )
        .withColumn("_mix_extra", F.floor(F.col("_mix_target") - F.col("_mix_epochs") * F.col("_mix_total")))
    )
    inside = (
        Window.partitionBy("_mix_source", "_mix_bucket").orderBy("_mix_hash", key, "_mix_size")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    reached = F.col("_mix_before") + F.sum("_mix_size").over(inside)
    joined = sized.join(
        plan, (F.col("_mix_source") == F.col("_mix_s")) & (F.col("_mix_bucket") == F.col("_mix_b"))
    ).withColumn("_mix_left", F.col("_mix_extra") - (reached - F.col("_mix_size")))
    part = F.greatest(F.lit(0), F.least(F.col("_mix_left"), F.col("_mix_size")))
    return joined.select(*others(df, ADDED), *[value.alias(name) for name, value in zip(ADDED, (
        F.col("_mix_size"), F.col("_mix_total"), F.col("_mix_target"),
        (F.col("_mix_epochs") * F.col("_mix_size") + part).cast("long"),
    ))])


def repeated(mixed: DataFrame, text: str, columns: list[str], n_chars: str | None = None) -> DataFrame:
    """The rows a mix takes: each whole repetition as a row, a last part cut after its words.

    A row of which nothing is taken goes. Rows without words have no size to repeat and stay as they are. ``n_chars``
    names a column that holds the length of the text and follows a cut.
    """
    copies = F.when(F.col("size") == 0, F.lit(1)).otherwise(F.ceil(F.col("taken") / F.greatest("size", F.lit(1))))
    numbered = mixed.filter(copies > 0).withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), copies.cast("int"))))
    rest = F.col("taken") - (F.col("_mix_copy") - 1) * F.col("size")
    words = F.regexp_extract_all(F.col(text), F.lit(f"({WORD_PATTERN})"), 1)
    whole = (F.col("size") == 0) | (rest >= F.col("size"))
    cut = F.array_join(F.slice(words, F.lit(1), F.greatest(rest, F.lit(0)).cast("int")), " ")
    changed = {text: cut} | ({n_chars: F.length(cut)} if n_chars else {})
    return numbered.select(*[
        F.when(whole, F.col(c)).otherwise(changed[c]).alias(c) if c in changed else F.col(c) for c in columns
    ])
