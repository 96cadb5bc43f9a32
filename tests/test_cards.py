"""Scorecards of several sources: one action, and a source that breaks off does not stop the others."""

from pyspark.sql import functions as F

from silverlane.plans.pipeline import CARD_SCHEMA, _card_rows


def _card(spark, name, score="0.5D"):
    rows = spark.range(3).groupBy().agg(F.count(F.lit(1)).alias("n"))
    return rows.selectExpr(f"'{name}' AS source_name", "n AS total_rows", "'overall' AS `check`", f"{score} AS score",
                           "true AS passed")


def test_cards_of_all_sources_are_one_action(spark, monkeypatch):
    calls = []
    frame = type(_card(spark, "a"))
    collect = frame.collect
    monkeypatch.setattr(frame, "collect", lambda self: calls.append(1) or collect(self))
    found = _card_rows({name: _card(spark, name) for name in "abcd"})
    assert found == [(name, 3, "overall", 0.5, True) for name in "abcd"] and len(calls) == 1
    assert _card_rows({}) == [] and len(calls) == 1


def test_a_broken_source_does_not_stop_the_others(spark):
    cards = {"a": _card(spark, "a"), "b": _card(spark, "b", "CAST(raise_error('no') AS DOUBLE)"), "c": _card(spark, "c")}
    found = _card_rows(cards)
    assert found == [("a", 3, "overall", 0.5, True), ("b", None, "overall", 0.0, False), ("c", 3, "overall", 0.5, True)]
    assert spark.createDataFrame(found, CARD_SCHEMA).count() == 3
