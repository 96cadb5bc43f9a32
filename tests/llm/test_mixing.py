import random

from pyspark.sql import functions as F

from silverlane.llm.common import word_count
from silverlane.llm.mixing import mix_sources, repeated, water_fill
from tests.llm.helpers import CLASHING, documents, empty, odd_texts, prose, words


def filled(sources, budget, epochs):
    """Plain water-filling: hold what is above its limit, share the rest again."""
    held = {}
    while True:
        rest = budget - sum(held.values())
        weight = sum(w for k, (_, w) in sources.items() if k not in held)
        target = {k: rest * w / weight for k, (_, w) in sources.items() if k not in held} if weight else {}
        over = {k: sources[k][0] * epochs for k, t in target.items() if t > sources[k][0] * epochs}
        if not over:
            return held | target
        held |= over


def test_water_filling(spark):
    rng = random.Random(3)
    for budget in (10.0, 900.0, 1500.0, 10_000.0):
        sources = {f"s{i}": (rng.randrange(1, 200), float(rng.choice((1, 2, 3, 40)))) for i in range(9)}
        df = spark.createDataFrame([(k, n, w) for k, (n, w) in sources.items()], "source string, source_size long, weight double")
        got = {r.source: r.target for r in water_fill(df, budget, 2.0).collect()}
        want = filled(sources, budget, 2.0)
        assert all(abs(got[k] - want[k]) < 1e-6 for k in sources)


def mixed(df, seed=0):
    return mix_sources(df, word_count(F.col("text")), "source", "doc_id", 1.5, 2.0, (3.0, 1.0, 2.0), seed)


def test_taken_meets_the_target(spark):
    rng = random.Random(4)
    df = documents(spark, [prose(rng, rng.randrange(1, 90)) for _ in range(300)], lambda i: "hot" if i % 3 else f"s{i % 7}")
    rows = mixed(df).collect()
    totals = {}
    for r in rows:
        assert r["size"] == len(words(r.text)) and 0 <= r.taken <= 2 * r["size"]
        totals.setdefault(r.source, [r.target, r.source_size, 0])[2] += r.taken
    assert all(abs(t - taken) < 1 and t <= 2 * n for t, n, taken in totals.values())
    assert abs(sum(t for t, _, _ in totals.values()) - 1.5 * sum(r["size"] for r in rows)) < 1e-6
    again = {(r.doc_id, r.taken) for r in mixed(df.repartition(7)).collect()}
    assert again == {(r.doc_id, r.taken) for r in rows}
    assert again != {(r.doc_id, r.taken) for r in mixed(df, seed=9).collect()}


def test_odd_rows(spark):
    df = documents(spark, odd_texts(), lambda i: None if i % 4 == 0 else "")
    rows = mixed(df).collect()
    assert len(rows) == len(odd_texts())
    assert all(r["size"] == len(words(r.text)) for r in rows) and all(r.taken == 0 for r in rows if r["size"] == 0)
    assert {c.lower() for c in CLASHING} <= {c.lower() for c in mixed(df).columns}
    assert mixed(empty(spark, df)).collect() == []
    assert mixed(df.unionAll(df)).count() == 2 * len(rows)


def test_named_weights(spark):
    df = documents(spark, ["a b c d"] * 6, lambda i: f"s{i % 3}")
    weights = spark.createDataFrame([("s0", 1.0), ("s1", 3.0)], "source string, weight double")
    got = mix_sources(df, word_count(F.col("text")), "source", "doc_id", 0.5, 2.0, weights=weights)
    assert {(r.source, r.target) for r in got.collect()} == {("s0", 3.0), ("s1", 9.0), ("s2", 0.0)}


def test_repetitions_hold_what_is_taken(spark):
    rng = random.Random(8)
    df = documents(spark, [prose(rng, rng.randrange(1, 40)) for _ in range(60)] + [None, ""])
    mix = mixed(df)
    rows = repeated(mix, "text", ["doc_id", "text", "n_chars"], "n_chars").collect()
    taken = {r.doc_id: r.taken for r in mix.collect()}
    got = {}
    for r in rows:
        got[r.doc_id] = got.get(r.doc_id, 0) + len(words(r.text))
        assert r.n_chars == len(r.text or "")
    assert all(got.get(d, 0) == n for d, n in taken.items())
    assert {60, 61} <= {r.doc_id for r in rows}
