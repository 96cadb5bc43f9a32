import random

import pytest

from silverlane.llm.components import components
from silverlane.llm.setjoin import first_of_groups, jaccard_groups
from tests.llm.helpers import Sets, documents, empty, mirror_words, odd_texts, prose, words


def shingles(text, n):
    w = words(text, lower=True)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def plain(texts, n, num, den):
    sets, union = [shingles(t, n) for t in texts], Sets()
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and den * both >= num * (len(a) + len(sets[j]) - both):
                union.link(i, j)
    return {i: (len(s), union.root(i)) for i, s in enumerate(sets)}


def near_copies(rng):
    """Groups around a text, with chains in which only neighbours are alike, and loose texts."""
    texts = odd_texts()
    for size in (1, 4, 9, 12, 30, 150):
        base = prose(rng, size, 5000).split()
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.randrange(0, 1 + size // 20)):
                copy[rng.randrange(size)] = f"new{rng.randrange(100)}"
            texts.append(" ".join(copy))
    chain = prose(rng, 200, 9000).split()
    for i in range(25):
        chain[(7 * i) % 200] = f"step{i}"
        texts.append(" ".join(chain))
    line = prose(rng, 30, 9000)
    texts += [line + " " + prose(rng, 40, 9000) for _ in range(30)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize(("n", "num", "den"), [(3, 90, 100), (5, 8, 10)])
def test_against_plain_version(spark, n, num, den):
    texts = near_copies(random.Random(n))
    rows = jaccard_groups(documents(spark, texts, partitions=5), "doc_id", "text", n, num, den).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == plain(texts, n, num, den)


def test_no_rows_no_keys_and_repeated_rows(spark):
    df = documents(spark, ["a b c d", "a b c d", "x"])
    assert jaccard_groups(empty(spark, df), "doc_id", "text", 3, 9, 10).collect() == []
    keyless = df.selectExpr("CAST(NULL AS BIGINT) AS doc_id", "text")
    rows = jaccard_groups(df.select("doc_id", "text").unionAll(keyless).unionAll(df.select("doc_id", "text")), "doc_id", "text", 3, 9, 10)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.component_id) for r in rows.collect() if r.doc_id is not None)
    assert got == [(0, 0), (0, 0), (1, 0), (1, 0), (2, 2), (2, 2)]
    assert {r.component_id for r in rows.collect() if r.doc_id is None} == {None}


def test_one_of_each_group_stays(spark):
    df = documents(spark, ["a b c d", "a b c d", "x", None, None])
    groups = jaccard_groups(df, "doc_id", "text", 3, 9, 10)
    assert sorted(r.doc_id for r in first_of_groups(df, groups, "doc_id").collect()) == [0, 2, 3, 4]


def test_components(spark):
    rng = random.Random(1)
    for links in ([(i, i + 1) for i in range(150)], [(rng.randrange(900), rng.randrange(900)) for _ in range(420)], [(4, 4)]):
        union = Sets()
        for a, b in links:
            if a != b:
                union.link(a, b)
        df = spark.createDataFrame(links + [(None, 3)], "x long, y long").repartition(5)
        assert {r.node: r.component for r in components(df, "x", "y").collect()} == {x: union.root(x) for x in list(union.up)}


def test_words_that_polynomials_confuse(spark):
    a, b = mirror_words(1024)
    texts = [f"{a} {a} {a} {a}", f"{b} {b} {b} {b}", f"{a} {a} {a} {a}"]
    got = {r.doc_id: r.component_id for r in jaccard_groups(documents(spark, texts), "doc_id", "text", 3, 9, 10).collect()}
    assert got == {0: 0, 1: 1, 2: 0}
