import random

import numpy as np

from silverlane.llm.decontamination import contaminated, tile
from tests.llm.helpers import documents, empty, odd_texts, prose, words


def plain_tile(item, text, least):
    """Greedy string tiling by trying every pair of places."""
    a, b, tiles = [True] * len(item), [True] * len(text), []
    while True:
        best = (0, 0, 0)
        for p in range(len(item)):
            for q in range(len(text)):
                n = 0
                while p + n < len(item) and q + n < len(text) and item[p + n] == text[q + n] and a[p + n] and b[q + n]:
                    n += 1
                if n > best[2]:
                    best = (p, q, n)
        if best[2] < least:
            return tiles
        p, q, n = best
        a[p : p + n], b[q : q + n] = [False] * n, [False] * n
        tiles.append(best)


def test_tiling_against_plain_version():
    rng = random.Random(6)
    for _ in range(60):
        item = [rng.randrange(4) for _ in range(rng.randrange(1, 25))]
        text = [rng.randrange(4) for _ in range(rng.randrange(1, 40))]
        least = rng.randrange(2, 5)
        got = tile(np.array(item, dtype=np.uint64), np.array(text, dtype=np.uint64), least)
        want = plain_tile(item, text, least)
        assert [t[2] for t in got][:1] == [t[2] for t in want][:1]
        assert all(item[p : p + n] == text[q : q + n] and n >= least for p, q, n in got)
        for k, size in ((0, len(item)), (1, len(text))):
            covered = [x for t in got for x in range(t[k], t[k] + t[2])]
            assert len(covered) == len(set(covered)) and all(x < size for x in covered)
        free = [i for i in range(len(item)) if not any(p <= i < p + n for p, _, n in got)]
        left = [q for q in range(len(text)) if not any(t <= q < t + n for _, t, n in got)]
        runs = {tuple(item[i : i + least]) for i in free if all(i + k in free for k in range(least))}
        assert not runs & {tuple(text[q : q + least]) for q in left if all(q + k in left for k in range(least))}


def test_reordered_passage_is_found_and_clean_text_left_alone(spark):
    rng = random.Random(7)
    items = [prose(rng, 40, 9000) for _ in range(5)] + ["short item", "", None]
    w = items[0].split()
    texts = [
        items[0].upper(), "x y " + " ".join(w[20:] + ["z"] + w[:20]) + " y", " ".join(w[:15]), prose(rng, 500, 9000),
        items[1] + "\n" + items[2], "a short item here", *odd_texts(),
    ]
    df = documents(spark, texts)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id int, text string").selectExpr("*", "1 AS coverage")
    rows = contaminated(df, bench, "doc_id", "text", "item_id", "text").collect()
    got = {(r.doc_id, r.item_id): (r.n_covered, r.n_tiles, r.first_word) for r in rows}
    assert got == {(0, 0): (40, 1, 0), (1, 0): (40, 2, 2), (4, 1): (40, 1, 0), (4, 2): (40, 1, 40), (5, 5): (2, 1, 1)}
    assert all(r.n_item_words == len(words(items[r.item_id])) for r in rows)


def test_empty_tables(spark):
    df = documents(spark, ["a b c d e f g h"])
    bench = spark.createDataFrame([(1, "a b c d e f g h")], "item_id long, text string")
    args = ("doc_id", "text", "item_id", "text")
    assert contaminated(empty(spark, df), bench, *args).collect() == []
    assert contaminated(df, empty(spark, bench), *args).collect() == []
    assert contaminated(df.unionAll(df), bench, *args).count() == 2
    nameless = bench.selectExpr("CAST(NULL AS BIGINT) AS item_id", "text")
    assert [r.item_id for r in contaminated(df, nameless, *args).collect()] == [None]
