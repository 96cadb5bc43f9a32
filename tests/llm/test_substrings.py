import random

import numpy as np

from silverlane.llm import substrings
from silverlane.llm.substrings import decode_gaps, encode_gaps, remove_repeats
from tests.llm.helpers import documents, empty, mirror_words, odd_texts, prose, words


def plain(texts, n=13):
    first, out = {}, {}
    lists = [words(t) for t in texts]
    for d, w in enumerate(lists):
        for i in range(len(w) - n + 1):
            first.setdefault(tuple(w[i : i + n]), d)
    for d, w in enumerate(lists):
        gone = set()
        for i in range(len(w) - n + 1):
            if first[tuple(w[i : i + n])] < d:
                gone.update(range(i, i + n))
        out[d] = (len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode())
    return out


def got(df):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in remove_repeats(df, "doc_id", "text").collect()}


def test_gaps():
    values = np.array([0, 0, 5, 259, 260, 70_000], dtype=np.uint32)
    assert decode_gaps(encode_gaps(values)).tolist() == values.tolist()


def test_against_plain_version(spark, monkeypatch):
    monkeypatch.setattr(substrings, "MIN_CELLS", 1 << 8)  # most cells are shared: the sketch may not lose a window
    rng = random.Random(2)
    passage = prose(rng, 60, 10_000)
    texts = []
    for i in range(120):
        text = prose(rng, rng.randrange(0, 60), 10_000)
        texts.append(text + " " + passage[rng.randrange(40) :] + " " + prose(rng, 9) if i % 2 else text)
    texts += odd_texts()
    df = documents(spark, texts, partitions=6)
    assert got(df) == plain(texts)


def test_no_rows_and_no_keys(spark):
    df = documents(spark, ["a " * 40])
    assert got(empty(spark, df)) == {}
    keyless = df.selectExpr("CAST(NULL AS BIGINT) AS doc_id", "text")
    rows = remove_repeats(keyless.unionAll(keyless).unionAll(df.select("doc_id", "text")), "doc_id", "text").collect()
    assert sorted((r.n_words, r.n_removed) for r in rows) == [(40, 0)] * 3


def test_rows_of_one_key_keep_their_words(spark):
    df = documents(spark, ["b " * 30])
    assert [r.n_removed for r in remove_repeats(df.unionAll(df), "doc_id", "text").collect()] == [0, 0]


def test_words_that_polynomials_confuse(spark):
    a, b = mirror_words(2048)
    rows = remove_repeats(documents(spark, [" ".join([a] * 13), " ".join([b] * 13), " ".join([a] * 13)]), "doc_id", "text").collect()
    assert {r.doc_id: r.n_removed for r in rows} == {0: 0, 1: 0, 2: 13}
