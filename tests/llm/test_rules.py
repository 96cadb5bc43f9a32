import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from silverlane.llm import rules as R
from silverlane.llm import words as W
from silverlane.llm.queries import QUERIES
from tests.llm.helpers import documents, empty, odd_texts, prose, words


def plain_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words by the letter of their rules."""
    text = text or ""
    ws = words(text)
    lines = [line for line in text.split("\n") if words(line)]
    grams = Counter(tuple(ws[i : i + 8]) for i in range(len(ws) - 7))
    hit = {i + k for i in range(len(ws) - 7) if grams[tuple(ws[i : i + 8])] > 1 for k in range(8)}
    return (len(ws), sum(len(w.decode()) for w in ws), sum(c in "#*$%&|<>" for c in text),
            sum(line in lines[:i] for i, line in enumerate(lines)), len(hit))


def rule_texts():
    rng = random.Random(12)
    out = odd_texts()
    for i in range(60):
        lines = [prose(rng, rng.randrange(0, 12), 6) for _ in range(rng.randrange(0, 8))]
        lines += [rng.choice(lines or ["x"]) for _ in range(rng.randrange(0, 3))] + ["", " ", "\r", "é# ñ|"][: i % 5]
        out.append("\n".join(lines))
    return out + ["a b c d e f g h " * 3, "a b c d e f g h a b c d e f g h", "w " * 40, "漢 # 字\n漢 # 字\n 漢 # 字"]


def test_counts_match_plain_rules(spark):
    texts = rule_texts()
    rows = R.count_rules(documents(spark, texts), "doc_id", "text").collect()
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows}
    assert got == {i: plain_counts(t) for i, t in enumerate(texts)}


def test_windows_are_compared_by_words(monkeypatch):
    plain = W.sequence_hashes
    monkeypatch.setattr(W, "sequence_hashes", lambda hashes, n: plain(hashes, n) & np.uint64(3))
    texts = rule_texts()
    for part in W.slices(pa.array(texts), 400):
        got = R.statistics(part)
        for k, row in enumerate(got.tolist()):
            assert tuple(row[:5]) == plain_counts(texts[part.first + k])


def labelled(spark, n=900, seed=1):
    """Good prose and three kinds of bad texts, all past the base rules."""
    rng = random.Random(seed)
    texts, quality = [], []
    for i in range(n):
        ws = [w.capitalize() if k % 11 == 0 else w for k, w in enumerate(prose(rng, rng.randrange(40, 300), 5000).split())]
        kind = rng.randrange(3) if i % 7 == 0 else None
        if kind == 0:
            ws = [w + rng.choice(["###", "$$$", "%%%"]) for w in ws]
        elif kind == 1:
            ws = [x for w in ws for x in (w, "|")]
        elif kind == 2:
            ws = [str(rng.randrange(10**9)) for w in ws]
        texts.append(" ".join(ws) + ".")
        quality.append(int(kind is None))
    labels = spark.createDataFrame([(i, q, 0) for i, q in enumerate(quality) if i % 3], "doc_id long, quality int, anomaly int")
    return texts, quality, labels


def test_held_out_accuracy(spark):
    texts, quality, labels = labelled(spark)
    rows = R.judge(R.count_rules(documents(spark, texts), "doc_id", "text"), labels, "doc_id", "quality").collect()
    kept = {r.doc_id: r.kept for r in rows}
    held_out = [i for i in range(len(texts)) if i % 3 == 0]
    good = [kept[i] for i in held_out if quality[i]]
    bad = [kept[i] for i in held_out if not quality[i]]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.05 * len(bad)


@pytest.mark.parametrize("n", [1, 2, 3, 300])
def test_forest_sets_strange_rows_apart(n):
    rng = np.random.default_rng(n)
    usual = rng.normal(0, 1, (n, 3))
    strange = np.array([[9.0, 0, 0], [0, -9, 0], [5, 5, 5]])
    everything = np.vstack([usual, strange])
    forest = R.Forest.grow(usual, everything.min(0), everything.max(0))
    scores = forest.score(everything, block=2)
    assert ((0 < scores) & (scores <= 1)).all() and (forest.score(everything) == scores).all()
    if n > 100:
        assert scores[n:].min() > np.quantile(scores[:n], 0.99)


def test_paths_of_one_tree_follow_its_cuts():
    rows = np.random.default_rng(5).normal(0, 1, (64, 2))
    forest = R.Forest.grow(rows, rows.min(0), rows.max(0))
    for t in (0, 7):
        reached = Counter()
        for row in rows:
            node, depth = 0, 0
            while forest.feature[t, node] >= 0:
                node = forest.child[t, node] + (row[forest.feature[t, node]] >= forest.cut[t, node])
                depth += 1
            reached[int(node)] += 1
            assert depth <= forest.path[t, node] <= depth + 10
        assert sum(reached.values()) == 64  # each tree has seen all 64 rows
        for node, held in reached.items():
            assert held <= 1 or forest.path[t, node] >= 2


def test_limit_spares_good_rows():
    scores, good = np.concatenate([np.linspace(0.2, 0.5, 1000), [0.7] * 20]), np.arange(1020) < 1000
    limit = R._limit(scores, good)
    assert (scores[good] >= limit).mean() <= R.MAX_LOSS and (scores[~good] >= limit).all()
    assert R._limit(scores, np.ones(1020, dtype=bool)) > 1 and R._limit(scores, np.zeros(1020, dtype=bool)) > 1
    assert R._limit(np.concatenate([np.linspace(0.2, 0.5, 1000), [0.1] * 20]), good) > 1


def test_all_labelled_rows_weigh_trees_and_set_the_limit(spark):
    rng = np.random.default_rng(7)
    n = 30_000
    n_words, good = rng.integers(40, 400, n), np.arange(n) % 100 > 0
    chars = 5 * n_words + rng.integers(0, 40, n)
    symbols = np.where(good, rng.integers(0, 3, n), n_words * 3 // 2)
    few = [rng.integers(0, top, n) for top in (3, 20, 20, 20)]
    counts = np.column_stack([
        n_words, chars, symbols, few[0], 0 * few[0], 1 + n_words // 30, n_words * 4 // 5, chars - symbols - few[1], *few[1:]])
    table = pa.table({"doc_id": np.arange(n), **{c: counts[:, i] for i, c in enumerate(R.COUNTS)}, "quality": good.astype(int)})
    df = spark.createDataFrame(table).repartition(5)
    rows = sorted(R.judge(df.drop("quality"), df.select("doc_id", "quality"), "doc_id", "quality").collect())
    different = np.unique(counts, axis=0, return_index=True)[1]
    weighing = np.isin(np.arange(n), different)
    seen = R.ratios(counts)
    forest = R.Forest.grow(seen[good & weighing], seen.min(0), seen.max(0))
    scores = forest.score(seen)
    limit = R._limit(scores[weighing], good[weighing])
    assert np.allclose([r.anomaly for r in rows], scores, rtol=1e-12)
    assert 20_000 < weighing.sum() and 0 < limit < 1
    assert [r.kept for r in rows] == (scores < limit).tolist()


def test_odd_rows_and_labels(spark):
    texts = odd_texts()
    df = documents(spark, texts)
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = R.judge(R.count_rules(df, "doc_id", "text"), none, "doc_id", "quality").collect()
    assert len(rows) == len(texts) and all(r.kept == (not r.base_failed) and r.anomaly == 0 for r in rows)
    assert {r.doc_id for r in rows if r.base_failed} == {
        i for i, t in enumerate(texts) if (c := plain_counts(t))[0] < 20 or 100 * c[4] > 30 * c[0]}
    odd = spark.createDataFrame([(None, 1), (11, None), (6, 1), (6, 0), (7, 1), (99, 1)], "doc_id long, quality int")
    keyless = df.unionAll(df).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "text")
    for table, n in ((df.unionAll(df), 2 * len(texts)), (keyless, 2 * len(texts)), (empty(spark, df), 0)):
        assert len(R.judge(R.count_rules(table, "doc_id", "text"), odd, "doc_id", "quality").collect()) == n


def test_query(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op12_quality"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        counts = plain_counts(docs[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (counts[0] < 20 or 100 * counts[4] > 30 * counts[0]) and not (r.kept and r.base_failed)
