import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from silverlane.llm.toxicity import LabelModel, _copies_once, mine_words, score_toxicity
from tests.llm.helpers import documents, empty, odd_texts, prose


def scores(df, labels, learn="doc_id % 4 <> 0"):
    return {r.doc_id: r.score for r in score_toxicity(df, labels, "doc_id", "text", "toxic", F.expr(learn)).collect()}


def table(spark, n=400):
    """Texts of which those with a bad word, known or not, are toxic; words of each text are its own."""
    rng = random.Random(4)
    bad = ["idiot", "scum", "vermin", "rotter", "blighter"]
    texts, toxic = [], []
    for i in range(n):
        w = prose(rng, rng.randrange(5, 60), 3000).split()
        if i % 5 == 2:
            for _ in range(rng.randrange(1, 4)):
                w[rng.randrange(len(w))] = rng.choice(bad)
        toxic.append(int(bool(set(bad) & set(w))))
        texts.append(" ".join(w))
    labels = spark.createDataFrame([(i, t, "x") for i, t in enumerate(toxic) if i % 10 != 9], "doc_id long, toxic int, score string")
    return texts, toxic, labels


def test_held_out_accuracy(spark):
    texts, toxic, labels = table(spark)
    got = scores(documents(spark, texts), labels)
    right = [(got[i] >= 0.5) == bool(t) for i, t in enumerate(toxic) if i % 4 == 0]
    assert sum(right) >= 0.97 * len(right)
    assert all(got[i] < 0.5 for i, t in enumerate(toxic) if not t)


def test_labels_of_held_out_rows_change_nothing(spark):
    texts, _, labels = table(spark, 200)
    turned = labels.withColumn("toxic", F.when(F.col("doc_id") % 4 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    df = documents(spark, texts)
    a, b = scores(df, labels), scores(df, turned)
    assert a.keys() == b.keys() and max(abs(a[k] - b[k]) for k in a) < 1e-9


def test_mining_counts_near_copies_once(spark):
    rng = random.Random(2)
    copy = "blurb " + prose(rng, 40, 3000)
    rows = [(copy + f" e{i}", 1) for i in range(40)] + [(prose(rng, 30, 3000), 0) for _ in range(60)]
    rows += [("vermin " + prose(rng, 20, 3000), 1) for _ in range(12)]
    mined = {w for w, _ in mine_words(spark.createDataFrame(rows, "text string, toxic int"), "text", "toxic")}
    assert "vermin" in mined and "blurb" not in mined


def test_label_model_finds_the_good_voter():
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.2
    good = np.where(rng.random(4000) < 0.95, np.where(truth, 1, -1), 0)
    weak = np.where(rng.random(4000) < 0.6, np.where(truth, 1, -1), np.where(truth, -1, 1))
    votes = np.stack([good, weak, weak], axis=1)
    model = LabelModel(votes, np.stack([np.ones(4000), np.zeros(4000), np.zeros(4000)], axis=1), 0.2)
    assert ((model.posterior(votes) >= 0.5) == truth).mean() > 0.97
    assert model.weights[1] < model.weights[0] and model.weights[1] == model.weights[2]


def test_odd_rows(spark):
    df = documents(spark, odd_texts() + ["you IDIOT, scum"])
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    got = scores(df, labels)
    assert len(got) == len(odd_texts()) + 1 and all(0 <= s <= 1 for s in got.values())
    assert got[len(odd_texts())] >= 0.5 and all(got[i] < 0.5 for i in range(len(odd_texts())))
    odd = spark.createDataFrame([(None, 1), (3, None), (5, 0), (5, 1), (5, 1)], "doc_id long, toxic int")
    assert scores(df, odd).keys() == got.keys()
    assert scores(empty(spark, df), odd) == {}
    assert len(score_toxicity(df.unionAll(df), odd, "doc_id", "text", "toxic", F.lit(True)).collect()) == 2 * len(got)


def test_mining_counts_unrelated_texts_that_share_words(spark):
    rng = random.Random(7)
    letters = [a + b + c for a in "bcdf" for b in "aeiou" for c in "lmnprst"]
    # Every text has all of ten common words, so least hashes are often the same.
    common = letters[:10]
    rows = [(" ".join(common + rng.sample(letters[10:], 25)), 0) for _ in range(200)]
    rows += [(" ".join(["vermin"] + common + rng.sample(letters[10:], 25)), 1) for _ in range(30)]
    df = spark.createDataFrame(rows, "text string, toxic int").selectExpr("text", "split(text, ' ') AS words", "toxic = 1 AS toxic")
    assert _copies_once(df).groupBy("toxic").count().orderBy("toxic").collect() == [(False, 200), (True, 30)]
    copies = df.unionAll(df).unionAll(df.selectExpr("text || ' e7'", "words", "toxic"))
    assert _copies_once(copies).count() == 230


@pytest.mark.parametrize("seed", range(5))
def test_label_model_without_labels(seed):
    """Independent voters of unlike accuracy, some of them copied, and nothing known but the share of toxic rows."""
    rng = np.random.default_rng(seed)
    truth = rng.random(4000) < 0.2
    open_rows = np.stack([np.ones(4000), np.zeros(4000), np.zeros(4000)], axis=1)

    def voter(accuracy, coverage=1.0):
        vote = np.where(rng.random(4000) < accuracy, np.where(truth, 1, -1), np.where(truth, -1, 1))
        return np.where(rng.random(4000) < coverage, vote, 0)

    def right(votes):
        return ((LabelModel(votes, open_rows, 0.2).posterior(votes) >= 0.5) == truth).mean()

    weak = voter(0.62)
    nearly = np.where(rng.random(4000) < 0.02, -weak, weak)
    votes = np.stack([voter(0.9), voter(0.85, 0.8), voter(0.8), weak, weak, nearly, weak], axis=1)
    assert right(votes) > 0.93 and ((votes.sum(1) > 0) == truth).mean() < 0.7
    assert LabelModel(votes, open_rows, 0.2).weights[3:].max() < 0.3
    votes = np.stack([voter(a) for a in (0.7, 0.75, 0.7, 0.8, 0.65)], axis=1)
    assert right(votes) > ((votes.sum(1) > 0) == truth).mean() + 0.02


def test_labels_show_what_votes_do_not():
    """Labelled rows mend a model whose voters are mostly wrong."""
    rng = np.random.default_rng(3)
    truth = rng.random(3000) < 0.3
    votes = np.stack([np.where(rng.random(3000) < a, np.where(truth, 1, -1), np.where(truth, -1, 1)) for a in (0.1, 0.3, 0.85)], axis=1)
    known = rng.random(3000) < 0.1
    counts = np.stack([~known, known & ~truth, known & truth], axis=1).astype(float)
    assert ((LabelModel(votes, counts, 0.3).posterior(votes) >= 0.5) == truth).mean() > 0.9


def test_scores_without_labels_or_rows_to_learn_from(spark):
    rng = random.Random(1)
    texts = [prose(rng, 20, 3000) + (" moron" if i % 8 == 0 else "") for i in range(80)]
    df, labels = documents(spark, texts), spark.createDataFrame([(1, 1), (8, 0)], "doc_id long, toxic int")
    got = scores(df, labels, "false")
    assert all((got[i] >= 0.5) == (i % 8 == 0) for i in got)
    assert got == scores(df, labels.filter("false"), "false")


def test_many_rows_without_a_key(spark):
    rng = random.Random(2)
    df = spark.createDataFrame([(None, prose(rng, 30, 3000) + (" scum" if i % 9 == 0 else "")) for i in range(300)], "doc_id long, text string")
    rows = score_toxicity(df, spark.createDataFrame([], "doc_id long, toxic int"), "doc_id", "text", "toxic", F.lit(True)).collect()
    assert len(rows) == 300 and sum(r.score >= 0.5 for r in rows) == 34
