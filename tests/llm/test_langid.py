import random

from pyspark.sql import functions as F

from silverlane.llm import langid
from silverlane.llm.queries import QUERIES
from tests.llm.helpers import documents, empty, odd_texts


def test_held_out_accuracy(spark, sf_dir):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = [r for r in QUERIES["op9_language"](spark, sf_dir).collect()]
    assert len(rows) == len(truth) and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert held and sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)


def speech(rng, syllables, n):
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def labelled(spark, n=120):
    rng = random.Random(1)
    kinds = {"xx": ["ka", "to", "ri"], "yy": ["sch", "ung", "el"], "zz": ["çã", "ñu", "éa"]}
    texts = [speech(rng, list(kinds.values())[i % 3], rng.randrange(1, 30)) for i in range(n)]
    df = documents(spark, texts).withColumn("lang", F.element_at(F.array(*map(F.lit, kinds)), (F.col("doc_id") % 3 + 1).cast("int")))
    return df, kinds


def test_short_texts_and_unseen_words(spark):
    df, kinds = labelled(spark)
    model = langid.train(df, "text", "lang", "doc_id")
    rng = random.Random(9)
    names = [list(kinds)[i % 3] for i in range(60)]
    fresh = documents(spark, [speech(rng, kinds[n], 2) for n in names])
    got = {r.doc_id: r for r in langid.predict(fresh, model, "doc_id", "text").collect()}
    assert sum(got[i].lang_pred == n for i, n in enumerate(names)) >= 57
    assert all(got[i].accepted <= (got[i].score >= model.accept) for i in got)
    assert model.languages == sorted(kinds)


def test_odd_rows(spark):
    df, _ = labelled(spark)
    model = langid.train(df, "text", "lang", "doc_id")
    texts = odd_texts() + ["1234 !! 5", "漢字"]
    rows = {r.doc_id: r for r in langid.predict(documents(spark, texts), model, "doc_id", "text").collect()}
    none = {i for i, t in enumerate(texts) if not any(c.isalpha() for c in t or "")}
    assert {d for d, r in rows.items() if r.lang_pred == "und"} == none
    assert all(r.score == 0 and not r.accepted for d, r in rows.items() if d in none)
    assert langid.predict(empty(spark, df), model, "doc_id", "text").collect() == []


def test_without_labels(spark):
    df, _ = labelled(spark, 9)
    model = langid.train(df.withColumn("lang", F.lit(None).cast("string")), "text", "lang", "doc_id")
    assert {(r.lang_pred, r.score) for r in langid.predict(df, model, "doc_id", "text").collect()} == {("und", 0.0)}
