"""What the driver is asked to do does not follow the number of partitions or the size of a vocabulary."""

import random
import time

import public_tokenizers
import tokenizers

from silverlane.llm import components as C
from silverlane.llm.setjoin import jaccard_groups
from silverlane.llm.tokenfiles import read_token_files, write_token_files
from tests.llm.helpers import documents, prose


def test_set_join_starts_as_many_jobs_on_more_partitions(spark):
    rng = random.Random(3)
    df = documents(spark, [prose(rng, 40, 9000) for _ in range(40)])
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before, jobs = {k: spark.conf.get(k) for k in keys}, []
    try:
        spark.conf.set(keys[1], "false")
        for n in (2, 48):
            spark.conf.set(keys[0], str(n))
            spark.sparkContext.setJobGroup(f"partitions-{n}", "")
            jaccard_groups(df, "doc_id", "text", 5, 8, 10).collect()
            time.sleep(2)  # until all jobs are listed
            jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"partitions-{n}")))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert 0 < jobs[1] < jobs[0] + 24


def test_joined_links_take_no_round(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(C, "stored", lambda df, label, put=C.stored: rounds.append(label) or put(df, label))
    stars = [(10 * c + i, 10 * c) for c in range(5) for i in range(1, 10)]
    df = spark.createDataFrame(stars * 2, "x long, y long").repartition(4)  # a link comes from several tasks
    found = [(r.node, r.component) for r in C.components(df, "x", "y").collect()]
    assert sorted(found) == sorted(stars + [(10 * c, 10 * c) for c in range(5)])
    assert len(rounds) == 1


def test_token_files_load_no_vocabulary_in_the_driver(spark, monkeypatch):
    class Refused:
        def __getattr__(self, name):
            raise AssertionError("the driver asked for the tokenizer")

    monkeypatch.setattr(tokenizers, "Tokenizer", Refused())
    files = write_token_files(documents(spark, ["a b", None]), "doc_id", "text", public_tokenizers.path("byte_bpe_50k.json"), 0)
    assert sorted((r.doc_id, r.n_tokens) for r in read_token_files(files, "doc_id").collect()) == [(0, 3), (1, 1)]
