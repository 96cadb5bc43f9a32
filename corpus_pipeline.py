"""A training corpus from the documents table: toxic texts and near copies go, test passages go, sources are mixed, and
what is left is written as token files.

Every stage takes (spark, docs, sf_dir) and returns the columns of documents, but for the last one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlane.llm import queries as Q
from silverlane.llm.common import read_table, stored, without_keys, word_count
from silverlane.llm.decontamination import contaminated
from silverlane.llm.mixing import mix_sources, repeated
from silverlane.llm.setjoin import first_of_groups, jaccard_groups
from silverlane.llm.tokenfiles import read_token_files, write_token_files
from silverlane.llm.toxicity import score_toxicity

NEAR_WORDS, NEAR_NUM, NEAR_DEN = 5, 8, 10


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier does not reject."""
    learn = F.coalesce(Q.fold("doc_id", 5) != 0, F.lit(False))
    scored = score_toxicity(docs, read_table(spark, sf_dir, "labels"), "doc_id", "text", "toxic", learn)
    return without_keys(docs, scored.filter(F.col("score") >= Q.TOXIC), "doc_id")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies."""
    groups = jaccard_groups(docs, "doc_id", "text", NEAR_WORDS, NEAR_NUM, NEAR_DEN)
    return first_of_groups(docs, groups, "doc_id")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not cover half of a test item."""
    found = contaminated(docs, read_table(spark, sf_dir, "benchmark"), "doc_id", "text", "item_id", "text")
    return without_keys(docs, found, "doc_id")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    mixed = mix_sources(docs, word_count(F.col("text")), "source", "doc_id", Q.MIX_SHARE, Q.MIX_EPOCHS, Q.MIX_CYCLE)
    return repeated(mixed, "text", docs.columns, "n_chars" if "n_chars" in docs.columns else None)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all rows, and per row where its ids are."""
    return read_token_files(write_token_files(docs, "doc_id", "text", Q.tokenizer_path(), Q.END_ID), "doc_id")


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("tokens", tokens),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
