"""Small tables and plain versions of rules that several tests need."""

from __future__ import annotations

import random

from pyspark.sql import types as T

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
#: Names that operators use for what they add.
CLASHING = ("size", "Score", "shard", "taken", "key", "n", "token", "component_id", "_extra")


def words(text, lower=False) -> list[bytes]:
    data = (text or "").encode()
    return (data.translate(LOWER) if lower else data).split()


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def documents(spark, texts, source=lambda i: f"s{i % 3}", partitions=3):
    """Documents with the given texts, with extra columns under clashing names."""
    rows = [(i, t, "en", source(i), len(t) if t else 0) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS).repartition(partitions)
    for name in CLASHING:
        df = df.selectExpr("*", f"'x' AS {name}")
    return df


def odd_texts() -> list:
    """Nulls, empty and blank texts, ties, repeated and very long texts."""
    rng = random.Random(5)
    base = prose(rng, 120)
    return [
        None, "", " \t\n ", "one", "one", "One two", base, base, base.upper(), base + " tail", "é ñ 漢字 \x1c x y",
        prose(rng, 60_000, 50_000), "a a a a a a a a a a a a a a a a a a a a a a a a a a a a", base[: len(base) // 2],
        "x" * 100_000, "<|endoftext|> b", None,
    ]


def empty(spark, df):
    return spark.createDataFrame([], df.schema)


class Sets:
    """Plain union-find; the least member names a set."""

    def __init__(self):
        self.up = {}

    def root(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def link(self, x, y):
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)


def mirror_words(n: int) -> tuple[str, str]:
    """Two different words of n letters, a power of two, that every polynomial hash modulo a power of two confuses."""
    a, b = "a", "b"
    while len(a) < n:
        a, b = a + b, b + a
    return a, b
