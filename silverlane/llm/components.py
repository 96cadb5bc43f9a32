"""Connected components of a table of links, without gathering links anywhere.

Links are first thinned within their tasks (union-find over the links of a task), then large-star and small-star steps
alternate: every node sends its larger neighbours, then its smaller ones, to the least node it knows, until every node
hangs on the least node of its component. That is seen from one count over the links, so no round runs only to find that
it changes nothing. Each step is written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlane.llm.common import stored

_SCHEMA = "a bigint, b bigint"
_THIN_LINKS = 1 << 20


class Union:
    """Sets of numbers, each known by its least member."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        path = []
        while (y := self.up.setdefault(x, x)) != x:
            path.append(x)
            x = y
        for p in path:
            self.up[p] = x
        return x

    def link(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True

    def stars(self) -> tuple[np.ndarray, np.ndarray]:
        pairs = [(x, self.root(x)) for x in list(self.up)]
        out = np.array([p for p in pairs if p[0] != p[1]], dtype=np.int64).reshape(-1, 2)
        return out[:, 0], out[:, 1]


def thin(pairs: Iterable[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    union = Union()
    for x, y in pairs:
        union.link(x, y)
    return union.stars()


def _thin_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    union, seen = Union(), 0
    for batch in batches:
        for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            union.link(x, y)
        seen += batch.num_rows
        if seen >= _THIN_LINKS:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in union.stars()], names=["a", "b"])
            union, seen = Union(), 0
    yield pa.RecordBatch.from_arrays([pa.array(c) for c in union.stars()], names=["a", "b"])


def _are_stars(links: DataFrame) -> bool:
    """Whether every node with a smaller neighbour has only that one, and none is the smaller neighbour of another."""
    ends = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.lit(None).cast("long").alias("b")))
    nodes = ends.groupBy("a").agg(F.min("b").alias("least"), F.max("b").alias("most"), F.max(F.col("b").isNull()).alias("centre"))
    return nodes.filter((F.col("least") < F.col("most")) | (F.col("centre") & F.col("least").isNotNull())).agg(F.count("*")).first()[0] == 0


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every node with a link to another; component is the least node reachable.

    Links may repeat, go either way or join a node with itself; those with a null end are left out. Without links the
    result is empty.
    """
    pairs = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).filter("a <> b")
    current = stored(pairs.mapInArrow(_thin_rows, _SCHEMA), "links")  # a > b from here on
    while not _are_stars(current):
        current = stored(_small_star(_large_star(current)), "links")
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        current.select(F.col("b").alias("node"), F.col("b").alias("component"))
    ).distinct()


def _large_star(links: DataFrame) -> DataFrame:
    """Every node sends its larger neighbours to the least of its neighbours and itself."""
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
    # Only links from a node to a larger one are sent on, so the links as stored are enough here.
    return links.join(least, F.col("b") == F.col("n")).select("a", F.col("m").alias("b")).filter("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every node sends its smaller neighbours and itself to the least of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), "m")
    sent = links.join(least, F.col("a") == F.col("n")).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return sent.unionAll(least.select(F.col("n").alias("a"), F.col("m").alias("b"))).distinct()
