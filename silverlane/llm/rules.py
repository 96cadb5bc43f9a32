"""Quality rules: statistics of whole texts, and an isolation forest over them.

Each text is read once, in its task, for the counts that quality rules use. An isolation forest over ratios of those
counts says how unlike the texts known to be good a text is: trees cut the statistics at random places, and a text that
few cuts set apart has short paths. All labelled rows weigh the trees and set the score from which a text is rejected. The
driver gets ranges, one number per node and ranks, whose size does not depend on the rows; no text is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlane.llm import words as W
from silverlane.functions.ordering import ranked_values
from silverlane.llm.common import small_batches, stored

MIN_WORDS = 20
REPEAT_WINDOW, MAX_REPEAT_PERCENT = 8, 30
SYMBOLS = W._table(b"#*$%&|<>")
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_letters", "n_upper",
    "n_digits", "n_marks",
)

_NOT_BREAK = ~W._table(b"\n")
_UPPER, _DIGITS = W._table(range(0x41, 0x5B)), W._table(range(0x30, 0x3A))
_LETTERS = _UPPER | W._table([*range(0x61, 0x7B), *range(0xC0, 0x100)])
_MARKS = W._table(b".,;:!?'\"()-")


def _distinct(owner: np.ndarray, number: np.ndarray, rows: int) -> np.ndarray:
    """How many different numbers each text has."""
    both = np.unique(owner * (int(number.max(initial=0)) + 1) + number)
    return np.bincount(both // (int(number.max(initial=0)) + 1), minlength=rows)


def _repeated_words(texts: W.Texts, words: W.Words, n: int) -> np.ndarray:
    """Whether each word is in a window of n words that its text has twice or more."""
    out = np.zeros(len(words.starts), dtype=bool)
    hashes, at, owner = W.windows(words, n)
    own = W.mix(hashes ^ W.mix(owner.astype(np.uint64)))
    order = np.argsort(own)
    same = own[order[1:]] == own[order[:-1]]
    likely = np.sort(order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]) if len(order) else order
    if not len(likely):
        return out
    # Windows with equal hashes are compared word by word.
    places = at[likely][:, None] + np.arange(n)[None, :]
    used = np.unique(places)
    number = W.numbers(texts, words._replace(starts=words.starts[used], ends=words.ends[used], hashes=words.hashes[used]))
    table = np.column_stack([owner[likely], number[np.searchsorted(used, places)]])
    _, group, times = np.unique(table, axis=0, return_inverse=True, return_counts=True)
    repeats = at[likely][times[group.reshape(-1)] > 1]
    change = np.bincount(repeats, minlength=len(out) + 1) - np.bincount(repeats + n, minlength=len(out) + 1)[: len(out) + 1]
    return np.cumsum(change)[:-1] > 0


def statistics(texts: W.Texts) -> np.ndarray:
    """COUNTS of each text of a slice, a column each."""
    data, rows = texts.data, len(texts.begins) - 1
    words = W.split(texts, W.NOT_SPACE)
    owner = words.text_of()

    def per_text(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flags)])[texts.begins])

    starts_char = (data & 0xC0) != 0x80
    lines = W.split(texts, _NOT_BREAK)
    worded = np.concatenate([[0], np.cumsum(W.NOT_SPACE[data])])
    full = worded[lines.ends] > worded[lines.starts]
    line_owner = lines.text_of()[full]
    line_number = W.numbers(texts, lines)[full]
    n_lines = np.bincount(line_owner, minlength=rows)
    repeated = _repeated_words(texts, words, REPEAT_WINDOW)
    return np.column_stack([
        np.diff(words.begins), per_text(starts_char & W.NOT_SPACE[data]), per_text(SYMBOLS[data]),
        n_lines - _distinct(line_owner, line_number, rows), np.bincount(owner[repeated], minlength=rows), n_lines,
        _distinct(owner, np.unique(words.hashes, return_inverse=True)[1], rows),
        *(per_text(table[data]) for table in (_LETTERS, _UPPER, _DIGITS, _MARKS)),
    ]).astype(np.int64)


def count_rules(df: DataFrame, key: str, text: str, carry: dict[str, Column] | None = None) -> DataFrame:
    """(key, carry..., COUNTS...) of each row; a null text counts as empty, a null key is kept."""
    carry = carry or {}
    small_batches(df.sparkSession)
    kept = df.select(F.col(key), *[value.alias(name) for name, value in carry.items()], F.col(text))
    names = kept.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in W.slices(batch.column(batch.num_columns - 1)):
                counts = statistics(texts)
                rows = batch.slice(texts.first, len(counts))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns[:-1], *(pa.array(c) for c in counts.T)], names=[*names, *COUNTS]
                )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])
    return kept.mapInArrow(run, schema + "".join(f", {c} bigint" for c in COUNTS))


def base_failed() -> Column:
    """Too few words, or too many in windows that repeat."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def ratios(counts: np.ndarray) -> np.ndarray:
    """What the forest sees of a text, from its COUNTS: shares that are mostly 0 on a logarithmic scale."""
    c = {name: counts[:, i].astype(float) for i, name in enumerate(COUNTS)}
    words, chars, lines = (np.maximum(c[name], 1) for name in ("n_words", "word_chars", "n_lines"))
    rare = [c["n_symbols"] / words, c["n_dup_lines"] / lines, c["n_repeat_words"] / words, c["n_digits"] / chars, c["n_upper"] / chars]
    return np.column_stack([
        np.log1p(c["n_words"]), c["word_chars"] / words, *(np.log1p(100 * x) for x in rare), c["n_distinct"] / words,
        c["n_letters"] / chars, c["n_marks"] / chars, np.log(words / lines),
    ])


TREES, TREE_ROWS, DEPTH = 128, 256, 10
MAX_LOSS = 0.005
MIN_BAD, MIN_CAUGHT = 5, 0.1
NEVER = 2.0


def _usual_path(n: np.ndarray) -> np.ndarray:
    """Mean path of an unsuccessful search in a random tree of n values: what a leaf of n rows still hides."""
    n = np.asarray(n, dtype=float)
    many = np.maximum(n, 3)
    long = 2 * (np.log(many - 1) + 0.5772156649015329) - 2 * (many - 1) / many
    return np.where(n >= 3, long, np.interp(n, [1, 2, 3], [0, 1, 2 * (np.log(2) + 0.5772156649015329) - 4 / 3]))


@dataclass
class Forest:
    """Trees as arrays, one row each: feature (-1 at a leaf), cut, first child (the second follows), path at a leaf."""

    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    path: np.ndarray
    usual: float

    @classmethod
    def plant(cls, low: np.ndarray, high: np.ndarray, seed: int = 0) -> Forest:
        """Whole trees of DEPTH levels, cut at random places between ``low`` and ``high`` of a random column.

        The range is that of all texts, so that a value no good row has is cut off with nothing beside it. The cuts do not
        depend on rows: ``weigh`` makes leaves of nodes with few of them.
        """
        rng = np.random.default_rng(seed)
        size = 2 << DEPTH
        feature, cut = np.full((TREES, size), -1, dtype=np.int16), np.zeros((TREES, size))
        child = np.zeros((TREES, size), dtype=np.int32)
        below, above = (np.broadcast_to(x, (TREES, 1, len(x))) for x in (low, high))
        for depth in range(DEPTH):
            nodes = np.arange((1 << depth) - 1, (2 << depth) - 1)
            wide = above > below
            chosen = np.where(wide, rng.random(wide.shape), -1).argmax(2)
            a, b = (np.take_along_axis(x, chosen[..., None], 2)[..., 0] for x in (below, above))
            at = rng.uniform(a, b)
            feature[:, nodes] = np.where(wide.any(2), chosen, -1)
            cut[:, nodes], child[:, nodes] = at, 2 * nodes + 1
            # Each node's two children: up to the cut, and from the cut on.
            below, above = np.repeat(below, 2, axis=1), np.repeat(above, 2, axis=1)
            np.put_along_axis(above[:, 0::2], chosen[..., None], at[..., None], 2)
            np.put_along_axis(below[:, 1::2], chosen[..., None], at[..., None], 2)
        return cls(feature, cut, child, np.zeros((TREES, size)), 0.0)

    def held(self, rows: np.ndarray) -> np.ndarray:
        """How many rows end in each node, a row per tree."""
        out = np.zeros(self.feature.size, dtype=np.int64)
        for _, node in self._ends(rows):
            out += np.bincount((node + np.arange(TREES) * self.feature.shape[1]).reshape(-1), minlength=len(out))
        return out.reshape(self.feature.shape)

    def weigh(self, held: np.ndarray) -> Forest:
        """The trees with paths from the rows that end in their nodes.

        All rows count, as shares of TREE_ROWS: a node with no more than one share is a leaf, as it would be in the mean of
        trees over TREE_ROWS random rows each.
        """
        held = held.astype(float)
        total = int(held[0].sum())
        for depth in reversed(range(DEPTH)):
            nodes = np.arange((1 << depth) - 1, (2 << depth) - 1)
            held[:, nodes] += held[:, 2 * nodes + 1] + held[:, 2 * nodes + 2]
        share = held * (min(TREE_ROWS, total) / max(total, 1))
        depth = np.floor(np.log2(np.arange(held.shape[1]) + 1))
        leaf = (self.feature < 0) | (share <= 1)
        return Forest(
            np.where(leaf, -1, self.feature).astype(np.int16), self.cut, self.child,
            np.where(leaf, depth + _usual_path(share), 0.0), float(_usual_path(min(TREE_ROWS, total))))

    @classmethod
    def grow(cls, rows: np.ndarray, low: np.ndarray, high: np.ndarray, seed: int = 0) -> Forest:
        """Trees weighed by all ``rows``."""
        forest = cls.plant(low, high, seed)
        return forest.weigh(forest.held(rows))

    def _ends(self, rows: np.ndarray, block: int = 2048) -> Iterator[tuple[int, np.ndarray]]:
        """First row of each block and the nodes its rows end in, one per tree."""
        tree = np.arange(len(self.feature))[None, :]
        for low in range(0, len(rows), block):
            part = rows[low : low + block]
            node = np.zeros((len(part), len(self.feature)), dtype=np.int32)
            row = np.arange(len(part))[:, None]
            for _ in range(DEPTH):
                feature = self.feature[tree, node]
                further = feature >= 0
                if not further.any():
                    break
                beyond = part[row, np.maximum(feature, 0)] >= self.cut[tree, node]
                node = np.where(further, self.child[tree, node] + beyond, node)
            yield low, node

    def score(self, rows: np.ndarray, block: int = 2048) -> np.ndarray:
        """0 to 1 for each row: the higher, the shorter its paths."""
        out = np.zeros(len(rows))
        tree = np.arange(len(self.feature))[None, :]
        for low, node in self._ends(rows, block):
            out[low : low + block] = 2.0 ** (-self.path[tree, node].mean(1) / max(self.usual, 1e-9))
        return out


def _limit_rank(good: int) -> int:
    """Place from 1 of the good row with the highest score that stays."""
    return int(np.ceil((1 - MAX_LOSS) * good))


def _between(limit: float, others: int, caught: int, nearest: float | None) -> float:
    """Between the good rows that stay and the next bad one the middle leaves most room to either side; above all scores if
    there are too few bad rows or too few of them are caught."""
    if others < MIN_BAD or not caught or caught < MIN_CAUGHT * others:
        return NEVER
    return (limit + nearest) / 2


def _limit(scores: np.ndarray, good: np.ndarray) -> float:
    """The score from which texts are rejected: it costs at most MAX_LOSS of the good rows and catches the most of the
    others; above all scores if there are too few others or too few of them are caught."""
    if not good.any():
        return NEVER
    limit = float(np.nextafter(np.sort(scores[good])[_limit_rank(good.sum()) - 1], 1))
    above = scores[~good & (scores >= limit)]
    return _between(limit, int((~good).sum()), len(above), float(above.min()) if len(above) else None)


def _limit_of(scored: DataFrame, good: int) -> float:
    """``_limit`` of a table (score, good) with ``good`` good rows, at least one."""
    ranks = ranked_values(scored.filter("good"), "score").table
    limit = float(np.nextafter(ranks.filter(F.col("upto") >= _limit_rank(good)).agg(F.min("value")).first()[0], 1))
    bad, above = ~F.col("good"), ~F.col("good") & (F.col("score") >= limit)
    return _between(limit, *scored.agg(F.count_if(bad), F.count_if(above), F.min(F.when(above, F.col("score")))).first())


def _count_array(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in COUNTS])


def _ranges(known: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest value of each ratio over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                rows = ratios(_count_array(batch))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(rows.shape[1])), pa.array(rows.min(0)), pa.array(rows.max(0))], names=["at", "low", "high"])

    found = known.mapInArrow(run, "at bigint, low double, high double").groupBy("at").agg(F.min("low"), F.max("high"))
    low, high = zip(*[row[1:] for row in sorted(found.collect())])  # one row per ratio
    return np.array(low), np.array(high)


def _held(good: DataFrame, forest: Forest) -> np.ndarray:
    """How many rows end in each node: each task sends one number per node that it reaches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(forest.feature.size, dtype=np.int64)
        for batch in batches:
            held += forest.held(ratios(_count_array(batch))).reshape(-1)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], names=["at", "n"])

    found = good.mapInArrow(run, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(forest.feature.size, dtype=np.int64)
    out[found.column("at").to_numpy()] = found.column("n").to_numpy()
    return out.reshape(forest.feature.shape)


def _scored(counted: DataFrame, forest: Forest | None, name: str) -> DataFrame:
    """The rows of a table of counts with their score; 0 without a forest."""
    names = counted.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = np.zeros(len(batch)) if forest is None else forest.score(ratios(_count_array(batch)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[*names, name])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in counted.schema.fields)
    return counted.mapInArrow(run, f"{schema}, {name} double")


def judge(counted: DataFrame, labels: DataFrame, key: str, label: str, seed: int = 0) -> DataFrame:
    """The columns of ``counted`` (of ``count_rules``) and base_failed, anomaly (0 to 1) and kept of each row.

    The forest is weighed by all texts labelled 1 and its limit set on all labelled ones, different rows of counts once
    each; texts the base rules reject are left out there. Several labels of a key count as the smallest; null keys and
    labels as none. Without labelled rows of both kinds only the base rules reject, and without any the anomaly is 0.
    Equal counts get equal verdicts; an empty table gives an empty result.
    """
    counted = stored(counted, "rule-counts")
    truth = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("_key")).agg(
        F.min(label).alias("_label"))
    known = counted.join(truth, F.col(key) == F.col("_key")).filter(~base_failed()).select(*COUNTS, "_label").distinct()
    known = stored(known.withColumn("good", F.col("_label") == 1), "rule-known")
    forest, limit = None, NEVER
    if good := known.filter("good").count():
        forest = Forest.plant(*_ranges(known), seed)
        forest = forest.weigh(_held(known.filter("good"), forest))
        limit = _limit_of(stored(_scored(known, forest, "score").select("score", "good"), "rule-scores"), good)
    failed = base_failed()
    return _scored(counted, forest, "anomaly").withColumns(
        {"base_failed": failed, "kept": ~failed & (F.col("anomaly") < limit)})
