"""Benchmark decontamination by greedy string tiling.

Documents and test items share seeds: runs of ``min_run`` equal words. For a document and an item with a shared seed,
the longest run of words that both have and that no earlier run covers is marked, again and again, until no run of
``min_run`` words is left. Runs are found by running hashes of the words (Karp-Rabin) and confirmed word by word. The
share of an item's words under runs is its coverage; order does not matter, so a reordered passage is found as well.

Items are a stated query set. Their seeds are broadcast in blocks of at most ``BLOCK_WORDS`` words, so the size of a
broadcast is bounded whatever the number of items; each block is one pass over the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from silverlane.llm import words as W
from silverlane.llm.common import small_batches, stored, word_count

MIN_RUN = 6
COVERAGE = 0.5
BLOCK_WORDS = 4_000_000
_BASE = 0x9E3779B97F4A7C15


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64. Runs with equal hashes are confirmed word by word."""
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            full = np.full(max(n, 1 << 14), np.uint64(base))
            full[0] = 1
            _POWERS[name] = np.multiply.accumulate(full)
    return _POWERS["up"], _POWERS["down"]


def _runs(hashes: np.ndarray, free: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places from which ``length`` words are free, and the running hash of those words."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    taken = np.concatenate([[0], np.cumsum(~free)])
    at = np.flatnonzero(taken[length:] == taken[:-length])
    up, down = _powers(len(hashes) + 1)
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(hashes * up[: len(hashes)], dtype=np.uint64)])
    return at, (sums[at + length] - sums[at]) * down[at]


def tile(item: np.ndarray, text: np.ndarray, min_run: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of word hashes: (place in item, place in text, length), longest first.

    Of runs of the same length the first free place of the item and then of the text is taken.
    """
    free_item, free_text = np.ones(len(item), dtype=bool), np.ones(len(text), dtype=bool)
    tiles, high = [], min(len(item), len(text))

    def common(length: int) -> bool:
        return bool(np.isin(_runs(item, free_item, length)[1], _runs(text, free_text, length)[1]).any())

    while high >= min_run and common(min_run):
        low = min_run
        while low < high:  # a common run of some length contains common runs of every smaller length
            middle = (low + high + 1) // 2
            low, high = (middle, high) if common(middle) else (low, middle - 1)
        length, before = low, len(tiles)
        (at_item, key_item), (at_text, key_text) = _runs(item, free_item, length), _runs(text, free_text, length)
        order = np.argsort(key_text, kind="stable")
        sorted_keys = key_text[order]
        left = np.searchsorted(sorted_keys, key_item, side="left")
        right = np.searchsorted(sorted_keys, key_item, side="right")
        next_of: dict[int, int] = {}
        for p, a, b, key in zip(at_item.tolist(), left.tolist(), right.tolist(), key_item.tolist()):
            if a == b or not free_item[p : p + length].all():
                continue
            k = next_of.get(key, a)
            while k < b:
                q = int(at_text[order[k]])
                if free_text[q : q + length].all() and (item[p : p + length] == text[q : q + length]).all():
                    free_item[p : p + length] = False
                    free_text[q : q + length] = False
                    tiles.append((p, q, length))
                    k += 1
                    break
                k += 1
            next_of[key] = k
        high = length if len(tiles) > before else length - 1
    return tiles


def contaminated(
    docs: DataFrame, items: DataFrame, key: str, text: str, item_key: str, item_text: str,
    min_run: int = MIN_RUN, coverage: float = COVERAGE,
) -> DataFrame:
    """(key, item_key, n_item_words, n_covered, coverage, n_tiles, first_word, tiles) of each document and item whose
    coverage is at least ``coverage``.

    Words are runs of bytes other than ASCII white space, A-Z lower-cased. Items shorter than ``min_run`` words are
    held as one run of their own length; empty and null items and texts match nothing. Repeated rows repeat their
    results. Other columns are ignored. ``tiles`` has item place, text place and length of each run.
    """
    spark = docs.sparkSession
    small_batches(spark)
    numbered = stored(items.select(F.col(item_key).alias("item"), F.col(item_text).alias("text")).withColumn(
        "n", word_count(F.col("text"))).filter(F.col("n") > 0), "items")
    blocks = stored(_blocks(numbered), "item-blocks")
    n_blocks = (blocks.agg(F.max("block")).first()[0] or 0) + 1
    key_type, item_type = docs.schema[key].dataType.simpleString(), items.schema[item_key].dataType.simpleString()
    item_arrow = to_arrow_type(items.schema[item_key].dataType)
    out = None
    for block in range(n_blocks):
        rows = [(row["item"], row["text"]) for row in blocks.filter(F.col("block") == block).collect()]
        shared = spark.sparkContext.broadcast(rows)
        found = docs.select(key, text).mapInArrow(
            _finder(shared, min_run, coverage, key, item_key, item_arrow),
            f"`{key}` {key_type}, `{item_key}` {item_type}, n_item_words bigint, n_covered bigint, coverage double, "
            "n_tiles bigint, first_word bigint, tiles array<struct<item:bigint, text:bigint, length:bigint>>",
        )
        out = found if out is None else out.unionByName(found)
    return out


def _blocks(items: DataFrame) -> DataFrame:
    """Deal items into blocks of about BLOCK_WORDS words by a hash; the item table alone decides their number."""
    total = items.agg(F.sum("n")).first()[0] or 0
    n = int(-(-total // BLOCK_WORDS)) or 1
    return items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(n)).cast("int"))


def _finder(shared, min_run: int, coverage: float, key: str, item_key: str, item_arrow: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = [text for _, text in shared.value]
        words = [W.split(t, W.NOT_SPACE, W.LOWER) for t in W.slices(pa.array(texts, type=pa.string()))]
        item_words = [h for w in words for h in np.split(w.hashes, w.begins[1:-1])]
        by_run: dict[int, list[int]] = {}
        for i, h in enumerate(item_words):
            by_run.setdefault(min(min_run, len(h)), []).append(i)
        seeds = []
        for n, members in by_run.items():
            keys = [W.sequence_hashes(item_words[i], n) for i in members]
            owner = np.repeat(np.array(members), [len(k) for k in keys])
            keys = np.concatenate(keys)
            order = np.argsort(keys, kind="stable")
            seeds.append((n, keys[order], owner[order]))
        filter_bits = np.zeros(1 << 20, dtype=bool)
        for _, keys, _ in seeds:
            filter_bits[(keys >> np.uint64(44)).astype(np.int64)] = True
        for batch in batches:
            results = []
            for slice_ in W.slices(batch.column(1)):
                found = W.split(slice_, W.NOT_SPACE, W.LOWER)
                pairs: set[tuple[int, int]] = set()
                for n, keys, owner in seeds:
                    hashes, _, text_of = W.windows(found, n)
                    likely = np.flatnonzero(filter_bits[(hashes >> np.uint64(44)).astype(np.int64)])
                    left = np.searchsorted(keys, hashes[likely], side="left")
                    right = np.searchsorted(keys, hashes[likely], side="right")
                    # Items by seed: the distinct seeds of a text, so that a repeated line counts once.
                    hit = left < right
                    unique = np.unique(np.stack([text_of[likely[hit]], left[hit], right[hit]]), axis=1)
                    for row, a, b in unique.T.tolist():
                        pairs.update((row, int(i)) for i in np.unique(owner[a:b]))
                for row, i in sorted(pairs):
                    item = item_words[i]
                    text = found.hashes[found.begins[row] : found.begins[row + 1]]
                    tiles = tile(item, text, min(min_run, len(item)))
                    covered = sum(t[2] for t in tiles)
                    if tiles and covered >= coverage * len(item):
                        results.append((slice_.first + row, i, len(item), covered, tiles))
            if results:
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array([r[0] for r in results])),
                    pa.array([shared.value[r[1]][0] for r in results], type=item_arrow),
                    pa.array([r[2] for r in results], type=pa.int64()),
                    pa.array([r[3] for r in results], type=pa.int64()),
                    pa.array([r[3] / r[2] for r in results]),
                    pa.array([len(r[4]) for r in results], type=pa.int64()),
                    pa.array([min(t[1] for t in r[4]) for r in results], type=pa.int64()),
                    pa.array([[{"item": p, "text": q, "length": n} for p, q, n in r[4]] for r in results],
                             type=pa.list_(pa.struct([(x, pa.int64()) for x in ("item", "text", "length")]))),
                ], names=[key, item_key, "n_item_words", "n_covered", "coverage", "n_tiles", "first_word", "tiles"])

    return run
