"""Stretches of words that repeat with a period, and texts without their repeats.

Texts are taken slice by slice, words as numbers. How far two places of a text agree (their longest common extension)
comes from a difference cover: only suffixes at places whose remainder modulo ``MODULUS`` is in ``COVER`` are sorted, by
their first MODULUS words and then by doubling. From any two places both are at such a place after the same few words, fewer than
MODULUS; those are compared, and the rest is the least of the common prefixes between the two sorted suffixes, from a
sparse table.

Runs are enumerated on a grid for every period p, so the number of pairs is harmonic (n / 1 + n / 2 + ...): a run of
exponent e agrees with itself p later over (e - 1) p words, so one pair in (e - 2) p words finds it; where that pair
agrees far enough, the run is followed to both ends. A text never leaves its task and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlane.llm import words as W
from silverlane.llm.common import small_batches

MODULUS = 31
# Every difference modulo 31 is the difference of two of these.
COVER = (0, 1, 3, 8, 12, 18)
MAX_PAIRS = 1 << 19

_K = len(COVER)
_SLOT = np.full(MODULUS, -1, dtype=np.int64)
_SLOT[list(COVER)] = np.arange(_K)


def _meeting() -> np.ndarray:
    """Words after which places with two remainders are both in the cover, the fewest possible."""
    steps = np.full((MODULUS, MODULUS), -1, dtype=np.int64)
    places = np.arange(MODULUS)
    for step in range(MODULUS - 1, -1, -1):
        inside = _SLOT[(places + step) % MODULUS] >= 0
        steps[np.ix_(inside, inside)] = step
    return steps


_MEETING = _meeting()


class Extensions:
    """Common extensions of places of the same text, in words.

    ``numbers`` has the words of all texts, each text followed by a number of its own, and ``owner`` the text of each
    place.
    """

    def __init__(self, numbers: np.ndarray, owner: np.ndarray):
        blocks = -(-len(numbers) // MODULUS)
        room = (blocks + 1) * MODULUS
        top = int(numbers.max(initial=-1)) + 1
        self.at = np.concatenate([numbers, top + np.arange(room - len(numbers))])  # numbers behind the end differ
        place = (np.arange(blocks)[:, None] * MODULUS + np.array(COVER)[None, :]).reshape(-1)
        owners = np.concatenate([owner, np.full(room - len(numbers), int(owner.max(initial=0)) + 1)])
        self._sort(place, owners[place] * (top + room) + self.at[place])
        self._table: list[np.ndarray] | None = None

    def _sort(self, place: np.ndarray, first: np.ndarray) -> None:
        """Order the suffixes at the sampled places and note what neighbours have in common."""
        n = len(place)
        self.order, self.rank = np.argsort(first, kind="stable"), np.zeros(n, dtype=np.int64)
        self.common = np.zeros(n, dtype=np.int64)
        head = np.concatenate([[True], np.diff(first[self.order]) != 0]) if n else np.zeros(0, dtype=bool)
        tied = self._regroup(np.arange(n), self.order, head)
        for words in range(1, MODULUS):
            if not len(tied):
                break
            tied, split = self._refine(tied, self.at[place[self.order[tied]] + words])
            self.common[split] = words
        levels, reach = [self.rank.copy()], 1  # ranks by the first MODULUS, twice, four times ... as many words
        while len(tied):
            tied, split = self._refine(tied, levels[-1][self.order[tied] + reach * _K])
            self.common[split] = self._compare(self.order[split - 1], self.order[split], reach, levels[:-1], place)
            levels.append(self.rank.copy())
            reach *= 2

    def _regroup(self, slots: np.ndarray, members: np.ndarray, head: np.ndarray) -> np.ndarray:
        """Give members the slot of their group's head as rank; the slots of groups of several are returned."""
        if not len(slots):
            return slots
        self.rank[members] = slots[np.maximum.accumulate(np.where(head, np.arange(len(slots)), 0))]
        return slots[~(head & np.append(head[1:], True))]

    def _refine(self, tied: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order tied groups by a further key; what is still tied, and the slots where a group was split."""
        members = self.order[tied]
        sorting = np.lexsort((key, self.rank[members]))
        members, key = members[sorting], key[sorting]
        group = self.rank[members]
        self.order[tied] = members
        inside = group[1:] == group[:-1]
        cut = inside & (key[1:] != key[:-1])
        rest = self._regroup(tied, members, np.concatenate([[True], ~inside | cut]))
        return rest, tied[1:][cut]

    def _compare(self, a, b, reach: int, levels: list[np.ndarray], place: np.ndarray) -> np.ndarray:
        """Words two sampled suffixes share that agree in ``reach`` blocks but not in twice as many."""
        blocks = np.full(len(a), reach, dtype=np.int64)
        for level in range(len(levels) - 1, -1, -1):
            same = levels[level][a + blocks * _K] == levels[level][b + blocks * _K]
            blocks[same] += 1 << level
        words = blocks * MODULUS
        live = np.arange(len(a))
        while len(live):
            live = live[self.at[place[a[live]] + words[live]] == self.at[place[b[live]] + words[live]]]
            words[live] += 1
        return words

    def _least(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Least common prefix between two ranks, the higher one included."""
        if self._table is None:
            self._table = [self.common.astype(np.int32)]
            while (width := 1 << len(self._table)) <= len(self.common):
                last = self._table[-1]
                self._table.append(np.minimum(last[: len(last) - width // 2], last[width // 2 :]))
        low, high = np.minimum(a, b) + 1, np.maximum(a, b)
        out = np.zeros(len(a), dtype=np.int64)
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        for k in np.unique(level).tolist():
            here = level == k
            out[here] = np.minimum(self._table[k][low[here]], self._table[k][high[here] - (1 << k) + 1])
        return out

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that agree from two different places of a text on."""
        out = np.zeros(len(a), dtype=np.int64)
        live, steps = np.arange(len(a)), _MEETING[a % MODULUS, b % MODULUS]
        met = []
        for words in range(MODULUS):
            there = steps[live] == words
            met.append(live[there])
            live = live[~there]
            live = live[self.at[a[live] + words] == self.at[b[live] + words]]
            out[live] = words + 1
            if not len(live):
                break
        met = np.concatenate(met)
        x, y = a[met] + steps[met], b[met] + steps[met]
        sample = [(p // MODULUS) * _K + _SLOT[p % MODULUS] for p in (x, y)]
        out[met] = steps[met] + self._least(self.rank[sample[0]], self.rank[sample[1]])
        return out


def find(numbers: np.ndarray, begins: np.ndarray, min_length: int, exponent: int) -> tuple[np.ndarray, ...]:
    """Text, start (words from 0), length and smallest period of every run, by text, start and period.

    ``begins`` has the first word of each text and the end of the last one. A run is a stretch of at least
    ``min_length`` words and ``exponent`` (2 or more) times its smallest period that cannot be made longer.
    """
    lengths = np.diff(begins)
    texts = len(lengths)
    owner = np.repeat(np.arange(texts), lengths + 1)
    spaced = np.zeros(len(owner), dtype=np.int64)
    place = np.arange(len(numbers)) + np.repeat(np.arange(texts), lengths)
    spaced[place] = numbers
    ends = begins[1:] + np.arange(texts)
    spaced[ends] = int(numbers.max(initial=-1)) + 1 + np.arange(texts)
    starts = begins[:-1] + np.arange(texts)
    extensions = None
    found = []
    periods = np.where(lengths >= min_length, lengths // exponent, 0)
    text = np.repeat(np.arange(texts), periods)
    period = W.ragged(np.ones(texts, dtype=np.int64), periods)
    # A run agrees with itself a period later over `agree` words; a grid of this step has a place among the first of them.
    agree = np.maximum(min_length, exponent * period) - period
    step = np.maximum(period, (exponent - 2) * period)
    need = np.maximum(agree - step + 1, 1)
    counts = np.maximum((lengths[text] - period - need) // step + 1, 0)
    upto = np.cumsum(counts)
    low = 0
    while low < len(counts):
        high = max(int(np.searchsorted(upto, (upto[low - 1] if low else 0) + MAX_PAIRS, side="right")), low + 1)
        n = counts[low:high]
        row = np.repeat(np.arange(low, high), n)
        a = starts[text[row]] + W.ragged(np.zeros(len(n), dtype=np.int64), n) * step[row]
        b = a + period[row]
        last = need[row] - 1
        likely = np.flatnonzero((spaced[a] == spaced[b]) & (spaced[a + last] == spaced[b + last]))
        low = high
        if not len(likely):
            continue
        extensions = extensions or Extensions(spaced, owner)
        row, a, b = row[likely], a[likely], b[likely]
        right = extensions.of(a, b)
        far = right >= need[row]
        row, a, b, right = row[far], a[far], b[far], right[far]
        left = _leftward(extensions, a, b, np.minimum(step[row], a - starts[text[row]]))
        first = (left < step[row]) & (left + right >= agree[row])  # else an earlier place of the grid has this run
        row, a, left, right = row[first], a[first], left[first], right[first]
        found.append((text[row], a - left - starts[text[row]], left + right + period[row], period[row]))
    if not found:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
    of, start, length, by = (np.concatenate([f[i] for f in found]) for i in range(4))
    order = np.lexsort((by, length, start, of))
    of, start, length, by = of[order], start[order], length[order], by[order]
    # A stretch is also found with multiples of its smallest period.
    new = np.ones(len(of), dtype=bool)
    new[1:] = (np.diff(of) != 0) | (np.diff(start) != 0) | (np.diff(length) != 0)
    of, start, length, by = of[new], start[new], length[new], by[new]
    order = np.lexsort((by, start, of))
    return of[order], start[order], length[order], by[order]


def _leftward(extensions: Extensions, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Words before two places that agree, up to ``most``: the furthest place from which they agree until here."""
    low, high = np.zeros(len(a), dtype=np.int64), most.copy()
    while len(open_ := np.flatnonzero(low < high)):
        middle = (low[open_] + high[open_] + 1) // 2
        reaches = extensions.of(a[open_] - middle, b[open_] - middle) >= middle
        low[open_[reaches]] = middle[reaches]
        high[open_[~reaches]] = middle[~reaches] - 1
    return low


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def find_runs(df: DataFrame, key: str, text: str, min_length: int = 6, exponent: int = 4) -> DataFrame:
    """(key, n_words, runs, collapsed) of each row.

    ``runs`` has (start, length, period) of every run of words, by start and period; ``collapsed`` the words that are
    left, joined by single blanks, when every run keeps only its first period. A null, empty or blank text has no words,
    no runs and an empty ``collapsed``. Keys are carried along, so null or repeated ones are rows like any other; other
    columns are ignored; an empty table gives an empty result. A very long text is worked on alone, its pairs in
    portions of ``MAX_PAIRS``; memory follows its words.
    """
    small_batches(df.sparkSession)
    kept = df.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in W.slices(batch.column(1)):
                words = W.split(texts, W.NOT_SPACE)
                n_words = np.diff(words.begins)
                of, start, length, period = find(W.numbers(texts, words), words.begins, min_length, exponent)
                change = np.zeros(len(words.starts) + 1, dtype=np.int64)
                at = words.begins[of] + start
                np.add.at(change, at + period, 1)
                np.add.at(change, at + length, -1)
                rows = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], fields=list(RUN))
                offsets = np.searchsorted(of, np.arange(len(n_words) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(texts.first, len(n_words)), pa.array(n_words),
                    pa.ListArray.from_arrays(pa.array(offsets), rows), W.joined(texts, words, np.cumsum(change)[:-1] == 0),
                ], names=["key", "n_words", "runs", "collapsed"])

    kind = kept.schema["key"].dataType.simpleString()
    found = kept.mapInArrow(
        run, f"key {kind}, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    )
    return found.withColumnRenamed("key", key)
