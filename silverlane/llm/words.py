"""Words of whole texts as numpy arrays.

Texts of an Arrow batch are read from its buffers, cut into slices of about ``SLICE_BYTES`` at text ends, and split into
words by byte class. Every word gets a 64-bit hash; word sequences get hashes of those. A text longer than a slice is a
slice of its own, so memory follows the longest text, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash

SLICE_BYTES = 1 << 19
LONG_SPAN = 256
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _table(members) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return table


#: Bytes of words between white space, and of words of letters and digits (every byte beyond ASCII counts as a letter).
NOT_SPACE = ~_table([0x20, *range(0x09, 0x0E)])
ALPHANUMERIC = _table([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
SAME = np.arange(256, dtype=np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that all bits depend on all."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Texts(NamedTuple):
    """Some texts of a batch: rows ``first`` and on, their bytes, and where each begins (one more for the end)."""

    first: int
    data: np.ndarray
    begins: np.ndarray


class Words(NamedTuple):
    """Words of a slice: where they start and end in its bytes, their hashes, and the first word of each text."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    begins: np.ndarray

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.begins) - 1), np.diff(self.begins))


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Texts]:
    """Whole texts of a string column; a null is an empty text."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    low = 0
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1
        high = min(max(high, low + 1), n)
        yield Texts(low, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
        low = high


def split(texts: Texts, is_word: np.ndarray, fold: np.ndarray | None = None) -> Words:
    """The words of each text: longest runs of word bytes."""
    data, begins = texts.data, texts.begins
    n = len(data)
    inside = np.zeros(n + 2, dtype=bool)
    inside[1:-1] = is_word[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[begins] = True
    here, before = inside[1:], inside[:-1]
    starts = np.flatnonzero(here & (~before | edge))
    ends = np.flatnonzero(before & (~here | edge))
    hashes = span_hashes(data if fold is None else fold[data], starts, ends)
    return Words(starts, ends, hashes, np.searchsorted(starts, begins))


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number; zeros follow the data."""
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    return np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))


#: Which of eight bytes count when so many are left.
_LEFT = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=np.uint64)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hash of the bytes of each span, wherever in the data it stands.

    Eight bytes at a time are put into the state, which is scrambled each time, so no rule of arithmetic makes two
    different words alike. Spans over ``LONG_SPAN`` bytes are hashed one by one. Other seeds give independent hashes.
    """
    lengths = ends - starts
    eights = _eights(data)
    hashes = mix((lengths.astype(np.uint64) + np.uint64(seed << 32)) * _ODD)
    live = np.flatnonzero((lengths > 0) & (lengths <= LONG_SPAN))
    at, left, done = starts[live], lengths[live], hashes[live]
    while len(live):
        done = mix((done ^ (eights[at] & _LEFT[np.minimum(left, 8)])) + _ODD)
        hashes[live] = done
        more = np.flatnonzero(left > 8)
        live, at, left, done = live[more], at[more] + 8, left[more] - 8, done[more]
    for i in np.flatnonzero(lengths > LONG_SPAN).tolist():
        hashes[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes(), seed)
    return hashes


def same_spans(
    data: np.ndarray, starts: np.ndarray, other: np.ndarray, other_starts: np.ndarray, lengths: np.ndarray
) -> np.ndarray:
    """Whether spans of equal lengths in two byte arrays have the same bytes."""
    mine, theirs = _eights(data), _eights(other)
    same = np.ones(len(lengths), dtype=bool)
    live = np.flatnonzero((lengths > 0) & (lengths <= LONG_SPAN))
    a, b, left = starts[live], other_starts[live], lengths[live]
    while len(live):
        equal = (mine[a] ^ theirs[b]) & _LEFT[np.minimum(left, 8)] == 0
        same[live[~equal]] = False
        more = np.flatnonzero(equal & (left > 8))
        live, a, b, left = live[more], a[more] + 8, b[more] + 8, left[more] - 8
    for i in np.flatnonzero(lengths > LONG_SPAN).tolist():
        n = int(lengths[i])
        same[i] = np.array_equal(data[starts[i] : starts[i] + n], other[other_starts[i] : other_starts[i] + n])
    return same


def numbers(texts: Texts, words: Words, fold: np.ndarray | None = None) -> np.ndarray:
    """A number for each word of a slice, the same for equal words only: words with equal hashes are compared."""
    hashes, lengths = words.hashes, words.ends - words.starts
    _, first, number = np.unique(hashes, return_index=True, return_inverse=True)
    data = texts.data if fold is None else fold[texts.data]
    model = first[number]
    alike = lengths == lengths[model]
    alike[alike] = same_spans(data, words.starts[alike], data, words.starts[model[alike]], lengths[alike])
    if not alike.all():
        names: dict[bytes, int] = {}
        spans = zip(words.starts.tolist(), words.ends.tolist())
        number = np.array([names.setdefault(data[a:b].tobytes(), len(names)) for a, b in spans], dtype=np.int64)
    return number


def hash_word(word: bytes) -> int:
    """The hash that ``split`` gives to this word, case folded already."""
    texts = Texts(0, np.frombuffer(word, dtype=np.uint8), np.array([0, len(word)]))
    return int(split(texts, np.ones(256, dtype=bool)).hashes[0])


@cache
def _salts(n: int) -> np.ndarray:
    return mix((np.arange(n, dtype=np.uint64) + np.uint64(7)) * _ODD) | np.uint64(1)


def sequence_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n values from each place on; shorter by n - 1."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = hashes[:count] * _salts(n)[0]
    for k in range(1, n):
        total += hashes[k : k + count] * _salts(n)[k]
    return mix(total)


def windows(words: Words, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all n consecutive words within a text, the place of the first word, and the text it is in."""
    hashes = sequence_hashes(words.hashes, n)
    owner = words.text_of()
    whole = owner[: len(hashes)] == owner[n - 1 : n - 1 + len(hashes)]
    at = np.flatnonzero(whole)
    return hashes[at], at, owner[at]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All places of runs, one run after the other."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, dtype=np.int64)
    out = np.ones(total, dtype=np.int64)
    held = lengths > 0
    starts, lengths = starts[held].astype(np.int64), lengths[held].astype(np.int64)
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    out[0] = starts[0]
    out[first[1:]] = starts[1:] - (starts[:-1] + lengths[:-1] - 1)
    return np.cumsum(out)


def joined(texts: Texts, words: Words, keep: np.ndarray) -> pa.Array:
    """Per text the words to keep, unchanged, with single blanks between them."""
    sums = np.concatenate([[0], np.cumsum(keep)])
    kept = sums[words.begins[1:]] - sums[words.begins[:-1]]
    lengths = (words.ends - words.starts)[keep] + 1
    out = np.append(texts.data, np.uint8(0x20))[ragged(words.starts[keep], lengths)]
    ends = np.cumsum(lengths)
    out[ends - 1] = 0x20
    # Each word ends in a blank; the last blank of a text goes.
    reach = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(kept)])]
    hold = np.ones(len(out), dtype=bool)
    hold[reach[1:][kept > 0] - 1] = False
    offsets = reach - np.concatenate([[0], np.cumsum(kept > 0)])
    strings = pa.LargeStringArray.from_buffers(
        len(kept), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out[hold].tobytes())
    )
    return strings.cast(pa.string())


def rows(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)
