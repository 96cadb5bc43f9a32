"""Token ids of whole texts by a byte-level tokenizer of the tokenizers library.

The tokenizer splits a text before it merges bytes, and it always splits before a single blank that an ordinary
character follows. So texts are cut there, each distinct cut is encoded by the library once per worker while it is in use, and the ids of a
text are those of its cuts in order. A cut found by its hash is compared byte by byte with the one kept; cuts over
``KEPT_BYTES`` are not kept. Texts with a special token's string, and tokenizers of another kind, are encoded whole. The
library runs in the task's own thread.
"""

from __future__ import annotations

import json
import os
from functools import cache

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from silverlane.llm import words as W
from silverlane.llm.common import give_back

CACHE_ENTRIES = 1 << 20
KEPT_BYTES = 64
_JOIN_BYTES = 1 << 12  # the library takes less time a byte for short strings than for long ones

# Bytes that may follow a blank at a cut: ASCII but white space and controls, and the first byte of Latin letters.
_ORDINARY = W._table([*range(0x21, 0x7F), *range(0xC3, 0xC7)])


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        form = json.loads(self.tokenizer.to_str())
        splitter = form.get("pre_tokenizer") or {}
        self.cuts = (
            form.get("normalizer") is None and form.get("post_processor") is None
            and splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True)
            and not splitter.get("add_prefix_space", False)
        )
        self.special = [token["content"].encode() for token in form.get("added_tokens", [])]
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max(vocabulary.values()) + 1
        self.dtype = np.uint16 if self.size <= 1 << 16 else np.uint32
        # In a byte-level vocabulary each character of a token stands for one byte.
        self.bytes_of = np.zeros(self.size, dtype=np.int64)
        for token, i in vocabulary.items():
            self.bytes_of[i] = len(token)
        self._clear()

    def _clear(self, wanted: int = 0) -> None:
        """An empty cache of CACHE_ENTRIES, or of more if one slice needs more."""
        self.room = max(CACHE_ENTRIES, 1 << max(wanted - 1, 1).bit_length())
        self.slots = np.zeros(2 * self.room, dtype=np.uint64)  # hashes, each at its place or the next free one
        self.numbers = np.zeros(2 * self.room, dtype=np.int32)
        self.hashes = np.zeros(self.room, dtype=np.uint64)
        self.starts, self.lengths, self.spans, self.uses = (np.zeros(self.room, dtype=np.int32) for _ in range(4))
        self.widths = np.zeros(self.room, dtype=np.uint8)
        self.pool, self.entries, self.used = np.zeros(1 << 16, dtype=self.dtype), 0, 0
        self.text, self.text_used = np.zeros(1 << 16, dtype=np.uint8), 0

    def _make_room(self, wanted: int) -> None:
        """Forget all but the entries used more than once, of which at most half of the room stays, most used first."""
        often = np.flatnonzero((self.uses[: self.entries] > 1) & (self.hashes[: self.entries] > 0))
        if len(often) > (most := max(0, min(CACHE_ENTRIES // 2, CACHE_ENTRIES - wanted))):
            often = np.sort(often[np.argsort(-self.uses[often], kind="stable")[:most]])
        hashes, lengths, widths, uses = self.hashes[often], self.lengths[often], self.widths[often].astype(np.int64), self.uses[often]
        ids = self.pool[W.ragged(self.starts[often], lengths.astype(np.int64))]
        text, spans = self.text, self.spans[often]
        self._clear(wanted)
        added = self._add(ids, lengths)
        self._keep(added, hashes, text, spans, widths)
        self.uses[added] = uses // 2

    def _look_up(self, hashes: np.ndarray) -> np.ndarray:
        """Cache entry of each hash, -1 without one."""
        mask = np.uint64(len(self.slots) - 1)
        at = (hashes & mask).astype(np.int64)
        seen = self.slots[at]
        out = np.where(seen == hashes, self.numbers[at], -1)
        rest = np.flatnonzero((seen != hashes) & (seen != 0))
        while len(rest):
            at[rest] = (at[rest] + 1) & int(mask)
            seen = self.slots[at[rest]]
            hit = seen == hashes[rest]
            out[rest[hit]] = self.numbers[at[rest[hit]]]
            rest = rest[~hit & (seen != 0)]
        return out

    def _add(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Entries for ids that follow each other."""
        first, end = self.entries, self.used + len(ids)
        if end > len(self.pool):
            self.pool = np.append(self.pool, np.zeros(max(end, len(self.pool)), dtype=self.dtype))
        self.pool[self.used : end] = ids
        entries = np.arange(first, first + len(lengths))
        self.starts[entries] = self.used + np.cumsum(lengths) - lengths
        self.lengths[entries] = lengths
        self.entries, self.used = first + len(lengths), end
        return entries

    def _keep(self, entries: np.ndarray, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, widths: np.ndarray) -> None:
        """Let entries be found by the hashes, distinct and new, of their spans of ``data``."""
        end = self.text_used + int(widths.sum())
        if end > len(self.text):
            self.text = np.append(self.text, np.zeros(max(end, len(self.text)), dtype=np.uint8))
        self.text[self.text_used : end] = data[W.ragged(starts, widths)]
        self.hashes[entries] = hashes
        self.spans[entries] = self.text_used + np.cumsum(widths) - widths
        self.widths[entries] = widths
        self.text_used = end
        at, rest = (hashes & np.uint64(len(self.slots) - 1)).astype(np.int64), np.arange(len(hashes))
        while len(rest):
            free = self.slots[at[rest]] == 0
            self.slots[at[rest[free]]] = hashes[rest[free]]
            placed = free & (self.slots[at[rest]] == hashes[rest])
            self.numbers[at[rest[placed]]] = entries[rest[placed]]
            rest = rest[~placed]
            at[rest] = (at[rest] + 1) & (len(self.slots) - 1)

    def _entries(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Entry of each span, encoded now if it is not there."""
        widths = ends - starts
        hashes = np.maximum(W.span_hashes(data, starts, ends), np.uint64(1))  # 0 stands for a free slot
        short = widths <= KEPT_BYTES
        known = np.where(short, self._look_up(hashes), -1)
        hit = np.flatnonzero(known >= 0)
        same = self.widths[known[hit]] == widths[hit]
        same[same] = W.same_spans(data, starts[hit[same]], self.text, self.spans[known[hit[same]]], widths[hit[same]])
        alone = ~short
        alone[hit[~same]] = True  # another span has this hash
        rest = np.flatnonzero((known < 0) & ~alone)
        new, first, number = np.unique(hashes[rest], return_index=True, return_inverse=True)
        model = rest[first[number]]
        same = widths[rest] == widths[model]
        same[same] = W.same_spans(data, starts[rest[same]], data, starts[model[same]], widths[rest[same]])
        alone[rest[~same]] = True
        single, kept = np.flatnonzero(alone), rest[first]
        asked = np.concatenate([kept, single])
        if self.entries + len(asked) > self.room:
            self._make_room(len(starts))
            return self._entries(data, starts, ends)
        if len(asked):
            added = self._add(*self._encode_spans(data.tobytes(), starts[asked].tolist(), ends[asked].tolist()))
            self._keep(added[: len(kept)], new, data, starts[kept], widths[kept])
            known[rest] = added[number]
            known[single] = added[len(kept) :]
        self.uses[: self.entries] += np.bincount(known, minlength=self.entries).astype(np.int32)
        return known

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=self.dtype) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: W.Texts, end: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each followed by ``end``, and how many each text has with it."""
        data = texts.data.tobytes()
        if not self.cuts or any(s in data for s in self.special):
            bounds = texts.begins.tolist()
            each = self._ids([data[a:b].decode() for a, b in zip(bounds, bounds[1:])])
            tail = [] if end is None else [np.array([end], dtype=self.dtype)]
            parts = [p for ids in each for p in (ids, *tail)]
            return np.concatenate(parts), np.array([len(ids) + len(tail) for ids in each])
        starts, ends, first = self._cut(texts)
        known = self._entries(texts.data, starts, ends)
        cut_starts, cut_lengths = self.starts[known], self.lengths[known]
        sums = np.concatenate([[0], np.cumsum(cut_lengths)])
        per_text = sums[first[1:]] - sums[first[:-1]]
        ids = self.pool[W.ragged(cut_starts, cut_lengths)]
        if end is None:
            return ids, per_text
        out = np.full(len(ids) + len(per_text), end, dtype=self.dtype)
        keep = np.ones(len(out), dtype=bool)
        keep[np.cumsum(per_text + 1) - 1] = False
        out[keep] = ids
        return out, per_text + 1

    @staticmethod
    def _cut(texts: W.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the cuts, and the first cut of each text (one more for the end)."""
        data, begins = texts.data, texts.begins
        cut = np.zeros(len(data) + 1, dtype=bool)
        cut[: max(len(data) - 1, 0)] = (data[:-1] == 0x20) & _ORDINARY[data[1:]]
        last = begins[1:] - 1
        cut[last[last >= 0]] = False  # a blank that ends a text is not followed by the next text
        cut[begins] = True
        cut[-1] = False
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
        return starts, ends, np.searchsorted(starts, begins)

    def _encode_spans(self, data: bytes, starts: list[int], ends: list[int]):
        """Ids of all spans in a row and how many each has. Spans that begin with a blank are encoded in long strings
        and told apart by the bytes of their ids."""
        lengths = np.zeros(len(starts), dtype=np.int64)
        groups, group, size, alone = [], [], 0, []
        for i, (a, b) in enumerate(zip(starts, ends)):
            if b - a < 2 or data[a] != 0x20 or data[a + 1] <= 0x20:
                alone.append(i)
                continue
            group.append(i)
            size += b - a
            if size >= _JOIN_BYTES:
                groups.append(group)
                group, size = [], 0
        if group:
            groups.append(group)
        order, parts = [], []
        texts = [b"".join([data[starts[i] : ends[i]] for i in g]).decode() for g in groups]
        for g, ids in zip(groups, self._ids(texts)):
            reached = np.cumsum(self.bytes_of[ids])
            wanted = np.cumsum([ends[i] - starts[i] for i in g])
            stops = np.searchsorted(reached, wanted)
            if len(reached) and reached[-1] == wanted[-1] and (reached[stops] == wanted).all():
                lengths[g] = np.diff(stops, prepend=-1)
                order.extend(g)
                parts.append(ids)
            else:
                alone.extend(g)
        for i, ids in zip(alone, self._ids([data[starts[i] : ends[i]].decode() for i in alone])):
            lengths[i] = len(ids)
            order.append(i)
            parts.append(ids)
        flat = np.concatenate(parts) if parts else np.zeros(0, dtype=self.dtype)
        order = np.array(order, dtype=np.int64)
        begins = np.zeros(len(starts), dtype=np.int64)
        begins[order] = np.cumsum(lengths[order]) - lengths[order]
        return flat[W.ragged(begins, lengths)], lengths


@cache
def encoder(path: str) -> Encoder:
    """The encoder of this worker, with what it has encoded so far: some 100 MB at most, until ``forget``."""
    return Encoder(path)


def forget() -> None:
    """Drop the encoders of this worker and their caches."""
    encoder.cache_clear()
    give_back()


def encode_texts(tokenizer: Encoder, texts: list[str | None], end: int | None = None) -> list[list[int]]:
    """Ids of each text, for small inputs."""
    out = []
    for part in W.slices(pa.array(texts, type=pa.string())):
        ids, lengths = tokenizer.encode(part, end)
        out.extend(x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1]))
    return out
