"""Removal of passages that repeat across documents, behind a count-min prefilter.

A window is ``n`` consecutive words of a document. A word goes if a window over it also starts in a document with a
smaller key.

1. Every task counts its windows in a sketch of two rows with counters 0, 1 and "2 or more", and sends the counted cells
   as differences. Sketches are merged range by range. A merged counter is never below the true count.
2. Windows whose counter is 2 or more in both rows are grouped exactly. Of the copies in one task only those of its
   smallest document travel; the others are marked on the spot. So a passage in millions of documents costs one row per
   task. The rest meet by hash and all but the smallest document are marked.
3. Marks and texts meet by document, and the words under marked windows are left out.

The sketch has a fixed greatest size (``MAX_CELLS``, 64 MB for the two rows). Beyond about twice as many windows as
cells it lets more single windows pass to step 2, which stays exact. Windows are compared by a 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlane.llm import words as W
from silverlane.llm.common import small_batches, stored

WINDOW = 13
MAX_CELLS = 1 << 28
MIN_CELLS = 1 << 16
CHUNK_BITS = 20
FLUSH_WINDOWS = 1 << 21
SHARD_BYTES = 2 << 20
BUCKET_BYTES = 8 << 20


def encode_gaps(values: np.ndarray) -> bytes:
    """Ascending values as bytes of differences; 255 means 255 more to come."""
    gaps = np.diff(values.astype(np.int64), prepend=np.int64(0))
    jumps = gaps // 255
    out = np.full(len(gaps) + int(jumps.sum()), 255, dtype=np.uint8)
    out[np.cumsum(jumps + 1) - 1] = gaps % 255
    return out.tobytes()


def decode_gaps(data: bytes) -> np.ndarray:
    steps = np.frombuffer(data, dtype=np.uint8)
    return np.cumsum(steps.astype(np.int64))[steps < 255]


def _cells(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    values = hashes if row == 0 else W.mix(hashes ^ np.uint64(0xA24BAED4963EE407))
    return (values >> np.uint64(64 - bits)).astype(np.uint32)


def _sketch_rows(batches: Iterator[pa.RecordBatch], n: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Counted cells of each task: (row, chunk, differences), a cell once or twice."""
    held, size = [], 0

    def flush() -> pa.RecordBatch:
        hashes = np.concatenate(held)
        out: dict[str, list] = {"row": [], "chunk": [], "cells": []}
        for row in (0, 1):
            cells = np.sort(_cells(hashes, row, bits))
            keep = np.ones(len(cells), dtype=bool)
            keep[2:] = cells[2:] != cells[:-2]
            cells = cells[keep]
            chunk = cells >> np.uint32(CHUNK_BITS)
            first = np.flatnonzero(np.diff(chunk, prepend=np.uint32(0xFFFFFFFF)))
            for a, b in zip(first.tolist(), [*first[1:].tolist(), len(cells)]):
                out["row"].append(row)
                out["chunk"].append(int(chunk[a]))
                out["cells"].append(encode_gaps(cells[a:b] & np.uint32((1 << CHUNK_BITS) - 1)))
        held.clear()
        return pa.RecordBatch.from_pydict(out, schema=pa.schema(
            [("row", pa.int32()), ("chunk", pa.int32()), ("cells", pa.binary())]))

    for batch in batches:
        for texts in W.slices(batch.column(0)):
            hashes, *_ = W.windows(W.split(texts, W.NOT_SPACE), n)
            if len(hashes):
                held.append(hashes)
                size += len(hashes)
            if size >= FLUSH_WINDOWS:
                yield flush()
                size = 0
    if held:
        yield flush()


def _merge_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bits of the cells counted twice or more, per row and chunk."""
    planes: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for row, chunk, cells in zip(*(c.to_pylist() for c in batch.columns)):
            once, twice = planes.setdefault(
                (row, chunk), (np.zeros(1 << CHUNK_BITS, dtype=bool), np.zeros(1 << CHUNK_BITS, dtype=bool))
            )
            at = decode_gaps(cells)
            twice[at[once[at]]] = True
            twice[at[1:][at[1:] == at[:-1]]] = True
            once[at] = True
    for (row, chunk), (_, twice) in planes.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([row], type=pa.int32()), pa.array([chunk], type=pa.int32()), pa.array([np.packbits(twice).tobytes()])],
            names=["row", "chunk", "bits"],
        )


def _candidates(batches, shared, n: int, bits: int, shards: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Windows that may repeat: of each one the copies in the smallest document here, by shard; marks for the others,
    by bucket of documents under a negative shard."""
    sketch = shared.value
    held, size = [], 0

    def flush() -> Iterator[pa.RecordBatch]:
        hashes, keys, places = (np.concatenate([h[i] for h in held]) for i in range(3))
        held.clear()
        order = np.argsort(hashes)
        hashes, keys, places = hashes[order], keys[order], places[order]
        first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
        least = np.repeat(np.minimum.reduceat(keys, first), np.diff(np.append(first, len(hashes))))
        later = keys > least
        marked = keys[later], places[later]
        yield _grouped(-1 - np.mod(marked[0], buckets), marked[0], None, marked[1])
        kept = ~later
        yield _grouped((hashes[kept] % np.uint64(shards)).astype(np.int64), keys[kept], hashes[kept], places[kept])

    for batch in batches:
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        for texts in W.slices(batch.column(1)):
            found = W.split(texts, W.NOT_SPACE)
            hashes, at, owner = W.windows(found, n)
            for row in (0, 1):
                cells = _cells(hashes, row, bits)
                likely = (sketch[row][cells >> np.uint32(3)] >> (7 - (cells & np.uint32(7))).astype(np.uint8)) & 1 == 1
                hashes, at, owner = hashes[likely], at[likely], owner[likely]
            if len(hashes):
                held.append((hashes, keys[texts.first + owner].astype(np.int64), (at - found.begins[owner]).astype(np.int32)))
                size += len(hashes)
            if size >= FLUSH_WINDOWS // 2:
                yield from flush()
                size = 0
    if held:
        yield from flush()


_GROUPED = pa.schema([("shard", pa.int64()), ("keys", pa.binary()), ("hashes", pa.binary()), ("places", pa.binary())])


def _grouped(shard: np.ndarray, keys: np.ndarray, hashes: np.ndarray | None, places: np.ndarray) -> pa.RecordBatch:
    """One row per shard, ordered by document."""
    order = np.lexsort((places, keys, shard))
    shard, keys, places = shard[order], keys[order], places[order].astype(np.int32)
    hashes = None if hashes is None else hashes[order]
    first = np.flatnonzero(np.diff(shard, prepend=shard[0] - 1)) if len(shard) else np.zeros(0, dtype=int)
    spans = list(zip(first.tolist(), [*first[1:].tolist(), len(shard)]))
    return pa.RecordBatch.from_arrays([
        pa.array(shard[first], type=pa.int64()), pa.array([keys[a:b].tobytes() for a, b in spans], type=pa.binary()),
        pa.array([b"" if hashes is None else hashes[a:b].tobytes() for a, b in spans], type=pa.binary()),
        pa.array([places[a:b].tobytes() for a, b in spans], type=pa.binary()),
    ], schema=_GROUPED)


def _mark(table: pa.Table, buckets: int) -> pa.Table:
    """All copies in a shard but those in the smallest document, by bucket; rows of marks pass."""
    if table.num_rows and table.column("shard")[0].as_py() < 0:
        marks = table.select(["shard", "keys", "places"])
        return marks.set_column(0, "bucket", pa.array([-1 - s for s in marks.column("shard").to_pylist()], type=pa.int64()))
    keys, hashes, places = (
        np.concatenate([np.frombuffer(x, dtype=t) for x in table.column(c).to_pylist()] or [np.zeros(0, dtype=t)])
        for c, t in (("keys", np.int64), ("hashes", np.uint64), ("places", np.int32))
    )
    order = np.argsort(hashes)
    hashes, keys, places = hashes[order], keys[order], places[order]
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    later = keys > np.repeat(np.minimum.reduceat(keys, first), np.diff(np.append(first, len(hashes))))
    marks = _grouped(np.mod(keys[later], buckets), keys[later], None, places[later])
    return pa.Table.from_batches([marks]).select(["shard", "keys", "places"]).rename_columns(["bucket", "keys", "places"])


def remove_repeats(df: DataFrame, key: str, text: str, n: int = WINDOW) -> DataFrame:
    """(key, n_words, n_removed, kept) of each row; ``kept`` has the remaining words joined by single blanks.

    ``key`` is a whole number. Rows with the same key are one document as far as "smaller" goes: none removes words of
    another. Rows without a key keep all their words and remove none. Null and empty texts have no words. Texts
    shorter than a window stay whole. Other columns are ignored; an empty table gives an empty result.
    """
    spark = df.sparkSession
    small_batches(spark)
    docs = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    keyed = docs.filter(F.col("key").isNotNull())
    n_bytes = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = int(min(max(n_bytes // 4, MIN_CELLS), MAX_CELLS) - 1).bit_length()
    shards, buckets = max(16, n_bytes // SHARD_BYTES), max(8, n_bytes // BUCKET_BYTES) | 1

    counted = keyed.select("text").mapInArrow(lambda b: _sketch_rows(b, n, bits), "row int, chunk int, cells binary")
    merged = counted.repartition("row", "chunk").mapInArrow(_merge_rows, "row int, chunk int, bits binary")
    sketch = np.zeros((2, max(1 << bits, 1 << CHUNK_BITS) // 8), dtype=np.uint8)
    width = (1 << CHUNK_BITS) // 8
    for row in merged.toLocalIterator():  # at most 2 * MAX_CELLS bits
        sketch[row["row"], row["chunk"] * width : (row["chunk"] + 1) * width] = np.frombuffer(row["bits"], dtype=np.uint8)
    shared = spark.sparkContext.broadcast(sketch)

    grouped = keyed.mapInArrow(
        lambda b: _candidates(b, shared, n, bits, shards, buckets), "shard bigint, keys binary, hashes binary, places binary"
    )
    marks = stored(grouped.groupBy("shard").applyInArrow(
        lambda t: _mark(t, buckets), "bucket bigint, keys binary, places binary"), "repeat-marks")
    nothing = F.lit(None)
    rows = marks.select(
        "bucket", F.lit(0).alias("kind"), nothing.cast("long").alias("key"), nothing.cast("string").alias("text"), "keys", "places"
    ).unionAll(docs.select(
        F.coalesce(F.pmod("key", F.lit(buckets)), F.pmod(F.xxhash64("text"), F.lit(buckets))).alias("bucket"),
        F.lit(1).alias("kind"), "key", "text", nothing.cast("binary").alias("keys"), nothing.cast("binary").alias("places"),
    ))
    key_type = df.schema[key].dataType.simpleString()
    cut = rows.repartition("bucket").sortWithinPartitions("bucket", "kind").mapInArrow(
        lambda b: _cut_rows(b, n), "key bigint, n_words bigint, n_removed bigint, kept string"
    )
    return cut.withColumn("key", F.col("key").cast(key_type)).withColumnRenamed("key", key)


def _cut_rows(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """Marks of a bucket come before its texts."""
    bucket, parts, marks = None, [], (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))
    for batch in batches:
        buckets = batch.column(0).to_numpy(zero_copy_only=False)
        kinds = batch.column(1).to_numpy(zero_copy_only=False)
        changes = np.flatnonzero((np.diff(buckets) != 0) | (np.diff(kinds) != 0)) + 1
        bounds = [0, *changes.tolist(), len(buckets)]
        for a, b in zip(bounds, bounds[1:]):
            if a == b:
                continue
            if buckets[a] != bucket:
                bucket, parts, marks = buckets[a], [], (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))
            part = batch.slice(a, b - a)
            if kinds[a] == 0:
                parts.extend(zip(part.column(4).to_pylist(), part.column(5).to_pylist()))
                continue
            if parts:
                keys = np.concatenate([np.frombuffer(k, dtype=np.int64) for k, _ in parts])
                places = np.concatenate([np.frombuffer(p, dtype=np.int32) for _, p in parts]).astype(np.int64)
                order, parts = np.argsort(keys, kind="stable"), []
                marks = keys[order], places[order]
            yield from _cut_texts(part.column(2), part.column(3), *marks, n)


def _cut_texts(keys: pa.Array, texts: pa.Array, mark_keys: np.ndarray, places: np.ndarray, n: int):
    for part in W.slices(texts):
        rows = len(part.begins) - 1
        own = keys.slice(part.first, rows)
        known = own.is_valid().to_numpy(zero_copy_only=False)
        values = own.fill_null(0).to_numpy(zero_copy_only=False)
        found = W.split(part, W.NOT_SPACE)
        left = np.where(known, np.searchsorted(mark_keys, values, side="left"), 0)
        right = np.where(known, np.searchsorted(mark_keys, values, side="right"), 0)
        at = places[W.ragged(left, right - left)] + np.repeat(found.begins[:-1], right - left)
        change = np.bincount(at, minlength=len(found.starts) + 1) - np.bincount(
            np.minimum(at + n, len(found.starts)), minlength=len(found.starts) + 1)
        keep = np.cumsum(change)[:-1] == 0 if len(found.starts) else np.zeros(0, dtype=bool)
        sums = np.concatenate([[0], np.cumsum(keep)])
        kept = sums[found.begins[1:]] - sums[found.begins[:-1]]
        starts, lengths = found.starts[keep], (found.ends - found.starts)[keep] + 1
        out = np.append(part.data, np.uint8(0x20))[W.ragged(starts, lengths)]
        ends = np.cumsum(lengths)
        out[ends - 1] = 0x20
        # Each word ends in a blank; the last blank of a text goes.
        reach = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(kept)])]
        lasts = reach[1:][kept > 0] - 1
        hold = np.ones(len(out), dtype=bool)
        hold[lasts] = False
        offsets = reach - np.concatenate([[0], np.cumsum(kept > 0)])
        strings = pa.LargeStringArray.from_buffers(rows, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out[hold].tobytes()))
        n_words = np.diff(found.begins)
        yield pa.RecordBatch.from_arrays(
            [own, pa.array(n_words), pa.array(n_words - kept), strings.cast(pa.string())],
            names=["key", "n_words", "n_removed", "kept"],
        )
