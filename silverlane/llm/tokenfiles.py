"""Token ids in compressed files: one wavelet matrix per shard, in ascending key order.

Texts are encoded where they are read, so only ids are shuffled, 2 bytes each for vocabularies up to 65,536. Rows are
dealt to parts that follow each other in key order (literal bounds, so a repeated task deals alike), sorted within a
part, and written as a file whenever ``SHARD_IDS`` ids have come. A key that holds many rows has parts of its own,
told apart by a hash of the text. A file gets a name of its own per attempt and the task's rows say which files count,
so a task that is run again or twice leaves at most files that nothing refers to.
"""

from __future__ import annotations

import sys
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverlane.functions.ordering import MAX_EDGES, bucket_of, edge_measures, edge_values
from silverlane.llm import wavelet
from silverlane.llm import words as W
from silverlane.llm.common import small_batches, stored
from silverlane.session import work_path

SHARD_IDS = 1 << 21
PART_BYTES = 16 << 20
HOT_STEPS = 256
MAX_READERS = 10_000
FILES = "part bigint, number bigint, path string, n_ids bigint, n_texts bigint"
_SUB, _ZONE = 1 << 16, 1 << 42


def _part(df: DataFrame, part_bytes: int) -> Column:
    """Number of the part of a row of (key, text): it never falls as the key grows, and null keys come first.

    A key is hot when it fills two of HOT_STEPS steps of the keys' distribution or more, so there are less than
    HOT_STEPS of them. Rows of a hot key, and rows without one, are dealt by their text to parts of part_bytes or so.
    """
    steps = [i / HOT_STEPS for i in range(1, HOT_STEPS)]
    seen = df.agg(
        F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("n"), F.count("key").alias("keyed"),
        F.percentile_approx("key", steps, 10 * HOT_STEPS).alias("steps"), *edge_measures("key", 8 * MAX_EDGES),
    ).first()
    size = seen["bytes"] or 0
    found = Counter(seen["steps"] or [])
    hot = sorted(key for key, times in found.items() if times > 1)

    def dealt(share: float) -> Column:
        return F.pmod(F.xxhash64("text"), F.lit(int(min(max(1, share * size // part_bytes), _SUB))))

    zone, sub = F.lit(0), F.lit(0)
    for key in hot:
        zone = zone + F.when(F.col("key") > key, 2).when(F.col("key") == key, 1).otherwise(0)
        sub = F.when(F.col("key") == key, dealt((found[key] + 1) / HOT_STEPS)).otherwise(sub)
    bucket = bucket_of("key", edge_values(seen), max(1, size // part_bytes))
    keyed = (1 + zone) * F.lit(_ZONE) + bucket * F.lit(_SUB) + sub
    return F.when(F.col("key").isNull(), dealt(1 - seen["keyed"] / max(1, seen["n"]))).otherwise(keyed).cast("long")


def write_token_files(
    df: DataFrame, key: str, text: str, tokenizer_path: str, end: int | None = 0, folder: str | None = None,
    shard_ids: int = SHARD_IDS, part_bytes: int = PART_BYTES,
) -> DataFrame:
    """Encode every whole text and write the ids; returns (part, number, path, n_ids, n_texts, start) per file.

    Files follow each other by (part, number) in ascending key order; ``start`` counts the ids of all files before.
    A null text is empty and has only the ``end`` id; a null key comes first and is written as the smallest key.
    Rows with equal keys are ordered by a hash of the text if there are many of them, else by their ids. A file holds
    whole texts, so a text longer than a shard makes a larger file. Other columns are ignored. An empty table writes
    nothing.
    """
    small_batches(df.sparkSession)
    folder = folder or work_path(df.sparkSession, "token-files")
    dtype, width = _id_type(df.sparkSession, tokenizer_path)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from silverlane.llm.tokens import encoder

        tokenizer = encoder(tokenizer_path)
        for batch in batches:
            for texts in W.slices(batch.column(2)):
                ids, lengths = tokenizer.encode(texts, end)
                offsets = np.concatenate([[0], np.cumsum(lengths)]) * ids.itemsize
                packed = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(ids.tobytes())]
                )
                rows = batch.slice(texts.first, len(lengths))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), packed.cast(pa.binary())], names=["part", "key", "ids"]
                )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held = None, 0, 0
        ids, keys, lengths = [], [], []

        def flush() -> pa.RecordBatch:
            nonlocal number, held
            values = np.concatenate(ids)
            ids.clear()
            data = wavelet.to_bytes(
                wavelet.WaveletMatrix.build(values, width), np.array(keys, dtype=np.int64), np.array(lengths, dtype=np.int64)
            )
            path = f"{folder}/{part:018d}-{number:06d}-{uuid.uuid4().hex}.wm"
            store, name = _store(path)
            with store.open_output_stream(name) as stream:
                stream.write(data)
            row = pa.RecordBatch.from_pylist([{
                "part": part, "number": number, "path": path, "n_ids": len(values), "n_texts": len(keys),
            }])
            keys.clear(), lengths.clear()
            number, held = number + 1, 0
            return row

        _encoded()
        _make(folder)
        for batch in batches:
            for here, key_value, packed in zip(*(c.to_pylist() for c in batch.columns)):
                if here != part:
                    if keys:
                        yield flush()
                    part, number = here, 0
                new = np.frombuffer(packed, dtype=dtype)
                ids.append(new)
                keys.append(np.iinfo(np.int64).min if key_value is None else key_value)
                lengths.append(len(new))
                held += len(new)
                if held >= shard_ids:
                    yield flush()
        if keys:
            yield flush()

    named = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    encoded = named.select(_part(named, part_bytes).alias("part"), "key", "text").mapInArrow(
        encode, "part bigint, key bigint, ids binary"
    )
    ordered = encoded.repartition("part").sortWithinPartitions("part", "key", "ids")
    files = stored(ordered.mapInArrow(write, FILES), "token-manifest")
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("part").alias("_part"),
                         F.coalesce(F.sum("_n").over(earlier.orderBy("part")), F.lit(0)).alias("_before"))
    inside = F.coalesce(F.sum("n_ids").over(earlier.partitionBy("part").orderBy("number")), F.lit(0))
    return files.join(parts, F.col("part") == F.col("_part")).select(
        *files.columns, (F.col("_before") + inside).cast("long").alias("start")
    )


def _id_type(spark, tokenizer_path: str) -> tuple[type, int]:
    """Type of the ids of a tokenizer and how many bits they need. A task looks, so the driver never holds the vocabulary."""
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        for _ in batches:
            most = max(Tokenizer.from_file(tokenizer_path).get_vocab(with_added_tokens=True).values())
            yield pa.RecordBatch.from_arrays([pa.array([most], type=pa.int64())], names=["most"])

    most = spark.range(1, numPartitions=1).mapInArrow(look, "most bigint").first()["most"]
    return (np.uint16 if most < 1 << 16 else np.uint32), max(1, int(most).bit_length())


def read_token_files(files: DataFrame, key: str) -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of each text, from the files alone, each decoded by one task.

    The smallest key is read as null. Without files the result is empty.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _encoded()
        for row in (r for batch in batches for r in batch.to_pylist()):
            with _opened(row["path"]) as source:
                file = wavelet.TokenFile(source)
                ids = file.matrix.decode(np.uint16 if len(file.matrix.planes) <= 16 else np.uint32)
            ends = np.cumsum(file.lengths)
            crc = [
                zlib.crc32(ids[a:b].astype("<u4").view(np.uint8)) for a, b in zip((ends - file.lengths).tolist(), ends.tolist())
            ]
            yield pa.RecordBatch.from_arrays([
                pa.array(file.keys, mask=file.keys == np.iinfo(np.int64).min), pa.array(row["start"] + ends - file.lengths),
                pa.array(file.lengths), pa.array(crc, type=pa.int64()),
            ], names=[key, "start", "n_tokens", "ids_crc32"])

    return _dealt(files).mapInArrow(read, f"`{key}` bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def find_token(files: DataFrame, token: int, key: str) -> DataFrame:
    """(key, place, position) of every occurrence of a token id, from the planes alone.

    ``place`` counts from 0 within the text, ``position`` within all files. A file is read by its directory and the
    chunks that rank and select touch; ids are never decoded. A token that does not occur gives no row.
    """
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for r in batch.to_pylist()):
            with _opened(row["path"]) as source:
                file = wavelet.TokenFile(source)
                at = np.array(file.matrix.occurrences(token), dtype=np.int64)
            ends = np.cumsum(file.lengths)
            text = np.searchsorted(ends, at, side="right")
            keys = file.keys[text]
            yield pa.RecordBatch.from_arrays([
                pa.array(keys, mask=keys == np.iinfo(np.int64).min), pa.array(at - (ends - file.lengths)[text]),
                pa.array(row["start"] + at),
            ], names=[key, "place", "position"])

    return _dealt(files).mapInArrow(look, f"`{key}` bigint, place bigint, position bigint")


def _dealt(files: DataFrame) -> DataFrame:
    return files.select("path", "start").repartition(min(max(1, files.count()), MAX_READERS))


def _encoded() -> None:
    """All texts are encoded before files are written or read, so what this worker kept for it is of no more use."""
    if (tokens := sys.modules.get("silverlane.llm.tokens")) is not None:
        tokens.forget()


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def _opened(path: str):
    store, name = _store(path)
    return store.open_input_file(name)


def _make(folder: str) -> None:
    store, name = _store(folder)
    store.create_dir(name, recursive=True)
