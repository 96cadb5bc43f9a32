"""CSV with line breaks in quotes, and JSON documents, read by many tasks a file.

Where a record begins depends on all bytes before it: a line break may stand in quotes, a brace in a string. So a file is
cut into byte ranges and read twice. The first pass says, for every state a range may begin in, the state it ends in; one
small row a range is put together in order, and then the state at the start of each range is known. In the second pass each
range gives the records that begin in it, reading on past its end until the last one is whole. Field values come from
Spark's own ``from_csv`` and ``from_json``.

A record is held whole in the task that reads it, and a task holds one range (``RANGE_BYTES``) and a few arrays over its
quotes and brackets. A quote that is never closed takes the rest of its file as one field, as in Spark's reader. Files are
opened by pyarrow, which must know the file system; compressed files have no ranges and are refused.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlane.columns import ROW_SEQ
from silverlane.session import work_path
from silverlane.sources.readers import CORRUPT

RANGE_BYTES = 32 << 20
MAX_TASKS = 20_000
BATCH_BYTES = 4 << 20
READ_ON_BYTES = 1 << 20
COMPRESSED = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate", ".xz")
_RECORDS = f"_source_file string, {ROW_SEQ} bigint, _head boolean, _text string"
_BOM = b"\xef\xbb\xbf"
_LOCAL = 1 << 10


class _Bytes:
    """Bytes of one file by position."""

    def __init__(self, path: str):
        store, name = fs.FileSystem.from_uri(re.sub("^s3a:", "s3:", re.sub("^file:/+", "file:///", path)))
        self.file = store.open_input_file(name)

    def __enter__(self) -> "_Bytes":
        return self

    def __exit__(self, *_) -> None:
        self.file.close()

    def read(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)


def file_ranges(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES, glob: str | None = None) -> DataFrame:
    """(path, length, before, at, last) per range: where it begins, whether it ends its file, and the bytes of all files
    that come before by path. Files are listed, not opened."""
    if range_bytes <= len(_BOM):
        raise ValueError("a range must be longer than a byte order mark")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = (reader.option("pathGlobFilter", glob) if glob else reader).load(path).select("path", "length")
    earlier = Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    placed = files.withColumn("before", F.coalesce(F.sum("length").over(earlier), F.lit(0)))
    at = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(range_bytes).cast("long")))
    return placed.withColumn("at", at).withColumn("last", F.col("at") + range_bytes >= F.col("length"))


def _spread(ranges: DataFrame) -> DataFrame:
    """One task per range; the rows are so small that adaptive execution would put them all into one."""
    return ranges.repartition(max(1, min(MAX_TASKS, ranges.count())))


def _stored(ranges: DataFrame) -> DataFrame:
    path = work_path(ranges.sparkSession, "ranges")
    ranges.write.parquet(path)
    return ranges.sparkSession.read.parquet(path)


def compressed(path: str) -> bool:
    return path.lower().endswith(COMPRESSED)


def has_compressed(spark: SparkSession, path: str, glob: str | None = None) -> bool:
    """Whether a file under the path is compressed, going by its name."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = (reader.option("pathGlobFilter", glob) if glob else reader).load(path).select(F.lower("path").alias("path"))
    wanted = F.lit(False)
    for ending in COMPRESSED:
        wanted = wanted | F.col("path").endswith(ending)
    return bool(files.filter(wanted).limit(1).count())


def _batches(records: Iterator[tuple[str, int, bool, bytes]]) -> Iterator[pa.RecordBatch]:
    names = ["_source_file", ROW_SEQ, "_head", "_text"]

    def batch(rows):
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.bool_(), pa.string()))]
        return pa.RecordBatch.from_arrays(columns, names=names)

    rows, size = [], 0
    for path, at, head, text in records:
        rows.append((path, at, head, text.decode("utf-8", "replace")))
        size += len(text) + 64
        if size >= BATCH_BYTES:
            yield batch(rows)
            rows, size = [], 0
    if rows:
        yield batch(rows)


# --- CSV -----------------------------------------------------------------------------------------------------------

# States before a byte: at the start of a record, of another field, in a field without quotes, in quotes, and after a
# quote in quotes, which ends the quoted part unless a second one follows.
RECORD, FIELD, PLAIN, QUOTED, QUOTE = range(5)
_IN_QUOTES = rb'[^"]*+(?:""[^"]*+)*+'
_VALUE = rb'(?:"' + _IN_QUOTES + rb'"()[^,\n]*+|[^",\n][^,\n]*+)'
_RUN = re.compile(rb'[^,\n]*+(?:[,\n]' + _VALUE + rb'?+)*+')
_TAIL = re.compile(_IN_QUOTES)
_REST = rb'(?:,' + _VALUE + rb'?+)*+\n'
_FULL_RECORD = re.compile(_VALUE + rb'?+' + _REST)
_PLAIN_REST = re.compile(rb'[^,\n]*+' + _REST)


def _begin(data: bytes, state: int) -> tuple[int, int]:
    """The same state as PLAIN or QUOTED, and the byte from which it holds."""
    if state == QUOTED:
        return QUOTED, 0
    return (QUOTED, 1) if state != PLAIN and data[:1] == b'"' else (PLAIN, 0)


def csv_end_state(data: bytes, state: int) -> int:
    """The state after ``data``."""
    if not data:
        return state
    kind, at = _begin(data, state)
    if kind == QUOTED:
        at = _TAIL.match(data, at).end()
        if at >= len(data):
            return QUOTED
        at += 1
        if at == len(data):
            return QUOTE
    run = _RUN.match(data, at)
    if run.end() < len(data):
        return QUOTED
    if run.end(1) == len(data):
        return QUOTE
    return {10: RECORD, 44: FIELD}.get(data[-1], PLAIN)


def csv_first_record(data: bytes, state: int) -> int:
    """Where the first record begins in ``data``; its length if none does."""
    if state == RECORD:
        return 0
    kind, at = _begin(data, state)
    if kind == QUOTED:
        at = _TAIL.match(data, at).end() + 1
    rest = _PLAIN_REST.match(data, at) if at <= len(data) else None
    return rest.end() if rest else len(data)


def _csv_states(ranges: DataFrame, range_bytes: int) -> DataFrame:
    def passed(batches):
        for batch in batches:
            paths, starts = batch.column("path").to_pylist(), batch.column("at").to_pylist()
            ends = []
            for path, at in zip(paths, starts):
                with _Bytes(path) as file:
                    data = file.read(at, range_bytes)
                data = data.removeprefix(_BOM) if at == 0 else data
                known: dict[tuple[int, int], int] = {}
                for state in (RECORD, FIELD, PLAIN, QUOTED, QUOTE):
                    begin = _begin(data, state)
                    if begin not in known:
                        known[begin] = csv_end_state(data, state)
                ends.append([known[_begin(data, s)] for s in (RECORD, FIELD, PLAIN, QUOTED, QUOTE)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.list_(pa.int32()))],
                names=["path", "at", "ends"])

    def composed(rows: pd.DataFrame) -> pd.DataFrame:
        rows, state, states = rows.sort_values("at"), RECORD, []
        for ends in rows["ends"]:
            state = int(ends[state])
            states.append(state)
        return pd.DataFrame({"of": rows["path"], "next": rows["at"] + range_bytes, "state": states})

    ends = _spread(ranges.filter(~F.col("last")).select("path", "at")).mapInArrow(passed, "path string, at bigint, ends array<int>")
    states = ends.groupBy("path").applyInPandas(composed, "of string, next bigint, state int")
    joined = ranges.join(states, (F.col("path") == F.col("of")) & (F.col("at") == F.col("next")), "left")
    return joined.select(*ranges.columns, F.coalesce("state", F.lit(RECORD)).alias("state"))


def _csv_range(file: _Bytes, at: int, size: int, length: int, state: int) -> Iterator[tuple[int, bytes]]:
    """(place, text) of every record that begins in a range; empty ones are left out."""
    data = file.read(at, size)
    own = len(data)
    here = csv_first_record(data, state)
    if at == 0 and data.startswith(_BOM):
        here = len(_BOM)
    base, more = at, READ_ON_BYTES
    while base + here < at + own:
        found = _FULL_RECORD.match(data, here)
        if found:
            stop = following = found.end()
            stop -= 1
        elif base + len(data) < length:
            data, base, here = data[here:] + file.read(base + len(data), more), base + here, 0
            more *= 2
            continue
        else:
            stop = following = len(data)
        text = data[here:stop].removesuffix(b"\r")
        if text:
            yield base + here, text
        here = following


def csv_records(
    spark: SparkSession, path: str, header: list[str] | None | bool = True, range_bytes: int = RANGE_BYTES, glob: str | None = None,
) -> DataFrame:
    """(_source_file, _row_seq, _head, _text) of every record of the CSV files under a path.

    ``_row_seq`` is the place in the file plus the bytes of all files before it. ``_head`` marks the first record of a file if there is a ``header``; a list of names is held against it.
    """
    ranges = _stored(_csv_states(file_ranges(spark, path, range_bytes, glob), range_bytes))
    names = header if isinstance(header, list) else None

    def records(path, before, at, length, state):
        if compressed(path):
            raise ValueError(f"a compressed file has no byte ranges: {path}")
        with _Bytes(path) as file:
            head = bool(header) and at == 0
            for place, text in _csv_range(file, at, range_bytes, length, state):
                if head and names is not None:
                    found = next(csv.reader([text.decode("utf-8", "replace")]))
                    if [n.lower() for n in found] != [n.lower() for n in names]:
                        raise ValueError(f"header {found} is not {names}: {path}")
                yield path, before + place, head, text
                head = False

    def read(batches):
        for batch in batches:
            for row in batch.select(["path", "before", "at", "length", "state"]).to_pylist():
                yield from _batches(records(**row))

    return _spread(ranges).mapInArrow(read, _RECORDS)


def _inferred_csv(spark: SparkSession, records: DataFrame, header: bool) -> T.StructType:
    reader = spark.read.options(inferSchema=True, quote='"', escape='"', multiLine=True)
    found = reader.csv(records.filter(~F.col("_head")).select("_text").rdd.map(lambda r: r[0])).schema
    first = records.filter("_head").select("_text").first() if header else None
    names = next(csv.reader([first[0]])) if first else found.names
    types = [f.dataType for f in found.fields] + [T.StringType()] * len(names)
    return T.StructType([T.StructField(n, t) for n, t in zip(names, types)])


def scan_csv_ranges(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, keep_rejected: bool = False, header: bool = True,
    range_bytes: int = RANGE_BYTES, glob: str | None = None, places: bool = False,
) -> DataFrame:
    """What ``scan_csv`` gives with ``multi_line``, by many tasks a file; records end with LF or CR LF.

    With ``places`` the columns ``_source_file`` and ``_row_seq`` come too: order by file path and place in the file.
    Without a schema one is inferred in a further pass. A header must hold the names of a given schema. Files without
    records give no rows.
    """
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    records = csv_records(spark, path, (fields.names if fields else True) if header else False, range_bytes, glob)
    if fields is None:
        fields = _inferred_csv(spark, records, header)
    options = {"quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
    wanted = fields
    if keep_rejected:
        options["columnNameOfCorruptRecord"] = CORRUPT
        wanted = T.StructType([*fields.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = records.filter(~F.col("_head")).withColumn("_row", F.from_csv("_text", F.lit(_ddl(wanted)), options))
    return parsed.select("_row.*", *(["_source_file", ROW_SEQ] if places else []))


def _ddl(fields: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in fields.fields)


# --- JSON ----------------------------------------------------------------------------------------------------------


def _json_marks(data: bytes, escaped: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of quotes that are not escaped; places of brackets, in strings or not, and +1 or -1 for each."""
    codes = np.frombuffer(data, np.uint8)
    quotes, slashes = np.flatnonzero(codes == 34), np.flatnonzero(codes == 92)
    skipped = [np.array([0])] if escaped and (not len(slashes) or slashes[0] > 0) else []
    if len(slashes):
        gap = np.diff(slashes) > 1
        first, last = slashes[np.append(True, gap)], slashes[np.append(gap, True)]
        odd = (last - first + 1 + (escaped & (first == 0))) % 2 == 1
        skipped.append(last[odd] + 1)
    if skipped:
        quotes = np.setdiff1d(quotes, np.concatenate(skipped), assume_unique=True)
    lowered = codes | 32
    brackets = np.flatnonzero((lowered == 123) | (lowered == 125))
    return quotes, brackets, np.where(lowered[brackets] == 123, 1, -1)


def _escaped(file: _Bytes, at: int) -> bool:
    """Whether an odd number of backslashes stands before a place."""
    run, size = 0, _LOCAL
    while at - run > 0:
        piece = file.read(max(0, at - run - size), min(size, at - run))
        kept = piece.rstrip(b"\\")
        run += len(piece) - len(kept)
        if kept:
            break
        size *= 2
    return run % 2 == 1


def _byte_before(file: _Bytes, at: int) -> bytes:
    """The last byte before a place that is no white space."""
    while at > 0:
        piece = file.read(max(0, at - _LOCAL), min(_LOCAL, at))
        if piece.rstrip():
            return piece.rstrip()[-1:]
        at -= len(piece)
    return b""


def _json_base(file: _Bytes, length: int, path: str) -> int:
    """Depth of the objects that are rows: 1 in a list, 0 for a single object."""
    at = 0
    while at < length:
        piece = file.read(at, _LOCAL)
        first = (piece.removeprefix(_BOM) if at == 0 else piece).strip()[:1]
        if first in (b"[", b"{"):
            return 1 if first == b"[" else 0
        if first:
            break
        at += len(piece)
    raise ValueError(f"not a JSON object or list of objects: {path}")


def _json_states(ranges: DataFrame, range_bytes: int) -> DataFrame:
    def passed(batches):
        for batch in batches:
            paths, starts = batch.column("path").to_pylist(), batch.column("at").to_pylist()
            out = []
            for path, at in zip(paths, starts):
                with _Bytes(path) as file:
                    data, escaped = file.read(at, range_bytes), _escaped(file, at)
                quotes, brackets, steps = _json_marks(data, escaped)
                odd = np.searchsorted(quotes, brackets) % 2 == 1
                out.append((len(quotes) % 2, int(steps[~odd].sum()), int(steps[odd].sum())))
            columns = [pa.array(c, pa.int64()) for c in zip(*out)] if out else [pa.array([], pa.int64())] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), pa.array(starts, pa.int64()), *columns], names=["path", "at", "flips", "plain", "inside"])

    seen = _spread(ranges.select("path", "at")).mapInArrow(
        passed, "path string, at bigint, flips bigint, plain bigint, inside bigint")
    earlier = Window.partitionBy("path").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    in_string = F.coalesce(F.sum("flips").over(earlier), F.lit(0)) % 2
    states = seen.withColumn("in_string", in_string).withColumn("step", F.when(F.col("in_string") == 0, F.col("plain")).otherwise(F.col("inside")))
    states = states.select(
        F.col("path").alias("of"), F.col("at").alias("start"), "in_string",
        F.coalesce(F.sum("step").over(earlier), F.lit(0)).alias("depth"))
    joined = ranges.join(states, (F.col("path") == F.col("of")) & (F.col("at") == F.col("start")))
    return joined.select(*ranges.columns, "in_string", "depth")


def _json_objects(data: bytes, escaped: bool, in_string: int, depth: int, base: int) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Places where objects of the wanted depth open and where they have closed, and the state at the end."""
    quotes, brackets, steps = _json_marks(data, escaped)
    outside = (np.searchsorted(quotes, brackets) + in_string) % 2 == 0
    brackets, steps = brackets[outside], steps[outside]
    after = depth + np.cumsum(steps)
    codes = np.frombuffer(data, np.uint8)[brackets]
    opened = brackets[(codes == 123) & (after == base + 1)]
    closed = brackets[(codes == 125) & (after == base)] + 1
    return opened, closed, (in_string + len(quotes)) % 2, int(after[-1]) if len(after) else depth


def _json_range(file: _Bytes, path: str, at: int, size: int, length: int, in_string: int, depth: int) -> Iterator[tuple[int, bytes]]:
    """(place, text) of every object that begins in a range."""
    problem = ValueError(f"not a JSON object or list of objects: {path}")
    base = _json_base(file, length, path)
    data = file.read(at, size)
    opened, closed, string_after, depth_after = _json_objects(data, _escaped(file, at), in_string, depth, base)
    if at + size >= length and (string_after or depth_after):
        raise problem
    within = bool(in_string) or depth > base
    if within and len(closed):
        here, closed = int(closed[0]), closed[1:]
    else:
        here = len(data) if within else 0

    def check(between: bytes, at_start: bool = False) -> None:
        left = (between.removeprefix(_BOM) if at_start else between).translate(None, b" \t\r\n")
        if left.strip(b",") not in ((b"", b"[", b"]", b"[]") if base else (b"",)) or len(left) > 3 or b",," in left:
            raise problem

    for i, start in enumerate(opened.tolist()):
        check(data[here:start], at + here == 0)
        if base and (data[here:start].rstrip()[-1:] or _byte_before(file, at + here)) not in (b",", b"["):
            raise problem
        if i < len(closed):
            here = int(closed[i])
            yield at + start, data[start:here]
            continue
        text, more = data[start:], READ_ON_BYTES
        here = len(data)
        while True:
            extra = file.read(at + start + len(text), more)
            if not extra:
                raise problem
            text, more = text + extra, more * 2
            ends = _json_objects(text, False, 0, 0, 0)[1]
            if len(ends):
                yield at + start, text[:int(ends[0])]
                break
    check(data[here:], at + here == 0)


def scan_json_ranges(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, range_bytes: int = RANGE_BYTES,
    glob: str | None = None, places: bool = False,
) -> DataFrame:
    """What ``scan_json`` gives for documents, by many tasks a file: a row per object of the list, or the one object.

    Lists in lists, values that are no objects, and documents that do not close are errors. With ``places`` the columns
    ``_source_file`` and ``_row_seq`` come too. Without a schema one is inferred in a further pass.
    """
    ranges = _stored(_json_states(file_ranges(spark, path, range_bytes, glob), range_bytes))

    def read(batches):
        for batch in batches:
            for row in batch.select(["path", "before", "at", "length", "in_string", "depth"]).to_pylist():
                if compressed(row["path"]):
                    raise ValueError(f"a compressed file has no byte ranges: {row['path']}")
                with _Bytes(row["path"]) as file:
                    found = _json_range(file, row["path"], row["at"], range_bytes, row["length"], row["in_string"], row["depth"])
                    yield from _batches((row["path"], row["before"] + place, False, text) for place, text in found)

    records = _spread(ranges).mapInArrow(read, _RECORDS)
    if schema is None:
        schema = spark.read.json(records.select("_text").rdd.map(lambda r: r[0])).schema
        if schema.names == [CORRUPT] or not schema.names:
            raise ValueError(f"not a JSON object or list of objects: {path}")
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    parsed = records.withColumn("_row", F.from_json("_text", fields, {"mode": "FAILFAST"}))
    return parsed.select("_row.*", *(["_source_file", ROW_SEQ] if places else []))
