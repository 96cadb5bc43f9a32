"""The trie of conversations: one node per distinct sequence of first turns, with totals of its subtree.

Turns are numbered within their conversation and reduced to hashes where they are read; a node is known by its depth
and 128 bits over all turns up to there, so a conversation of any length is never gathered. Subtree totals are passed
up by time-forward processing: nodes are sorted externally by reverse level order, and every node takes what its
children have put into a priority queue, adds its own and puts the sum in for its parent. Subtrees of at most a share of
all turns are shards, each worked on alone; their roots then send to the few nodes above all shards.

The queue keeps ``QUEUE_ROWS`` messages in memory and writes more to unnamed scratch files, as Spark's own sorts do; these
end with the task, so a task that is run again needs nothing of them.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverlane.llm.common import small_batches, stored

QUEUE_ROWS = 1 << 16
CELL_TURNS, BLOCK_TURNS = 1024, 1024
SHARDS_PER_PARTITION = 8
CHUNK_IDS = 4096
BROADCAST_ROWS = 200_000

_MESSAGE = struct.Struct("<6q")


class SpillQueue:
    """A priority queue of tuples of six integers that holds a bounded number of them in memory.

    What comes in beyond ``limit`` is written as a sorted run; the least of the heap and of the heads of all runs is the
    next one out.
    """

    def __init__(self, limit: int = QUEUE_ROWS):
        self.limit, self.heap, self.heads = limit, [], []

    def __len__(self) -> int:
        return len(self.heap) + len(self.heads)

    def push(self, message: tuple[int, ...]) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.limit:
            run = tempfile.TemporaryFile()
            self.heap.sort()
            for m in self.heap:
                run.write(_MESSAGE.pack(*m))
            run.seek(0)
            self.heap = []
            self._advance(run)

    def _advance(self, run) -> None:
        data = run.read(_MESSAGE.size)
        if data:
            heapq.heappush(self.heads, (_MESSAGE.unpack(data), id(run), run))
        else:
            run.close()

    def first(self) -> tuple[int, ...] | None:
        """The least message, left in place."""
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            return self.heads[0][0]
        return self.heap[0] if self.heap else None

    def pop(self) -> tuple[int, ...]:
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            message, _, run = heapq.heappop(self.heads)
            self._advance(run)
            return message
        return heapq.heappop(self.heap)


def turn_rows(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, at, h1, h2, size) of each turn: its place in its conversation from 0, 120 bits of (role, text), and the
    UTF-8 bytes of the text.

    Turns are ordered by ``turn``, null first, then role and text. A null role or text is empty; rows without a
    conversation are left out. Turns are sorted by ranges of CELL_TURNS turn numbers, so a conversation that holds most
    rows is numbered by many tasks.
    """
    cell = F.coalesce(F.floor(F.col("turn") / CELL_TURNS), F.lit(-(1 << 62)))
    rows = df.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    ).withColumn("cell", cell)
    cells = rows.groupBy("conv", "cell").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))
    offsets = cells.select(F.col("conv").alias("_conv"), F.col("cell").alias("_cell"), F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("conv", "cell").orderBy(F.asc_nulls_first("turn"), "role", "text"))
    # The length of the role keeps role and text apart.
    digest = F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"))
    placed = rows.select("conv", "cell", place.alias("place"), digest.alias("digest"), F.octet_length("text").cast("long").alias("size"))
    half = [F.conv(F.substring("digest", first, 15), 16, 10).cast("long") for first in (1, 16)]
    joined = placed.join(offsets, (F.col("conv") == F.col("_conv")) & (F.col("cell") == F.col("_cell")))
    return stored(joined.select(
        "conv", (F.col("_before") + F.col("place") - 1).alias("at"), half[0].alias("h1"), half[1].alias("h2"), "size"
    ), "trie-turns")


def whole_conversations(turns: DataFrame) -> DataFrame:
    """(conv, depth, length, h1, h2, size) of the conversations as they are; depth 0 stands for a conversation itself."""
    return with_shared_starts(turns, F.lit(0), 1)


def with_shared_starts(turns: DataFrame, shared: Column, every: int) -> DataFrame:
    """(conv, depth, length, h1, h2, size) of rebuilt conversations: the first ``shared`` turns (an expression of
    ``conv``) of conversation ``conv - conv % every``, all if it has fewer, none if there is none; then the own turns
    from that place on.

    A turn goes to less than ``every`` other conversations.
    """
    convs = turns.groupBy("conv").agg(F.count("*").alias("n")).select(
        "conv", "n", shared.cast("long").alias("h"), (F.col("conv") - F.col("conv") % every).alias("base"))
    convs = stored(convs, "trie-conversations")
    bases = convs.select(F.col("conv").alias("_base"), F.col("n").alias("_n"))
    convs = convs.join(bases, F.col("base") == F.col("_base"), "left").select(
        "conv", "h", "base", F.least("h", F.coalesce("_n", F.lit(0))).alias("taken"), "n"
    ).withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    convs = stored(convs, "trie-rebuilt")
    mine = convs.select(F.col("conv").alias("_conv"), "h", "taken", "length")
    own = turns.join(mine, F.col("conv") == F.col("_conv")).filter(F.col("at") >= F.col("h")).select(
        "conv", (F.col("taken") + F.col("at") - F.col("h") + 1).alias("depth"), "length", "h1", "h2", "size")
    wanted = convs.filter("taken > 0").select(
        F.col("conv").alias("_conv"), F.col("base").alias("_base"), "length",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("taken") - 1)).alias("_at"))
    first = turns.join(wanted, (F.col("conv") == F.col("_base")) & (F.col("at") == F.col("_at"))).select(
        F.col("_conv").alias("conv"), (F.col("at") + 1).alias("depth"), "length", "h1", "h2", "size")
    none = F.lit(0).cast("long")
    heads = convs.select("conv", none.alias("depth"), "length", none.alias("h1"), none.alias("h2"), none.alias("size"))
    return heads.unionAll(first).unionAll(own)


def _prefixes(rows: DataFrame) -> DataFrame:
    """Rows with the key (k1, k2) of their first ``depth`` turns and that (p1, p2) of one turn less.

    A key is the exclusive or of hashes of all turns with their depths; so it is gathered block by block, and a
    conversation over BLOCK_TURNS turns is spread over many tasks.
    """
    own = [F.when(F.col("depth") > 0, F.xxhash64(F.lit(salt), "depth", "h1", "h2")).otherwise(F.lit(0)) for salt in (1, 2)]
    block = F.floor(F.col("depth") / BLOCK_TURNS)
    rows = rows.select("conv", "depth", "length", "size", own[0].alias("z1"), own[1].alias("z2"), block.alias("block"))
    inside = Window.partitionBy("conv", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({"k1": F.bit_xor("z1").over(inside), "k2": F.bit_xor("z2").over(inside)})
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.filter(F.col("length") >= BLOCK_TURNS).groupBy("conv", "block").agg(
        F.bit_xor("z1").alias("x1"), F.bit_xor("z2").alias("x2"))
    blocks = blocks.select(F.col("conv").alias("_conv"), F.col("block").alias("_block"),
                           F.bit_xor("x1").over(earlier).alias("b1"), F.bit_xor("x2").over(earlier).alias("b2"))
    rows = rows.join(blocks, (F.col("conv") == F.col("_conv")) & (F.col("block") == F.col("_block")), "left")
    key = {f"k{i}": F.col(f"k{i}").bitwiseXOR(F.coalesce(f"b{i}", F.lit(0))) for i in (1, 2)}
    return rows.withColumns(key).select(
        "conv", "depth", "length", "size", "k1", "k2",
        F.col("k1").bitwiseXOR(F.col("z1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("z2")).alias("p2"))


_KEY = ("depth", "k1", "k2")
_TOTALS = "depth bigint, k1 bigint, k2 bigint, n_children bigint, n_leaves bigint, saved bigint"


def _pass_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals of nodes that come shard by shard in reverse level order, from (s1, s2, depth, k1, k2, p1, p2, saved,
    n_children, n_leaves), the last three without what is to come from nodes of the shard."""
    shard, queue = None, SpillQueue()
    for batch in batches:
        out = []
        for s1, s2, depth, k1, k2, p1, p2, saved, n_children, n_leaves in zip(*(c.to_pylist() for c in batch.columns)):
            if (s1, s2) != shard:
                shard, queue = (s1, s2), SpillQueue()  # what is left went from the shard's root to a node outside
            while (message := queue.first()) is not None and message[:3] == (-depth, k1, k2):
                queue.pop()
                n_children, n_leaves, saved = n_children + message[3], n_leaves + message[4], saved + message[5]
            n_leaves = n_leaves or 1
            queue.push((1 - depth, p1, p2, 1, n_leaves, saved))
            out.append((depth, k1, k2, n_children, n_leaves, saved))
        if out:
            names = [part.split()[0] for part in _TOTALS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in zip(*out)], names=names)


def _sent(nodes: DataFrame) -> DataFrame:
    """What nodes send to their parents, added up per parent."""
    return nodes.groupBy((F.col("depth") - 1).alias("_depth"), F.col("p1").alias("_k1"), F.col("p2").alias("_k2")).agg(
        F.count("*").alias("got_children"), F.sum("n_leaves").alias("got_leaves"), F.sum("saved").alias("got_saved"))


def _with_sent(nodes: DataFrame, sent: DataFrame) -> DataFrame:
    """Nodes with what they were sent added to their n_children, n_leaves and saved."""
    here = (F.col("depth") == F.col("_depth")) & (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2"))
    added = {name: F.col(name) + F.coalesce(f"got_{short}", F.lit(0))
             for name, short in (("n_children", "children"), ("n_leaves", "leaves"), ("saved", "saved"))}
    return nodes.join(sent, here, "left").withColumns(added).select(*nodes.columns)


def _small(side: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(side) if rows <= BROADCAST_ROWS else side


def _same_node(a: DataFrame, prefix: str):
    return a.select(*[F.col(c).alias(f"{prefix}{c}") for c in _KEY])


def _on(prefix: str) -> Column:
    return (F.col("depth") == F.col(f"{prefix}depth")) & (F.col("k1") == F.col(f"{prefix}k1")) & (F.col("k2") == F.col(f"{prefix}k2"))


def trie(rows: DataFrame, shard_rows: int | None = None) -> DataFrame:
    """One row per node: conv_id (its smallest member; with depth it names the turns), depth, parent_conv_id, n_convs
    (members), n_children, n_leaves (childless nodes of its subtree), saved_tokens (bytes of last texts not kept twice,
    over its subtree), ends_sha256 (of the conversations that end here, ascending, comma-joined).

    ``rows`` comes from ``whole_conversations`` or ``with_shared_starts``. The root has depth 0 and no parent; without
    conversations the result is empty. Nodes with one member are the rest of one conversation and need no totals from
    below. Of the others, those with more than ``shard_rows`` turns in or below them (the share of an eighth of a shuffle
    partition, if not given) stand above all shards: fewer than eight a shuffle partition on any level. They are
    worked on last, by one task that holds QUEUE_ROWS messages at most.
    """
    spark = rows.sparkSession
    small_batches(spark)
    rows = stored(_prefixes(rows), "trie-rows")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    limit = shard_rows or max(1000, rows.count() // (SHARDS_PER_PARTITION * partitions))
    nodes = rows.groupBy(*_KEY).agg(
        F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.max("p1").alias("p1"), F.max("p2").alias("p2"),
        F.max("size").alias("size"), F.sum(F.col("length") - F.col("depth") + 1).alias("below"),
        F.max("length").alias("length"), F.count_if(F.col("length") == F.col("depth")).alias("n_ends"))
    none = F.lit(0).cast("long")
    nodes = stored(nodes.select(
        *_KEY, "p1", "p2", "conv_id", "n_convs", "n_ends", "below", ((F.col("n_convs") - 1) * F.col("size")).alias("saved"),
        F.when(F.col("n_convs") == 1, (F.col("length") > F.col("depth")).cast("long")).otherwise(none).alias("n_children"),
        F.when(F.col("n_convs") == 1, F.lit(1)).otherwise(0).cast("long").alias("n_leaves")), "trie-nodes")
    tails = nodes.filter("n_convs = 1")
    shared = stored(_with_sent(nodes.filter("n_convs > 1"), _sent(tails)), "trie-shared")
    above, inside = shared.filter(F.col("below") > limit), shared.filter(F.col("below") <= limit)
    n_above = above.count()

    # The shard of a node is the first node below all high ones on the way to it, which is the same for its smallest member.
    high = rows.join(_small(_same_node(above, "_"), n_above), _on("_")).groupBy("conv").agg(F.max("depth").alias("_high"))
    high = high.select(F.col("conv").alias("_of"), "_high")
    tops = rows.join(high, F.col("conv") == F.col("_of"), "left").filter(
        F.col("depth") == F.coalesce("_high", F.lit(-1)) + 1).select(
        F.col("conv").alias("_rep"), F.col("k1").alias("s1"), F.col("k2").alias("s2"))
    sharded = inside.join(tops, F.col("conv_id") == F.col("_rep"))
    columns = ["s1", "s2", *_KEY, "p1", "p2", "saved", "n_children", "n_leaves"]
    order = ["s1", "s2", F.desc("depth"), "k1", "k2"]
    low_totals = stored(sharded.select(*columns).repartition("s1", "s2").sortWithinPartitions(*order).mapInArrow(
        _pass_up, _TOTALS), "trie-low")

    # Roots of shards send to the nodes above, added up per node first.
    parents = _same_node(above, "_up_")
    low = low_totals.join(inside.select(*[F.col(c).alias(f"_{c}") for c in _KEY], "p1", "p2"), _on("_"))
    roots = low.join(_small(parents, n_above), (F.col("depth") - 1 == F.col("_up_depth")) & (F.col("p1") == F.col("_up_k1"))
                     & (F.col("p2") == F.col("_up_k2")), "left_semi")
    top = _with_sent(above, _sent(roots)).select(none.alias("s1"), none.alias("s2"), *columns[2:])
    high_totals = top.repartition(1).sortWithinPartitions(*order).mapInArrow(_pass_up, _TOTALS)

    own = tails.select(*[c.split()[0] for c in _TOTALS.split(", ")])
    totals = low_totals.unionByName(high_totals).unionByName(own).select(
        *[F.col(c).alias(f"_{c}") for c in _KEY], "n_children", "n_leaves", F.col("saved").alias("saved_tokens"))
    whole = nodes.drop("n_children", "n_leaves", "saved").join(totals, _on("_")).drop(*[f"_{c}" for c in _KEY])
    up = nodes.select((F.col("depth") + 1).alias("_depth"), F.col("k1").alias("_p1"), F.col("k2").alias("_p2"),
                      F.col("conv_id").alias("parent_conv_id"))
    whole = whole.join(up, (F.col("depth") == F.col("_depth")) & (F.col("p1") == F.col("_p1")) & (F.col("p2") == F.col("_p2")), "left")
    ends = _ends(rows, nodes).select(*[F.col(c).alias(f"_end_{c}") for c in _KEY], "ends_sha256")
    return whole.join(ends, _on("_end_"), "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"))


def _ends(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """(key, ends_sha256) of the nodes where conversations end.

    Up to CHUNK_IDS conversations are put in order in place. The ids of nodes with more are sorted over all tasks and
    joined to pieces there; one task per node then only hashes the pieces, one after the other.
    """
    many = stored(_same_node(nodes.filter(F.col("n_ends") > CHUNK_IDS), "_many_"), "trie-many")
    n_many = many.count()
    ending = rows.filter(F.col("length") == F.col("depth")).select(*_KEY, "conv")
    few = ending.join(_small(many, n_many), _on("_many_"), "left_anti") if n_many else ending
    ids = F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string"))
    hashed = few.groupBy(*_KEY).agg(F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("ends_sha256"))
    if not n_many:
        return hashed
    hot = ending.join(_small(many, n_many), _on("_many_"), "left_semi")
    pieces = hot.repartitionByRange(*_KEY, "conv").sortWithinPartitions(*_KEY, "conv").mapInArrow(
        _pieces, "depth bigint, k1 bigint, k2 bigint, first bigint, ids string")
    pieces = stored(pieces, "trie-pieces").repartition(*_KEY).sortWithinPartitions(*_KEY, "first")
    return hashed.unionByName(pieces.mapInArrow(_hash_pieces, "depth bigint, k1 bigint, k2 bigint, ends_sha256 string"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, first id, ids joined by commas) of ascending ids, CHUNK_IDS at a time."""
    names = [*_KEY, "first", "ids"]
    node, held = None, []

    def piece() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(names, (*node, held[0], ",".join(map(str, held)))))])

    for batch in batches:
        for *key, conv in zip(*(c.to_pylist() for c in batch.columns)):
            if held and (key != node or len(held) == CHUNK_IDS):
                yield piece()
                held = []
            node = key
            held.append(conv)
    if held:
        yield piece()


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of all pieces of each node, which come in order."""
    node, state = None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip((*_KEY, "ends_sha256"), (*node, state.hexdigest())))])

    for batch in batches:
        for *key, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if key != node:
                if node is not None:
                    yield done()
                node, state = key, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
    if node is not None:
        yield done()
