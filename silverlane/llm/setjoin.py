"""N-gram Jaccard join: which texts share so many word n-grams that their sets reach a Jaccard similarity.

Sets are ordered rarest n-gram first, by counts of hash buckets (a table of fixed size, summed over all texts; any one
order is right, rare first is fast). Two sets that are similar enough share an n-gram in their prefixes, so only
prefixes are joined. Before a pair is verified, once, on the whole sets, it must pass

* the length filter: the smaller set has at least the wanted share of the larger;
* the positional filter: what can follow the shared n-gram in both orders is enough for the overlap;
* the suffix filter: n-grams fall into 512 classes by hash, and sets differ in at least as many n-grams as there are
  classes whose counts differ in parity.

Large groups are joined in rounds, so that they cost no square of their size in pairs: first every set meets two leaders
of each shared prefix n-gram (``LEADER_ROUNDS`` times, where one is still shared by several components); at last only
sets that are still in different components meet. Equal sets are one
set throughout. Links are found by 64-bit hashes of n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlane.functions.skew import attach_by_key
from silverlane.llm import words as W
from silverlane.llm.common import BROADCAST_KEYS, give_back, small_batches, stored, without_keys
from silverlane.llm.components import components

RARITY_BITS = 20
CHUNK_BITS = 14
PARITY_LONGS = 8
MEMBERS_PER_TASK = 4096
LEADER_ROUNDS = 1
LEADER_KINDS = 8
SEND_BYTES = 4 << 20

_PARITY = [f"p{i}" for i in range(PARITY_LONGS)]
_MEASURED = "key bigint, n bigint, same_a bigint, same_b bigint, chunk int, counts binary"


def ngram_sets(texts: W.Texts, n: int) -> list[np.ndarray]:
    """Distinct hashes of the word n-grams of each text, ascending; a shorter text is one n-gram, an empty one none."""
    found = W.split(texts, W.NOT_SPACE, W.LOWER)
    hashes, _, owner = W.windows(found, n)
    bounds = np.searchsorted(owner, np.arange(len(found.begins)))
    out = []
    for row, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        if a < b:
            values = np.sort(hashes[a:b])
            out.append(values[np.concatenate([[True], values[1:] != values[:-1]])])
        else:
            own = found.hashes[found.begins[row] : found.begins[row + 1]]
            out.append(W.sequence_hashes(own, len(own)) if len(own) else own)
    return out


def _measure(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """Size and signature of each set, and per task how many sets have an n-gram of each rarity bucket."""
    give_back()
    counts = np.zeros(1 << RARITY_BITS, dtype=np.uint32)
    schema = pa.schema([("key", pa.int64()), ("n", pa.int64()), ("same_a", pa.int64()), ("same_b", pa.int64()),
                        ("chunk", pa.int32()), ("counts", pa.binary())])
    for batch in batches:
        sizes, a, b = [], [], []
        for texts in W.slices(batch.column(1)):
            for s in ngram_sets(texts, n):
                sizes.append(len(s))
                a.append(int(W.mix(s).sum(dtype=np.uint64).view(np.int64)))
                b.append(int(W.mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)))
                np.add.at(counts, (s >> np.uint64(64 - RARITY_BITS)).astype(np.int64), 1)
        nothing = pa.nulls(batch.num_rows)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), pa.array(sizes, type=pa.int64()), pa.array(a, type=pa.int64()),
             pa.array(b, type=pa.int64()), nothing.cast(pa.int32()), nothing.cast(pa.binary())], schema=schema)
    pack, parts = zstandard.ZstdCompressor(level=1), counts.reshape(-1, 1 << CHUNK_BITS)
    rows = np.flatnonzero(parts.any(axis=1))
    nothing = pa.nulls(len(rows), pa.int64())
    yield pa.RecordBatch.from_arrays(
        [nothing] * 4 + [pa.array(rows, type=pa.int32()), pa.array([pack.compress(parts[r].tobytes()) for r in rows], type=pa.binary())],
        schema=schema)


def _sum_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            new = np.frombuffer(unpack.decompress(counts), dtype=np.uint32).astype(np.int64)
            sums[chunk] = sums.get(chunk, 0) + new
    for chunk, total in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([chunk], type=pa.int32()), pa.array([np.minimum(total, (1 << 32) - 1).astype(np.uint32).tobytes()])],
            names=["chunk", "counts"])


def prefix_length(size: int, num: int, den: int) -> int:
    """N-grams of which one must be shared: all but the least overlap with a similar set, and one more."""
    return size - -(-num * size // den) + 1


def _prefixes(batches: Iterator[pa.RecordBatch], shared, n: int, num: int, den: int) -> Iterator[pa.RecordBatch]:
    give_back()
    rarity = shared.value
    for batch in batches:
        tokens, sizes, parities = [], [], []
        for texts in W.slices(batch.column(1)):
            for s in ngram_sets(texts, n):
                order = np.lexsort((s, rarity[(s >> np.uint64(64 - RARITY_BITS)).astype(np.int64)]))
                tokens.append(s[order[: prefix_length(len(s), num, den) if len(s) else 0]].view(np.int64))
                sizes.append(len(s))
                odd = np.bincount((W.mix(s) >> np.uint64(55)).astype(np.int64), minlength=64 * PARITY_LONGS) & 1
                parities.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
        flat = pa.array(np.concatenate(tokens) if tokens else np.zeros(0, dtype=np.int64))
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int32)
        parity = np.array(parities, dtype=np.int64).reshape(-1, PARITY_LONGS)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), pa.array(sizes, type=pa.int32()), pa.ListArray.from_arrays(offsets, flat),
             *(pa.array(np.ascontiguousarray(parity[:, i])) for i in range(PARITY_LONGS))],
            names=["key", "n", "tokens", *_PARITY])


def _may_link(num: int, den: int, x: str, y: str, places: bool = True, parity: bool = True) -> Column:
    """The filters of a pair, on the columns of either side by prefix."""
    nx, ny = F.col(f"{x}n").cast("long"), F.col(f"{y}n").cast("long")
    need = F.ceil((num * (nx + ny)) / F.lit(num + den))
    out = (F.least(nx, ny) * den >= F.greatest(nx, ny) * num)
    if places:
        out = out & (F.least(nx - F.col(f"{x}place"), ny - F.col(f"{y}place")) >= need)
    if parity:
        apart = reduce(lambda a, b: a + b, [F.bit_count(F.col(f"{x}{p}").bitwiseXOR(F.col(f"{y}{p}"))) for p in _PARITY])
        out = out & (apart <= nx + ny - 2 * need)
    return out


def _with_key(docs: DataFrame, keys: DataFrame, how: str, on: str) -> DataFrame:
    """Join whole texts with some keys: by broadcast up to BROADCAST_KEYS of them, by shuffle beyond."""
    side = F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys
    return docs.join(side, F.col("key") == F.col(on), how)


def _verified(docs: DataFrame, pairs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar. Sets travel once per pair, to the end with more pairs."""
    pairs = stored(pairs, "pairs")
    ends = pairs.select(F.col("a").alias("k")).unionAll(pairs.select(F.col("b").alias("k"))).groupBy("k").agg(F.count("*").alias("c"))
    counted = pairs.join(ends.select(F.col("k").alias("ka"), F.col("c").alias("ca")), F.col("a") == F.col("ka")).join(
        ends.select(F.col("k").alias("kb"), F.col("c").alias("cb")), F.col("b") == F.col("kb"))
    to_a = F.col("ca") >= F.col("cb")
    sent = counted.select(
        F.when(to_a, F.col("b")).otherwise(F.col("a")).alias("k"), F.when(to_a, F.col("a")).otherwise(F.col("b")).alias("host"),
        F.ceil(F.greatest("ca", "cb") / MEMBERS_PER_TASK).cast("int").alias("parts"),
    ).withColumn("part", F.pmod(F.xxhash64("k"), F.col("parts")).cast("int"))
    visits = sent.select("k", "host", "part", F.lit(False).alias("own"))
    hosts = sent.select(F.col("host").alias("k"), "host", "part", F.lit(True).alias("own"))
    errands = stored(visits.unionAll(hosts).groupBy("k").agg(F.collect_set(F.struct("host", "part", "own")).alias("errands")), "errands")
    bound = _with_key(docs, errands, "inner", "k").select("key", "text", "errands")
    sets = bound.mapInArrow(lambda b: _errand_rows(b, n), "key bigint, host bigint, part int, own boolean, grams binary")
    dealt = sets.repartition("host", "part").sortWithinPartitions("host", "part", F.desc("own"))
    return dealt.mapInArrow(lambda b: _compare(b, num, den), "a bigint, b bigint")


def _errand_rows(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    types = (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary())

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, type=t) for c, t in zip(columns, types)], names=["key", "host", "part", "own", "grams"])

    give_back()
    rows, size = [], 0
    for batch in batches:
        errands, keys = batch.column(2).to_pylist(), batch.column(0).to_pylist()
        for texts in W.slices(batch.column(1)):
            for i, s in enumerate(ngram_sets(texts, n), texts.first):
                data = s.tobytes()
                for e in errands[i]:
                    rows.append((keys[i], e["host"], e["part"], e["own"], data))
                    size += len(data)
                    if size >= SEND_BYTES:
                        yield batch_of(rows)
                        rows, size = [], 0
    if rows:
        yield batch_of(rows)


def _compare(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """A host's own set comes before those that visit it."""
    give_back()
    host, own = None, np.zeros(0, dtype=np.uint64)
    for batch in (whole.slice(low, 256) for whole in batches for low in range(0, whole.num_rows, 256)):
        found = []
        for key, at, is_own, grams in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4))):
            other = np.frombuffer(grams, dtype=np.uint64)
            if is_own:
                host, own = at, other
                continue
            if at != host or not len(own):
                continue
            near = np.minimum(np.searchsorted(own, other), len(own) - 1)
            both = int((own[near] == other).sum())
            if den * both >= num * (len(own) + len(other) - both):
                found.append((key, at))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in zip(*found)], names=["a", "b"])


def jaccard_groups(df: DataFrame, key: str, text: str, n: int, num: int, den: int) -> DataFrame:
    """(key, n_shingles, component_id) of each row.

    Words are runs of bytes other than ASCII white space, A-Z lower-cased. Two texts are linked when
    den * intersection >= num * union of their distinct word n-grams; a text of fewer words is one n-gram.
    ``component_id`` is the least key reachable by links, itself included. Null and empty texts have 0 n-grams and no
    links, and so have rows without a key, whose component is null. Rows with the same key are one document. Other
    columns are ignored; an empty table gives an empty result.
    """
    small_batches(df.sparkSession)
    docs = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    measured = stored(docs.mapInArrow(lambda b: _measure(b, n), _MEASURED), "set-sizes")
    rarity = np.zeros(1 << RARITY_BITS, dtype=np.uint32)
    summed = measured.filter("chunk IS NOT NULL").select("chunk", "counts").repartition("chunk").mapInArrow(
        _sum_counts, "chunk int, counts binary")
    for row in summed.collect():  # a table of fixed size, 4 MB; one job, where a local iterator starts one per partition
        at = row["chunk"] << CHUNK_BITS
        rarity[at : at + (1 << CHUNK_BITS)] = np.frombuffer(row["counts"], dtype=np.uint32)
    shared = df.sparkSession.sparkContext.broadcast(rarity)

    own = measured.filter("chunk IS NULL").withColumn(
        "same", F.when((F.col("n") > 0) & F.col("key").isNotNull(), F.concat_ws(":", F.hex("same_a"), F.hex("same_b"), F.hex("n")))
    ).select("key", F.col("n").alias("n_shingles"), "same")
    classes = stored(own.filter("same IS NOT NULL").groupBy("same").agg(F.min("key").alias("first"), F.count("*").alias("n")), "equal-sets")

    firsts = classes.select("first").distinct()
    kept = docs.filter("key IS NOT NULL").mapInArrow(
        lambda b: _prefixes(b, shared, n, num, den),
        "key bigint, n int, tokens array<bigint>, " + ", ".join(f"{p} bigint" for p in _PARITY),
    ).filter("n > 0").join(firsts, F.col("key") == F.col("first"), "left_semi")
    prefixes = stored(kept, "prefixes")
    entries = prefixes.select("key", "n", F.posexplode("tokens").alias("place", "token"))
    found = _links(docs, prefixes, entries, n, num, den)

    facts = classes.join(found, F.col("first") == F.col("node"), "left").select(
        "same", "n", F.coalesce("component", "first").alias("_component"))
    whole = classes.agg(F.sum("n")).first()[0] or 0
    joined = attach_by_key(own, stored(facts, "set-components"), "same", whole, ["_component"])
    return joined.select(
        F.col("key").cast(df.schema[key].dataType).alias(key), "n_shingles",
        F.coalesce("_component", "key").cast(df.schema[key].dataType).alias("component_id"))


def _links(docs: DataFrame, prefixes: DataFrame, entries: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """(node, component) of all linked keys."""
    # Most n-grams of a prefix are in one set only. They are counted alone, before anything travels with them.
    tokens = stored(entries.groupBy("token").agg(F.count("*").alias("n")).filter("n > 1").withColumn("rows", F.col("n")), "shared-tokens")
    total = tokens.agg(F.sum("n")).first()[0] or 0
    attached = attach_by_key(entries.withColumnRenamed("n", "size"), tokens, "token", total, ["rows"])
    shared = stored(attached.filter("rows IS NOT NULL").drop("rows"), "shared-entries")
    current = _still_open(shared.withColumn("component", F.col("key")), 0)
    parity = prefixes.select("key", *_PARITY)
    seen = links = joined = None
    for round_ in range(LEADER_ROUNDS):
        pairs = _leader_pairs(current, parity, num, den)
        pairs = stored(pairs if seen is None else pairs.join(seen, ["a", "b"], "left_anti"), "leader-pairs")
        found = stored(_verified(docs, pairs, n, num, den), "leader-links")
        seen = pairs if seen is None else seen.unionAll(pairs)
        links = found if links is None else links.unionAll(found)
        joined = components(links, "a", "b")
        current = _still_open(stored(_labelled(current, joined), "labelled-entries"), round_ + 1)
    parted = current.withColumn("parts", F.ceil(F.col("rows") / MEMBERS_PER_TASK).cast("int"))
    marked = parted.join(parity.withColumnRenamed("key", "_k"), F.col("key") == F.col("_k")).withColumnRenamed("size", "n")
    kept = ["token", "key", "n", "place", "component", "parts", *_PARITY]
    still = stored(marked.select(*kept), "open-entries")
    left = still.withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int"))
    right = still.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    left = left.select(*[F.col(c).alias(f"x_{c}") for c in left.columns])
    right = right.select(*[F.col(c).alias(f"y_{c}") for c in right.columns])
    open_pairs = left.join(
        right,
        (F.col("x_token") == F.col("y_token")) & (F.col("x_part") == F.col("y_part")) & (F.col("x_key") < F.col("y_key"))
        & (F.col("x_component") != F.col("y_component")) & _may_link(num, den, "x_", "y_"),
    ).select(F.col("x_key").alias("a"), F.col("y_key").alias("b")).distinct()
    more = stored(_verified(docs, open_pairs.join(seen, ["a", "b"], "left_anti"), n, num, den), "open-links")
    # What is joined already comes as one link a node.
    return components(joined.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(more), "a", "b")


def _leaders(round_: int, size: str = "n") -> list[Column]:
    """Two members of an n-gram. They differ between LEADER_KINDS kinds of n-gram and between rounds, so that a group
    meets several of its members, but as few in long texts as in short ones."""
    kind = F.pmod("token", F.lit(LEADER_KINDS))
    member = F.struct(F.xxhash64(F.lit(round_), kind, "key").alias("h"), "key", F.col(size).alias("n"), "place")
    return [F.min(member).alias("low"), F.max(member).alias("high")]


def _leader_pairs(entries: DataFrame, parity: DataFrame, num: int, den: int) -> DataFrame:
    """Every entry with the leaders of its n-gram, once per pair, if the filters let it pass."""
    met = entries.select(
        F.col("key").alias("x_key"), F.col("size").alias("x_n"), F.col("place").alias("x_place"),
        F.explode(F.array("low", "high")).alias("l"),
    ).select("x_key", "x_n", "x_place", F.col("l.key").alias("y_key"), F.col("l.n").alias("y_n"), F.col("l.place").alias("y_place"))
    near = met.filter((F.col("x_key") != F.col("y_key")) & _may_link(num, den, "x_", "y_", parity=False))
    pairs = near.groupBy(F.least("x_key", "y_key").alias("a"), F.greatest("x_key", "y_key").alias("b")).agg(
        F.first(F.when(F.col("x_key") < F.col("y_key"), F.col("x_n")).otherwise(F.col("y_n"))).alias("x_n"),
        F.first(F.when(F.col("x_key") < F.col("y_key"), F.col("y_n")).otherwise(F.col("x_n"))).alias("y_n"),
    )
    x = parity.select(F.col("key").alias("x_key"), *[F.col(c).alias(f"x_{c}") for c in _PARITY])
    y = parity.select(F.col("key").alias("y_key"), *[F.col(c).alias(f"y_{c}") for c in _PARITY])
    return pairs.join(x, F.col("a") == F.col("x_key")).join(y, F.col("b") == F.col("y_key")).filter(
        _may_link(num, den, "x_", "y_", places=False)).select("a", "b")


def _labelled(entries: DataFrame, joined: DataFrame) -> DataFrame:
    """Entries with the component of their set."""
    return entries.select("token", "key", "size", "place").join(
        joined.withColumnRenamed("component", "_c"), F.col("key") == F.col("node"), "left"
    ).select("token", "key", "size", "place", F.coalesce("_c", "key").alias("component"))


def _still_open(labelled: DataFrame, round_: int) -> DataFrame:
    """Entries of n-grams whose members are in several components, with the leaders of the next round."""
    mixed = stored(labelled.groupBy("token").agg(
        F.count("*").alias("n"), F.min("component").alias("least"), F.max("component").alias("most"), *_leaders(round_, "size")
    ).filter("least < most").withColumn("rows", F.col("n")), "open-tokens")
    total = mixed.agg(F.sum("n")).first()[0] or 0
    still = attach_by_key(labelled, mixed, "token", total, ["low", "high", "rows"]).filter("low IS NOT NULL")
    return stored(still, "open-entries")


def first_of_groups(docs: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """The rows of ``docs`` that are the first of their group; rows without a key stay."""
    return without_keys(docs, groups.filter(F.col(key) != F.col("component_id")), key)
