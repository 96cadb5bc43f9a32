"""Near-duplicate vectors by an exact metric range join.

Vectors of one group are scaled to length 1, where a cosine of at least c is a distance of at most r = sqrt(2 - 2c).
Each vector's home is the cell of its nearest pivot. By the triangle inequality a partner within r of a home vector x of
pivot p is at most d(x, p) + r from p, and so at most 2 r farther from p than from its own nearest pivot; only
such vectors, and of those only the ones within r of the plane half-way between the two pivots, are copied to the
cell. Cells are then joined on their own, a home vector with everything in its cell.

Equal vectors of a group are one vector with a weight. A cell with more than ``TILE_ROWS`` vectors is cut into blocks,
and every two blocks meet in a task, so no task holds more than two blocks. A task gives sums of links and the links
thinned to trees, never all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlane.functions.skew import attach_by_key
from silverlane.llm.common import seeded_order, stored
from silverlane.llm.components import components

PIVOTS = 4096
PIVOTS_PER_GROUP = 64
CELL_ROWS = 1024
TILE_ROWS = 2048
_MARGIN = 1e-7


def near_vectors(df: DataFrame, key: str, vector: str, group: str, cosine: float, seed: int = 0) -> DataFrame:
    """(key, n_links, component_id, kept) of each row of ``df``.

    Two rows are linked when their groups are equal and not null and their cosine is ``cosine`` or more; ``n_links``
    counts the other rows linked directly, ``component_id`` is the least key reachable by links, ``kept`` marks the row
    that has it. Vectors that are null, empty, zero, or hold null or non-finite components, and rows without a group
    or key, link with nothing; vectors of different lengths are not compared. Keys are whole numbers; rows with the same
    key and vector count as rows of their own. An empty table gives an empty result.
    """
    values = F.col(vector)
    usable = (
        F.col(group).isNotNull() & F.col(key).isNotNull() & values.isNotNull() & (F.size(values) > 0)
        & F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(values, lambda x: x != 0)
    )
    usable = F.coalesce(usable, F.lit(False))
    # Two hashes stand for a vector: equal ones mean equal vectors.
    same = F.when(usable, F.concat_ws(
        ":", F.to_json(F.struct(F.col(group).alias("g"))), F.hex(F.xxhash64(values)), F.hex(F.xxhash64(F.lit(1), F.transform(values, lambda x: x + x)))
    ))
    rows = df.select(F.col(key).alias("_key"), F.col(group).alias("_group"), values.alias("_vector"), same.alias("_same"))
    classes = stored(
        rows.filter(F.col("_same").isNotNull()).groupBy("_same").agg(
            F.min("_key").cast("long").alias("id"), F.count("*").alias("n"), F.first("_vector").alias("vector"),
            F.concat_ws(":", F.first(F.to_json(F.struct(F.col("_group").alias("g")))), F.first(F.size("_vector"))).alias("part"),
        ), "vector-classes",
    )
    links, edges = _range_join(classes, math.sqrt(max(0.0, 2 - 2 * cosine)), cosine, seed)
    found = components(edges, "a", "b")
    facts = classes.select("_same", "id", "n").join(links, "id", "left").join(
        found, F.col("id") == F.col("node"), "left"
    ).select(
        "_same", "n", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("_links"), F.coalesce("component", "id").alias("_component")
    )
    facts = stored(facts, "vector-facts")
    whole = facts.agg(F.sum("n")).first()[0] or 0
    joined = attach_by_key(rows.select("_key", "_same"), facts, "_same", whole, ["_links", "_component"])
    component = F.coalesce("_component", "_key")
    return joined.select(
        F.col("_key").alias(key), F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"),
        component.cast("long").alias("component_id"), F.coalesce(F.col("_key") == component, F.lit(True)).alias("kept"),
    )


def _pivots(classes: DataFrame, seed: int) -> dict[str, np.ndarray]:
    """Pivots of every part with more than CELL_ROWS vectors and a fair share of all; at most about PIVOTS."""
    counts = classes.groupBy("part").agg(F.count("*").alias("rows"))
    whole = counts.agg(F.sum("rows")).first()[0] or 0
    wanted = counts.withColumn("wanted", F.least(
        F.lit(PIVOTS_PER_GROUP), F.floor(F.col("rows") / CELL_ROWS), F.floor(F.col("rows") * F.lit(float(PIVOTS)) / F.lit(max(1, whole)))
    )).filter("wanted >= 2")  # fewer than PIVOTS parts
    drawn = classes.withColumn("_order", seeded_order(seed, "id")).join(
        F.broadcast(wanted.withColumnRenamed("part", "_part")), F.col("part") == F.col("_part")
    ).filter(F.col("_order") <= F.col("wanted") / F.col("rows") * F.lit(float(1 << 60)))
    out: dict[str, list] = {}
    for row in drawn.select("part", "_order", "vector").orderBy("part", "_order").collect():
        out.setdefault(row["part"], []).append(row["vector"])
    return {part: _unit(np.array(vectors, dtype=np.float64)) for part, vectors in out.items() if len(vectors) > 1}


def _unit(x: np.ndarray) -> np.ndarray:
    scaled = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or loss in the squares
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2 - 2 * (x @ pivots.T)))


def _assign(batches, shared, radius: float) -> Iterator[pa.RecordBatch]:
    """Cells of each vector: its home, and those it is copied to."""
    between = {}
    for part, pivots in shared.value.items():
        between[part] = np.maximum(_distances(pivots, pivots), 1e-12)
    for batch in batches:
        ids, parts = batch.column(0).to_numpy(zero_copy_only=False), np.array(batch.column(1).to_pylist(), dtype=object)
        out_id, out_cell, out_home = [], [], []
        for part in dict.fromkeys(parts.tolist()):
            at = np.flatnonzero(parts == part)
            pivots = shared.value.get(part)
            if pivots is None:
                out_id.append(ids[at])
                out_cell.append(np.zeros(len(at), dtype=np.int32))
                out_home.append(np.ones(len(at), dtype=bool))
                continue
            for low in range(0, len(at), 1024):
                rows = at[low : low + 1024]
                vectors = batch.column(2).take(pa.array(rows))
                x = _unit(vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1).astype(np.float64))
                d = _distances(x, pivots)
                home = d.argmin(axis=1)
                nearest = d[np.arange(len(rows)), home][:, None]
                plane = (d * d - nearest * nearest) / (2 * between[part][home])
                inside = (d <= nearest + 2 * radius + _MARGIN) & (plane <= radius + _MARGIN)
                inside[np.arange(len(rows)), home] = True
                r, c = np.nonzero(inside)
                out_id.append(ids[rows][r])
                out_cell.append(c.astype(np.int32))
                out_home.append(home[r] == c)
        if out_id:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x)) for x in (out_id, out_cell, out_home)], names=["id", "cell", "home"])


def _range_join(classes: DataFrame, radius: float, cosine: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """Weights linked to each class (id, links), and links (a, b) that join what all links join."""
    shared = classes.sparkSession.sparkContext.broadcast(_pivots(classes, seed))
    cells = stored(classes.select("id", "part", "vector").mapInArrow(
        lambda b: _assign(b, shared, radius), "id bigint, cell int, home boolean"), "vector-cells")
    placed = cells.join(classes.select("id", "n", "vector", "part"), "id")
    sizes = cells.join(classes.select("id", "part"), "id").groupBy("part", "cell").agg(
        F.ceil(F.count("*") / TILE_ROWS).cast("int").alias("blocks")
    ).select(F.col("part").alias("_part"), F.col("cell").alias("_cell"), "blocks")
    blocked = placed.join(sizes, (F.col("part") == F.col("_part")) & (F.col("cell") == F.col("_cell"))).withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    ).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = blocked.select(
        "part", "cell", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "id", "n", "home", "vector"
    )
    joined = stored(tiles.groupBy("part", "cell", "i", "j").applyInArrow(
        lambda t: _join_tile(t, cosine), "id bigint, links bigint, root bigint"), "vector-links")
    links = joined.filter("links > 0").groupBy("id").agg(F.sum("links").alias("links"))
    edges = joined.filter(F.col("root").isNotNull() & (F.col("root") != F.col("id"))).select(
        F.col("id").alias("a"), F.col("root").alias("b")
    )
    return links, edges


def _join_tile(table: pa.Table, cosine: float) -> pa.Table:
    table = table.combine_chunks()
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    ids, weights, home, block = (
        table.column(c).to_numpy() for c in ("id", "n", "home", "block")
    )
    flat = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    x = _unit(flat.reshape(len(ids), -1).astype(np.float64))
    left, right = (np.arange(len(ids)), np.arange(len(ids))) if i == j else (np.flatnonzero(block == i), np.flatnonzero(block == j))
    links, label = np.zeros(len(ids), dtype=np.int64), np.arange(len(ids))
    for low in range(0, len(left), 512):
        rows = left[low : low + 512]
        near = x[rows] @ x[right].T >= cosine
        if i == j:
            near[np.arange(len(rows)), np.arange(low, low + len(rows))] = False
            links[rows] += near @ weights[right]
        else:
            links[rows] += near @ weights[right]
            links[right] += weights[rows] @ near
        near &= home[rows][:, None] | home[right][None, :]
        _merge(label, rows, right, near)
    links[~home] = 0  # counted where the vector is at home
    least = np.full(len(ids), np.iinfo(np.int64).max)
    np.minimum.at(least, label, ids)
    a, b = ids[ids != least[label]], least[label][ids != least[label]]
    return pa.table({
        "id": pa.array(np.concatenate([ids[links > 0], a])),
        "links": pa.array(np.concatenate([links[links > 0], np.zeros(len(a), dtype=np.int64)])),
        "root": pa.array(np.concatenate([np.zeros(int((links > 0).sum()), dtype=np.int64), b]),
                         mask=np.concatenate([np.ones(int((links > 0).sum()), dtype=bool), np.zeros(len(a), dtype=bool)])),
    })


def _merge(label: np.ndarray, rows: np.ndarray, columns: np.ndarray, near: np.ndarray) -> None:
    """Give all that is linked the same label. A row whose links are joined already costs one comparison."""
    for r in np.flatnonzero(near.any(axis=1)):
        linked = label[columns[near[r]]]
        own = label[rows[r]]
        if (linked != own).any():
            label[np.isin(label, linked)] = own
