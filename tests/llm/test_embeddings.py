import random

import numpy as np

from silverlane.llm import embeddings
from silverlane.llm.embeddings import near_vectors
from tests.llm.helpers import Sets

SCHEMA = "vec_id long, embedding array<float>, label int, n string, id string, part string"


def plain(rows, cosine):
    union, links = Sets(), {i: 0 for i, *_ in rows}
    good = []
    for i, v, label in rows:
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, dtype=np.float32).astype(np.float64)
            good.append((i, label, x / np.linalg.norm(x)))
    for a, (i, l, x) in enumerate(good):
        for j, m, y in good[:a]:
            if l == m and len(x) == len(y) and x @ y >= cosine:
                links[i] += 1
                links[j] += 1
                union.link(i, j)
    return {i: (links[i], union.root(i), union.root(i) == i) for i, *_ in rows}


def got(df, cosine=0.98):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors(df, "vec_id", "embedding", "label", cosine).collect()}


def test_against_plain_version(spark, monkeypatch):
    # Small cells and tiles, so that pivots, copies across cells and pairs of blocks all occur.
    monkeypatch.setattr(embeddings, "CELL_ROWS", 20)
    monkeypatch.setattr(embeddings, "TILE_ROWS", 24)
    rng = np.random.default_rng(3)
    rows = []
    centres = rng.normal(size=(12, 8))
    for i in range(420):
        v = centres[i % 12] + rng.normal(size=8) * (0.08 if i % 3 else 0.5)
        rows.append((i, [float(x) for x in np.float32(v * rng.uniform(0.1, 9))], int(i % 2)))
    rows += [(500 + i, rows[5][1], 1) for i in range(30)]
    for i, v in enumerate([None, [], [0.0] * 8, [1.0, None] + [0.0] * 6, [float("nan")] * 8, [float("inf")] + [1.0] * 7, [1.0, 2.0], [2.0, 4.0]]):
        rows.append((600 + i, v, 1))
    rows += [(700, rows[5][1], None), (701, rows[5][1], None), (702, rows[5][1], 0), (703, [1e-30] * 8, 1), (704, [1e30] * 8, 1)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA).repartition(4)
    assert got(df) == plain(rows, 0.98)


def test_no_rows_and_no_keys(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0], 1, "", "", ""), (3, [1.0, 0.0], 1, "", "", ""), (3, [1.0, 0.0], 1, "", "", "")], SCHEMA)
    rows = sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in near_vectors(df, "vec_id", "embedding", "label", 0.98).collect())
    assert rows == [(0, 0, 0, True), (3, 1, 3, True), (3, 1, 3, True)]
    assert got(spark.createDataFrame([], SCHEMA)) == {}


def test_documented_table(spark, sf_dir):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    assert got(df, 0.4) == plain(rows, 0.4)
