import hashlib
import zlib
from collections import Counter

import pytest

from silverlane.llm import queries
from silverlane.llm.sharding import interleave
from tests.llm.helpers import documents, empty


def check(df, shards):
    rows = interleave(df, shards, "source", "doc_id").collect()
    counts = Counter(r.shard for r in rows)
    if rows:
        assert max(counts.values()) - min(counts.get(s, 0) for s in range(shards)) <= 1
    for shard in counts:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(counts[shard]))
    per = Counter((r.source, r.shard) for r in rows)
    for source, n in Counter(r.source for r in rows).items():
        # A cut may fall anywhere between two rows of a source.
        assert all(abs(per[source, s] - n / shards) < 2 for s in range(shards))
    return {(r.doc_id, r.shard, r.slot) for r in rows}


def test_every_shard_has_the_mixture(spark):
    df = documents(spark, ["x"] * 500, lambda i: "hot" if i % 3 == 0 else None if i % 7 == 0 else f"s{i % 5}")
    assert check(df, 8) == check(df.repartition(5), 8)


def test_few_rows_and_none(spark):
    df = documents(spark, ["x"] * 5)
    assert len(check(df, 40)) == 5
    assert interleave(empty(spark, df), 40, "source", "doc_id").collect() == []


def test_repeated_rows(spark):
    df = documents(spark, ["x", None, "x"])
    rows = interleave(df.unionAll(df), 2, "source", "doc_id").collect()
    assert Counter(r.shard for r in rows) == {0: 3, 1: 3}


def plain_deal(docs, shards):
    """Shard and slot of every (doc_id, source), by sorting the whole table."""
    def order(doc_id):
        return int(hashlib.md5(f"0:{doc_id}".encode()).hexdigest()[:15], 16)

    per = {}
    for doc_id, source in docs:
        per.setdefault("null" if source is None else f"of {source}", []).append((order(doc_id), doc_id))
    line = sorted(
        ((2 * k + 1) / (2 * len(rows)), name.encode(), h, doc_id)
        for name, rows in per.items() for k, (h, doc_id) in enumerate(sorted(rows)))
    slots, out = Counter(), {}
    for place, (_, _, _, doc_id) in enumerate(line):
        shard = place * shards // len(line)
        out[doc_id] = (shard, slots[shard])
        slots[shard] += 1
    return out


def test_query_equals_a_plain_sort(spark, sf_dir):
    """Every column of the registered query over the whole table."""
    docs = [(r.doc_id, r.source, r.text or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = plain_deal([d[:2] for d in docs], queries.SHARDS)
    got = {r.doc_id: r for r in queries.QUERIES["op6_sharding"](spark, sf_dir).collect()}
    assert len(got) == len(docs)
    for doc_id, _, text in docs:
        data, r = text.encode(), got[doc_id]
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 16, zlib.crc32(data), "rows", None)
        assert (r.shard, r.slot) == want[doc_id]


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_odd_tables_equal_a_plain_sort(spark, shards):
    df = documents(spark, ["x"] * 333, lambda i: "hot" if i % 3 else None if i % 2 else "é" if i % 5 else "")
    want = plain_deal([(r.doc_id, r.source) for r in df.collect()], shards)
    assert {r.doc_id: (r.shard, r.slot) for r in interleave(df, shards, "source", "doc_id").collect()} == want
