import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from silverlane.llm import trie as T
from silverlane.llm.queries import fold

SCHEMA = "conv_id long, turn long, role string, text string, depth string, size int, k1 string, conv string"


def plain_nodes(rows, every=None):
    """Every node of the trie by the letter of its definition; with ``every`` of the rebuilt conversations."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    whole = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    if every:
        def h(c):
            return zlib.crc32(str(c).encode()) % 9
        whole = {c: whole.get(c - (abs(c) % every) * (1 if c >= 0 else -1), [])[: h(c)] + ts[h(c):] for c, ts in whole.items()}
    members = defaultdict(list)
    for c in sorted(whole):
        for d in range(len(whole[c]) + 1):
            members[tuple(whole[c][:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        saved[node] = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0) + sum(saved[k] for k in children[node])
    return sorted((
        members[n][0], len(n), members[n[:-1]][0] if n else None, len(members[n]), len(children[n]), leaves[n], saved[n],
        hashlib.sha256(",".join(str(c) for c in members[n] if len(whole[c]) == len(n)).encode()).hexdigest(),
    ) for n in members)


def table(spark, rows):
    """Conversations with extra columns under names the operator uses."""
    return spark.createDataFrame([(*r, "x", 1, "y", "z") for r in rows], SCHEMA).repartition(5)


def talks(n, seed=1):
    """Few different turns, so that many conversations begin alike; with copies, ties, nulls and negative ids."""
    rng = random.Random(seed)
    rows = []
    for c in range(-7, n):
        length = rng.choice([0, 1, 1, 2, 3, 5, 9])
        for t in range(length):
            rows.append((c, rng.choice([t, t, t, None, 3]), rng.choice(["user", "bot", None, ""]), rng.choice(["é漢", "b", "", None, "b" * 70 + "1", "b" * 70])))
    copy = [(t, "user", f"copy {t}") for t in range(6)]
    rows += [(1000 + k, *r) for k in range(n) for r in copy[: rng.choice([4, 5, 6])]]
    rows += rows[:5] + [(None, 0, "user", "lost")]
    return rows


def got(frame):
    return sorted(map(tuple, frame.collect()))


@pytest.mark.parametrize("shard_rows,cell", [(None, 1024), (5, 1024), (40, 2), (1, 1)])
def test_nodes_match_a_plain_version(spark, monkeypatch, shard_rows, cell):
    monkeypatch.setattr(T, "CELL_TURNS", cell)
    monkeypatch.setattr(T, "BLOCK_TURNS", cell)
    monkeypatch.setattr(T, "CHUNK_IDS", 3)
    rows = talks(60)
    turns = T.turn_rows(table(spark, rows), "conv_id", "turn", "role", "text")
    assert got(T.trie(T.with_shared_starts(turns, fold("conv", 9), 5), shard_rows)) == plain_nodes(rows, 5)
    assert got(T.trie(T.whole_conversations(turns), shard_rows)) == plain_nodes(rows)


def test_many_copies_and_one_long_conversation(spark):
    rows = [(c, 0, "user", "hello") for c in range(9500)] + [(c, 1, "bot", "yes") for c in range(9400)]
    rows += [(7, 2 + t, "user", str(t % 3)) for t in range(3000)] + [(8, 2 + t, "user", str(t % 3)) for t in range(2500)]
    turns = T.turn_rows(table(spark, rows), "conv_id", "turn", "role", "text")
    out = got(T.trie(T.whole_conversations(turns), 2000))
    # Nodes of the long ones by their definition.
    want = [(0, 0, None, 9500, 1, 1, 9499 * 5 + 9399 * 3 + 2500, hashlib.sha256(b"").hexdigest())]
    want.append((0, 1, 0, 9500, 1, 1, want[0][6], hashlib.sha256(",".join(map(str, range(9400, 9500))).encode()).hexdigest()))
    two = ",".join(str(c) for c in range(9400) if c not in (7, 8))
    want.append((0, 2, 0, 9400, 1, 1, 9399 * 3 + 2500, hashlib.sha256(two.encode()).hexdigest()))
    for d in range(3, 3003):
        both = d <= 2502
        ends = {2502: b"8", 3002: b"7"}.get(d, b"")
        want.append((7, d, 0 if d == 3 else 7, 2 if both else 1, int(d < 3002), 1, 2503 - d if both else 0,
                     hashlib.sha256(ends).hexdigest()))
    assert out == sorted(want, key=lambda r: (r[0], r[1]))


def test_no_rows_and_nothing_but_nulls(spark):
    for rows in ([], [(None, 1, "user", "x")]):
        turns = T.turn_rows(table(spark, rows), "conv_id", "turn", "role", "text")
        assert got(T.trie(T.whole_conversations(turns))) == []
    turns = T.turn_rows(table(spark, [(4, None, None, None), (4, None, None, None)]), "conv_id", "turn", "role", "text")
    assert got(T.trie(T.whole_conversations(turns))) == plain_nodes([(4, None, None, None)] * 2)
    # A conversation that takes no turn from another and none of its own is still a member of the root.
    one = T.with_shared_starts(turns, F.lit(9), 5)
    assert got(T.trie(one)) == [(4, 0, None, 1, 0, 1, 0, hashlib.sha256(b"4").hexdigest())]


@pytest.mark.parametrize("limit", [1, 3, 50, 10_000])
def test_queue_keeps_order(limit):
    rng = random.Random(limit)
    queue, plain = T.SpillQueue(limit), []
    for _ in range(3000):
        if plain and rng.random() < 0.45:
            assert queue.first() == min(plain) and queue.pop() == min(plain)
            plain.remove(min(plain))
        else:
            message = tuple(rng.randrange(-5, 5) for _ in range(6))
            queue.push(message)
            plain.append(message)
        assert len(queue.heap) <= limit
    assert [queue.pop() for _ in range(len(plain))] == sorted(plain) and queue.first() is None
