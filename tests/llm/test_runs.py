import hashlib
import random
import zlib

import numpy as np
import pytest

from silverlane.llm import runs as R
from silverlane.llm.queries import QUERIES
from silverlane.llm.runs import find_runs
from tests.llm.helpers import documents, empty, odd_texts, words


def plain_runs(ws, min_length=6, exponent=4):
    """Every stretch with a smallest period that is long enough and cannot be extended, by trying all periods."""
    found = {}
    n = len(ws)
    for p in range(1, n // exponent + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and ws[j] == ws[j + p]:
                j += 1
            if j + p - i >= max(min_length, exponent * p):
                found.setdefault((i, j + p), p)
            i = max(j, i + 1) if j > i else i + 1
    return sorted((a, b - a, p) for (a, b), p in found.items())


def plain_collapsed(ws, runs):
    gone = {k for a, n, p in runs for k in range(a + p, a + n)}
    return [w for k, w in enumerate(ws) if k not in gone]


def repeated_texts(n, seed=3):
    """Texts of few words with stretches that repeat, some side by side or inside each other."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        ws = []
        for _ in range(rng.randrange(0, 6)):
            unit = [rng.choice("abc") for _ in range(rng.randrange(1, 5))]
            if rng.random() < 0.3:
                unit = unit * rng.randrange(1, 6) + [rng.choice("abcd")]
            ws += (unit * 12)[: len(unit) * rng.randrange(1, 9) + rng.randrange(0, 4)]
        out.append(" ".join(ws))
    return out


def test_cover_meets_everywhere():
    assert (R._MEETING >= 0).all() and (R._MEETING < R.MODULUS).all()
    for a in range(R.MODULUS):
        for b in range(R.MODULUS):
            step = R._MEETING[a, b]
            assert (a + step) % R.MODULUS in R.COVER and (b + step) % R.MODULUS in R.COVER


@pytest.mark.parametrize("letters,n", [(1, 300), (2, 700), (30, 500), (3, 5)])
def test_extensions(letters, n):
    rng = np.random.default_rng(letters * n)
    texts = [rng.integers(0, letters, int(k)) for k in (n, 0, n // 2, 1)]
    texts[2] = np.tile(texts[2][:40], 9)
    spaced = np.concatenate([np.append(t, letters + i) for i, t in enumerate(texts)])
    owner = np.repeat(np.arange(4), [len(t) + 1 for t in texts])
    extensions = R.Extensions(spaced, owner)
    for t, first in ((0, 0), (2, len(texts[0]) + 2)):
        if len(texts[t]) < 2:
            continue
        a, b = rng.integers(0, len(texts[t]), (2, 400))
        a, b = a[a != b], b[a != b]
        want = []
        for x, y in zip(a.tolist(), b.tolist()):
            k = 0
            while max(x, y) + k < len(texts[t]) and texts[t][x + k] == texts[t][y + k]:
                k += 1
            want.append(k)
        assert extensions.of(first + a, first + b).tolist() == want


@pytest.mark.parametrize("min_length,exponent,pairs", [(6, 4, 1 << 19), (6, 4, 7), (2, 2, 1 << 19), (9, 3, 50)])
def test_runs_match_trying_all_periods(spark, monkeypatch, min_length, exponent, pairs):
    monkeypatch.setattr(R, "MAX_PAIRS", pairs)
    texts = repeated_texts(300)
    numbers = [np.array([ord(w) for w in words(t)], dtype=np.int64) for t in texts]
    begins = np.concatenate([[0], np.cumsum([len(x) for x in numbers])])
    of, *rest = R.find(np.concatenate(numbers), begins, min_length, exponent)
    got = [[] for _ in texts]
    for t, *run in zip(of.tolist(), *(x.tolist() for x in rest)):
        got[t].append(tuple(run))
    assert got == [plain_runs(words(t), min_length, exponent) for t in texts]


def test_rows_of_find_runs(spark):
    texts = repeated_texts(60) + odd_texts()
    rows = {r.doc_id: r for r in find_runs(documents(spark, texts), "doc_id", "text").collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        ws = words(t)
        want = plain_runs(ws) if len(ws) < 5000 else [tuple(r) for r in rows[i].runs]
        assert [tuple(r) for r in rows[i].runs] == want and rows[i].n_words == len(ws)
        assert rows[i].collapsed.encode() == b" ".join(plain_collapsed(ws, want))


def test_long_text_with_a_long_period(spark):
    rng = random.Random(6)
    unit = [f"w{rng.randrange(2000)}" for _ in range(3001)]
    ws = [f"x{i}" for i in range(50)] + (unit * 5)[:14_000] + ["y"] * 7
    row = find_runs(documents(spark, [" ".join(ws)]), "doc_id", "text").first()
    assert [tuple(r) for r in row.runs] == [(50, 14_000, 3001), (14_050, 7, 1)]
    assert row.collapsed.split() == ws[: 50 + 3001] + ["y"]


def test_repeated_rows_no_keys_and_no_rows(spark):
    df = documents(spark, ["a a a a a a", None])
    twice = df.unionAll(df).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "text")
    assert sorted(r.collapsed for r in find_runs(twice, "doc_id", "text").collect()) == ["", "", "a", "a"]
    assert find_runs(empty(spark, df), "doc_id", "text").collect() == []


def test_query_matches_a_plain_version(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op11_runs"](spark, sf_dir).collect()
    assert len(rows) == len(docs) and any(r.n_runs for r in rows)
    for r in rows:
        ws, h = words(docs[r.doc_id]), zlib.crc32(str(r.doc_id).encode())
        n, g = len(ws), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            ws = [ws[i] if i < a else ws[a + (i - a) % p] for i in range(n)]
        elif n > 3000:
            continue
        runs = plain_runs(ws)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(b" ".join(plain_collapsed(ws, runs))).hexdigest()
