import random

import numpy as np
import pyarrow as pa

from silverlane.llm import words as W
from tests.llm.helpers import LOWER, mirror_words, odd_texts, words


def test_words_match_plain_split():
    texts = odd_texts()
    for limit in (1, 50, 1 << 20):
        seen = []
        for part in W.slices(pa.array(texts).slice(0), limit):
            found = W.split(part, W.NOT_SPACE, W.LOWER)
            owner = found.text_of()
            for row in range(len(part.begins) - 1):
                at = np.flatnonzero(owner == row)
                seen.append([bytes(part.data[a:b]).translate(LOWER) for a, b in zip(found.starts[at], found.ends[at])])
        assert seen == [words(t, lower=True) for t in texts]


def test_hash_depends_on_the_word_alone():
    part = next(W.slices(pa.array(["abc  x abc", "x", "zabc abc"])))
    found = W.split(part, W.NOT_SPACE)
    assert found.hashes[0] == found.hashes[2] == found.hashes[5] == W.hash_word(b"abc")
    assert found.hashes[1] == found.hashes[3] != found.hashes[4]


def test_windows_stay_inside_a_text():
    rng = random.Random(1)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randrange(9))) for _ in range(40)]
    part = next(W.slices(pa.array(texts)))
    hashes, at, owner = W.windows(W.split(part, W.NOT_SPACE), 3)
    plain = [(i, tuple(t.split()[k : k + 3])) for i, t in enumerate(texts) for k in range(len(t.split()) - 2)]
    assert [i for i, _ in plain] == owner.tolist()
    by_hash = {}
    for h, (_, w) in zip(hashes.tolist(), plain):
        assert by_hash.setdefault(h, w) == w
    assert len(by_hash) == len({w for _, w in plain})


def test_ragged():
    assert W.ragged(np.array([5, 0, 9]), np.array([3, 0, 2])).tolist() == [5, 6, 7, 9, 10]
    assert W.ragged(np.array([1]), np.array([0])).tolist() == []


def test_no_two_words_share_a_hash():
    words = [w for n in (2, 8, 16, 64, 128, 256, 512, 1024, 2048, 4096) for w in mirror_words(n)]
    rng = random.Random(3)
    words += sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(1, 40))) for _ in range(20_000)} - set(words))
    words += ["x" * n for n in range(200, 300)] + ["x" * n + "y" for n in range(200, 300)]
    for seed in (0, 1):
        data = np.frombuffer("".join(words).encode(), dtype=np.uint8)
        ends = np.cumsum([len(w) for w in words])
        hashes = W.span_hashes(data, ends - [len(w) for w in words], ends, seed)
        assert len(set(hashes.tolist())) == len(words)


def test_same_spans():
    rng = random.Random(9)
    texts = ["".join(rng.choice("ab") for _ in range(n)) for n in (0, 1, 7, 8, 9, 31, 32, 255, 256, 257, 1000)]
    pairs = [(t, u) for t in texts for u in (t, t[:-1] + "c" if t else t, "c" + t[1:] if t else t)]
    one, two = (np.frombuffer("".join(p[i] for p in pairs).encode(), dtype=np.uint8) for i in (0, 1))
    lengths = np.array([len(a) for a, _ in pairs])
    starts = np.cumsum(lengths) - lengths
    assert W.same_spans(one, starts, two, starts, lengths).tolist() == [a == b for a, b in pairs]


def test_numbers_hold_when_hashes_do_not(monkeypatch):
    texts = odd_texts()
    part = next(W.slices(pa.array(texts), 1 << 30))
    for bits in (64, 3):
        found = W.split(part, W.NOT_SPACE)
        found = found._replace(hashes=found.hashes & np.uint64((1 << bits) - 1))
        number = W.numbers(part, found)
        by_number, plain = {}, [w for t in texts for w in words(t)]
        assert len(number) == len(plain)
        for n, w in zip(number.tolist(), plain):
            assert by_number.setdefault(n, w) == w
        assert len(by_number) == len(set(plain))
