import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from silverlane.llm import tokens, wavelet
from silverlane.llm import words as W
from silverlane.llm.tokenfiles import find_token, read_token_files, write_token_files
from tests.llm.helpers import documents, empty, mirror_words, odd_texts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def random_texts(n):
    """Texts of pieces that matter to the splitter."""
    rng = random.Random(11)
    pieces = ["a", "it's", " 'll", " ", "  ", "\n", " \n", "\t", "12", " 3", "é", " ñu", "漢", " 漢", "\xa0", "　", "\x85", "\x1c",
              "!", " ?!", "word", " word", "<|endoftext|>", "’s", "​", "Ā", " ā", "ƒ", "\r\n", "😀", " 😀"]
    return ["".join(rng.choice(pieces) for _ in range(rng.randrange(0, 12))) for _ in range(n)]


def test_ids_are_those_of_the_library(library, spark, sf_dir):
    texts = random_texts(4000) + odd_texts() + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).collect()]
    want = [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert tokens.encode_texts(tokens.Encoder(PATH), texts) == want
    plain = [t for t in texts if "<|endoftext|>" not in (t or "")]  # without a special token everything goes by cuts
    want = [[*e.ids, 7] for e in library.encode_batch([t or "" for t in plain], add_special_tokens=False)]
    assert tokens.encode_texts(tokens.Encoder(PATH), plain, 7) == want


def test_small_cache(library, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_ENTRIES", 8)
    texts = [f"w{i % 90} v{i % 7} x" for i in range(400)]
    encoder = tokens.Encoder(PATH)
    for part in (texts[:100], texts[100:150], texts[150:]):
        assert tokens.encode_texts(encoder, part) == [e.ids for e in library.encode_batch(part, add_special_tokens=False)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json"])
def test_other_tokenizers_encode_whole_texts(name):
    path = public_tokenizers.path(name)
    texts = ["Hello  world", "", "a b"]
    encoder = tokens.Encoder(path)
    assert not encoder.cuts
    want = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert tokens.encode_texts(encoder, texts) == want


@pytest.mark.parametrize("n", [0, 1, 7, 2048, 2049, 30_000])
def test_wavelet_matrix(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n), 65_535).astype(np.uint16)
    keys, lengths = np.array([-5, 3], dtype=np.int64), np.array([n // 2, n - n // 2])
    matrix, back_keys, back_lengths = wavelet.from_bytes(wavelet.to_bytes(wavelet.WaveletMatrix.build(ids, 16), keys, lengths))
    assert back_keys.tolist() == keys.tolist() and back_lengths.tolist() == lengths.tolist()
    assert (matrix.decode() == ids).all()
    assert (matrix.access(np.arange(n)) == ids).all()
    for value in {1, 2, 60_000, *ids[:3].tolist()}:
        at = np.flatnonzero(ids == value)
        assert matrix.count(value) == len(at)
        assert matrix.count(value, n // 3, n // 2) == (ids[n // 3 : n // 2] == value).sum()
        for k in {0, len(at) // 2, len(at) - 1} - {-1}:
            assert matrix.select(value, k) == (at[k] if k < len(at) else -1)
        if len(at) < 50:
            assert matrix.occurrences(value) == at.tolist()
    assert matrix.count(1 << 20) == 0


def test_bad_file():
    with pytest.raises(ValueError):
        wavelet.from_bytes(b"something else")


def test_round_trip(spark, library):
    texts = odd_texts() + random_texts(200)
    df = documents(spark, texts, partitions=7)
    files = write_token_files(df, "doc_id", "text", PATH, 0, shard_ids=5000)
    rows = sorted(read_token_files(files, "doc_id").collect(), key=lambda r: r.doc_id)
    start = 0
    assert [r.doc_id for r in rows] == list(range(len(texts)))
    for r, text in zip(rows, texts):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert sum(f.n_ids for f in files.collect()) == start


def test_no_rows_no_keys_and_repeated_rows(spark):
    df = documents(spark, ["a b", "c"])
    assert read_token_files(write_token_files(empty(spark, df), "doc_id", "text", PATH), "doc_id").collect() == []
    keyless = df.selectExpr("CAST(NULL AS BIGINT) AS doc_id", "text")
    both = df.select("doc_id", "text").unionAll(df.select("doc_id", "text")).unionAll(keyless)
    rows = read_token_files(write_token_files(both, "doc_id", "text", PATH), "doc_id").collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens) for r in rows) == [(-1, 2), (-1, 3), (0, 3), (0, 3), (1, 2), (1, 2)]
    assert sorted(r.start for r in rows) == [0, *np.cumsum([r.n_tokens for r in sorted(rows, key=lambda r: r.start)])[:-1]]


@pytest.mark.parametrize("bits", [0, 4, 12])
def test_ids_hold_when_hashes_do_not(library, monkeypatch, bits):
    plain = W.span_hashes
    monkeypatch.setattr(W, "span_hashes", lambda *a: plain(*a) & np.uint64((1 << bits) - 1))
    texts = [t for t in random_texts(600) if "<|endoftext|>" not in t]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    encoder = tokens.Encoder(PATH)
    assert [tokens.encode_texts(encoder, texts[i : i + 200]) for i in (0, 200, 400)] == [want[:200], want[200:400], want[400:]]


def test_words_that_polynomials_confuse(spark, library):
    texts = [f"{a} {w}" for n in (32, 64, 1024, 2048, 4096) for w in mirror_words(n) for a in ("x", "y")]
    rows = read_token_files(write_token_files(documents(spark, texts), "doc_id", "text", PATH), "doc_id").collect()
    for r in rows:
        ids = np.array([*library.encode(texts[r.doc_id], add_special_tokens=False).ids, 0], dtype="<u4")
        assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))


def test_find_token(spark, library):
    texts = odd_texts() + random_texts(300)
    files = write_token_files(documents(spark, texts, partitions=5), "doc_id", "text", PATH, 0, shard_ids=9000)
    ids = [[*library.encode(t or "", add_special_tokens=False).ids, 0] for t in texts]
    starts = np.cumsum([0, *map(len, ids)])
    for token in (0, ids[3][0], ids[-1][0], 50_000_000, 41_234):
        want = [(i, k, int(starts[i]) + k) for i, row in enumerate(ids) for k, x in enumerate(row) if x == token]
        assert sorted(map(tuple, find_token(files, token, "doc_id").collect())) == want


def test_parts_follow_each_other_with_a_hot_key_and_many_nulls(spark):
    rng = random.Random(8)
    rows = [(None, f"n{i}") for i in range(300)] + [(70, f"h{i}") for i in range(300)]
    rows += [(rng.randrange(-100, 200), f"t{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    files = write_token_files(df, "doc_id", "text", PATH, 0, shard_ids=100, part_bytes=100)
    assert files.select("part").distinct().count() > 10
    hot = files.filter("n_texts > 150").count()
    assert hot == 0
    got = read_token_files(files, "doc_id").orderBy("start").collect()
    keys = [-(1 << 62) if r.doc_id is None else r.doc_id for r in got]
    assert keys == sorted(keys) and sorted(keys) == sorted(-(1 << 62) if k is None else k for k, _ in rows)
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1]]


def test_workers_keep_no_encoder_once_files_are_written(spark):
    def kept(batches):
        import sys

        import pyarrow as pa

        for _ in batches:
            module = sys.modules.get("silverlane.llm.tokens")
            yield pa.RecordBatch.from_arrays([pa.array([module.encoder.cache_info().currsize if module else 0])], names=["n"])

    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        spark.conf.set(keys[0], "64")
        spark.conf.set(keys[1], "false")
        files = write_token_files(documents(spark, ["a b", "c d", None], partitions=64), "doc_id", "text", PATH)
        assert sorted(r.n_tokens for r in read_token_files(files, "doc_id").collect()) == [1, 3, 3]
        assert spark.range(64, numPartitions=64).mapInArrow(kept, "n bigint").agg({"n": "max"}).first()[0] == 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
