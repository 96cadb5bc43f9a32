import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer

from silverlane.llm.common import stored
from tests.llm.helpers import odd_texts, words
from tests.llm.test_mixing import filled
from tests.llm.test_setjoin import plain


def test_stages_on_the_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    toxic = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect() if r.toxic == 0}
    seen = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"test-{name}")
        seen.append(docs.collect())
        if name != "tokens":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    start, polite, single, clean, mixed, ids = seen
    # Few clean documents go, and those that stay are unchanged.
    assert len(toxic - {r.doc_id for r in polite}) <= 0.03 * len(toxic)
    assert set(polite) <= set(start) and set(single) <= set(polite) and set(clean) <= set(single)
    by = sorted(polite, key=lambda r: r.doc_id)
    groups = plain([r.text for r in by], 5, 8, 10)
    assert {r.doc_id for r in single} == {by[i].doc_id for i, (n, first) in groups.items() if n == 0 or first == i}
    items = [tuple(words(r.text, True)) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    for r in single:
        w = words(r.text, True)
        holds = any(tuple(w[i : i + len(t)]) == t for t in items for i in range(len(w) - len(t) + 1) if w[i] == t[0])
        assert not holds or r.doc_id not in {c.doc_id for c in clean}
    assert len(clean) >= 0.9 * len(single)
    sizes, taken = {}, {}
    for out, rows in ((sizes, clean), (taken, mixed)):
        for r in rows:
            out[r.source] = out.get(r.source, 0) + len(words(r.text))
    weights = {s: (sizes[s], (3.0, 1.0, 2.0)[i % 3]) for i, s in enumerate(sorted(sizes))}
    target = filled(weights, 1.5 * sum(sizes.values()), 2.0)
    assert all(abs(taken.get(s, 0) - target[s]) < 1 for s in sizes)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted((r.doc_id, len(library.encode(r.text or "", add_special_tokens=False).ids) + 1) for r in mixed)
    assert sorted((r.doc_id, r.n_tokens) for r in ids) == want


def test_odd_and_empty_documents(spark, sf_dir, tmp_path):
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 else "s", 0) for i, t in enumerate(odd_texts())] * 2 + [(None, None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for name, data in (("odd", rows), ("none", [])):
        folder = tmp_path / name
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/documents.parquet")
        for table in ("labels", "benchmark"):
            spark.read.parquet(f"{sf_dir}/{table}.parquet").write.parquet(f"{folder}/{table}.parquet")
        out = corpus_pipeline.run(spark, str(folder)).collect()
        assert bool(out) == bool(data)
