"""Queries of the operators over their whole tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlane.llm import langid
from silverlane.llm.common import WORD_PATTERN, read_table, word_count
from silverlane.llm.decontamination import contaminated
from silverlane.llm.embeddings import near_vectors
from silverlane.llm.licenses import labels_of, scan_licenses
from silverlane.llm.mixing import mix_sources
from silverlane.llm.rules import count_rules, judge
from silverlane.llm.runs import find_runs
from silverlane.llm.setjoin import jaccard_groups
from silverlane.llm.sharding import interleave
from silverlane.llm.substrings import remove_repeats
from silverlane.llm.tokenfiles import read_token_files, write_token_files
from silverlane.llm.toxicity import score_toxicity
from silverlane.llm.trie import trie, turn_rows, with_shared_starts

SHARDS = 40
TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
TOXIC = 0.5
MIX_SHARE, MIX_EPOCHS, MIX_CYCLE = 1.5, 2.0, (3.0, 1.0, 2.0)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(run):
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return register


MIX_SQL = """
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
    ('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, '~')), 1, 15))::BIGINT AS place
  FROM documents
), totals AS (
  SELECT source, sum(size)::DOUBLE AS source_size,
    [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
  FROM docs GROUP BY source
), ratios AS (
  SELECT *, 2 * source_size / weight AS ratio, 1.5 * sum(source_size) OVER () AS budget FROM totals
), levels AS (
  SELECT *, coalesce(sum(2 * source_size) OVER (ORDER BY ratio, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
    sum(weight) OVER (ORDER BY ratio, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
  FROM ratios
), level AS (
  SELECT budget - held AS rest, open FROM levels WHERE (budget - held) * weight <= 2 * source_size * open
  ORDER BY ratio, source LIMIT 1
), targets AS (
  SELECT source, source_size, CASE WHEN 2 * source_size * open < rest * weight THEN 2 * source_size
    ELSE rest * weight / open END AS target FROM totals, level
), runs AS (
  SELECT doc_id, size, source_size::BIGINT AS source_size, target, floor(target / source_size)::BIGINT AS epochs,
    sum(size) OVER (PARTITION BY d.source ORDER BY place, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS before
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  (epochs * size + greatest(0, least(floor(target - epochs * source_size)::BIGINT - before, size)))::BIGINT AS taken
FROM runs
"""


@query("op2_mixing", MIX_SQL)
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mix_sources(docs, word_count(F.col("text")), "source", "doc_id", MIX_SHARE, MIX_EPOCHS, MIX_CYCLE)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op5_licenses")
def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(read_table(spark, sf_dir, "documents"), "doc_id", "text")
    base = F.filter("matches", lambda m: m["kind"] == "phrase")
    starts = F.transform(base, lambda m: m["start"])
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels_of(F.col("matches"), "phrase").alias("base_labels"),
        labels_of(F.col("matches"), "phrase", "template").alias("labels"),
        F.coalesce(
            F.array_max(F.transform("matches", lambda m: m["share"])), F.lit(0.0)
        ).alias("score"),
    )


@query("op6_sharding")
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", "source", (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    dealt = interleave(docs, SHARDS, "source", "doc_id", tie=("size", "text_crc32"))
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source",
    )


def fold(key: str, parts: int):
    """Number of the part a row is in, from the unsigned crc32 of its key as text."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(parts))


@query("op9_language")
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(fold("doc_id", 4) == 2, F.lit(False))
    model = langid.train(docs.filter(~held_out), "text", "lang", "doc_id")
    return langid.predict(docs, model, "doc_id", "text", {"held_out": held_out})


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(False))
    scored = score_toxicity(
        docs, read_table(spark, sf_dir, "labels"), "doc_id", "text", "toxic", ~held_out, {"held_out": held_out}
    )
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))


@query("op4_decontamination")
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and test item of which the document covers half or more."""
    docs, items = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    found = contaminated(docs, items, "doc_id", "text", "item_id", "text")
    return found.select("doc_id", "item_id", "n_item_words", "n_covered", "coverage", "n_tiles", "first_word")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


@query("op10_tokens")
def op10_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return read_token_files(write_token_files(docs, "doc_id", "text", tokenizer_path(), END_ID), "doc_id")


@query("op3_substrings")
def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(read_table(spark, sf_dir, "documents"), "doc_id", "text")
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query("op7_embeddings")
def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label", 0.98)


@query("op1_jaccard")
def op1_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(read_table(spark, sf_dir, "documents"), "doc_id", "text", 3, 90, 100)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text) in which the words of one document in ten repeat from some word on; others stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    chosen = docs.select("doc_id", "text", g.alias("g"), F.when(
        h % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD_PATTERN})"), 1)).alias("words"))
    n = F.size("words")
    chosen = chosen.select("doc_id", "text", "words", "g", F.when(n > 0, (F.col("g") % F.greatest(n, F.lit(1))).cast("int")).alias("a"))
    rest = n - F.col("a")
    period = (1 + F.floor(rest / (3 + F.col("g") % 8))).cast("int")
    again = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, period), F.ceil(rest / period).cast("int")))
    planted = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(again, F.lit(1), rest))
    return chosen.select("doc_id", F.when(F.col("a").isNull(), F.col("text")).otherwise(F.array_join(planted, " ")).alias("text"))


@query("op11_runs")
def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(with_planted_runs(read_table(spark, sf_dir, "documents")), "doc_id", "text")
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.withColumns({"longest": longest, "lines": lines}).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"), (-F.col("longest.period")).alias("period"),
        F.floor(1000 * F.col("longest.length") / -F.col("longest.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("lines", lambda x: F.concat(x, F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query("op12_quality")
def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_rules(read_table(spark, sf_dir, "documents"), "doc_id", "text")
    judged = judge(counted, read_table(spark, sf_dir, "labels"), "doc_id", "quality")
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly"
    )


TRIE_SQL = """
WITH ordered AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS at
  FROM conversations WHERE conv_id IS NOT NULL
), crc AS (
  SELECT c, n, xor(list_reduce(list_prepend(4294967295::BIGINT, [ord(x)::BIGINT FOR x IN split(c::VARCHAR, '')]),
    lambda s, b: list_reduce(list_prepend(xor(s, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda y, z: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END)), 4294967295) % 9 AS h
  FROM (SELECT c, count(*) AS n FROM ordered GROUP BY c)
), convs AS (
  SELECT a.c, a.h, a.c - a.c % 5 AS base, least(a.h, coalesce(b.n, 0)) AS taken FROM crc a LEFT JOIN crc b ON b.c = a.c - a.c % 5
), rebuilt AS (
  SELECT v.c, o.at + 1 AS d, role, text FROM convs v JOIN ordered o ON o.c = v.base AND o.at < v.taken
  UNION ALL SELECT v.c, v.taken + o.at - v.h + 1, role, text FROM convs v JOIN ordered o ON o.c = v.c AND o.at >= v.h
  UNION ALL SELECT c, 0, '', '' FROM convs
), rows AS (
  SELECT c, d, CASE WHEN d = 0 THEN 0 ELSE strlen(text) END AS size,
    sha256(string_agg(sha256(role) || sha256(text), '') OVER (PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING)) AS k,
    d = max(d) OVER (PARTITION BY c) AS ends
  FROM rebuilt
), nodes AS (
  SELECT d, k, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS saved,
    sha256(coalesce(string_agg(CASE WHEN ends THEN c::VARCHAR END, ',' ORDER BY c), '')) AS ends_sha256
  FROM rows GROUP BY d, k
), up AS (
  SELECT n.d, n.k, p.conv_id AS parent_conv_id, p.d AS parent_d, p.k AS parent_k
  FROM nodes n JOIN rows r ON r.c = n.conv_id AND r.d = n.d - 1 JOIN nodes p ON p.d = r.d AND p.k = r.k
), children AS (
  SELECT parent_d AS d, parent_k AS k, count(*) AS n_children FROM up GROUP BY ALL
), whole AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children USING (d, k)
), subtree AS (
  SELECT r.d, r.k, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
  FROM whole n JOIN rows r ON r.c = n.conv_id AND r.d <= n.d GROUP BY r.d, r.k
)
SELECT conv_id, n.d::BIGINT AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM whole n JOIN subtree USING (d, k) LEFT JOIN up USING (d, k)
"""


@query("op13_trie", TRIE_SQL)
def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = turn_rows(read_table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    return trie(with_shared_starts(turns, fold("conv", 9), 5))
