"""Toxicity by weak supervision.

Voters look at a text and vote toxic, clean or nothing: word lists mined from labelled rows, a fixed word list, and
patterns. A generative label model estimates from all voted rows how often each voter is right and which voters say the
same thing twice, and gives every row a posterior label. A linear classifier trained on posterior labels gives the score.

The text is read twice: about MINE_ROWS labelled rows for the word lists (their keys are few enough to broadcast, so no
text is shuffled for its label), all rows for the counts that votes and features come from. What reaches the driver is
bounded: the mined words, one row per vote pattern, and a sample for the classifier.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlane.functions.skew import attach_by_key
from silverlane.llm import words as W
from silverlane.llm.common import seeded_order, small_batches, stored

LISTS = 8
MIN_TEXTS = 4
MIN_SHARE = 0.02
MIN_PRECISION = 0.9
MIN_SHARE_HERE = 0.7
MIN_CORRELATION, COPIED = 0.2, 0.9
MIN_KNOWN = 30
EQUAL_FIT = 1e-3
USUAL_ROWS, USUAL_ACCURACY = 0.5, 0.95
MINE_ROWS = 20000
SAMPLE_ROWS = 20000
ROUNDS = 60
RIDGE = 2.5e-5
BANDS, BAND_ROWS = 8, 4
NEAR = 0.8
SHOUT, BANGS = 0.6, 0.02

# Common English insults and swear words, written down from general knowledge and not from any table.
SEED_WORDS = (
    "arsehole", "asshole", "bastard", "bitch", "bullshit", "cretin", "cunt", "dickhead", "dimwit", "douchebag", "dumbass",
    "fuck", "fucker", "fucking", "halfwit", "idiot", "idiotic", "imbecile", "jackass", "moron", "moronic", "motherfucker",
    "nitwit", "prick", "scum", "scumbag", "shit", "shithead", "simpleton", "slut", "stupid", "twat", "wanker", "whore",
)

COUNTS = "hits array<int>, n_words bigint, n_bytes bigint, n_upper bigint, n_bangs bigint"


def _letter_words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
                                F.lit("([a-z\\u0080-\\x{10FFFF}]+)"), 1)


def _least_hash(seed: int) -> Column:
    return F.array_min(F.transform("hashes", lambda h: F.xxhash64(h, F.lit(seed))))


def _copies_once(rows: DataFrame) -> DataFrame:
    """(words, toxic), one row for each set of near copies with the same label.

    Rows with the same set of all their words (numbers too) are one. Of the others a row goes only for another row that
    agrees in one of BANDS bands of BAND_ROWS minimum hashes and, compared word by word, has a Jaccard of NEAR or more
    with it: the first row of the band, so that a band costs one pair a row. Unrelated texts all stay.
    """
    tokens = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("([a-z0-9\\u0080-\\x{10FFFF}]+)"), 1))
    whole = rows.withColumn("tokens", F.array_sort(tokens)).withColumn(
        "place", F.struct(F.size("tokens").alias("n"), F.md5(F.array_join("tokens", " ")).alias("id"), "toxic")
    ).groupBy("place").agg(F.first("tokens").alias("tokens"), F.first("words").alias("words"))
    whole = stored(whole, "toxic-sets")
    bands = F.array(*[
        F.xxhash64(F.lit(b), "place.toxic", *[_least_hash(r) for r in range(b * BAND_ROWS, (b + 1) * BAND_ROWS)])
        for b in range(BANDS)
    ])
    hashed = whole.withColumn("hashes", F.transform("tokens", lambda w: F.xxhash64(w)))
    banded = stored(hashed.select("place", F.explode(bands).alias("band")), "toxic-bands")
    firsts = banded.groupBy("band").agg(F.min("place").alias("first"), F.count("*").alias("n")).filter("n > 1")
    met = attach_by_key(banded, firsts, "band", banded.count(), ["first"])
    pairs = stored(met.filter("place <> first").select("place", "first").distinct(), "toxic-pairs")
    others = pairs.groupBy("first").agg(F.count("*").alias("n")).join(
        whole.select(F.col("place").alias("first"), F.col("tokens").alias("others")), "first")
    shared = F.size(F.array_intersect("tokens", "others"))
    both = attach_by_key(pairs, others, "first", pairs.count(), ["others"]).join(whole.select("place", "tokens"), "place")
    near = both.filter(shared >= NEAR * (F.size("tokens") + F.size("others") - shared)).select("place").distinct()
    return whole.join(near, "place", "left_anti").select("words", "place.toxic")


def mine_words(labelled: DataFrame, text: str, label: str) -> list[tuple[str, float]]:
    """Words that mark the label, with their precision, best first. Near copies count once.

    A word is in MIN_SHARE of the toxic texts at least, so there are at most the mean number of words of such a text
    divided by MIN_SHARE.
    """
    worded = labelled.filter(F.col(text).isNotNull() & F.col(label).isNotNull()).select(
        F.col(text).alias("text"), F.array_distinct(_letter_words(F.col(text))).alias("words"), (F.col(label) == 1).alias("toxic")
    ).filter(F.size("words") > 0)
    once = stored(_copies_once(worded), "toxic-words")
    sums = once.agg(F.sum(F.col("toxic").cast("long")).alias("toxic"), F.count("*").alias("all")).first()
    toxic, clean = sums["toxic"] or 0, (sums["all"] or 0) - (sums["toxic"] or 0)
    counted = once.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(
        F.sum(F.col("toxic").cast("long")).alias("t"), F.sum((~F.col("toxic")).cast("long")).alias("c")
    )
    ratio = (F.col("t") + 0.1) / (toxic + 0.2)
    base = (F.col("c") + 0.1) / (clean + 0.2)
    kept = counted.filter(F.col("t") >= max(MIN_TEXTS, MIN_SHARE * toxic)).withColumn("precision", ratio / (ratio + base))
    best = kept.filter((F.col("precision") >= MIN_PRECISION) & (F.col("t") >= MIN_SHARE_HERE * (F.col("t") + F.col("c")))).orderBy(F.desc("t"), "word")
    return [(row["word"], row["precision"]) for row in best.select("word", "precision", "t").collect()]


def count_hits(df: DataFrame, key: str, text: str, words: list[tuple[str, int]], carry: dict[str, Column]) -> DataFrame:
    """(key, carry..., hits per list, sizes) of each whole text; null counts as empty."""
    width = LISTS + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = (W.LOWER >= 0x61) & (W.LOWER <= 0x7A) | (W.LOWER >= 0x80)
        hashes = np.array([W.hash_word(w.encode()) for w, _ in words] or [0], dtype=np.uint64)
        lists = np.array([n for _, n in words] or [0])
        order = np.argsort(hashes)
        hashes, lists = hashes[order], lists[order]
        for batch in batches:
            parts = []
            for texts in W.slices(batch.column(batch.num_columns - 1)):
                found = W.split(texts, letters, W.LOWER)
                near = np.minimum(np.searchsorted(hashes, found.hashes), len(hashes) - 1)
                at = np.flatnonzero(hashes[near] == found.hashes) if words else np.zeros(0, dtype=int)
                rows = len(texts.begins) - 1
                hits = np.bincount(found.text_of()[at] * width + lists[near[at]], minlength=rows * width)
                upper = (texts.data >= 0x41) & (texts.data <= 0x5A)
                ends = [np.concatenate([[0], np.cumsum(x)])[texts.begins] for x in (upper, texts.data == 0x21)]
                parts.append((hits.reshape(rows, width), np.diff(found.begins), np.diff(texts.begins), *map(np.diff, ends)))
            hits, n_words, n_bytes, upper, bangs = (
                np.concatenate([p[i] for p in parts]) if parts else np.zeros((0, width)[: 2 if i == 0 else 1], dtype=np.int64)
                for i in range(5)
            )
            hits = pa.ListArray.from_arrays(np.arange(len(hits) + 1, dtype=np.int32) * width,
                                            pa.array(hits.reshape(-1).astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(batch.num_columns - 1)]
                + [hits, *(pa.array(x.astype(np.int64)) for x in (n_words, n_bytes, upper, bangs))],
                names=names + ["hits", "n_words", "n_bytes", "n_upper", "n_bangs"],
            )

    kept = df.select(key, *[value.alias(name) for name, value in carry.items()], text)
    names = kept.columns[:-1]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])
    return kept.mapInArrow(run, f"{schema}, {COUNTS}")


def _votes() -> list[Column]:
    """One column per voter: 1 toxic, -1 clean, 0 no vote."""
    hit = [F.element_at("hits", i + 1) for i in range(LISTS + 1)]
    any_hit = hit[0] > 0
    for h in hit[1:]:
        any_hit = any_hit | (h > 0)
    lists = [F.when(h > 0, 1).otherwise(0) for h in hit]
    return lists + [
        F.when(~any_hit, -1).otherwise(0),
        F.when(F.col("n_bangs") > BANGS * F.col("n_bytes"), 1).otherwise(0),
        F.when((F.col("n_upper") <= SHOUT * F.col("n_bytes")) & (F.col("n_bangs") == 0) & ~any_hit, -1).otherwise(0),
    ]


def _features() -> list[Column]:
    """Inputs of the linear classifier."""
    hit = [F.element_at("hits", i + 1) for i in range(LISTS + 1)]
    total = hit[0]
    for h in hit[1:]:
        total = total + h
    size = F.greatest(F.col("n_bytes"), F.lit(1))
    return [F.when(total > 0, 1.0).otherwise(0.0), F.log1p(total.cast("double"))] + [
        F.when(h > 0, 1.0).otherwise(0.0) for h in hit
    ] + [F.col("n_bangs") / size, F.col("n_upper") / size]


class LabelModel:
    """Posterior of the label given votes: each vote multiplies the odds, voters that repeat others weigh less.

    ``counts`` has a column for rows without a label, with label 0 and with label 1. Which voters say the same thing
    twice is found before any label is estimated: from votes within a label where enough rows have one, else from voters
    that agree nearly always. Rows with a label count for it, the others for their posterior, again and again
    (expectation maximization). This starts several times: from voters that are mostly right, from accuracies that
    agreement rates of three independent voters imply, and from each voter taken as the truth. The most likely outcome
    stands; of outcomes equally likely the one with the most decided posterior. Without labelled rows the share of toxic
    rows stays at ``prior``, and voters that all copy one are taken to be as accurate as usual.
    """

    def __init__(self, votes: np.ndarray, counts: np.ndarray, prior: float):
        self.prior = prior
        self._share = np.stack([(counts.sum(1)[:, None] * (votes == v)).sum(0) for v in (-1, 0, 1)], axis=1) / counts.sum()
        # Voters that are mostly right; USUAL_ROWS rows of each label are taken to vote so.
        share = self._share + 1e-6
        self._usual = self._tables(share * np.array([0.2, 1.0, 5.0]), share * np.array([1.2, 1.0, 0.3]))
        repeats = self._repeats(votes, counts)
        self.weights = 1 / (1 + repeats.sum(1))
        if not counts[:, 1:].sum() and self._voices(votes, repeats) < 2:
            # One voice and no label: nothing can be estimated, and every vote counts with its usual accuracy.
            speaks = np.maximum(1 - share[:, 1], 1e-6)
            right, wrong = speaks * USUAL_ACCURACY, speaks * (1 - USUAL_ACCURACY)
            self.weights = np.ones(votes.shape[1])
            self.table = self._tables(np.stack([wrong, share[:, 1], right], axis=1), np.stack([right, share[:, 1], wrong], axis=1))
            return
        outcomes = [self._fit(votes, counts, start) for start in self._starts(votes, counts.sum(1), repeats)]
        # Less than two in all is what chance alone gives an outcome more than another.
        least = max(fit for fit, *_ in outcomes) - max(EQUAL_FIT, 2 / counts.sum())
        _, _, self.table, self.prior = min((o for o in outcomes if o[0] >= least), key=lambda o: o[1])

    @staticmethod
    def _correlation(votes: np.ndarray, w: np.ndarray) -> np.ndarray:
        w = w / max(w.sum(), 1e-9)
        centred = votes - w @ votes
        spread = np.sqrt((w[:, None] * centred**2).sum(0)) + 1e-6
        return (w[:, None] * centred).T @ centred / np.outer(spread, spread)

    def _repeats(self, votes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """How much of each voter every other one says too."""
        m = votes.shape[1]
        within = [self._correlation(votes, counts[:, y]) for y in (1, 2) if counts[:, y].sum() >= MIN_KNOWN]
        if len(within) == 2:
            found = sum(within) / 2
            found[found < MIN_CORRELATION] = 0
        else:
            rows = counts.sum(1)
            found = self._correlation(votes, rows)
            for i in range(m):
                for j in range(i):
                    both = rows * (votes[:, i] != 0) * (votes[:, j] != 0)
                    if min((both * (votes[:, k] == v)).sum() for k in (i, j) for v in (-1, 1)) > 0:
                        found[i, j] = found[j, i] = self._correlation(votes[:, [i, j]], both)[0, 1]
            found[found < COPIED] = 0
        np.fill_diagonal(found, 0)
        return np.minimum(found, 1)

    @staticmethod
    def _voices(votes: np.ndarray, repeats: np.ndarray) -> int:
        """Voters that vote at all and copy none before them."""
        votes_at_all = (votes != 0).any(0)
        return sum(bool(votes_at_all[j]) and not (votes_at_all[:j] & (repeats[j, :j] >= COPIED)).any() for j in range(votes.shape[1]))

    def _tables(self, toxic: np.ndarray, clean: np.ndarray) -> np.ndarray:
        return np.stack([clean / clean.sum(1, keepdims=True), toxic / toxic.sum(1, keepdims=True)])

    def _starts(self, votes: np.ndarray, rows: np.ndarray, repeats: np.ndarray):
        """P(vote = v | label) for votes -1, 0, 1, by label and voter."""
        m = votes.shape[1]
        share = self._share + 1e-6
        yield self._usual
        accuracy = self._triples(votes, rows, repeats)
        if accuracy is not None:
            right, wrong = np.clip(accuracy, 0.55, 0.99), 1 - np.clip(accuracy, 0.55, 0.99)
            speaks = np.maximum(1 - share[:, 1], 1e-6)
            yield self._tables(np.stack([speaks * wrong, share[:, 1], speaks * right], axis=1),
                               np.stack([speaks * right, share[:, 1], speaks * wrong], axis=1))
        for j in range(m):
            if any(repeats[j, i] >= COPIED for i in range(j)):
                continue  # a copy starts where its model does
            q = np.where(votes[:, j] > 0, 0.95, np.where(votes[:, j] < 0, 0.05, self.prior))
            yield self._maximize(votes, np.stack([rows * (1 - q), rows * q]))

    def _triples(self, votes: np.ndarray, rows: np.ndarray, repeats: np.ndarray) -> np.ndarray | None:
        """Accuracy of each voter from its agreement with two others that are independent of it and of each other."""
        m = votes.shape[1]
        speak = (votes != 0).astype(float)
        together = (rows[:, None] * speak).T @ speak
        agree = (rows[:, None] * votes).T @ votes / np.maximum(together, 1)
        free = (repeats == 0) & (together >= MIN_KNOWN)
        out, any_found = np.full(m, 0.7), False
        for i in range(m):
            found = [np.sqrt(min(1.0, abs(agree[i, j] * agree[i, k] / agree[j, k]))) for j in range(m) for k in range(j)
                     if len({i, j, k}) == 3 and free[i, j] and free[i, k] and free[j, k] and abs(agree[j, k]) > 0.02]
            if found:
                out[i], any_found = (1 + float(np.median(found))) / 2, True
        return out if any_found else None

    def _maximize(self, votes: np.ndarray, mass: np.ndarray) -> np.ndarray:
        onehot = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(float)
        seen = np.einsum("yn,njv->yjv", mass, onehot) + 0.01 + USUAL_ROWS * self._usual
        return seen / seen.sum(2, keepdims=True)

    def _fit(self, votes: np.ndarray, counts: np.ndarray, table: np.ndarray) -> tuple[float, float, np.ndarray, float]:
        """Log likelihood a row and doubt a row (entropy of the posterior) after some rounds, the table and the prior."""
        known, rows, prior = counts[:, 1:].T, counts.sum(1), self.prior
        for _ in range(ROUNDS):
            q = self._posterior(votes, table, prior)
            mass = np.stack([counts[:, 0] * (1 - q), counts[:, 0] * q]) + known
            table = self._maximize(votes, mass)
            if known.sum():
                prior = float(np.clip((mass[1].sum() + 20 * self.prior) / (rows.sum() + 20), 1e-4, 1 - 1e-4))
        joint = self._joint(votes, table, prior)
        fit = (counts[:, 0] * np.logaddexp(*joint)).sum() + (known * joint).sum()
        q = np.clip(self._posterior(votes, table, prior), 1e-9, 1 - 1e-9)
        doubt = -(counts[:, 0] * (q * np.log(q) + (1 - q) * np.log(1 - q))).sum()
        return fit / rows.sum(), doubt / rows.sum(), table, prior

    def _joint(self, votes: np.ndarray, table: np.ndarray, prior: float) -> np.ndarray:
        """Log of P(label and votes), a row for label 0 and one for 1."""
        out = np.log([1 - prior, prior])[:, None] + np.zeros((2, len(votes)))
        for j in range(votes.shape[1]):
            out += self.weights[j] * np.log(table[:, j] + 1e-9)[:, votes[:, j] + 1]
        return out

    def _posterior(self, votes: np.ndarray, table: np.ndarray, prior: float) -> np.ndarray:
        clean, toxic = self._joint(votes, table, prior)
        return 1 / (1 + np.exp(-np.clip(toxic - clean, -30, 30)))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return self._posterior(votes, self.table, self.prior)


def _logistic(x: np.ndarray, q: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression on soft labels, by Newton's method; the bias comes first. Large weights cost the
    same per row however many rows there are."""
    ridge = RIDGE * w.sum()
    x = np.hstack([np.ones((len(x), 1)), x])
    theta = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    def loss(at: np.ndarray) -> float:
        z = x @ at
        return float((w * (np.logaddexp(0, z) - q * z)).sum() + 0.5 * (penalty * at**2).sum())

    now = loss(theta)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        step = np.linalg.solve(
            (x * (w * p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9), x.T @ (w * (p - q)) + penalty * theta
        )
        while (then := loss(theta - step)) > now and np.abs(step).max() > 1e-9:  # too far: half the way
            step /= 2
        if now - then < 1e-10 * max(1.0, w.sum()):
            break
        theta, now = theta - step, then
    return theta


def score_toxicity(
    docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, learn: Column,
    carry: dict[str, Column] | None = None, seed: int = 0,
) -> DataFrame:
    """(key, carry..., score, posterior features) for each row of ``docs``.

    ``learn`` marks rows whose labels may be used. Labels are joined by key; several for a key are reduced to the
    largest. Null and empty texts have no hits and get the score of such a text. Without usable labels the votes of the
    fixed words and patterns alone decide, on the assumption that one row in ten is toxic; if ``learn`` marks no row, the
    texts of all rows count as rows without a label. Other columns never enter a score. An empty table gives an empty
    result.
    """
    carry = carry or {}
    small_batches(docs.sparkSession)
    truth = labels.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.max(label).alias("_label"))
    labelled = truth.filter(F.col("_label").isNotNull())
    drawn = min(1.0, MINE_ROWS / max(1, labelled.count()))
    chosen = labelled.filter(seeded_order(seed, "_key") <= F.lit(drawn * (1 << 60)))
    known = docs.filter(learn).join(F.broadcast(chosen), F.col(key) == F.col("_key")).select(F.col(text), F.col("_label"))
    mined = mine_words(known, text, "_label")
    known_words = {w for w, _ in mined}
    words = [(w, i % LISTS) for i, (w, _) in enumerate(mined)]
    words += [(w, LISTS) for w in SEED_WORDS if w not in known_words]
    counted = stored(count_hits(docs, key, text, words, carry | {"_learn": learn}), "toxic-counts")
    votes, features = _votes(), _features()
    known_label = F.when(F.col("_label") == 1, 2).when(F.col("_label") == 0, 1).otherwise(0).alias("known")
    usable = counted.filter("_learn")
    usable = counted if usable.isEmpty() else usable
    learned = usable.withColumn("_own", F.when(F.col("_learn"), F.col(key))).join(truth, F.col("_own") == F.col("_key"), "left")
    patterns = learned.groupBy(*[v.alias(f"v{i}") for i, v in enumerate(votes)], known_label).agg(
        F.count("*").alias("n")
    ).collect()
    if not patterns:
        return counted.select(key, *carry, F.lit(0.0).alias("score"), "hits")
    place = {v: i for i, v in enumerate(sorted({tuple(row[f"v{i}"] for i in range(len(votes))) for row in patterns}))}
    table, counts = np.array(list(place)), np.zeros((len(place), 3))
    for row in patterns:
        counts[place[tuple(row[f"v{i}"] for i in range(len(votes)))], row["known"]] += row["n"]
    known_rows = counts[:, 1:].sum(0)
    base = known_rows[1] / known_rows.sum() if known_rows.sum() else 0.1  # of rows whose labels may be used
    model = LabelModel(table, counts, min(max(base, 0.01), 0.5))
    posterior = {tuple(v): q for v, q in zip(table.tolist(), model.posterior(table))}
    share = min(1.0, SAMPLE_ROWS / counts.sum())
    # Drawn by the counts, so that rows without a key and copies, which the grouping makes one, are drawn like others.
    sizes = ("n_words", "n_bytes", "n_upper", "n_bangs")
    drawn = usable.filter(seeded_order(seed, *sizes) <= F.lit(share * (1 << 60))).select(
        *[v.alias(f"v{i}") for i, v in enumerate(votes)], *[x.alias(f"x{i}") for i, x in enumerate(features)]
    ).groupBy(*[f"v{i}" for i in range(len(votes))], *[f"x{i}" for i in range(len(features))]).agg(F.count("*").alias("n"))
    sample = drawn.toPandas()
    x = sample[[f"x{i}" for i in range(len(features))]].to_numpy(dtype=float)
    q = np.array([posterior[tuple(v)] for v in sample[[f"v{i}" for i in range(len(votes))]].to_numpy().tolist()])
    theta = _logistic(x, q, sample["n"].to_numpy(dtype=float)) if len(sample) else np.zeros(len(features) + 1)
    line = F.lit(float(theta[0]))
    for weight, feature in zip(theta[1:], features):
        line = line + F.lit(float(weight)) * feature
    return counted.select(key, *carry, (1 / (1 + F.exp(-line))).alias("score"), "hits")
