"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text is the mean of the embeddings of its byte n-grams (hashed into a fixed number of buckets), followed by a linear
softmax over the languages. Embeddings and softmax are trained by stochastic gradient descent in numpy on a bounded
sample of labelled rows. A temperature and a rejection limit are fitted on sampled rows that training does not see.

For prediction the embeddings are multiplied by the softmax weights once, so a text costs one table row per n-gram.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverlane.llm import words as W
from silverlane.llm.common import seeded_order, small_batches

SAMPLE_ROWS = 2400
PIECE_CHARS = 1500
BUCKET_BITS = 15
ORDERS = (1, 2, 3, 4)
WIDTH = 16
EPOCHS = 4
RATE = 0.8
WANTED_ACCURACY = 0.99
BROADCAST_LANGUAGES = 1000
UNDETERMINED = "und"

_BLANK = np.uint8(0x20)
_FOLD = W.LOWER.copy()
_FOLD[~(((W.LOWER >= 0x61) & (W.LOWER <= 0x7A)) | (W.LOWER >= 0x80))] = _BLANK


class Model(NamedTuple):
    """Languages, logits of each bucket and of the bias (temperature applied), and the confidence to accept."""

    languages: list[str]
    logits: np.ndarray
    bias: np.ndarray
    accept: float


def _letters(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters with single blanks between words and at both ends of each text."""
    padded = np.full(len(data) + 2 * (len(begins) - 1), _BLANK)
    text = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    padded[np.arange(len(data)) + 2 * text + 1] = _FOLD[data]
    starts = begins + 2 * np.arange(len(begins))
    keep = np.ones(len(padded), dtype=bool)
    keep[1:] = (padded[1:] != _BLANK) | (padded[:-1] != _BLANK)
    keep[starts[:-1]] = True
    kept = np.concatenate([[0], np.cumsum(keep)])
    return padded[keep], kept[starts]


def _buckets(letters: np.ndarray, order: int) -> np.ndarray:
    """Bucket of the n-gram at each place; the last places wrap into nothing and are cut by the caller."""
    n = len(letters) - order + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    code = letters[:n].astype(np.uint32)
    for k in range(1, order):
        code = (code << np.uint32(8)) | letters[k : k + n]
    code = (code ^ np.uint32(order * 0x1F123BB5)) * np.uint32(0x9E3779B1)
    code ^= code >> np.uint32(15)
    code *= np.uint32(0x85EBCA77)
    return (code >> np.uint32(32 - BUCKET_BITS)).astype(np.int64)


def _sample(labelled: DataFrame, text: str, lang: str, key: str, seed: int) -> list:
    """About SAMPLE_ROWS rows, evenly over the languages, each a piece of at most PIECE_CHARS from a seeded place."""
    counts = labelled.groupBy(lang).agg(F.count("*").alias("_n"))
    languages = counts.count()
    each = max(20, SAMPLE_ROWS // max(1, languages))
    sizes = counts.select(F.col(lang).alias("_lang"), "_n")
    if languages <= BROADCAST_LANGUAGES:  # otherwise Spark chooses the join
        sizes = F.broadcast(sizes)
    order = seeded_order(seed, key)
    share = F.lit(4.0 * each) / F.col("_n") * F.lit(float(1 << 60))
    thin = labelled.withColumn("_order", order).join(sizes, F.col(lang) == F.col("_lang")).filter(F.col("_order") <= share)
    place = F.row_number().over(Window.partitionBy("_lang").orderBy("_order", F.col(text)))
    room = F.greatest(F.lit(1), F.length(text) - PIECE_CHARS)
    piece = F.substring(F.col(text), (F.pmod(F.col("_order"), room) + 1).cast("int"), F.lit(PIECE_CHARS))
    return thin.withColumn("_place", place).filter(F.col("_place") <= each).select(
        "_lang", piece.alias("piece"), "_order"
    ).orderBy("_order", "piece").collect()


def _examples(rows: list, languages: list[str], seed: int) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Buckets and their shares for pieces of each sampled text: the whole, and shorter runs for short texts."""
    rng, out = np.random.default_rng(seed), []
    for row in rows:
        data = np.frombuffer((row["piece"] or "").encode(), dtype=np.uint8)
        letters, _ = _letters(data, np.array([0, len(data)]))
        label = languages.index(row["_lang"])
        cuts = [(0, len(letters))]
        for size in (12, 30, 80, 200):
            if len(letters) > size:
                start = int(rng.integers(0, len(letters) - size))
                cuts.append((start, start + size))
        for low, high in cuts:
            codes = np.concatenate([_buckets(letters[low:high], k) for k in ORDERS])
            if len(codes):
                unique, counts = np.unique(codes, return_counts=True)
                out.append((unique, (counts / len(codes)).astype(np.float32), label))
    return out


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(labelled: DataFrame, text: str, lang: str, key: str, seed: int = 0) -> Model:
    """Fit a model on rows whose text and language are not null. Without such rows it knows no language."""
    rows = _sample(labelled.filter(F.col(text).isNotNull() & F.col(lang).isNotNull()), text, lang, key, seed)
    languages = sorted({row["_lang"] for row in rows})
    if not languages:
        return Model([], np.zeros((1 << BUCKET_BITS, 0), dtype=np.float32), np.zeros(0), 1.0)
    held = set(range(0, len(rows), 5)) if len(rows) >= 50 else set()
    fit = _examples([r for i, r in enumerate(rows) if i not in held], languages, seed)
    check = _examples([r for i, r in enumerate(rows) if i in held], languages, seed + 1) or fit
    rng = np.random.default_rng(seed)
    embedding = rng.uniform(-1 / WIDTH, 1 / WIDTH, (1 << BUCKET_BITS, WIDTH)).astype(np.float32)
    weights, bias = np.zeros((WIDTH, len(languages)), dtype=np.float32), np.zeros(len(languages), dtype=np.float32)
    steps, done = EPOCHS * len(fit), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(fit)):
            unique, shares, label = fit[i]
            rate = np.float32(RATE * (1 - done / steps))
            hidden = shares @ embedding[unique]
            error = _softmax(hidden @ weights + bias)
            error[label] -= 1
            back = weights @ error
            weights -= rate * np.outer(hidden, error)
            bias -= rate * np.float32(0.1) * error
            embedding[unique] -= (rate * np.float32(len(ORDERS)) * shares)[:, None] * back[None, :]
            done += 1
    logits = embedding @ weights
    raw = np.array([shares @ logits[unique] + bias for unique, shares, _ in check], dtype=np.float64)
    labels = np.array([label for *_, label in check])
    scales = np.geomspace(0.05, 5, 60)
    losses = [-np.log(_softmax(raw * s)[np.arange(len(labels)), labels] + 1e-12).mean() for s in scales]
    scale = float(scales[int(np.argmin(losses))])
    sure = _softmax(raw * scale)
    top, right = sure.max(axis=1), sure.argmax(axis=1) == labels
    best = np.argsort(-top, kind="stable")
    accuracy = np.cumsum(right[best]) / np.arange(1, len(best) + 1)
    good = np.flatnonzero(accuracy >= WANTED_ACCURACY)
    accept = float(top[best[good[-1]]]) if len(good) else 1.0
    return Model(languages, (logits * scale).astype(np.float32), bias.astype(np.float64) * scale, accept)


def predict(df: DataFrame, model: Model, key: str, text: str, carry: dict[str, Column] | None = None) -> DataFrame:
    """(key, carry..., lang_pred, score, accepted) for each row.

    ``score`` is the calibrated probability of the predicted language; ``accepted`` says whether it reaches the limit
    from which held-out pieces were right as often as wanted. A text that is null or has no letter is ``und`` with
    score 0 and is not accepted, and so is every text under a model without languages. Texts are read whole.
    """
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)
    known = bool(model.languages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        table = np.ascontiguousarray(m.logits)
        for batch in batches:
            probabilities = np.zeros((batch.num_rows, len(m.languages)))
            for texts in W.slices(batch.column(batch.num_columns - 1), 1 << 18):
                letters, begins = _letters(texts.data, texts.begins)
                total = np.zeros((len(begins) - 1, len(m.languages)))
                count = np.zeros(len(begins) - 1)
                for order in ORDERS:
                    codes = _buckets(letters, order)
                    ends = np.maximum(begins[1:] - order + 1, begins[:-1])
                    ends, starts = np.minimum(ends, len(codes)), np.minimum(begins[:-1], len(codes))
                    sums = np.zeros((len(codes) + 1, len(m.languages)))
                    np.cumsum(table[codes], axis=0, out=sums[1:])
                    total += sums[ends] - sums[starts]
                    count += ends - starts
                at = slice(texts.first, texts.first + len(count))
                probabilities[at] = _softmax(total / np.maximum(count, 1)[:, None] + m.bias)
            best = probabilities.argmax(axis=1)
            score = probabilities[np.arange(len(best)), best]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(batch.num_columns - 1)]
                + [pa.array([m.languages[i] for i in best], type=pa.string()), pa.array(score)],
                names=names + ["_lang", "_score"],
            )

    kept = df.select(key, *[value.alias(name) for name, value in (carry or {}).items()],
                     F.coalesce(F.col(text).rlike("\\p{L}"), F.lit(False)).alias("_letter"), text)
    names = kept.columns[:-1]
    if not known:
        scored = kept.withColumns({"_lang": F.lit(UNDETERMINED), "_score": F.lit(0.0)}).withColumn("_letter", F.lit(False))
    else:
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])
        scored = kept.mapInArrow(run, f"{schema}, _lang string, _score double")
    return scored.select(
        *names[:-1],
        F.when(F.col("_letter"), F.col("_lang")).otherwise(F.lit(UNDETERMINED)).alias("lang_pred"),
        F.when(F.col("_letter"), F.col("_score")).otherwise(F.lit(0.0)).alias("score"),
        (F.col("_letter") & (F.col("_score") >= F.lit(model.accept))).alias("accepted"),
    )
