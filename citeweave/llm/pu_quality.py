"""Quality classifier by positive-unlabelled learning.

A small network scores the numbers of a text (shares of byte classes, repeats, lengths).  It minimises the non-negative
unbiased risk  p * R+(positives) + max(0, R-(unlabelled) - p * R-(positives))  with logistic loss, from trusted positives
(label 1), unlabelled texts and the class prior p, which is estimated as the share of label 1 among training labels.
When the bracket turns negative, the step goes the other way on it, as the method prescribes.  Logistic loss makes the
score an estimate of the probability of label 1.

Training sees at most ``MAX_POSITIVE`` positives and ``MAX_UNLABELLED`` other texts, stated bounds, chosen by hash among
training rows; rows that share a doc_id count as one of them.  Scoring covers whole texts of all rows without a shuffle.

Defined results: null and empty texts are scored as texts without words; without a positive or an unlabelled training
row every score is the prior (0.5 if there are no labels); rows repeating a doc_id are scored each; a null doc_id is not
learned from; several labels of a document count as the largest; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _text
from ._lines import doc_counts, line_table
from ._memory import frugal

MAX_POSITIVE, MAX_UNLABELLED, HIDDEN, THRESHOLD = 4000, 8000, 16, 0.3


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    inner: np.ndarray
    outer: np.ndarray
    prior: float


def text_features(w: _text.Words) -> np.ndarray:
    """One row of numbers per text."""
    d = doc_counts(w, line_table(w))
    words, chars, lines = np.maximum(d["words"], 1), np.maximum(d["chars"], 1), np.maximum(d["lines"], 1)
    letters = np.maximum(d["upper"] + d["lower"], 1)
    return np.column_stack([
        np.log1p(d["words"]), np.log1p(d["lines"]), np.log1p(d["words"] / lines), d["chars"] / words / 10, d["symbols"] / words, d["pipes"] / words,
        d["shouts"] / words, d["upper"] / letters, d["digits"] / chars, d["foreign"] / chars, d["points"] / words, d["repeat_lines"] / lines,
        d["repeat_words"] / words, d["ends"] / lines, d["words"] < 20, np.minimum(d["words"], 60) / 60,
    ]).astype(float)


N_FEATURES = 16


def _forward(model: Model, x: np.ndarray) -> np.ndarray:
    z = np.clip((x - model.mean) / model.scale, -8, 8)
    hidden = np.tanh(np.column_stack([z, np.ones(len(z))]) @ model.inner)
    return np.column_stack([hidden, np.ones(len(z))]) @ model.outer


def score(model: Model, x: np.ndarray) -> np.ndarray:
    if not model.outer.any():
        return np.full(len(x), model.prior)
    return 1 / (1 + np.exp(-np.clip(_forward(model, x), -40, 40)))


def train(positive: np.ndarray, unlabelled: np.ndarray, prior: float, rounds: int = 400, rate: float = 0.02, decay: float = 1e-4, seed: int = 9) -> Model:
    """Minimises the non-negative risk by Adam over all rows."""
    n, draw = N_FEATURES, np.random.default_rng(seed)
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros(n), np.ones(n), np.zeros((n + 1, HIDDEN)), np.zeros(HIDDEN + 1), prior)
    prior = float(np.clip(prior, 0.02, 0.98))
    both = np.concatenate([positive, unlabelled])
    mean, scale = unlabelled.mean(axis=0), unlabelled.std(axis=0) + 1e-3
    z = np.column_stack([np.clip((both - mean) / scale, -8, 8), np.ones(len(both))])
    inner, outer = draw.normal(0, 0.3, (n + 1, HIDDEN)), draw.normal(0, 0.3, HIDDEN + 1)
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (inner, outer)]
    is_p, n_p, n_u = np.arange(len(both)) < len(positive), len(positive), len(unlabelled)
    for k in range(1, rounds + 1):
        hidden = np.tanh(z @ inner)
        s = 1 / (1 + np.exp(-np.clip(hidden @ outer[:-1] + outer[-1], -40, 40)))
        loss_minus = -np.log(np.maximum(1 - s, 1e-12))  # cost of calling a row negative
        bracket = loss_minus[~is_p].mean() - prior * loss_minus[is_p].mean()
        # gradients of the mean costs in the network's output: -(1 - s) for "positive", s for "negative"
        rest = np.where(is_p, -prior * s / n_p, s / n_u)
        slope = np.where(is_p, -prior * (1 - s) / n_p, 0.0) + rest if bracket >= 0 else -rest
        back = np.outer(slope, outer[:-1]) * (1 - hidden**2)
        grads = (z.T @ back + decay * inner, np.append(hidden.T @ slope, slope.sum()) + decay * outer)
        for p, g, m in zip((inner, outer), grads, moments, strict=True):
            m[0], m[1] = 0.9 * m[0] + 0.1 * g, 0.999 * m[1] + 0.001 * g * g
            p -= rate * m[0] / (1 - 0.9**k) / (np.sqrt(m[1] / (1 - 0.999**k)) + 1e-8)
    return Model(mean, scale, inner, outer, prior)


def held_out(doc_id: Column, folds: int = 5, fold: int = 0) -> Column:
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % folds == fold, F.lit(False))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [x.tobytes() for w in _text.word_tables(batch.column(2)) for x in text_features(w)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(rows, pa.binary())], names=["doc_id", "positive", "x"])


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learns from rows that are not held out."""
    doc_id = F.col("doc_id").cast("long")
    marks = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(doc_id)).groupBy(doc_id.alias("doc_id")).agg(F.max("quality").alias("q"))
    share = marks.agg(F.avg("q").alias("p")).first()["p"]
    prior = 0.5 if share is None else float(share)
    order = F.xxhash64("doc_id"), F.col("doc_id")
    trusted = marks.where("q = 1").orderBy(*order).limit(MAX_POSITIVE).select("doc_id", F.lit(True).alias("positive"))
    others = docs.where(F.col("doc_id").isNotNull() & ~held_out(doc_id)).select(doc_id.alias("doc_id"))
    # one id of each of so many cells of the hash is found by combining before the shuffle, however often ids repeat
    others = others.groupBy(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(8 * MAX_UNLABELLED))).agg(F.min(F.struct(F.xxhash64("doc_id"), "doc_id")["doc_id"]).alias("doc_id"))
    others = others.orderBy(*order).limit(MAX_UNLABELLED).select("doc_id", F.lit(False).alias("positive"))
    # MAX_POSITIVE + MAX_UNLABELLED pairs, and one row comes back for each
    chosen = F.broadcast(trusted.union(others))
    texts = docs.select(doc_id.alias("doc_id"), F.col("text").cast("string").alias("text")).join(chosen, "doc_id")
    found = texts.select("doc_id", "positive", "text").mapInArrow(lambda b: frugal(_features(b)), "doc_id long, positive boolean, x binary")
    rows = found.groupBy("doc_id", "positive").agg(F.min("x").alias("x")).collect()
    rows.sort(key=lambda r: bytes(r["x"]))
    sides = [np.array([np.frombuffer(r["x"]) for r in rows if r["positive"] == side]).reshape(-1, N_FEATURES) for side in (True, False)]
    return train(*sides, prior)


def _score(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [score(model, text_features(w)) for w in _text.word_tables(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(parts) if parts else np.zeros(0))], names=["doc_id", "score"])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(lambda b: frugal(_score(b, model)), "doc_id long, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
