"""Language ID by nearest centroid.

A text is the vector of its letter trigrams (lower-cased bytes, words bounded by a space, hashed to ``SIZE`` places) as
(1 + ln count) * idf, scaled to length 1.  Each language has ``CENTROIDS`` centroids from spherical k-means; the nearest
centroid by cosine names the language.  A text farther from it than almost all training texts of that centroid is
marked ``rejected``; the prediction itself stays the nearest language.

The centroids and idf are fitted on at most ``PER_LANGUAGE`` texts of each language and ``MAX_DOCS`` in all, stated
bounds: the ids of the language are cut into that many hash cells and each cell gives one text, an aggregate that hot
languages do not slow down.  ``MAX_DOCS`` is shared out by language: all first cells come before all second ones, so
languages with few texts keep theirs, and each language keeps one even if there are more than ``MAX_DOCS``.  Repeats of a
row count once.  Scoring covers whole texts of all rows without a shuffle.

Defined results: null text, or text without a letter, is ``und`` with score 0; so is any text if nothing was learned; a
text with letters but no trigram of them takes the language with the most training texts of the cells; rows repeating a
doc_id are judged each; a null doc_id counts as held out never and is not learned from; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import _text
from ._memory import frugal

SIZE, CENTROIDS, PER_LANGUAGE, MAX_DOCS, ROWS = 4096, 3, 500, 4_000, 256
_LETTERS = _text.byte_set((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
_FOLD = np.where(_LETTERS, _text.LOWER, 0x20).astype(np.uint32)


class Model(NamedTuple):
    languages: list[str]  # of each centroid
    centroids: np.ndarray
    idf: np.ndarray
    farthest: np.ndarray  # least cosine of each centroid's training texts, but for the farthest hundredth


def gram_counts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Counts of hashed trigrams, one row per text."""
    n = len(at) - 1
    folded = np.full(len(data) + 2, 0x20, np.uint32)
    folded[1:-1] = _FOLD[data]
    code = (folded[:-2] << 16) | (folded[1:-1] << 8) | folded[2:]
    middle = folded[1:-1] != 0x20  # trigrams around a letter; texts are apart as their edges count as spaces
    edges = at[1:-1][(at[1:-1] > 0) & (at[1:-1] < len(data))]
    code[edges] = (code[edges] & 0xFFFF) | (0x20 << 16)
    code[edges - 1] = (code[edges - 1] & 0xFFFF00) | 0x20
    place = ((code * np.uint32(2654435761)) >> np.uint32(20)).astype(np.int64)
    doc = np.repeat(np.arange(n), np.diff(at))
    return np.bincount((doc * SIZE + place)[middle], minlength=n * SIZE).reshape(n, SIZE)


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.zeros(counts.shape, np.float32)
    on = counts > 0
    x[on] = 1 + np.log(counts[on])
    x *= idf
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-9)


def _clusters(x: np.ndarray, k: int, draw: np.random.Generator, rounds: int = 8) -> np.ndarray:
    k = min(k, len(x))
    centres = x[draw.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = (x @ centres.T).argmax(axis=1)
        for i in range(k):
            if (near == i).any():
                mean = x[near == i].mean(axis=0)
                centres[i] = mean / max(float(np.linalg.norm(mean)), 1e-9)
    return centres


def train(counts: np.ndarray, languages: list[str]) -> Model:
    idf = (np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))) + 1).astype(np.float32)
    x, names = vectors(counts, idf), np.array(languages, object)
    draw, of, centroids, farthest = np.random.default_rng(6), [], [], []
    for name in sorted(set(languages), key=lambda n: (-languages.count(n), n)):
        own = x[names == name]
        centres = _clusters(own, CENTROIDS, draw)
        near = own @ centres.T
        for i in range(len(centres)):
            mine = near[near.argmax(axis=1) == i, i]
            centroids.append(centres[i])
            farthest.append(float(np.quantile(mine, 0.01)) if len(mine) else 0.0)
            of.append(name)
    return Model(of, np.array(centroids, np.float32).reshape(-1, SIZE), idf, np.array(farthest))


def _buffers(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    at, data = _text.text_buffers(column)
    for i, j in _text.chunks(at):
        for a in range(i, j, ROWS):
            b = min(a + ROWS, j)
            yield a, data[at[a] : at[b]], at[a : b + 1] - at[a]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for _, data, at in _buffers(batch.column(3)):
            for row in gram_counts(data, at):
                place = np.flatnonzero(row)
                out.append(np.stack([place, row[place]]).astype(np.int32).tobytes())
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, pa.binary())], names=["doc_id", "code", "lang", "grams"])


def _predict(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    names = sorted(set(model.languages))
    groups = [np.flatnonzero([x == name for x in model.languages]) for name in names]
    for batch in batches:
        column = batch.column(1)
        pred, score, rejected = ["und"] * len(column), np.zeros(len(column)), np.ones(len(column), bool)
        for a, data, at in _buffers(column) if names else ():
            ascii_letters = _text.sums_by_doc(((data | 0x20) >= 0x61) & ((data | 0x20) <= 0x7A), at)
            cosine = vectors(gram_counts(data, at), model.idf) @ model.centroids.T
            near = np.stack([cosine[:, g].max(axis=1) for g in groups], axis=1)
            best, centre = near.argmax(axis=1), cosine.argmax(axis=1)
            weight = np.exp(30 * (near - near.max(axis=1, keepdims=True)))
            for i in range(len(at) - 1):
                text = None if ascii_letters[i] else column[a + i].as_py()
                if ascii_letters[i] or (text and any(c.isalpha() for c in text)):
                    empty = not cosine[i].any()
                    pred[a + i] = model.languages[0] if empty else names[best[i]]
                    score[a + i] = 0.0 if empty else 1 / float(weight[i].sum())
                    rejected[a + i] = empty or cosine[i, centre[i]] < model.farthest[centre[i]]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pred), pa.array(score), pa.array(rejected)], names=["doc_id", "lang_pred", "score", "rejected"])


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % folds == fold, F.lit(False))


def fit(docs: DataFrame) -> Model:
    """Learns from text and lang of rows that are not held out."""
    doc_id, lang, text = F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("text").cast("string")
    rows = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(doc_id))
    rows = rows.select(doc_id.alias("doc_id"), lang.alias("lang"), F.xxhash64(text).alias("code"), text.alias("text"))
    cell = F.struct(F.xxhash64("doc_id").alias("h"), "doc_id", "code")
    ids = rows.groupBy("lang", F.pmod(F.xxhash64("doc_id"), F.lit(PER_LANGUAGE)).alias("cell")).agg(F.min(cell).alias("c"))
    # PER_LANGUAGE small rows of each language; of these, MAX_DOCS pairs, or one pair of each language if these are more
    ids = ids.withColumn("turn", F.row_number().over(Window.partitionBy("lang").orderBy("c")))
    ids = ids.withColumn("place", F.row_number().over(Window.orderBy("turn", "c", "lang"))).where((F.col("turn") == 1) | (F.col("place") <= MAX_DOCS))
    ids = ids.select("c.doc_id", "c.code", "lang")
    counted = rows.join(F.broadcast(ids), ["doc_id", "code", "lang"]).select("doc_id", "code", "lang", "text").mapInArrow(lambda b: frugal(_count(b)), "doc_id long, code long, lang string, grams binary")
    found = counted.dropDuplicates(["doc_id", "code", "lang"]).collect()  # as many as ids, however often a row is repeated
    found.sort(key=lambda r: (r["lang"], bytes(r["grams"])))
    counts = np.zeros((len(found), SIZE), np.int32)
    for i, r in enumerate(found):
        place, n = np.frombuffer(r["grams"], np.int32).reshape(2, -1)
        counts[i, place] = n
    return train(counts, [r["lang"] for r in found])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, rejected."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lambda b: frugal(_predict(b, model)), "doc_id long, lang_pred string, score double, rejected boolean")
