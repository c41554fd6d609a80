"""Quality rules: base counts, and a linear-chain conditional random field over lines.

Each line with a word is a state of a chain, content or boilerplate.  Viterbi decoding finds the best labelling of a
text's lines under emission weights (line features) and transition weights; the share of words' code points in content
lines decides retention.  A whole chunk of texts is decoded at once, one line place at a time.

The field, transitions included, is trained by maximum likelihood (forward-backward gradients) on at most ``PER_LABEL``
labelled texts of each quality, a stated bound.  Labels are of texts, so lines are labelled first, by what a line looks
like, under the text's quality as a weak constraint (``line_labels``): poor texts hold clean lines and good texts some
that are not, and from where these stand the chain learns its steps.  The texts are chosen by hash among those that hold a word, so
labels without such a text take no place; equal rows of a doc_id count once.  Texts are learned from whole, however long;
so that the driver holds them, no further text of a quality is taken once those before it have ``MAX_LINES`` lines,
blank ones included, a stated bound too.  Seeded example texts are used only if a
quality has no labelled text at all.

Symbols are ASCII, so a symbol is always in a word.

Defined results: null, empty or blank text has no words, fails the base rules and is not kept; rows repeating a doc_id
are judged each; a null doc_id is carried along; other columns are ignored by ``judge`` and kept by ``keep``.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import _text
from ._lines import LINE_FEATURES, line_table
from ._memory import frugal

PER_LABEL, MAX_LINES = 3000, 200_000
CONTENT, BOILERPLATE = 1, 0
MIN_WORDS, MAX_REPEAT, MIN_CONTENT = 50, 50, 0.3
CLEAR = 1.0  # log odds from which a line's looks alone tell what it is


class Field(NamedTuple):
    """Weights of a two-label chain: emission[label] per line feature, step[from][to]."""

    emission: np.ndarray
    step: np.ndarray


def _by_place(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of sequences sorted from the longest on, place by place, and where the rows of each place begin."""
    lengths = np.array([len(s) for s in sequences])
    on = np.array([(lengths > t).sum() for t in range(lengths[0])])
    at = np.concatenate([[0], np.cumsum(on)])
    x = np.empty((at[-1], *sequences[0].shape[1:]), sequences[0].dtype)
    for i, s in enumerate(sequences):
        x[at[: len(s)] + i] = s
    return x, at


def _expected(scores: np.ndarray, step: np.ndarray, places: list[slice], later: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The probability of each label of each line, and of each pair of labels of a line and the one before it."""
    emit = np.exp(scores - scores.max(axis=1, keepdims=True))
    move = np.exp(step - step.max())
    forward, backward, scale = emit.copy(), np.ones_like(emit), np.empty((len(emit), 1))
    for i, here in enumerate(places):
        if i:
            forward[here] *= forward[places[i - 1]][: here.stop - here.start] @ move
        scale[here] = forward[here].sum(axis=1, keepdims=True)
        forward[here] /= scale[here]
    ahead = emit / scale
    for i in range(len(places) - 2, -1, -1):
        there, start = places[i + 1], places[i].start
        ahead[there] *= backward[there]
        backward[start : start + there.stop - there.start] = ahead[there] @ move.T
    return forward * backward, forward[before][:, :, None] * move * ahead[later][:, None, :]


def maximise(sequences: list[np.ndarray], labels: list[np.ndarray], weights: list[float] | None = None, chain: bool = True, rounds: int = 150, rate: float = 0.2, decay: float = 1e-4) -> Field:
    """Maximum likelihood of the lines' labels by Adam; without ``chain`` all steps stay at 0, so each line is on its own."""
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
    x, at = _by_place([sequences[i] for i in order])
    y = _by_place([np.asarray(labels[i]) for i in order])[0].astype(int)
    places = [slice(a, b) for a, b in zip(at[:-1], at[1:], strict=True)] if chain else [slice(0, len(x))]
    number = np.concatenate([np.arange(b - a) for a, b in zip(at[:-1], at[1:], strict=True)])  # sequence of each row
    share = np.array([1 / len(y) if weights is None else weights[i] for i in order])[number]
    later = np.arange(at[1], at[-1]) if chain else np.zeros(0, int)  # rows with a line before them, and the rows of those lines
    before = np.concatenate([[0], at])[np.searchsorted(at, later, side="right") - 1] + number[later]
    truth = np.stack([y == 0, y == 1], axis=1)
    steps = np.zeros((2, 2))
    np.add.at(steps, (y[before], y[later]), share[later])
    theta = np.zeros(2 * LINE_FEATURES + 4)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for k in range(1, rounds + 1):
        emission, step = theta[: 2 * LINE_FEATURES].reshape(2, -1), theta[2 * LINE_FEATURES :].reshape(2, 2)
        mean, pairs = _expected(x @ emission.T, step, places, later, before)
        grad_emission = ((truth - mean) * share[:, None]).T @ x
        grad_step = steps - (pairs * share[later, None, None]).sum(axis=0)
        gradient = np.concatenate([grad_emission.ravel(), grad_step.ravel()]) - decay * theta
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient**2
        theta = theta + rate * first / (1 - 0.9**k) / (np.sqrt(second / (1 - 0.99**k)) + 1e-8)
    return Field(theta[: 2 * LINE_FEATURES].reshape(2, -1), theta[2 * LINE_FEATURES :].reshape(2, 2))


def _balanced(sequences: list[np.ndarray], qualities: list[int]) -> list[float]:
    """What a line of each text counts, so that both qualities count alike."""
    lines = [sum(len(s) for s, q in zip(sequences, qualities, strict=True) if q == k) for k in (0, 1)]
    return [0.5 / max(1, lines[q]) for q in qualities]


def line_labels(sequences: list[np.ndarray], qualities: list[int]) -> list[np.ndarray]:
    """A label for each line from its looks, and where these leave it open from the quality of its text.

    A classifier of single lines, fitted with each line under its text's quality, tells which lines are common in good
    texts and which in poor ones, wherever they stand.  Lines of odds below ``CLEAR`` take their text's quality, so what
    stands around them tells more than they do, which the chain learns.  The quality binds weakly elsewhere: the likelier
    half of a good text's lines is content, and the least likely line of a poor one boilerplate.
    """
    weights = _balanced(sequences, qualities)
    alone = maximise(sequences, [np.full(len(s), q) for s, q in zip(sequences, qualities, strict=True)], weights, chain=False)
    out = []
    for s, q in zip(sequences, qualities, strict=True):
        odds = s @ (alone.emission[CONTENT] - alone.emission[BOILERPLATE])
        labels = np.where(odds >= CLEAR, CONTENT, np.where(odds <= -CLEAR, BOILERPLATE, q)).astype(np.int8)
        order = np.argsort(odds, kind="stable")
        if q == CONTENT:
            labels[order[len(order) // 2 :]] = CONTENT
        else:
            labels[order[:1]] = BOILERPLATE
        out.append(labels)
    return out


def train(sequences: list[np.ndarray], qualities: list[int]) -> Field:
    """The field from the lines of texts of known quality."""
    return maximise(sequences, line_labels(sequences, qualities), _balanced(sequences, qualities))


def viterbi(field: Field, features: np.ndarray, line_at: np.ndarray) -> np.ndarray:
    """The best label of each line, for all texts of a chunk together."""
    sizes = np.diff(line_at)
    order = np.argsort(-sizes, kind="stable")
    base, sizes = line_at[:-1][order], sizes[order]
    scores = features @ field.emission.T
    longest = int(sizes[0]) if len(sizes) else 0
    on = np.searchsorted(-sizes, -np.arange(longest), side="left") if longest else np.zeros(0, int)
    came = np.zeros((len(features), 2), np.int8)
    best = scores[base[: on[0]]] if longest else np.zeros((0, 2))
    last = best.copy()
    for t in range(1, longest):
        n = on[t]
        from0, from1 = best[:n, :1] + field.step[0], best[:n, 1:] + field.step[1]
        at = base[:n] + t
        came[at] = from1 > from0
        best = np.maximum(from0, from1) + scores[at]
        last[:n] = best
    label = np.zeros(len(features), np.int8)
    now = (last[:, 1] >= last[:, 0]).astype(np.int8)  # a tie is content
    for t in range(longest - 1, -1, -1):
        n = on[t]
        at = base[:n] + t
        # texts that end here start from their own best last label
        label[at] = now[:n]
        if t:
            now[:n] = came[at, now[:n]]
    return label


JUDGED = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_content_lines long, content_share double"


def _judge(batches: Iterator[pa.RecordBatch], field: Field) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = []
        for w in _text.word_tables(batch.column(batch.schema.get_field_index("text"))):
            lines = line_table(w)
            label = viterbi(field, lines.features(), lines.line_at)
            per = lambda x: _text.sums_by_doc(x, lines.line_at)
            chars = per(lines.chars)
            parts.append([
                w.count, chars, per(lines.counts["symbols"]), per(lines.repeat), per(lines.repeat_words), np.diff(lines.line_at), per(label),
                per(lines.chars * label) / np.maximum(chars, 1),
            ])
        columns = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.zeros(0)] * 8
        kinds = [pa.int64()] * 7 + [pa.float64()]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, *(pa.array(c).cast(k) for c, k in zip(columns, kinds, strict=True))],
            names=[*batch.schema.names, *(x.split()[0] for x in JUDGED.split(", "))],
        )


def _line_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for w in _text.word_tables(batch.column(3)):
            lines = line_table(w)
            x = lines.features()
            out += [x[a:b].tobytes() for a, b in zip(lines.line_at[:-1], lines.line_at[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, pa.binary())], names=["doc_id", "code", "quality", "lines"])


def example_texts(n: int = 400, seed: int = 5) -> list[tuple[str, int]]:
    """Seeded texts, prose or boilerplate, for a field without labelled texts."""
    r = random.Random(seed)
    word = lambda: "".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randint(2, 9)))
    prose = lambda: " ".join(word() for _ in range(r.randint(6, 40))).capitalize() + "."
    menu = lambda: " | ".join(word() for _ in range(r.randint(4, 20)))
    noise = lambda: " ".join(word() + r.choice(["###", "$$$", "&&&", "***"]) for _ in range(r.randint(6, 40)))
    shout = lambda: " ".join(word().upper() + "!!" for _ in range(r.randint(6, 40)))
    out = []
    for i in range(n):
        kinds = [prose] if i % 2 else [r.choice([menu, noise, shout])]
        out.append(("\n".join(r.choice(kinds)() for _ in range(r.randint(1, 12))), i % 2))
    return out


def fit(docs: DataFrame, labels: DataFrame | None) -> Field:
    """The field from labelled texts, or from the examples if a quality has none."""
    rows: list = []
    if labels is not None:
        marks = labels.where("doc_id is not null and quality in (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        marks = marks.groupBy("doc_id").agg(F.max("quality").alias("quality"))
        texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        texts = texts.where(F.col("text").rlike("[^\\x20\\x09-\\x0D]")).withColumn("code", F.xxhash64("text"))
        breaks = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit("")))
        known = texts.select("doc_id", "code", (breaks + 1).cast("long").alias("n")).join(marks, "doc_id").distinct()
        order = F.xxhash64("doc_id"), F.col("doc_id"), F.col("code")
        chosen = [known.where(F.col("quality") == k).orderBy(*order).limit(PER_LABEL) for k in (0, 1)]
        # at most PER_LABEL rows of numbers for each quality
        before = F.sum("n").over(Window.partitionBy("quality").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
        chosen = chosen[0].union(chosen[1]).withColumn("before", before).where(F.coalesce("before", F.lit(0)) < MAX_LINES)
        texts = texts.join(F.broadcast(chosen.select("doc_id", "code", "quality")), ["doc_id", "code"])
        lines = texts.select("doc_id", "code", "quality", "text").mapInArrow(lambda b: frugal(_line_features(b)), "doc_id long, code long, quality int, lines binary")
        rows = lines.dropDuplicates(["doc_id", "code"]).collect()
        rows.sort(key=lambda r: (r["doc_id"], r["code"]))
    sequences = [(np.frombuffer(r["lines"]).reshape(-1, LINE_FEATURES), r["quality"]) for r in rows if r["lines"]]
    if len({q for _, q in sequences}) < 2:
        texts, marks = zip(*example_texts(), strict=True)
        sequences = [(s, q) for s, q in zip(_sequences(list(texts)), marks, strict=True) if len(s)]
    return train([s for s, _ in sequences], [q for _, q in sequences])


def _sequences(texts: list[str]) -> list[np.ndarray]:
    out = []
    for w in _text.word_tables(pa.array(texts, pa.string())):
        lines = line_table(w)
        x = lines.features()
        out += [x[a:b] for a, b in zip(lines.line_at[:-1], lines.line_at[1:], strict=True)]
    return out


def judge(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, the base counts, base_failed, content_share, n_lines, n_content_lines, kept."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return _verdict(rows.mapInArrow(lambda b: frugal(x.drop_columns(["text"]) for x in _judge(b, field)), "doc_id long, " + JUDGED))


def _verdict(rows: DataFrame) -> DataFrame:
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    return rows.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("content_share") >= MIN_CONTENT))


def keep(docs: DataFrame, field: Field) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    named = docs.select(F.col("text").cast("string").alias("text"), F.struct("*").alias("row"))
    schema = f"text string, row {named.schema['row'].dataType.simpleString()}, {JUDGED}"
    return _verdict(named.mapInArrow(lambda b: frugal(_judge(b, field)), schema)).where("kept").select("row.*")
