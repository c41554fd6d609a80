"""Substring dedup by seed and extend.

1. Seed.  Every window of ``length`` consecutive words chooses an anchor: the k-gram of least hash among those it holds
   (winnowing), so equal windows choose equal anchors at equal places.  Anchors, about two in ``length - k + 2`` words,
   are joined by their hash; those that occur once go.  A task sends an anchor that it holds several times once.
2. Extend.  An anchor that stays travels with its surroundings: the words of the windows that chose it, at most
   ``length - k`` on each side.  All occurrences of a seed are extended together, one word at a time to the right and to
   the left: they part where their words differ, so two that are still together after r words right and l words left match
   there word by word (words are compared, not hashes).  No pair of occurrences is formed.
3. Keep.  An occurrence together with an earlier one for l + k + r >= ``length`` repeats it; neighbouring repeats of a
   document merge into maximal repeated spans, which are cut out.

A seed of more than ``HOT`` occurrences is not gathered: its occurrences go on window by window, to places of their own by
the words of the whole window, where only the earliest is held.  ``HOT`` is doubled until at most ``MAX_HOT`` seeds are
above it, so the list sent to all tasks has a fixed bound.  Repeats within a batch are found where it is read, so a
passage that a third of all documents hold travels once per batch.  The texts are shuffled once; both joins read that
shuffle.  The anchors that stay are written to the shared folder.

Defined results: null or blank text has no words and is returned with an empty ``kept_text``; of equal windows the one
with the smaller doc_id, then the earlier start, is kept; equal rows count as one document (the same start in both is not
"earlier"); different texts that share a doc_id are documents of their own, in the order of a hash of the text; rows with
a null doc_id are neither compared nor changed; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import _text
from ._memory import frugal
from ._store import Store

HOT, MAX_HOT = 4096, 1 << 20
SLICE_BYTES, SEGMENT = 4 << 20, 1 << 26
ANCHORS = "key long, doc_id long, code int, pos int, n int"
SEEDS = "key long, doc_id long, code int, pos int, left int, open long, words binary"
SPANS = "doc_id long, code int, pos int, n int"
CUT = "doc_id long, n_words long, n_removed long, kept_text string, removed_spans array<array<int>>"
_U = np.uint64


def anchors(w: _text.Words, length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The seed hash at each word, the windows that lie within a text, and the word at which each one's anchor starts."""
    seeds = w.grams(k)
    windows, chosen = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    low = _U((1 << 28) - 1)
    for a in range(0, len(seeds) - length + 1, SEGMENT):  # places within a segment take 28 bits
        part = seeds[a : a + SEGMENT + length - 1]
        tagged = (part & ~low) | np.arange(len(part), dtype=np.uint64)
        least = _text.sliding_min(tagged[: len(tagged) - k + 1], length - k + 1) & low
        windows.append(np.arange(a, a + len(least)))
        chosen.append(least.astype(np.int64) + a)
    at, anchor = np.concatenate(windows), np.concatenate(chosen)
    inside = w.room()[at] >= length
    return seeds, at[inside], anchor[inside]


def _slices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Slices of bounded size: a word takes some fifty bytes while its windows are told apart."""
    for batch in batches:
        for i, j in _text.chunks(_text.text_buffers(batch.column(column))[0], SLICE_BYTES):
            yield batch.slice(i, j - i)


def _numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def _anchor_rows(batches: Iterator[pa.RecordBatch], length: int, k: int) -> Iterator[pa.RecordBatch]:
    """Each anchor of a slice, once under its seed with how often it occurs, all others under keys of their own with n 0."""
    for batch in _slices(batches, 2):
        ids, codes, parts = _numbers(batch.column(0)), _numbers(batch.column(1)), []
        for w in _text.word_tables(batch.column(2)):
            seeds, _, anchor = anchors(w, length, k)
            anchor = np.unique(anchor)
            doc = np.searchsorted(w.word_at, anchor, side="right") - 1
            parts.append((seeds[anchor], ids[w.first + doc], codes[w.first + doc], (anchor - w.word_at[doc]).astype(np.int32)))
        if not parts:
            continue
        key, doc, code, pos = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(key)
        new = np.ones(len(key), bool)
        new[1:] = key[order][1:] != key[order][:-1]
        n = np.zeros(len(key), np.int32)
        n[order[new]] = np.diff(np.append(np.flatnonzero(new), len(key)))
        key = np.where(n > 0, key, _text.mix(key + _text.mix(doc.astype(np.uint64)) + pos.astype(np.uint64)))
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(doc), pa.array(code), pa.array(pos), pa.array(n)], names=["key", "doc_id", "code", "pos", "n"])


class Seeds(NamedTuple):
    """Occurrences of seeds: the words around each, how many are left of the seed, and which splits are in question.

    Bit l of ``open`` stands for the window of l words left of the seed and the rest right of it.
    """

    key: np.ndarray
    doc_id: np.ndarray
    code: np.ndarray
    pos: np.ndarray
    left: np.ndarray
    open: np.ndarray
    words: pa.Array

    def take(self, at: np.ndarray) -> Seeds:
        return Seeds(*(x[at] for x in self[:6]), self.words.take(pa.array(at)))

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*(pa.array(x) for x in self[:6]), self.words], names=list(self._fields))

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> Seeds:
        return cls(*(_numbers(c) for c in batch.columns[:6]), batch.column(6))


def _named(values: np.ndarray) -> np.ndarray:
    """Equal values get equal numbers, counted from 0 in the order in which they first occur."""
    return pa.array(values).dictionary_encode().indices.to_numpy().astype(np.int64)


def extend(seeds: Seeds, length: int, k: int) -> np.ndarray:
    """For each occurrence the splits (bits) at which an earlier one of its key has the same words."""
    n, sides = len(seeds.key), length - k
    rank = np.lexsort((seeds.pos, seeds.code, seeds.doc_id))
    s = seeds.take(rank)
    later = np.zeros(n, bool)
    later[1:] = (s.doc_id[1:] != s.doc_id[:-1]) | (s.code[1:] != s.code[:-1]) | (s.pos[1:] != s.pos[:-1])
    turn = np.cumsum(later)
    lists = pc.split_pattern(s.words.cast(pa.string()), " ")
    at = lists.offsets.to_numpy().astype(np.int64)
    word = lists.flatten().dictionary_encode().indices.to_numpy().astype(np.int64) + 1
    word, at, n_words = np.append(word, 0), at[:-1] - at[0], np.diff(at)
    many = int(word.max()) + 1
    seed_at = at + s.left

    def step(group: np.ndarray, place: np.ndarray, inside: np.ndarray) -> np.ndarray:
        return _named(group * many + np.where(inside, word[np.where(inside, place, 0)], 0))

    group = _named(s.key)
    for i in range(k):
        group = step(group, seed_at + i, np.ones(n, bool))
    right, left = [group], [group]
    for i in range(sides):
        right.append(step(right[-1], seed_at + k + i, s.left + k + i < n_words))
        left.append(step(left[-1], seed_at - 1 - i, s.left > i))
    found = np.zeros(n, np.int64)
    for split in range(sides + 1):
        on = np.flatnonzero((s.open >> split) & 1)
        if len(on) < 2:
            continue
        window = _named(left[split][on] * n + right[sides - split][on])
        first = np.full(int(window.max()) + 1, n)
        np.minimum.at(first, window, turn[on])
        repeats = on[turn[on] > first[window]]
        found[repeats] |= 1 << split
    out = np.empty(n, np.int64)
    out[rank] = found
    return out


def _spans(seeds: Seeds, found: np.ndarray, splits: int) -> list[np.ndarray]:
    """doc_id, code, first window and number of windows of each run of found windows."""
    at = np.flatnonzero(found)
    flag = np.zeros((len(at), splits + 2), np.int8)
    for j in range(splits):  # the window of most words to the left starts first
        flag[:, j + 1] = (found[at] >> (splits - 1 - j)) & 1
    edge = np.diff(flag, axis=1)
    row, start = np.nonzero(edge == 1)
    end = np.nonzero(edge == -1)[1]
    return [seeds.doc_id[at[row]], seeds.code[at[row]], (seeds.pos[at[row]] - (splits - 1) + start).astype(np.int32), (end - start).astype(np.int32)]


def _plain(w: _text.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words one space apart, and where each starts and ends there."""
    n = len(w.data)
    edge = np.zeros(n + 1, np.int8)
    edge[w.start] += 1
    edge[w.end] -= 1
    inside = np.cumsum(edge[:n]).astype(bool)
    keep = inside.copy()
    keep[w.end[w.end < n]] = True
    place = np.zeros(n + 1, np.int64)
    np.cumsum(keep, out=place[1:])
    return np.where(inside, w.data, 0x20).astype(np.uint8)[keep], place[w.start], place[w.end]


def _binary(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    size = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start, out=size[1:])
    at = np.repeat(start - size[:-1], end - start) + np.arange(size[-1])
    return pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(size.astype(np.int32)), pa.py_buffer(data[at])])


def _surroundings(ids: np.ndarray, codes: np.ndarray, shared: list[np.ndarray], w: _text.Words, length: int, k: int) -> Seeds:
    """The shared anchors of a chunk with the words of the windows that chose them."""
    hashes, windows, anchor = anchors(w, length, k)
    wanted = np.concatenate([w.word_at[d] + shared[w.first + d] for d in range(w.n_docs)]).astype(np.int64)
    new = np.ones(len(anchor), bool)
    new[1:] = anchor[1:] != anchor[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(anchor))[: len(first)] - 1
    ours = np.isin(anchor[first], wanted)
    first, last = first[ours], last[ours]
    at, low, high = anchor[first], windows[first], windows[last]
    doc = np.searchsorted(w.word_at, at, side="right") - 1
    data, start, end = _plain(w)
    left = at - low
    ones = np.left_shift(np.int64(1), left - (at - high) + 1) - 1  # windows low .. high have at - low .. at - high words left
    return Seeds(
        hashes[at].view(np.int64), ids[w.first + doc], codes[w.first + doc], (at - w.word_at[doc]).astype(np.int32), left.astype(np.int32), ones << (at - high),
        _binary(data, start[low], end[high + length - 1]),
    )


def _by_window(seeds: Seeds, length: int) -> Seeds:
    """Each open window of the occurrences alone, under a key made of its words."""
    words = pc.split_pattern(seeds.words.cast(pa.string()), " ")
    flat, at = words.flatten(), words.offsets.to_numpy().astype(np.int64)
    at = at - at[0]
    row, split = np.nonzero((seeds.open[:, None] >> np.arange(63)) & 1)
    _, data = _text.text_buffers(flat)
    bounds = _text.text_buffers(flat)[0]
    first = at[row] + seeds.left[row] - split
    # words of a row lie one byte apart in the array of words joined by a space
    joined = np.full(len(data) + len(flat), 0x20, np.uint8)
    base = bounds[0]
    place = np.arange(bounds[-1] - base) + np.repeat(np.arange(len(flat)), np.diff(bounds))
    joined[place] = data[base : bounds[-1]]
    starts, ends = bounds[:-1] - base + np.arange(len(flat)), bounds[1:] - base + np.arange(len(flat))
    packed = _binary(joined, starts[first], ends[first + length - 1])
    size = np.diff(np.frombuffer(packed.buffers()[1], np.int32)[: len(packed) + 1])
    table = _text.words_of(np.frombuffer(packed.buffers()[2], np.uint8), np.concatenate([[0], np.cumsum(size)]), 0, _text.byte_set())
    return Seeds(table.code.view(np.int64), seeds.doc_id[row], seeds.code[row], seeds.pos[row], split.astype(np.int32), np.left_shift(np.int64(1), split), packed)


def _seed_rows(batches: Iterator[pa.RecordBatch], length: int, k: int, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Occurrences that no earlier one in the slice repeats whole, and the repeats found, as spans without words."""
    for batch in _slices(batches, 2):
        ids, codes = _numbers(batch.column(0)), _numbers(batch.column(1))
        shared = [np.asarray(x, np.int64) for x in batch.column(3).to_pylist()]
        for w in _text.word_tables(batch.column(2)):
            seeds = _surroundings(ids, codes, shared, w, length, k)
            if not len(seeds.key):
                continue
            found = extend(seeds, length, k)
            doc, code, pos, n = _spans(seeds, found, length - k + 1)
            key = _text.mix(doc.astype(np.uint64) * _U(31) + pos.astype(np.uint64)).view(np.int64)
            yield Seeds(key, doc, code, pos, n, np.zeros(len(doc), np.int64), pa.nulls(len(doc), pa.binary())).batch()
            seeds = seeds._replace(open=seeds.open & ~found)
            seeds = seeds.take(np.flatnonzero(seeds.open))
            at = np.minimum(np.searchsorted(hot, seeds.key), max(0, len(hot) - 1))
            is_hot = hot[at] == seeds.key if len(hot) else np.zeros(len(seeds.key), bool)
            yield seeds.take(np.flatnonzero(~is_hot)).batch()
            if is_hot.any():
                yield _by_window(seeds.take(np.flatnonzero(is_hot)), length).batch()


def _match(batches: Iterator[pa.RecordBatch], length: int, k: int) -> Iterator[pa.RecordBatch]:
    """Rows come by key, then document and place; what is open of a batch's last key waits for the rest of its key."""
    waiting: Seeds | None = None
    for batch in batches:
        for at in range(0, batch.num_rows, 20_000):
            part = batch.slice(at, 20_000)
            passed = part.filter(pc.is_null(part.column(6)))
            yield pa.RecordBatch.from_arrays([passed.column(i) for i in (1, 2, 3, 4)], names=["doc_id", "code", "pos", "n"])
            seeds = Seeds.of(part.filter(pc.is_valid(part.column(6))))
            if not len(seeds.key):
                continue
            if waiting is not None:
                seeds = Seeds(*(np.concatenate(x) for x in zip(waiting[:6], seeds[:6], strict=True)), pa.concat_arrays([waiting.words, seeds.words]))
            found = extend(seeds, length, k)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _spans(seeds, found, length - k + 1)], names=["doc_id", "code", "pos", "n"])
            seeds = seeds._replace(open=seeds.open & ~found)
            waiting = seeds.take(np.flatnonzero((seeds.key == seeds.key[-1]) & (seeds.open != 0)))


def _cut(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    from itertools import compress

    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            kept, counts, removed, spans_out = [], [], [], []
            for text, spans in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                words = text.encode().split() if text else []
                counts.append(len(words))
                cut: list[list[int]] = []
                for a, b in sorted((s["pos"], s["pos"] + s["n"] + length - 1) for s in spans or ()):
                    if cut and a <= cut[-1][1]:
                        cut[-1][1] = max(cut[-1][1], b)
                    else:
                        cut.append([a, b])
                if cut:
                    keep = bytearray(b"\1") * len(words)
                    for a, b in cut:
                        keep[a:b] = bytes(b - a)
                    words = list(compress(words, keep))
                removed.append(counts[-1] - len(words))
                kept.append(b" ".join(words).decode())
                spans_out.append(cut)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string()), pa.array(spans_out, pa.list_(pa.list_(pa.int32())))],
                names=["doc_id", "n_words", "n_removed", "kept_text", "removed_spans"],
            )


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id, code, text; the code tells texts of one doc_id apart."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.hash(text), F.lit(0)).alias("code"), text.alias("text"))


def _hot_seeds(shared: DataFrame, hot: int) -> np.ndarray:
    """At most MAX_HOT seeds, all of those above a number of occurrences that is ``hot`` or the next power of two that does."""
    totals = shared.where(F.col("total") > hot).groupBy("key").agg(F.max("total").alias("total"))
    sizes = {r["size"]: r["n"] for r in totals.groupBy(F.floor(F.log2(F.col("total") - 1)).alias("size")).agg(F.count(F.lit(1)).alias("n")).collect()}  # 63 rows at most
    least = hot
    while sum(n for size, n in sizes.items() if 2**size >= least) > MAX_HOT:
        least *= 2
    keys = totals.where(F.col("total") > least).collect() if sizes else []
    return np.sort(np.array([r["key"] for r in keys], np.int64))


def repeated_windows(docs: DataFrame, length: int = 20, k: int = 8, hot: int = HOT) -> DataFrame:
    """doc_id, code, pos, n: the n windows from word ``pos`` on start earlier elsewhere, too; ``hot`` is a power of two."""
    if not 0 < k <= length or length - k > 61:
        raise ValueError("k must lie between 1 and length, and length - k below 62")
    store, texts = Store(docs.sparkSession, "substring-dedup"), _texts(docs).where("doc_id is not null")
    rows = texts.mapInArrow(lambda b: frugal(_anchor_rows(b, length, k)), ANCHORS)
    rows = rows.withColumn("total", F.sum("n").over(Window.partitionBy("key"))).where("n = 0 or total > 1")
    shared = store.save(rows.select("key", "doc_id", "code", "pos", "total"))
    hot_seeds = _hot_seeds(shared, hot)
    places = shared.groupBy("doc_id", "code").agg(F.collect_set("pos").alias("places"))
    seeds = texts.join(places, ["doc_id", "code"]).select("doc_id", "code", "text", "places").mapInArrow(lambda b: frugal(_seed_rows(b, length, k, hot_seeds)), SEEDS)
    return seeds.repartition("key").sortWithinPartitions("key", "doc_id", "code", "pos").mapInArrow(lambda b: frugal(_match(b, length, k)), SPANS)


def remove_repeats(docs: DataFrame, length: int = 20, k: int = 8, hot: int = HOT) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text (kept words joined by one space), removed_spans ([from, to) word spans)."""
    spans = repeated_windows(docs, length, k, hot).groupBy("doc_id", "code").agg(F.collect_set(F.struct("pos", "n")).alias("spans"))
    texts = _texts(docs)
    cut = texts.where("doc_id is not null").join(spans, ["doc_id", "code"], "left").select("doc_id", "text", "spans").mapInArrow(lambda b: frugal(_cut(b, length)), CUT)
    bare = texts.where("doc_id is null").select("doc_id", "text", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"))
    return cut.union(bare.mapInArrow(lambda b: frugal(_cut(b, length)), CUT))
