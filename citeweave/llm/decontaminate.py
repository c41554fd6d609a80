"""Benchmark decontamination with an FM-index per training shard.

The test phrases are the windows of ``window`` consecutive words of each benchmark item (a shorter item is one phrase).
A shard is what one task holds of the corpus at a time.  Its alphabet is the benchmark's vocabulary: every other word
is a separator, and runs of vocabulary words shorter than the shortest phrase cannot hold one and are left out, so the
index covers the small part of the shard where a phrase may lie.  All phrases are searched backwards at once through
wavelet-tree ranks, occurrences are located by sampled suffix positions, and the word spans they cover are merged per
document.  Documents are not shuffled.

The benchmark is the stated query set: it goes to the tasks in blocks of about ``block_bytes`` of text, one pass over
the documents per block, each adding to the spans and items found before.  A block has a phrase for each of its words at
most, four bytes for each word of a phrase, so some 30 MB go to a task.  A pass but the last is written to the shared
folder.

Defined results: null text has no words and no hits; items without words, without text or without an id have no
phrases; items that share an id count once; rows repeating a doc_id are judged each; a null doc_id is carried along;
other columns are ignored; an empty benchmark hits nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text
from ._memory import frugal
from ._store import Store
from .fm_index import FMIndex

SHARD_SYMBOLS, BLOCK_BYTES = 1 << 20, 4 << 20
_END, _BREAK, _WORDS = 0, 1, 2


@dataclass
class Phrases:
    """Distinct phrases over a vocabulary of word hashes, and the items of each."""

    vocabulary: np.ndarray
    symbols: np.ndarray  # one row a phrase, aligned to the right
    lengths: np.ndarray
    item_at: np.ndarray  # items of phrase i: item_of[item_at[i] : item_at[i + 1]]
    item_of: np.ndarray
    names: list[str]


def phrases_of(items: list[tuple[object, str]], window: int) -> Phrases:
    items = sorted((str(i), t) for i, t in items if i is not None and t)
    names = sorted({i for i, _ in items})
    number = {name: k for k, name in enumerate(names)}
    codes, owners, sizes = [np.zeros((0, window), np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    at = 0
    for w in _text.word_tables(pa.array([t for _, t in items], pa.string()), _text.NON_ALNUM, lower=True):
        for d in np.flatnonzero(w.count):
            words = w.code[w.word_at[d] : w.word_at[d + 1]]
            short = max(0, window - len(words))
            rows = np.lib.stride_tricks.sliding_window_view(np.concatenate([np.zeros(short, np.uint64), words]), window)
            codes.append(rows)
            owners.append(np.full(len(rows), number[items[at + d][0]]))
            sizes.append(np.full(len(rows), window - short))
        at += w.n_docs
    lengths, owner, rows = np.concatenate(sizes), np.concatenate(owners), np.concatenate(codes)
    held = np.arange(window) >= (window - lengths)[:, None]
    vocabulary = np.unique(rows[held])
    symbols = np.where(held, np.searchsorted(vocabulary, rows) + _WORDS, 0).astype(np.int32)
    _, first, phrase = np.unique(symbols.view(f"V{4 * window}").ravel(), return_index=True, return_inverse=True)
    pairs = np.unique(phrase.ravel() * max(1, len(names)) + owner)
    phrase_of, item_of = np.divmod(pairs, max(1, len(names)))
    return Phrases(vocabulary, symbols[first], lengths[first], np.searchsorted(phrase_of, np.arange(len(first) + 1)), item_of, names)


class _Shard:
    """Runs of vocabulary words of consecutive documents, and where each symbol stands."""

    def __init__(self) -> None:
        self.symbols: list[np.ndarray] = []
        self.docs: list[np.ndarray] = []
        self.places: list[np.ndarray] = []
        self.size = 0

    def add(self, words: _text.Words, phrases: Phrases) -> None:
        shortest = int(phrases.lengths.min())
        at = np.minimum(np.searchsorted(phrases.vocabulary, words.code), len(phrases.vocabulary) - 1)
        known = phrases.vocabulary[at] == words.code
        first = np.zeros(len(known), bool)
        first[words.word_at[:-1][words.count > 0]] = True
        before, after = np.zeros(len(known), bool), np.zeros(len(known), bool)
        before[1:] = known[:-1] & ~first[1:]
        after[:-1] = known[1:] & ~first[1:]
        start, end = np.flatnonzero(known & ~before), np.flatnonzero(known & ~after) + 1
        long = end - start >= shortest
        start, end = start[long], end[long]
        size = end - start + 1  # and a separator behind each run
        run = np.repeat(np.arange(len(start)), size)
        step = np.arange(len(run)) - np.repeat(np.cumsum(size) - size, size)
        word = np.minimum(start[run] + step, len(known) - 1)
        doc = np.searchsorted(words.word_at, start, side="right")[run] - 1
        self.symbols.append(np.where(step == (end - start)[run], _BREAK, at[word] + _WORDS))
        self.docs.append(doc + words.first)
        self.places.append(word - words.word_at[doc])
        self.size += len(run)

    def hits(self, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document, first word and phrase of each occurrence."""
        symbols, docs, places = (np.concatenate(x) for x in (self.symbols, self.docs, self.places))
        index = FMIndex(symbols, len(phrases.vocabulary) + _WORDS)
        low, high = index.search(phrases.symbols, phrases.lengths)
        size = high - low
        phrase = np.repeat(np.arange(len(size)), size)
        rows = low[phrase] + np.arange(len(phrase)) - np.repeat(np.cumsum(size) - size, size)
        at = index.locate(rows)
        return docs[at], places[at], phrase


def _scan(batches: Iterator[pa.RecordBatch], phrases: Phrases, with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_words = np.zeros(batch.num_rows, np.int64)
        found, shard = [], _Shard()
        for words in _text.word_tables(batch.column(1), _text.NON_ALNUM, lower=True):
            n_words[words.first : words.first + words.n_docs] = words.count
            if len(phrases.lengths):
                shard.add(words, phrases)
            if shard.size >= SHARD_SYMBOLS:
                found.append(shard.hits(phrases))
                shard = _Shard()
        if shard.size:
            found.append(shard.hits(phrases))
        doc, place, phrase = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
        spans: dict[int, list[tuple[int, int]]] = {}
        items: dict[int, set[str]] = {}
        for i, (old_spans, old_items) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
            if old_spans:
                spans[i], items[i] = [tuple(s) for s in old_spans], set(old_items)
        pairs = np.unique(doc * max(1, len(phrases.lengths)) + phrase)
        for d, p in zip(*(x.tolist() for x in divmod(pairs, max(1, len(phrases.lengths)))), strict=True):
            items.setdefault(d, set()).update(phrases.names[x] for x in phrases.item_of[phrases.item_at[p] : phrases.item_at[p + 1]])
        for d, s, n in zip(doc.tolist(), place.tolist(), phrases.lengths[phrase].tolist(), strict=True):
            spans.setdefault(d, []).append((s, s + n))
        merged = {d: merge(x) for d, x in spans.items()}
        columns = [
            batch.column(0),
            batch.column(1) if not with_text else pa.array(_without(batch.column(1), merged), pa.string()),
            pa.array([merged.get(i, []) for i in range(batch.num_rows)], pa.list_(pa.list_(pa.int32()))),
            pa.array([sorted(items.get(i, ())) for i in range(batch.num_rows)], pa.list_(pa.string())),
            pa.array(n_words),
        ]
        yield pa.RecordBatch.from_arrays([*columns, *batch.columns[4:]], names=["doc_id", "text", "spans", "items", "n_words", *batch.schema.names[4:]])


def merge(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _without(column: pa.Array, spans: dict[int, list[list[int]]]) -> list[str | None]:
    """The texts without the bytes from the first to the last word of each span."""
    out = column.to_pylist()
    for i, cut in spans.items():
        words = next(_text.word_tables(column.slice(i, 1), _text.NON_ALNUM, lower=True))
        text, at, kept = out[i].encode(), 0, []
        for a, b in cut:
            kept.append(text[at : words.start[a]])
            at = int(words.end[b - 1])
        out[i] = b"".join([*kept, text[at:]]).decode()
    return out


def _blocks(benchmark: DataFrame, block_bytes: int) -> int:
    total = benchmark.agg(F.sum(F.octet_length(F.col("text").cast("string")) + 64).alias("n")).first()["n"] or 0
    return max(1, -(-int(total) // block_bytes))


def scan(docs: DataFrame, benchmark: DataFrame, window: int = 8, remove: bool = False, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, text (without the spans, if ``remove``), spans ([from, to) words), items, n_words, then other columns.

    ``docs`` needs doc_id and text; its other columns follow under a leading underscore, so that no name clashes.
    """
    store = Store(docs.sparkSession, "decontaminate")
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    out = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.array().cast("array<array<int>>").alias("spans"),
        F.array().cast("array<string>").alias("items"), *(F.col(f"`{c}`").alias(f"_{c}") for c in others),
    )
    kinds = dict(out.dtypes)
    schema = "doc_id long, text string, spans array<array<int>>, items array<string>, n_words long" + "".join(f", `_{c}` {kinds[f'_{c}']}" for c in others)
    blocks = _blocks(benchmark, block_bytes)
    for i in range(blocks):
        # a block has a stated share of a table whose size was measured just above
        block = benchmark.where(F.pmod(F.xxhash64(F.col("item_id").cast("string")), F.lit(blocks)) == i)
        phrases = phrases_of([tuple(r) for r in block.select("item_id", F.col("text").cast("string")).collect()], window)
        last = i == blocks - 1
        out = out.mapInArrow(lambda b, p=phrases, t=last and remove: frugal(_scan(b, p, t)), schema)
        if not last:
            out = store.save(out).drop("n_words").select("doc_id", "text", "spans", "items", *(f"`_{c}`" for c in others))
    return out


def report(docs: DataFrame, benchmark: DataFrame, window: int = 8, min_items: int = 2) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items, spans, contaminated."""
    found = scan(docs.select("doc_id", "text"), benchmark, window)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), "items", "spans").withColumn("contaminated", F.col("n_items") >= min_items)
