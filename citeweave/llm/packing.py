"""Best-fit packing of token pieces into sequences of fixed capacity, bulk-synchronous.

1. Each text is tokenised and closed with the end id; only longer texts are cut, into full pieces after a first piece
   that takes the rest.  Pieces are written to the shared folder once, with their place among the pieces of equal
   length in their task.
2. Range sort: lengths are whole numbers up to the capacity, so the sorted order of all pieces is kept as its run-length
   code: how many pieces of each length each task has.  A running sum over tasks, per length, turns places within a task
   into global ranks.  No piece moves for this, and one length with half of all pieces is as cheap as any other.
3. Rounds, from the longest pieces on, each over the lengths down to half of those before.  Pieces and gaps, as runs, are
   dealt out by ranges of size, and each range sweeps on its own: a piece takes its successor, the smallest gap that
   holds it, gaps are updated, and pieces that want the same gaps take them in the order of length and rank.  What finds
   no gap in its range meets the gaps of the wider range in the next sweep; the last one spans all sizes, and what
   finds none there opens new sequences.  Gaps and placed runs go on to the next round in a shuffle.
4. Each run of ranks knows its sequences and offset; pieces look up their run by length and rank.

The driver holds no run and no piece.  Runs are at most about as many as pairs of lengths and gaps.

Defined results: null or empty text is the end id alone; repeated rows are packed each; a null doc_id is carried along;
other columns are ignored; an empty table gives no rows.  The ids are those of the ``tokenizers`` file: texts made of
characters on which both libraries certainly agree go through the faster one over the same vocabulary.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._memory import frugal
from ._store import Store

ROUNDS, STEP, RANGES, MAX_RUNS = 6, 2, 16, 200_000
#: Anything but printable ASCII, plain white space, Latin, Greek and Cyrillic letters and common punctuation.
_UNSURE = re.compile("[^\t\n\r\x20-\x7e\xa1-\xac\xae-ſΑ-ΡΣ-ώА-я‐-‧‰-⁞€]")


class Tokenizer(NamedTuple):
    """Files of one byte-level vocabulary: for ``tokenizers``, and the same as ranks (or None)."""

    path: str
    ranks: str | None = None

    @classmethod
    def public(cls) -> Tokenizer:
        import public_tokenizers

        return cls(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


@lru_cache(2)
def encoder(files: Tokenizer):
    """text -> ids as an array of uint32."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    slow: list = []

    def exact(text: str) -> np.ndarray:
        if not slow:  # it takes a hundred megabytes of each worker, and few texts need it
            from tokenizers import Tokenizer as Slow

            slow.append(Slow.from_file(files.path))
            slow[0].encode_special_tokens = True
        return np.array(slow[0].encode(text, add_special_tokens=False).ids, np.uint32)

    if files.ranks is None:
        return exact
    import public_tokenizers
    import tiktoken

    with open(files.ranks, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(text: str) -> np.ndarray:
        if _UNSURE.search(text):
            return exact(text)
        return np.array(fast.encode_to_numpy(text, disallowed_special=()), np.uint32)

    return ids


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a text: full ones, behind a first one that takes the rest."""
    first = length % capacity or min(length, capacity)
    return [(0, first), *((s, capacity) for s in range(first, length, capacity))]


PIECES = "part int, place long, doc_id long, piece int, start long, length int, ids_crc32 long"


def _pieces(batches: Iterator[pa.RecordBatch], files: Tokenizer, capacity: int, end: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    part, places, encode = TaskContext.get().partitionId(), [0] * (capacity + 1), encoder(files)
    tail = np.array([end], "<u4")
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            rows, packed = [], []
            for doc_id, text in zip(batch.column(0).slice(at, 500).to_pylist(), batch.column(1).slice(at, 500).to_pylist(), strict=True):
                ids = np.concatenate([encode(text), tail]).astype("<u4") if text else tail
                for i, (start, n) in enumerate(cut(len(ids), capacity)):
                    piece = ids[start : start + n]
                    rows.append((part, places[n], doc_id, i, start, n, zlib.crc32(piece.tobytes())))
                    packed.append(piece)
                    places[n] += 1
            if not rows:
                continue
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()]
            columns = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)]
            names = ["part", "place", "doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                sizes = np.cumsum([0, *map(len, packed)]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(sizes), pa.array(np.concatenate(packed).astype(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)


class Run(NamedTuple):
    """Pieces of a length with ranks first .. last - 1: the one of rank r lies in sequence ``sequence + r - first``."""

    length: int
    first: int
    last: int
    sequence: int
    offset: int


GAP, PIECE, PLACED = 0, 1, 2
#: Runs between sweeps: ``n`` gaps of a size in sequences ``at`` on; or ``n`` pieces of a size with ranks ``at`` on, and where they lie.
STATE = "kind int, size int, at long, n long, sequence long, offset long"


class Swept(NamedTuple):
    placed: list[Run]
    gaps: list[tuple[int, int, int]]  # size, first sequence, how many
    left: list[tuple[int, int, int]]  # length, first rank, how many


def sweep(pieces: list[tuple[int, int, int]], gaps: list[tuple[int, int, int]], capacity: int, opened: int | None = None) -> Swept:
    """Best fit of runs: pieces from the longest on sweep the gaps upwards from their own length to the next open one.

    Pieces that want the same gaps take them in the order of length and rank, and gaps are updated at once.  Pieces
    without a gap open sequences numbered from ``opened`` on, or are left over if it is None.
    """
    runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    for size, sequence, n in sorted(gaps, reverse=True):
        runs[size].append((sequence, n))
    out = Swept([], [], [])
    for length, rank, left in sorted(pieces, key=lambda p: (-p[0], p[1])):
        gap = length
        while left:
            while gap <= capacity and not runs[gap]:
                gap += 1
            if gap <= capacity:
                sequence, many = runs[gap].pop()
            elif opened is None:
                out.left.append((length, rank, left))
                break
            else:
                gap, sequence = capacity, opened
                many = -(-left // (capacity // length))
                opened += many
            each = min(gap // length, -(-left // many))  # best fit keeps filling a gap that still has room for its like
            full = min(many, left // each)
            if not full:
                full, each = 1, left
            for i in range(each):
                out.placed.append(Run(length, rank, rank + full, sequence, capacity - gap + i * length))
                rank += full
            left -= full * each
            runs[gap - each * length].append((sequence, full))
            if many > full:
                runs[gap].append((sequence + full, many - full))
            if gap == capacity:
                gap = length
    out.gaps.extend((size, sequence, n) for size in range(1, capacity + 1) for sequence, n in runs[size])
    return out


def _range_sweep(capacity: int, lower: int, opened: int | None) -> Callable[[pa.Table], pa.Table]:
    """For a range of sizes: its pieces longer than ``lower`` take its gaps; placed runs and shorter pieces pass."""

    def run(table: pa.Table) -> pa.Table:
        rows = list(zip(*(table.column(c).to_pylist() for c in ("kind", "size", "at", "n", "sequence", "offset")), strict=True))
        pieces, gaps = [r[1:4] for r in rows if r[0] == PIECE and r[1] > lower], [r[1:4] for r in rows if r[0] == GAP]
        swept = sweep(pieces, gaps, capacity, opened)
        out = [r for r in rows if r[0] == PLACED or (r[0] == PIECE and r[1] <= lower)]
        out += [(PLACED, r.length, r.first, r.last - r.first, r.sequence, r.offset) for r in swept.placed]
        out += [(GAP, *g, 0, 0) for g in swept.gaps] + [(PIECE, *p, 0, 0) for p in swept.left]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        names = ["kind", "size", "at", "n", "sequence", "offset"]
        return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names=names)

    return run


def best_fit(totals: DataFrame, capacity: int) -> DataFrame:
    """length, first, last, sequence, offset of all runs of pieces, from how many pieces (n) each length has."""
    zero = F.lit(0).cast("long")
    rows = totals.select(F.lit(PIECE).alias("kind"), F.col("length").alias("size"), zero.alias("at"), "n", zero.alias("sequence"), zero.alias("offset"))
    narrow, lower = max(1, capacity // RANGES), capacity
    for number in range(ROUNDS):
        lower = lower // STEP if number < ROUNDS - 1 else 0
        for opened in (None, number << 48) if number else (0,):  # nothing is open before the first sequences
            own = F.floor(F.col("size") / F.lit(narrow))
            # the sweep that opens sequences spans all sizes, so what finds no gap there has none
            wide = own if opened is None else F.when((F.col("kind") == GAP) | ((F.col("kind") == PIECE) & (F.col("size") > lower)), -1).otherwise(own)
            rows = rows.withColumn("range", wide).groupBy("range").applyInArrow(_range_sweep(capacity, lower, opened), STATE)
    return rows.where(F.col("kind") == PLACED).select(F.col("size").alias("length"), F.col("at").alias("first"), (F.col("at") + F.col("n")).alias("last"), "sequence", "offset")


def pack(docs: DataFrame, files: Tokenizer, capacity: int = 1024, end: int = 2, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids, if asked for) of each piece."""
    spark = docs.sparkSession
    store = Store(spark, "packing")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = PIECES + ", ids array<int>" * with_ids
    pieces = store.save(texts.mapInArrow(lambda b: frugal(_pieces(b, files, capacity, end, with_ids)), schema))
    counts = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = store.save(counts.select("length", "part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")))
    runs = store.save(best_fit(counts.groupBy("length").agg(F.sum("n").alias("n")), capacity), 1)
    if runs.count() <= MAX_RUNS:
        runs = F.broadcast(runs)
    # counts grow with the tasks, so they are not to be sent to all of them however small their file is
    placed = pieces.join(counts.select("length", "part", "before").hint("merge"), ["length", "part"]).withColumn("rank", F.col("before") + F.col("place"))
    placed = placed.join(runs.withColumnRenamed("length", "l"), (F.col("length") == F.col("l")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last")))
    return placed.select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32",
        (F.col("sequence") + F.col("rank") - F.col("first")).alias("sequence_id"), "offset", *["ids"] * with_ids,
    )
