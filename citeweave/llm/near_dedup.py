"""MinHash near-dedup: one-permutation hashing, optimal densification, banded buckets, star-shaped candidate edges.

1. Each text becomes its set of five-word shingle hashes, a 128-bit fingerprint of that set, and a signature: the hash
   range is cut into ``bands * rows`` bins, each keeps the least shingle hash in it, and an empty bin copies from the
   first non-empty bin of a random probe order of its own (optimal densification).  Bands of ``rows`` values are
   buckets.
2. Texts of equal sets become one class; only classes go on, so exact copies never make pairs.
3. Stars: in each bucket one class is the centre, by one of four hash orders, so that a large group meets several
   centres.  Every other class of the bucket whose set size allows the similarity is compared with it on the full sets.
   Links are contracted into components.
4. A bucket may still hold classes of several components.  Each such bucket makes another star: its centre is a class
   outside the bucket's largest component, and every class of another component than the centre's is compared with it.
   There are ``STARS`` rounds of stars in all, each contracted before the next.
5. What is still open then is not given up: classes outside the bucket's largest component are compared with all classes of
   that component's open buckets and with one another.  This runs in cells of about ``BLOCK`` such classes and ``CHUNK``
   others; a task reads the sets of a cell and returns links only, so no pair is ever a row, and a class is read once per
   block, not once per bucket or pair.

With 48 bands of 6 rows a pair of similarity 0.75 shares no bucket with probability 1e-4, one of 0.8 with 5e-7; of the
pairs that share one, no link between components is lost and nothing is capped.

Sets are made again from the texts that take part: a bitmap of their hashed ids (at most ``BITMAP_WORDS`` numbers, a
fixed size) drops most other texts before the shuffle; over a very large input it fills up and then drops none, which
costs a shuffle of the texts and nothing else.  Nothing else is sent to all tasks, and nothing is collected.

Defined results: a text without words (null, blank) has an empty set (n_shingles 0), is linked with nothing and kept; a
text of one to four words has one shingle, its whole sequence; the class and the component are named by their least
doc_id; rows that share a doc_id are one node, so all of them are kept or none; a null doc_id is linked with nothing,
its component_id is null and it is kept; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _text
from ._memory import frugal
from ._store import Store

BANDS, ROWS, WORDS, PERCENT = 48, 6, 5, 75
STARS, ORDERS, BLOCK, CHUNK, BITMAP_WORDS = 3, 4, 64, 512, 1 << 16
CELL_BYTES, SIGN_ROWS = 2 << 20, 2000
_U = np.uint64


def shingle_sets(column: pa.Array, words: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for w in _text.word_tables(column, lower=True):
        shingles, count, at = w.grams(words), w.count, w.word_at
        short = {n: w.grams(n) for n in set(count[(count > 0) & (count < words)].tolist())}
        for d in range(w.n_docs):
            n, a = int(count[d]), int(at[d])
            if n >= words:
                yield np.unique(shingles[a : a + n - words + 1])
            elif n:
                yield short[n][a : a + 1]
            else:
                yield np.zeros(0, np.uint64)


@lru_cache(4)
def _plan(bands: int, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin edges, each bin's probe order as ranks, and a seed for each band."""
    size, draw = bands * rows, np.random.default_rng(20177)
    edges = np.array([i * (1 << 64) // size for i in range(size)], np.uint64)
    return edges, np.argsort(draw.random((size, size)), axis=1).astype(np.int16), _text.mix(np.arange(1, bands + 1, dtype=np.uint64))


def band_keys(shingles: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    edges, probes, seeds = _plan(bands, rows)
    at = np.searchsorted(shingles, edges)
    full = np.empty(len(at), bool)
    full[:-1] = at[:-1] < at[1:]
    full[-1] = at[-1] < len(shingles)
    have = np.flatnonzero(full)
    source = np.arange(len(at))
    if len(have) < len(at):
        empty = np.flatnonzero(~full)
        source[empty] = have[probes[empty[:, None], have[None, :]].argmin(axis=1)]
    values = shingles[at[source]].reshape(bands, rows)
    key = seeds.copy()
    for i in range(rows):
        key = _text.mix(key * _U(0x9E3779B97F4A7C15) + values[:, i])
    return key


SIGNED = "doc_id long, n_shingles long, f1 long, f2 long, bands array<long>"


def _sign(batches: Iterator[pa.RecordBatch], bands: int, rows: int, words: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, SIGN_ROWS):
            batch = whole.slice(at, SIGN_ROWS)
            n, f1, f2, keys = [], [], [], []
            for s in shingle_sets(batch.column(1), words):
                n.append(len(s))
                mixed = _text.mix(s + _U(77))
                f1.append(np.add.reduce(mixed) if len(s) else _U(0))
                f2.append(np.bitwise_xor.reduce(_text.mix(mixed * _U(3))) if len(s) else _U(0))
                keys.append(band_keys(s, bands, rows) if len(s) else np.zeros(0, np.uint64))
            sizes = np.cumsum([0, *map(len, keys)]).astype(np.int32)
            flat = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
            lists = pa.ListArray.from_arrays(pa.array(sizes), pa.array(flat.view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(np.array(f1, np.uint64).view(np.int64)), pa.array(np.array(f2, np.uint64).view(np.int64)), lists],
                names=["doc_id", "n_shingles", "f1", "f2", "bands"],
            )


CELLS = "cell long, centre boolean, id long, shingles binary"


def _to_cells(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """The set of each text, once for each cell that it takes part in."""
    for batch in batches:
        rows: list[tuple] = []
        size = 0
        for i, s in enumerate(shingle_sets(batch.column(1), words)):
            ids, packed = batch.column(0)[i].as_py(), s.tobytes()
            for role in batch.column(2)[i].as_py():
                rows.append((role["cell"], role["centre"], ids, packed))
                size += len(packed)
                if size > CELL_BYTES:
                    yield _cell_rows(rows)
                    rows, size = [], 0
        if rows:
            yield _cell_rows(rows)


def _cell_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["cell", "centre", "id", "shingles"])


class _Cell:
    """The centres of a cell, as an inverted index from shingle to centres."""

    def __init__(self) -> None:
        self.ids: list[int] = []
        self.sets: list[np.ndarray] = []
        self.index = None

    def add(self, id_: int, shingles: np.ndarray) -> None:
        self.ids.append(id_)
        self.sets.append(shingles)

    def linked(self, id_: int, shingles: np.ndarray, percent: int) -> list[int]:
        if not self.ids:
            return []
        if self.index is None:
            owner = np.repeat(np.arange(len(self.sets)), [len(s) for s in self.sets])
            flat = np.concatenate(self.sets)
            order = np.argsort(flat, kind="stable")
            self.keys, start = np.unique(flat[order], return_index=True)
            self.index, self.start = owner[order], np.append(start, len(flat))
            self.sizes, self.names = np.array([len(s) for s in self.sets]), np.array(self.ids)
            self.sets = []
        at = np.minimum(np.searchsorted(self.keys, shingles), len(self.keys) - 1)
        at = at[self.keys[at] == shingles]
        many = self.start[at + 1] - self.start[at]
        place = np.repeat(self.start[at] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        both = np.bincount(self.index[place], minlength=len(self.ids))
        hit = (100 * both >= percent * (self.sizes + len(shingles) - both)) & (self.names != id_)
        return self.names[hit].tolist()


def _compare(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows come by cell, centres first."""
    now, cell = None, _Cell()
    for batch in batches:
        a, b = [], []
        for key, centre, id_, packed in zip(*(c.to_pylist() for c in batch.columns[:3]), batch.column(3), strict=True):
            if key != now:
                now, cell = key, _Cell()
            shingles = np.frombuffer(packed.as_buffer(), np.uint64)
            if centre:
                cell.add(id_, shingles.copy())
            else:
                for other in cell.linked(id_, shingles, percent):
                    a.append(min(id_, other))
                    b.append(max(id_, other))
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _links(store: Store, texts: DataFrame, roles: DataFrame, words: int, percent: int) -> DataFrame:
    """a, b: links found in cells; ``roles`` (id, role) says which ids are in which cell, as a centre or not."""
    roles = store.save(roles.groupBy("id").agg(F.collect_set("role").alias("roles")))
    word, bit = F.pmod(F.xxhash64("id"), F.lit(BITMAP_WORDS)), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(64)).cast("int")
    # BITMAP_WORDS rows of two numbers, whatever the size of the input
    bitmap = roles.groupBy(word.alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(xxhash64(id, 1), 64) as int))")).alias("bits"))
    texts = texts.select(F.col("doc_id").alias("id"), "text").withColumn("word", word).withColumn("bit", bit)
    texts = texts.join(F.broadcast(bitmap), "word").where("getbit(bits, bit) = 1").select("id", "text")
    cells = texts.join(roles, "id").select("id", "text", "roles").mapInArrow(lambda b: frugal(_to_cells(b, words)), CELLS)
    # true sorts last, so descending puts the centres first
    cells = cells.repartition("cell").sortWithinPartitions("cell", F.col("centre").desc())
    return cells.mapInArrow(lambda b: frugal(_compare(b, percent)), "a long, b long").distinct()


def components(edges: DataFrame, store: Store) -> DataFrame:
    """node, label: the least node that each node of the distinct saved edges (a, b) reaches.

    Labels spread along edges and are then looked up among the labels before, so chains shorten by half each round.
    Labels only fall, so equal sums mean that none did.
    """
    rows = 2 * edges.count()
    both = store.save(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))), rows)
    labels = store.save(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")), rows)
    total = None
    while True:
        now = labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
        if now == total:
            store.drop(both)
            return labels
        total, before = now, labels
        sent = both.join(labels, both.b == labels.node).select(F.col("a").alias("node"), "label").union(labels.select("node", "label"))
        least = sent.groupBy("node").agg(F.min("label").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        labels = store.save(least.join(jump, "label", "left").select("node", F.least("label", F.coalesce("further", "label")).alias("label")), rows)
        store.drop(before)


def _role(cell: Column, centre: bool) -> Column:
    return F.struct(cell.alias("cell"), F.lit(centre).alias("centre"))


def _star_cells(buckets: DataFrame, percent: int) -> DataFrame:
    """Each centre meets the classes of its buckets, in cells of a share of them."""
    fits = f"id <> c and 100 * least(n, cn) >= {percent} * greatest(n, cn)"
    cell = F.xxhash64("c", F.pmod(F.xxhash64("id"), F.ceil(F.col("k") / CHUNK)))
    both = F.array(F.struct("id", _role(cell, False).alias("role")), F.struct(F.col("c").alias("id"), _role(cell, True).alias("role")))
    return buckets.where(fits).select(F.inline(both))


def _open(buckets: DataFrame, names: DataFrame) -> DataFrame:
    """bucket, id, n, comp, largest, k of the classes in buckets that hold several components."""
    rows = buckets.select("bucket", "id", "n", "k").join(names.select("id", F.col("label").alias("comp")), "id")
    parts = rows.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("m"))
    parts = parts.groupBy("bucket").agg(F.count(F.lit(1)).alias("parts"), F.max(F.struct("m", "comp")).alias("most")).where("parts > 1")
    return rows.join(parts.select("bucket", F.col("most.comp").alias("largest")), "bucket")


def _next_stars(rows: DataFrame, turn: int) -> DataFrame:
    """A class outside of its bucket's largest component as the centre, and all classes of other components."""
    first = F.min(F.struct(F.xxhash64("id", F.lit(turn)).alias("h"), "id", "n", "comp"))
    centres = rows.where("comp <> largest").groupBy("bucket").agg(first.alias("c"))
    rows = rows.join(centres, "bucket").where("comp <> c.comp")
    return rows.select("bucket", "id", "n", "k", F.col("c.id").alias("c"), F.col("c.n").alias("cn"))


def _rest_cells(store: Store, rows: DataFrame) -> DataFrame:
    """Classes outside the largest component of an open bucket, against all classes of the component's open buckets."""
    rows = store.save(rows.groupBy("largest", "id").agg(F.max(F.col("comp") != F.col("largest")).alias("outside")))
    sizes = rows.groupBy("largest").agg(F.count(F.lit(1)).alias("n"), F.count_if("outside").alias("m"))
    sizes = sizes.select("largest", F.ceil(F.col("m") / BLOCK).alias("blocks"), F.ceil(F.col("n") / CHUNK).alias("chunks"))
    rows = rows.join(sizes, "largest").withColumn("block", F.pmod(F.xxhash64("id"), "blocks")).withColumn("chunk", F.pmod(F.xxhash64("id", F.lit(1)), "chunks"))
    zero = F.lit(0).cast("long")
    reads = F.transform(F.sequence(zero, F.col("blocks") - 1), lambda b: _role(F.xxhash64("largest", b, "chunk"), False))
    leads = F.transform(F.sequence(zero, F.col("chunks") - 1), lambda c: _role(F.xxhash64("largest", "block", c), True))
    return rows.select("id", F.explode(F.when(F.col("outside"), F.concat(reads, leads)).otherwise(reads)).alias("role"))


def _merged(store: Store, names: DataFrame, links: DataFrame) -> DataFrame:
    """The labels of all classes, after links that join components."""
    for side in ("a", "b"):
        links = links.join(names.select(F.col("id").alias(side), F.col("label").alias("_label")), side).withColumn(side, F.col("_label")).drop("_label")
    links = store.save(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    if links.isEmpty():
        return names
    found = components(links, store).select(F.col("node").alias("label"), F.col("label").alias("_label"))
    return store.save(names.join(found, "label", "left").select("id", F.coalesce("_label", "label").alias("label")))


def link(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row."""
    store = Store(docs.sparkSession, "near-dedup")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = store.save(texts.mapInArrow(lambda b: frugal(_sign(b, bands, rows, words)), SIGNED))
    same = ["f1", "f2", "n_shingles"]
    classes = store.save(
        signed.where("doc_id is not null and n_shingles > 0").groupBy(*same).agg(F.min("doc_id").alias("id"), F.first("bands").alias("bands"))
    )
    members = classes.select("id", F.col("n_shingles").cast("int").alias("n"), F.explode("bands").alias("bucket"))
    first = F.min(F.struct(F.xxhash64("id", F.pmod("bucket", F.lit(ORDERS))).alias("h"), "id", "n"))
    shared = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("k"), first.alias("c")).where("k > 1")
    buckets = store.save(members.join(shared.select("bucket", "k", F.col("c.id").alias("c"), F.col("c.n").alias("cn")), "bucket"))
    names, cells = classes.select("id", F.col("id").alias("label")), _star_cells(buckets, percent)
    for turn in range(1, STARS + 1):
        names = _merged(store, names, _links(store, texts, cells, words, percent))
        held = store.save(_open(buckets, names))
        if held.isEmpty():
            break
        cells = _star_cells(_next_stars(held, turn), percent) if turn < STARS else _rest_cells(store, held)
    else:
        names = _merged(store, names, _links(store, texts, cells, words, percent))
    known = classes.select(*same, "id").join(names, "id").select(*same, F.col("label").alias("id"))
    whole = signed.select("doc_id", *same).join(known, same, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("id", "doc_id"))
    return whole.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
