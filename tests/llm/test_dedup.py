"""Substring dedup and near-dedup against brute force."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from citeweave.llm import near_dedup, substring_dedup

from . import edge


def removed_by_brute_force(rows, length):
    first = {}
    texts = sorted({(i, t) for i, t in rows if i is not None and t})
    for i, t in texts:
        w = t.encode().split()
        for s in range(len(w) - length + 1):
            first.setdefault(tuple(w[s : s + length]), (i, s))
    out = {}
    for i, t in texts:
        w = t.encode().split()
        keep = [True] * len(w)
        for s in range(len(w) - length + 1):
            if first[tuple(w[s : s + length])] != (i, s):
                keep[s : s + length] = [False] * length
        out[i] = (len(w), keep.count(False), b" ".join(x for x, k in zip(w, keep, strict=True) if k).decode())
    return out


def test_removal_on_edge_cases(spark):
    rows = substring_dedup.remove_repeats(edge.docs(spark)).collect()
    wanted = removed_by_brute_force(edge.TEXTS, 20)
    assert len(rows) == len(edge.TEXTS)
    for r in rows:
        if r.doc_id is None:
            assert (r.n_words, r.n_removed) == (40, 0)
        else:
            assert (r.n_words, r.n_removed, r.kept_text) == wanted.get(r.doc_id, (0, 0, "")), r.doc_id
    assert wanted[6][1] == 40 and wanted[12][1] > 0
    assert substring_dedup.remove_repeats(edge.none(spark)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_removal_on_random_texts(spark, seed):
    r = random.Random(seed)
    passages = [[r.choice("abcdefg") + r.choice("xyz") for _ in range(r.randint(5, 40))] for _ in range(6)]
    rows = []
    for i in r.sample(range(100), 40):
        parts = [r.choice(passages) if r.random() < 0.5 else [r.choice("ab") for _ in range(r.randint(1, 25))] for _ in range(r.randint(0, 5))]
        rows.append((i, r.choice([" ", "\n", "  "]).join(x for p in parts for x in p)))
    length, k = r.choice([(20, 8), (5, 3), (7, 7), (4, 1)])
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    wanted = removed_by_brute_force(rows, length)
    got = {x.doc_id: (x.n_words, x.n_removed, x.kept_text) for x in substring_dedup.remove_repeats(frame, length, k).collect()}
    assert got == {i: wanted.get(i, (0, 0, "")) for i, _ in rows}


@pytest.mark.parametrize("hot", [4096, 2])
def test_removal_on_documents(spark, sf, hot):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    wanted = removed_by_brute_force(rows, 20)
    got = {x.doc_id: (x.n_words, x.n_removed, x.kept_text) for x in substring_dedup.remove_repeats(docs, hot=hot).collect()}
    assert got == {i: wanted.get(i, (0, 0, "")) for i, _ in rows}
    assert sum(n for _, n, _ in wanted.values()) > 1000


@pytest.mark.parametrize("hot", [4096, 16])
def test_a_hot_phrase_in_different_surroundings(spark, hot):
    """A third of all rows hold the phrase; only those with the same words around it repeat."""
    phrase = edge.words(10, 77)
    rows = [(i, f"{edge.words(15, 1000 + i % 150)} {phrase} {edge.words(15, 2000 + i % 220)}" if i % 3 == 0 else edge.words(40, 5000 + i)) for i in range(900)]
    wanted = removed_by_brute_force(rows, 20)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = {x.doc_id: (x.n_words, x.n_removed, x.kept_text) for x in substring_dedup.remove_repeats(frame, hot=hot).collect()}
    assert got == {i: wanted[i] for i, _ in rows}
    assert sum(n > 0 for _, n, _ in wanted.values()) > 100


def test_different_texts_of_one_doc_id_are_documents_of_their_own(spark):
    a, b, shared = edge.words(60, 11), edge.words(60, 12), edge.words(30, 13)
    rows = [(1, f"{shared} {a}"), (2, f"{b} {a}"), (2, f"{a} x"), (2, b), (3, b), (3, b)]
    got = sorted((r.doc_id, r.n_words, r.n_removed) for r in substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got[0] == (1, 90, 0)
    assert sorted(n for i, _, n in got if i == 2) == [60, 60, 60] or sorted(n for i, _, n in got if i == 2) == [0, 60, 120]
    assert got[-2:] == [(3, 60, 60), (3, 60, 60)]


def test_extension_parts_where_words_differ():
    """Occurrences of one seed: equal surroundings, one that differs on the right, one that differs on the left."""
    words = [b"l2 l1 s r1 r2", b"l2 l1 s r1 r2", b"l2 l1 s r1 xx", b"xx l1 s r1 r2"]
    seeds = substring_dedup.Seeds(*(np.array(x) for x in ([7] * 4, [1, 2, 3, 4], [0] * 4, [2] * 4, [2] * 4, [0b111] * 4)), pa.array(words, pa.binary()))
    assert substring_dedup.extend(seeds, 3, 1).tolist() == [0, 0b111, 0b110, 0b011]


def sets_of(rows):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = {}
    for i, t in rows:
        w = (t or "").translate(low).encode().split()
        out[i] = {tuple(w[s : s + 5]) for s in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    return out


def components_by_brute_force(rows):
    sets = sets_of([r for r in rows if r[0] is not None])
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def test_links_on_edge_cases(spark):
    rows = near_dedup.link(edge.docs(spark)).collect()
    wanted = components_by_brute_force(edge.TEXTS)
    assert len(rows) == len(edge.TEXTS)
    for r in rows:
        if r.doc_id is None:
            assert (r.component_id, r.kept, r.n_shingles) == (None, True, 36)
        else:
            assert (r.n_shingles, r.component_id, r.kept) == wanted[r.doc_id]
    assert near_dedup.link(edge.none(spark)).count() == 0


def test_links_in_a_group_without_one_centre(spark):
    """Chains and rings of edits: neighbours are similar, far ones are not, and all share buckets."""
    r = random.Random(7)
    rows, number = [], 0
    for group in range(3):
        now = edge.words(120, 50 + group).split()
        for _ in range(40):
            rows.append((number, " ".join(now)))
            number += 1
            now = now[:]
            for _ in range(2):
                now[r.randrange(len(now))] = f"new{r.randrange(10**6)}"
    rows += [(number + i, edge.words(80, 900 + i)) for i in range(20)]
    r.shuffle(rows)
    got = {x.doc_id: (x.n_shingles, x.component_id, x.kept) for x in near_dedup.link(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert got == components_by_brute_force(rows)


def test_signature_agreement_estimates_similarity():
    r = np.random.default_rng(1)
    pool = np.sort(r.integers(0, 1 << 63, 4000).astype(np.uint64))
    a, b = np.unique(pool[:1000]), np.unique(np.concatenate([pool[100:1000], pool[2000:2100]]))
    same = np.mean(near_dedup.band_keys(a, 400, 1) == near_dedup.band_keys(b, 400, 1))
    assert abs(same - 900 / 1100) < 0.08
    tiny = near_dedup.band_keys(pool[:1], 48, 6)
    assert len(tiny) == 48  # one shingle fills every bin


def test_shingles_of_short_texts():
    sets = list(near_dedup.shingle_sets(pa.array(["a b", "A  B", "b a", "a b c d e", None, ""])))
    assert [len(s) for s in sets] == [1, 1, 1, 1, 0, 0]
    assert sets[0][0] == sets[1][0] != sets[2][0]
