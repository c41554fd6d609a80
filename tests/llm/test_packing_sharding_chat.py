"""Packing, sharding, chat formatting and the pipeline."""

from __future__ import annotations

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from citeweave.llm import chat_template, packing, queries, sharding

from ..oracle import duck_rows
from . import edge

# --- packing -----------------------------------------------------------------------------------------------------------


def check_plan(runs, counts, capacity):
    """Each piece lies once, sequences are full from 0 on, and no two could be one; gives the number of sequences."""
    placed, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for run in runs:
        for r in range(run.first, run.last):
            placed[run.length].append(r)
            sequences[run.sequence + r - run.first].append((run.offset, run.length))
    assert {k: sorted(v) for k, v in placed.items()} == {k: list(range(v)) for k, v in counts.items()}
    for items in sequences.values():
        end = 0
        for offset, length in sorted(items):
            assert offset == end
            end += length
        assert end <= capacity
    fill = sorted(sum(n for _, n in items) for items in sequences.values())
    assert len(fill) < 2 or fill[0] + fill[1] > capacity
    return len(sequences)


def best_fit_by_brute_force(counts, capacity):
    """How many sequences best fit takes, one piece at a time, the longest first."""
    gaps = []
    for length in sorted((n for n, many in counts.items() for _ in range(many)), reverse=True):
        fitting = [g for g in gaps if g >= length]
        if fitting:
            gaps.remove(min(fitting))
            gaps.append(min(fitting) - length)
        else:
            gaps.append(capacity - length)
    return len(gaps)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 60), st.dictionaries(st.integers(1, 60), st.integers(1, 40), min_size=1, max_size=12))
def test_one_sweep_is_best_fit(capacity, counts):
    counts = {min(k, capacity): v for k, v in counts.items()}
    swept = packing.sweep([(k, 0, v) for k, v in counts.items()], [], capacity, 0)
    assert not swept.left
    assert check_plan(swept.placed, counts, capacity) == best_fit_by_brute_force(counts, capacity)


def test_sweeps_without_gaps_leave_pieces():
    swept = packing.sweep([(5, 0, 3), (2, 0, 2)], [(6, 100, 2)], 10)
    assert swept.left == [(2, 0, 2), (5, 2, 1)] or swept.left == [(5, 2, 1), (2, 0, 2)]
    assert sorted(swept.placed) == [packing.Run(5, 0, 2, 100, 4)]
    assert swept.gaps == [(1, 100, 2)]


@pytest.mark.parametrize("seed", range(5))
def test_rounds_give_a_plan_like_best_fit(spark, seed):
    r = random.Random(seed)
    capacity = r.choice([7, 40, 100, 100])
    counts = {} if seed == 4 else {r.randint(1, capacity): r.randint(1, 30) for _ in range(r.randint(1, 40))}
    totals = spark.createDataFrame(list(counts.items()), "length int, n long")
    runs = [packing.Run(*x) for x in packing.best_fit(totals, capacity).select(*packing.Run._fields).collect()]
    many = check_plan(runs, counts, capacity)
    assert many <= best_fit_by_brute_force(counts, capacity) * 1.02 + 1


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.Tokenizer.public().path)
    t.encode_special_tokens = True
    return lambda x: [*t.encode(x or "", add_special_tokens=False).ids, 2]


ODD = ["<|endoftext|> x", "it's  we'll\n\n\n a\tb", "ñ é ß 12³ ½", "Ω≈ç√ 中文 😀‍👩", "  \x85 a\r\nb", "a" * 3000, " " * 700, "I'M I'm ₂", "x\x1cy\x00"]


def test_fast_and_named_tokenizer_agree(tokenizer):
    fast = packing.encoder(packing.Tokenizer.public())
    r = random.Random(2)
    texts = ODD + ["".join(r.choice(" abcé'sßZ09\n\t.,!#-中٣ⅷ ́") for _ in range(40)) for _ in range(400)]
    for t in texts:
        assert [*fast(t).tolist(), 2] == tokenizer(t), repr(t)


def test_packing(spark, tokenizer):
    texts = [*edge.TEXTS, *((50 + i, t) for i, t in enumerate(ODD))]
    rows = packing.pack(edge.docs(spark, texts), packing.Tokenizer.public(), with_ids=True).collect()
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
    for i, t in texts:
        ids = tokenizer(t)
        first = len(ids) % 1024 or min(1024, len(ids))
        starts = [0, *range(first, len(ids), 1024)]
        wanted = [(n, s, ids[s : e]) for n, (s, e) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True))]
        mine = [(r.piece, r.start, r.ids) for r in by_doc[i]]
        assert all(w in mine for w in wanted) and len(mine) % len(wanted) == 0
    for items in by_sequence.values():
        assert [o for o, _ in sorted(items)] == [0, *np.cumsum([n for _, n in sorted(items)])[:-1]] and sum(n for _, n in items) <= 1024
    assert len(by_sequence) <= -(-sum(r.length for r in rows) // 1024) + 1
    assert packing.pack(edge.none(spark), packing.Tokenizer.public()).count() == 0


# --- sharding ----------------------------------------------------------------------------------------------------------


def test_sharding(spark):
    one = sharding.uniform(40)
    rows = sharding.assign(edge.docs(spark), one, sharding.grow(one)).collect()
    assert len(rows) == len(edge.TEXTS)
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 40) and 0 <= r.shard < 40 and r.law == "key"
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    wanted = collections.Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in edge.TEXTS)
    assert collections.Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == wanted
    assert len({r.shard for r in rows if r.doc_id == 12}) == 1
    assert sharding.assign(edge.none(spark), one).count() == 0
    with pytest.raises(ValueError):
        sharding.assign(edge.docs(spark), [])


def test_shares_and_movement(spark):
    docs = spark.range(20_000).selectExpr("id as doc_id", "'x' as text")
    tree = [sharding.Shard(0, 0, 0, 1.0), sharding.Shard(0, 1, 1, 2.0), sharding.Shard(1, 0, 2, 3.0), sharding.Shard(1, 0, 3, 4.0)]
    heavier = [*tree[:3], sharding.Shard(1, 0, 3, 8.0)]
    rows = sharding.assign(docs, tree, heavier).select("shard", "grown_shard").collect()
    n = collections.Counter(r.shard for r in rows)
    assert all(abs(n[s.shard] / 20_000 - s.weight / 10) < 0.02 for s in tree)
    # only the region whose weight grew takes rows; inside of it only the heavier shard gains
    moved = collections.Counter((r.shard, r.grown_shard) for r in rows if r.shard != r.grown_shard)
    assert {b for _, b in moved} <= {2, 3} and (3, 2) not in moved


def test_sharding_equals_sql(spark, sf):
    ours = queries.op10_sharding(spark, sf)
    columns = sorted(ours.columns)
    assert (columns, sorted((tuple(r[c] for c in columns) for r in ours.collect()), key=repr)) == duck_rows(sf, sharding.oracle_sql(40))


# --- chat formatting ---------------------------------------------------------------------------------------------------

PIECES = ["\\", "[", "INST", "]", "/", "</s>", "<s>", "[INST]", "[/INST]", " ", "a", "\n", "[ROLE]", "[TEXT]", "[/ROLE]", "<", "s", ">"]
TEXT = st.lists(st.sampled_from(PIECES), max_size=7).map("".join)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system"]), TEXT), TEXT), max_size=5))
def test_round_trip(turns):
    made = chat_template.formatter()(turns)
    assert chat_template.read_back(made.text) == turns
    assert "".join(chat_template.unescape(made.text[a:b]) for a, b in made.loss) == "".join(t for r, t in turns if r == "assistant")


def test_compiler():
    run = lambda s, **v: "".join(t for t, _ in chat_template.compile_template(s)(**v))
    assert run("{% for x in xs %}{{ loop.index }}{{ x }}{% if not loop.last %},{% endif %}{% endfor %}", xs=["a", "b"]) == "1a,2b"
    assert run("{% set y = x ~ '!' %}{{ y|upper }}{{ x[0] }}{{ d.k }}{{ d.nothing }}", x="ab", d={"k": 1}) == "AB!a1"
    assert run("{{ 'a' in x and 1 < 2 or false }}", x="abc") == "True"
    assert run("{{ x.__class__ }}{{ xs.append }}{{ missing }}", x="s", xs=[]) == ""
    assert chat_template.fold(chat_template.parse("a{{ 1 + 2 }}{% if 1 == 2 %}x{% elif true %}y{% endif %}{{ 'q'|upper ~ 'z' }}b")) == ("block", (("text", "a3yQzb"),))
    for bad in ("{% for %}", "{% if x %}", "{{ 1 + }}", "{% endfor %}", "{{ x|open }}", "{% import os %}", "{{ (1 }}", "{% else %}"):
        with pytest.raises(chat_template.TemplateError):
            chat_template.compile_template(bad)


def test_conversations(spark):
    rows = [(1, 1, "assistant", "b", "x"), (1, 0, "user", "a", "x"), (2, 0, None, None, None), (None, 0, "user", "q", "x"), (3, 0, "assistant", "", "x"), (3, 0, "assistant", "", "x"), (4, None, "user", "first", "x"), (4, 0, "user", "z" * 100_000, "x")]
    given_ = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    out = {r.conv_id: r for r in chat_template.digests(chat_template.format_conversations(given_)).collect()}
    digest = lambda *turns: hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    assert {i: (r.n_turns, r.turns_sha256, r.loss_chars) for i, r in out.items()} == {
        1: (2, digest(("user", "a"), ("assistant", "b")), 1), 2: (1, digest(("", "")), 0), None: (1, digest(("user", "q")), 0),
        3: (2, digest(("assistant", ""), ("assistant", "")), 0), 4: (2, digest(("user", "first"), ("user", "z" * 100_000)), 0),
    }
    assert chat_template.format_conversations(given_.where("false")).count() == 0


def test_planted_conversation(spark, sf):
    row = queries.op7_chat_format(spark, sf).where("conv_id = -1").first()
    assert (row.n_turns, row.loss_chars) == (2, 21)


# --- pipeline ----------------------------------------------------------------------------------------------------------


def test_pipeline(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, now = now, stage(spark, now, sf).cache()
        assert now.columns == docs.columns
        assert now.count() <= before.count()
        if name in ("decontamination", "secret_scan"):
            assert now.count() == before.count()
    changed = now.where("n_chars <> char_length(text)").count()
    assert changed == docs.join(now.select("doc_id"), "doc_id").where("n_chars <> char_length(text)").count()
    packed = corpus_pipeline.run(spark, sf)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in now.collect()}


def test_pipeline_stages_on_edge_cases(spark, sf):
    import corpus_pipeline

    now = edge.docs(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, sf)
        assert out.columns == now.columns
        assert stage(spark, edge.none(spark), sf).count() == 0
        out.collect()
    ids = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, now, sf).collect()}
    assert ids == {1, 2, 3, 4, 5, 7, 9, 11, 12, 13, 15, None}
