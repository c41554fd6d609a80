"""Sharding by a hierarchical weighted hash tree.

A topology is a tree of regions, racks and shards with weights; a node weighs what its shards weigh together.  A
document descends level by level: at each node every child draws ``-ln(u) / weight`` with u the hash of (doc_id, child)
in (0, 1), and the least draw wins, which gives each child a share in proportion to its weight.  A child's draws depend
on nothing but its own path and weight, so a change of weights moves documents only into or out of subtrees whose
weights changed.  ``grow`` opens a new region for the new shard: no weight of an old subtree changes, and rows move
only into the new shard (law ``key``: doc_id and the shard count decide).

Everything is JVM-side expressions: the tree is a literal map and the descent folds over its levels; documents are never grouped to be
placed, and equal texts or ids need no group.  Slots are gapless ranks within a shard by (hash of doc_id, doc_id),
counted in two steps so that no shard has to fit one task: the hash order is split into bands, each band is ranked by
itself, and the counts of the bands before it (shards x bands rows) are added.

Defined results: null text counts as empty (size 16, CRC 0); a null doc_id hashes as the word ``null`` and is placed
like any other; rows repeating a doc_id go to the same shard with slots of their own; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class Shard(NamedTuple):
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def uniform(n: int, regions: int = 4, racks: int = 2) -> list[Shard]:
    """``n`` shards of weight 1, dealt over the racks of the regions in order."""
    return [Shard(i * regions // n, i * regions * racks // n % racks, i) for i in range(n)]


def grow(topology: list[Shard], weight: float = 1.0) -> list[Shard]:
    """One more shard, in a region of its own."""
    return [*topology, Shard(max((s.region for s in topology), default=-1) + 1, 0, max((s.shard for s in topology), default=-1) + 1, weight)]


def _weights(topology: list[Shard]) -> dict[tuple, dict[int, float]]:
    """Path of a node -> weight of each child."""
    if len({s.shard for s in topology}) != len(topology) or not topology or min(s.weight for s in topology) <= 0:
        raise ValueError("a topology needs distinct shards of positive weight")
    out: dict[tuple, dict[int, float]] = {}
    for s in sorted(topology):
        for path, child in (((), s.region), ((s.region,), s.rack), ((s.region, s.rack), s.shard)):
            out.setdefault(path, {})
            out[path][child] = out[path].get(child, 0.0) + s.weight
    return out


def _descent(topology: list[Shard]) -> str:
    """SQL of the path '/region/rack/shard' that the hash of ``_key`` leads to.

    The tree is a literal map from a node's path to its children.  -ln(u) takes u as an odd multiple of 2**-49 in
    (0, 1), from 48 bits of the hash of (document, path of the child).
    """
    nodes = ", ".join(
        f"'{''.join(f'/{x}' for x in path)}', array({', '.join(f"named_struct('child', {c}, 'weight', {w!r}D)" for c, w in children.items())})"
        for path, children in _weights(topology).items()
    )
    u = "(cast(conv(substr(md5(concat(_key, path, '/', c.child)), 1, 12), 16, 10) as double) + 0.5D) / 281474976710656D"
    draws = f"transform(element_at(map({nodes}), path), c -> named_struct('draw', -ln({u}) / c.weight, 'child', c.child))"
    return f"aggregate(array(1, 2, 3), '', (path, _) -> concat(path, '/', array_min({draws}).child))"


def _step(path: str, level: int) -> Column:
    return F.split_part(F.col(path), F.lit("/"), F.lit(level + 2)).cast("int")


def assign(docs: DataFrame, topology: list[Shard], grown: list[Shard] | None = None, bands: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, region, rack."""
    spark = docs.sparkSession
    bands = bands or max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("null")).alias("_key"),
    )
    rows = rows.withColumn("_order", F.conv(F.substring(F.md5("_key"), 1, 12), 16, 10).cast("long"))
    rows = rows.withColumn("_path", F.expr(_descent(topology)))
    rows = rows.select("*", *(_step("_path", i).alias(name) for i, name in enumerate(("region", "rack", "shard"))))
    rows = rows.withColumn("grown_shard", F.split_part(F.expr(_descent(grown)), F.lit("/"), F.lit(4)).cast("int") if grown else F.lit(None).cast("int"))
    rows = rows.withColumn("_band", F.floor(F.col("_order") / F.lit(float(1 << 48)) * bands).cast("int"))
    counts = rows.groupBy("shard", "_band").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_band").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("shard", "_band", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # shards x bands rows of three numbers, however large the table is
    rows = rows.join(F.broadcast(counts) if len(topology) * bands <= 200_000 else counts, ["shard", "_band"])
    within = Window.partitionBy("shard", "_band").orderBy("_order", "doc_id", "size", "text_crc32")
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("_before") + F.row_number().over(within) - 1).cast("long").alias("slot"),
        "grown_shard", "region", "rack",
    )


def oracle_sql(n: int) -> str:
    """DuckDB's form of ``assign(documents, uniform(n), grow(uniform(n)))``, with the CRC folded byte by byte."""

    def hexed(text: str) -> str:
        return f"('0x' || md5({text})[1:12])::BIGINT"

    def least(children: dict[int, float], path: tuple) -> str:
        if len(children) == 1:
            return str(next(iter(children)))
        draws = ", ".join(
            f"{{'draw': -ln(({hexed(f"k || '/{'/'.join(map(str, (*path, c)))}'")}::DOUBLE + 0.5) / 281474976710656.0) / {w!r}::DOUBLE, 'child': {c}}}"
            for c, w in children.items()
        )
        return f"list_min([{draws}]).child"

    def level(weights: dict, depth: int, names: list[str]) -> str:
        whens = " ".join(
            f"WHEN {' AND '.join([f'{a} = {b}' for a, b in zip(names, path)] or ['TRUE'])} THEN {least(weights[path], path)}"
            for path in weights
            if len(path) == depth
        )
        return f"CASE {whens} END"

    old, new = _weights(uniform(n)), _weights(grow(uniform(n)))
    byte = "(('0x' || x)::BIGINT)"
    crc = f"list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: {byte}), lambda s, b: xor(s >> 8, crc[(xor(s, b) & 255) + 1]), 4294967295)"
    return f"""
WITH RECURSIVE steps AS (SELECT i, i AS v, 0 AS k FROM (SELECT unnest(range(256)) AS i)
  UNION ALL SELECT i, xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END), k + 1 FROM steps WHERE k < 8),
bytes AS (SELECT list(v ORDER BY i) AS crc FROM steps WHERE k = 8),
a AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 16 AS size, coalesce(doc_id::VARCHAR, 'null') AS k, xor({crc}, 4294967295) AS text_crc32 FROM documents, bytes),
b AS (SELECT *, {level(old, 0, [])} AS r, {level(new, 0, [])} AS gr FROM a),
c AS (SELECT *, {level(old, 1, ["r"])} AS c, {level(new, 1, ["gr"])} AS gc FROM b),
d AS (SELECT *, {level(old, 2, ["r", "c"])} AS s, {level(new, 2, ["gr", "gc"])} AS gs FROM c)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, s::INTEGER AS shard,
  row_number() OVER (PARTITION BY s ORDER BY {hexed('k')}, doc_id) - 1 AS slot,
  gs::INTEGER AS grown_shard, r::INTEGER AS region, c::INTEGER AS rack FROM d"""
