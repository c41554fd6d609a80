from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from citeweave.sources import sinks, works


def shuffled(spark) -> int:
    """Bytes that all shuffles of the session have written so far."""
    sc = spark.sparkContext._jsc.sc()
    sc.listenerBus().waitUntilEmpty(30_000)
    return sc.statusStore().executorSummary("driver").totalShuffleWrite()


def size(folder: Path) -> int:
    return sum(p.stat().st_size for p in folder.rglob("part-*"))


def field_rows(spark, n):
    k, i = (F.col("id") / 20).cast("long"), (F.col("id") % 20).cast("string")
    path = F.concat(F.lit("authorships["), i, F.lit("].author.display_name"))
    ids = [F.concat(F.lit("https://openalex.org/W"), k.cast("string")), F.concat(F.lit("10.1000/Ord."), k.cast("string")), F.concat(F.lit("https://openalex.org/S"), (k % 5).cast("string"))]
    return spark.range(n).select(ids[0].alias("work_id"), ids[1].alias("doi"), path.alias("subfield_path"), F.concat(F.lit("Name "), (F.col("id") % 97).cast("string")).alias("value"), ids[2].alias("source_id"))


def test_organized_sink_takes_little_disk(spark, tmp_path):
    rows, n = field_rows(spark, 200_000), 200_000
    text = rows.agg(F.sum(F.length(F.concat_ws(",", *rows.columns)))).first()[0]
    before = shuffled(spark)
    sinks.write_organized(rows, str(tmp_path / "out"), "source_id", "gzip")
    assert shuffled(spark) - before < text / 20
    assert size(tmp_path / "out") < text / 8
    back = works.read_csv(spark, str(tmp_path / "out"))
    assert back.count() == n and back.drop("organized_by").exceptAll(rows).isEmpty()


def test_organized_sink_keeps_all_rows(spark, tmp_path):
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    odd = [("w", 'a "b", c', None), ("w", "two\nlines", ""), (None, "\\", "a/b"), ("é", "x", "a b")]
    rows = spark.createDataFrame(odd, "work_id string, value string, source_id string")
    many = spark.range(20_000).select(F.col("id").cast("string").alias("work_id"), F.sha2(F.col("id").cast("string"), 256).alias("value"), F.concat(F.lit("S"), F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 301).cast("string")).alias("source_id"))
    rows = rows.union(many)  # more folders than a task keeps open, and one with half of all rows
    held = spark.conf.get(advisory)
    try:
        spark.conf.set(advisory, "512k")
        sinks.write_organized(rows, str(tmp_path / "out"), "source_id")
        assert spark.conf.get(advisory) == "512k" and spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None) in (None, "0")
    finally:
        spark.conf.set(advisory, held)
    back = works.read_csv(spark, str(tmp_path / "out"))
    given = rows.withColumn("source_id", F.nullif("source_id", F.lit("")))
    folder = F.when(F.col("source_id").isNull(), "unknown").when(F.col("source_id").isin("a/b", "a b"), "a_b").otherwise(F.col("source_id"))
    wanted = sorted(map(repr, map(tuple, given.withColumn("organized_by", folder).collect())))
    assert sorted(map(repr, map(tuple, back.select(*given.columns, "organized_by").collect()))) == wanted
    assert len(list((tmp_path / "out" / "organized_by=S0").glob("part-*.csv"))) > 1
