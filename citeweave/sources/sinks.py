"""Sinks (K1-K11)."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SUFFIXES = {
    "linkage": "_linkage.csv", "discovered": "_discovered_works.csv", "entities": "_entity_mappings.csv", "search": "_search_results.csv", "log": "_full_discovery_log.csv",
}


def _csv(df: DataFrame):
    return df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').option("emptyValue", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)


def write_csv(df: DataFrame, path: str, single: bool = False) -> str:
    """K1, K4, K7-K9: CSV with a header; ``single`` brings all rows into one file named ``path`` and is for small results."""
    if not single:
        _csv(df).csv(path)
        return path
    spark, part = df.sparkSession, f"{path}.parts"
    _csv(df.coalesce(1)).csv(part)
    jvm = spark.sparkContext._jvm
    source, target = jvm.org.apache.hadoop.fs.Path(part), jvm.org.apache.hadoop.fs.Path(path)
    files = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    made = next((f.getPath() for f in files.listStatus(source) if f.getPath().getName().startswith("part-")), None)
    files.delete(target, True)
    if made is not None:
        files.rename(made, target)
    files.delete(source, True)
    return path


def safe_key(key: Column) -> Column:
    """A source or member id as a folder name; nothing becomes ``unknown``."""
    return F.regexp_replace(F.when(F.coalesce(key, F.lit("")) == "", "unknown").otherwise(key), "[^A-Za-z0-9._-]+", "_")


#: Bytes of rows that the organized sink packs together, about how much smaller they become than rows of a shuffle, and
#: how many files a task keeps open.
PACK_BYTES, PACKED, OPEN_FILES = 16 << 20, 8, 100


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that end in a bucket, as one Parquet blob per bucket and ``PACK_BYTES`` of rows, in the order in which they came."""

    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        last = table.num_columns - 1
        table = table.take(pc.sort_indices(table[last]))
        buckets, blobs, at = pc.value_counts(table[last]), [], 0  # in order of first occurrence
        table = table.remove_column(last)
        for n in buckets.field("counts").to_pylist():
            out = pa.BufferOutputStream()
            pq.write_table(table.slice(at, n), out, compression="zstd", write_statistics=False)
            blobs.append(out.getvalue().to_pybytes())
            at += n
        return pa.RecordBatch.from_arrays([buckets.field("values"), pa.array(blobs, pa.binary())], names=["bucket", "packed"])

    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
        if size >= PACK_BYTES:
            yield packed(held)
            held, size = [], 0
    if held:
        yield packed(held)


def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows that ``pack`` took, without their bucket."""
    for batch in batches:
        for blob in batch.column("packed"):
            yield from pq.read_table(pa.BufferReader(blob.as_buffer()), use_threads=False).to_batches()


@contextmanager
def _settings(spark: SparkSession, values: dict[str, int]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def write_organized(df: DataFrame, path: str, key: str, compression: str | None = None) -> str:
    """K2: one folder per source or member; ``compression`` (such as ``gzip``) is that of the files.

    Rows are dealt by key, so a folder of usual size gets one file.  Adaptive execution splits a key that holds more than
    a partition should, and puts small ones together, by the sizes that the shuffle measured.  Field rows repeat ids and
    paths, so they go through the shuffle packed, by hash of the key.  A task writes rows to its folders as they come and
    sorts them only where it has more than ``OPEN_FILES`` folders.
    """
    spark, advisory = df.sparkSession, "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    rows = df.withColumn("organized_by", safe_key(F.col(key)))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = rows.select("*", F.pmod(F.xxhash64("organized_by"), F.lit(buckets)).alias("_bucket")).mapInArrow(pack, "bucket long, packed binary")
    writer = _csv(packed.hint("rebalance", F.col("bucket")).mapInArrow(unpack, rows.schema)).partitionBy("organized_by")
    size = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(advisory))
    with _settings(spark, {advisory: max(1, size // PACKED), "spark.sql.maxConcurrentOutputFileWriters": OPEN_FILES}):
        (writer.option("compression", compression) if compression else writer).csv(path)
    return path


def write_table(df: DataFrame, path: str) -> str:
    """A table between the entry points: Parquet where the name says so, which any number of tasks can read, else CSV."""
    if not path.rstrip("/").endswith(".parquet"):
        return write_csv(df, path)
    df.write.mode("overwrite").parquet(path)
    return path


def write_references(df: DataFrame, path: str, cluster_by: list[str] | None = None, partitions: int | None = None) -> str:
    """K5, C4: the reference table as Parquet; clustered copies replace indexes (min/max and bloom filters prune)."""
    if cluster_by:
        parts = [F.col(c) for c in cluster_by]
        df = (df.repartitionByRange(partitions, *parts) if partitions else df.repartitionByRange(*parts)).sortWithinPartitions(*parts)
    writer = df.write.mode("overwrite")
    for c in cluster_by or []:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.parquet(path)
    return path


def output_paths(base: str) -> dict[str, str]:
    """Result files beside one another, named by suffix."""
    stem = base[:-4] if base.endswith(".csv") else base
    return {name: stem + suffix for name, suffix in SUFFIXES.items()}


def processed_name(path: str) -> str:
    """K4: the default name of the normalizer's output."""
    head, _, name = path.rpartition("/")
    stem = name.rsplit(".", 1)[0] if "." in name else name
    return f"{head}/{stem}_processed.csv" if head else f"{stem}_processed.csv"


def export_order(linkage: DataFrame) -> DataFrame:
    """K7, O2: the order of the linkage file, NULLs last."""
    return linkage.orderBy(*(F.col(c).asc_nulls_last() for c in ("input_doi", "input_work_id", "input_author_name")))
