"""Tables written between steps, in the folder that every executor shares.

A step whose result is read more than once, or that ends a loop's lineage, is written as Parquet under the session's
``spark.checkpoint.dir``, so the loss of an executor costs no more than the tasks it ran.  Where the session names no
such folder (tests, a local session), one is made in the temporary folder, which is right for a local master only.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROWS_PER_FILE = 100_000
_OWN: dict[str, str] = {}


def folder(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):  # local-cluster has executors of its own
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if "here" not in _OWN:
        _OWN["here"] = "file://" + tempfile.mkdtemp(prefix="citeweave-")
    return _OWN["here"]


def unused(name: str, columns: list[str]) -> str:
    """The name, or with underscores ahead of it one that no column has."""
    while name.lower() in {c.lower() for c in columns}:
        name = "_" + name
    return name


class Store:
    """The tables of one run of an operator."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.base, self.count = spark, f"{folder(spark)}/{name}-{uuid.uuid4().hex}", 0

    def save(self, df: DataFrame, rows: int | None = None) -> DataFrame:
        """Writes and reads again; a bound on the rows keeps small tables out of very many files."""
        self.count += 1
        if rows is not None:
            df = df.coalesce(max(8, rows // ROWS_PER_FILE))
        path = f"{self.base}/{self.count}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._citeweave_path = path
        return out

    def drop(self, df: DataFrame | None) -> None:
        """Removes a saved table that no later step reads."""
        if df is None:
            return
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._citeweave_path)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
