"""Scans of works and of user tables."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import INPUT_IDS


#: Compressed bytes that unpack to about one task's worth of lines.
TASK_BYTES = 32 << 20


def _missing(error: Exception) -> bool:
    """No file there, so Spark has no schema to infer from."""
    return "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error)


def files_below(spark: SparkSession, folder: str, pattern: str = "*.gz") -> DataFrame:
    """Path and length of all matching files below a folder, from the listing alone."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    try:
        return reader.load(folder).select("path", "length")
    except Exception as error:
        if _missing(error):
            return spark.createDataFrame([], "path string, length long")
        raise


def file_report(spark: SparkSession, folder: str, pattern: str = "*.gz") -> DataFrame:
    """Path, length, unpacked bytes and error (NULL for a good file) of each file.

    Every file is unpacked to its end where it lies, a file a task at a time and in pieces, so one that is cut short or
    broken is named although ``read_lines`` takes what can be read of it.  This is a pass of its own.
    """
    paths = files_below(spark, folder, pattern)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow as pa
        from pyarrow import fs

        for frame in frames:
            rows = []
            for path, length in zip(frame["path"], frame["length"], strict=True):
                size, error = 0, None
                try:
                    system, place = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
                    with system.open_input_stream(place, compression="gzip" if path.endswith(".gz") else None) as stream:
                        while piece := stream.read(1 << 20):
                            size += len(piece)
                except (OSError, pa.ArrowException) as problem:
                    error = str(problem)
                rows.append((path, length, size, error))
            yield pd.DataFrame(rows, columns=["path", "length", "unpacked", "error"])

    return paths.repartition("path").mapInPandas(run, "path string, length long, unpacked long, error string")


def file_counts(report: DataFrame) -> DataFrame:
    """Files that could be read and files that could not."""
    return report.agg(F.count_if(F.col("error").isNull()).alias("files_ok"), F.count_if(F.col("error").isNotNull()).alias("files_failed"))


def partitions_for(files: DataFrame, task_bytes: int = TASK_BYTES) -> int | None:
    """Into how many partitions lines should be dealt, by the size of their files; None where the files are small enough."""
    total, largest = files.agg(F.sum("length"), F.max("length")).first()
    return None if not total or largest <= 2 * task_bytes else -(-total // task_bytes)


def read_lines(spark: SparkSession, folder: str, pattern: str = "*.gz", partitions: int | None = None) -> DataFrame:
    """Line and source_file_path of all matching files below a folder, blank lines included.

    A gz file is one task, so ``partitions`` (``partitions_for``) spreads the lines of large ones before they are parsed.
    Of a file that cannot be read to its end, the lines before are taken; ``file_report`` names such files.  Without any
    file the result is empty.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
    try:
        rows = reader.text(folder).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("source_file_path"))
    except Exception as error:
        if _missing(error):
            return spark.createDataFrame([], "line string, source_file_path string")
        raise
    return rows.repartition(partitions) if partitions else rows


def read_table(spark: SparkSession, path: str, splittable: bool = False) -> DataFrame:
    """A table between the entry points: Parquet where the name says so, else CSV."""
    return spark.read.parquet(path) if path.rstrip("/").endswith(".parquet") else read_csv(spark, path, splittable=splittable)


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None, corrupt: str | None = None, splittable: bool = False) -> DataFrame:
    """Header, all strings, doubled quotes, newlines in quotes, short rows padded with NULL.

    Empty fields are NULL, quoted or not.  With ``columns`` the header is not read for the schema, and ``corrupt`` may
    name a column for rows that do not fit.  Newlines in quotes make each file one task; ``splittable`` says that there
    are none, so that a large file is read by many.
    """
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", not splittable).option("mode", "PERMISSIVE")
    reader = reader.option("maxCharsPerColumn", 10 << 20).option("enforceSchema", columns is None).option("nullValue", "").option("emptyValue", "")
    if columns:
        fields = [T.StructField(c, T.StringType()) for c in [*columns, *([corrupt] if corrupt else [])]]
        reader = reader.schema(T.StructType(fields))
        if corrupt:
            reader = reader.option("columnNameOfCorruptRecord", corrupt).option("enforceSchema", True)
    rows = reader.csv(path)
    return rows.select(*(F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c) for c in rows.columns))


def read_csv_or_plain(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """As ``read_csv``; if the file cannot be read so, line by line without quoted newlines, bad lines left out."""
    try:
        rows = read_csv(spark, path, columns)
        rows.limit(1).count()
        return rows
    except Exception:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        plain = spark.read.option("header", True).option("mode", "DROPMALFORMED").option("ignoreCorruptFiles", True).schema(schema).csv(path)
        return plain.select(*(F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c) for c in columns))


def input_ids(rows: DataFrame, doi: str | None = None, work_id: str | None = None) -> DataFrame:
    """The distinct pairs of raw ids; a column that is not given is NULL."""
    if not doi and not work_id:
        raise ValueError("a DOI column or a work id column is needed")
    pick = [(F.col(f"`{c}`") if c else F.lit(None)).cast("string").alias(n) for c, n in ((doi, "doi"), (work_id, "work_id"))]
    return rows.select(*pick).distinct()


def discovered_log(spark: SparkSession, path: str) -> DataFrame:
    """The ids of an earlier discovery log."""
    return read_csv(spark, path).select("discovered_work_id", "discovered_doi").distinct()


def references(spark: SparkSession, path: str) -> DataFrame:
    """The reference table."""
    return spark.read.parquet(path)


def empty_ids(spark: SparkSession) -> DataFrame:
    """U4: a relation of ids without rows."""
    return spark.createDataFrame([], INPUT_IDS)


def from_pandas(spark: SparkSession, frame, name: str | None = None) -> DataFrame:
    """A pandas frame as a relation, and as a view where a name is given."""
    rows = spark.createDataFrame(frame)
    if name:
        rows.createOrReplaceTempView(name)
    return rows
