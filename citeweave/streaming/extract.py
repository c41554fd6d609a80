"""Extraction as a stream: new work files are taken up as they arrive, each exactly once.

Extraction keeps no state between lines, so the batch function runs unchanged on a stream.  Normalization needs all
rows of a work and is run per micro-batch, which is right as a work's rows come from one line of one file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import extract, normalize


def stream_lines(spark: SparkSession, folder: str, pattern: str = "*.gz", files_per_batch: int = 1000) -> DataFrame:
    """line and source_file_path of files that arrive below a folder."""
    reader = spark.readStream.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_batch)
    rows = reader.text(folder).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("source_file_path"))
    return rows.where(F.trim("line") != "")


def stream_fields(
    spark: SparkSession, folder: str, output: str, checkpoint: str, fields: str = extract.PIPELINE_FIELDS, flavour: extract.Flavour = extract.WORK, pattern: str = "*.gz"
) -> StreamingQuery:
    """Field rows as Parquet; ends when all files that are there are done."""
    rows = extract.extract(stream_lines(spark, folder, pattern), fields, flavour)
    return rows.writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_author_affiliations(spark: SparkSession, folder: str, output: str, checkpoint: str, pattern: str = "*.gz") -> StreamingQuery:
    """Author x affiliation rows as Parquet, one folder per micro-batch, which a repeated batch overwrites."""
    rows = extract.extract(stream_lines(spark, folder, pattern), extract.PIPELINE_FIELDS)

    def write(batch: DataFrame, number: int) -> None:
        normalize.normalize_works(batch).write.mode("overwrite").parquet(f"{output}/batch={number}")

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
