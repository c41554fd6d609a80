"""Extraction statistics (A9, O4) as aggregates of the field rows, which task retries cannot count twice."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOP_FIELDS, SHOWN_GROUPS = 20, 50


def totals(fields: DataFrame, work: str | None = "work_id") -> DataFrame:
    """Rows, distinct works and distinct DOIs; an empty DOI is none."""
    works = [F.count_distinct(work).alias("unique_works")] if work else []
    return fields.agg(F.count(F.lit(1)).alias("total_rows"), *works, F.count_distinct(F.nullif(F.col("doi"), F.lit(""))).alias("unique_dois"))


def rows_per(fields: DataFrame, key: str) -> DataFrame:
    """Rows per field, source, member or prefix, from field rows or from counts (n) of finer groups."""
    counted = F.sum("n") if "n" in fields.columns else F.count(F.lit(1))
    return fields.groupBy(key).agg(counted.alias("n"))


def top_fields(fields: DataFrame, n: int = TOP_FIELDS) -> DataFrame:
    """The most frequent fields; ties by name."""
    return rows_per(fields, "field_name").orderBy(F.col("n").desc(), "field_name").limit(n)


def group_table(fields: DataFrame, key: str, most: int = SHOWN_GROUPS) -> DataFrame:
    """Rows per source or member, and nothing if there are ``most`` of them or more."""
    per = rows_per(fields.where(F.coalesce(key, F.lit("")) != ""), key)
    few = per.agg((F.count(F.lit(1)) < most).alias("few")).where("few")
    return per.join(F.broadcast(few), how="left_semi", on=F.lit(True)).orderBy(F.col("n").desc(), key)
