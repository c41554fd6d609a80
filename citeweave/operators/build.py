"""Building and profiling the reference table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..schemas import AUTHOR_REFERENCES

REJECTED = "Invalid or missing required fields"
MAX_WORK_ID, MAX_AUTHOR, LOGGED = 1000, 500, 100


def is_valid() -> Column:
    """P5: a work id and an author name that are there and not too long.  Never NULL, so its complement is P6."""
    work, author = F.coalesce("work_id", F.lit("")), F.coalesce("author_name", F.lit(""))
    return ~work.isin("", "null") & (author != "") & (F.char_length(work) < MAX_WORK_ID) & (F.char_length(author) < MAX_AUTHOR)


def build_references(staged: DataFrame) -> DataFrame:
    """Valid rows of the author x affiliation table, sentinels nulled, sequences cast, lookup key added."""
    doi = F.when(~F.col("doi").isin("", "null"), F.col("doi"))
    return staged.where(is_valid()).select(
        "work_id", doi.alias("doi"), text.lossy_int(F.col("author_sequence").cast("string")).alias("author_sequence"), "author_name", "normalized_author_name",
        text.lossy_int(F.col("affiliation_sequence").cast("string")).alias("affiliation_sequence"), "affiliation_name", "normalized_affiliation_name",
        "affiliation_ror", text.affiliation_key(F.col("normalized_affiliation_name")).alias("normalized_affiliation_key"),
    ).select(*AUTHOR_REFERENCES.names)


def rejects(staged: DataFrame) -> DataFrame:
    """All rows that ``build_references`` leaves out (P6); NULL in a part makes row_content NULL."""
    content = F.concat(F.col("work_id"), F.lit(","), F.coalesce("doi", F.lit("")), F.lit(","), F.coalesce("author_name", F.lit("")))
    return staged.where(~is_valid()).select(F.lit(REJECTED).alias("error_message"), content.alias("row_content"))


def import_errors(staged: DataFrame, limit: int = LOGGED) -> DataFrame:
    """K6: at most ``limit`` rejects with a time stamp."""
    return rejects(staged).limit(limit).withColumn("timestamp", F.current_timestamp())


def counts(staged: DataFrame) -> DataFrame:
    """A2: staged, imported and rejected rows, in one pass."""
    return staged.agg(
        F.count(F.lit(1)).alias("staged"), F.count_if(is_valid()).alias("imported"), F.count_if(~is_valid()).alias("rejected")
    )


def profile(references: DataFrame) -> DataFrame:
    """A3: rows, distinct works, DOIs, authors and affiliations, rows with DOI and with ROR."""
    distinct = {"unique_works": "work_id", "unique_dois": "doi", "unique_authors": "normalized_author_name", "unique_affiliations": "normalized_affiliation_key"}
    return references.agg(
        F.count(F.lit(1)).alias("total_rows"), *(F.count_distinct(c).alias(n) for n, c in distinct.items()),
        F.count("doi").alias("rows_with_doi"), F.count("affiliation_ror").alias("rows_with_ror"),
    )


def null_checks(references: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """A4, A5: column_name, nulls, percent (NULL for an empty table) of each column."""
    columns = columns or AUTHOR_REFERENCES.names
    one = references.agg(F.count(F.lit(1)).alias("n"), *(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    pairs = F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in columns))
    return one.select("n", F.explode(pairs).alias("x")).select("x.*", F.round(F.try_divide(F.col("x.nulls") * 100, F.col("n")), 4).alias("percent"))


def recent_errors(errors: DataFrame, n: int = 5) -> DataFrame:
    """The latest import errors."""
    return errors.orderBy(F.col("timestamp").desc(), F.col("row_content").asc_nulls_last()).limit(n)


def sample_rows(references: DataFrame, n: int = 10) -> DataFrame:
    """Some rows of the table."""
    return references.limit(n)
