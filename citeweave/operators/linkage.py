"""Author linkage (C5: J1, F5, P7, P11).

The reference's join condition is "same DOI or same work id", which a planner can only run as a nested loop.  Here each
id is an equi-join of its own; the union of both, made distinct, is the same set.  Names are compared on the distinct
candidates only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names, text

ORG_MATCH, NAME_ONLY, FIRST_AVAILABLE = "org_match_found", "name_match_no_org_affiliation", "first_available"


def input_authors(rows: DataFrame, authors: str, separator: str, doi: str | None = None, work_id: str | None = None) -> DataFrame:
    """Distinct input_doi (cleaned), input_work_id, input_author of a user's table."""
    if not doi and not work_id:
        raise ValueError("a DOI column or a work id column is needed")
    cell = F.col(f"`{authors}`").cast("string")
    picked = rows.where(F.trim(cell) != "").select(
        (text.clean_doi(F.col(f"`{doi}`")) if doi else F.lit(None).cast("string")).alias("input_doi"),
        (F.col(f"`{work_id}`").cast("string") if work_id else F.lit(None).cast("string")).alias("input_work_id"),
        F.explode(text.authors_of(F.trim(cell), separator)).alias("input_author"),
    )
    return picked.distinct()


def candidates(inputs: DataFrame, references: DataFrame) -> DataFrame:
    """J1 without the names: distinct pairs that share a DOI or a work id, both not empty."""
    refs = references.where("author_name <> ''").select("doi", "work_id", F.col("author_name").alias("ref_author_name"), F.col("normalized_affiliation_name").alias("ref_affiliation"))
    keep = ["input_doi", "input_work_id", "input_author", "ref_author_name", "ref_affiliation"]
    by = [inputs.where(F.col(a) != "").join(refs.where(F.col(b) != ""), F.col(a) == F.col(b)).select(*keep) for a, b in (("input_doi", "doi"), ("input_work_id", "work_id"))]
    return by[0].unionByName(by[1]).distinct()


def status(affiliation: Column, organizations: Sequence[str]) -> Column:
    """What a reference affiliation says about the organizations one looks for."""
    wanted = [w for w in (text.normalize_query(o) for o in organizations if o) if w]
    if not wanted:
        return F.lit(FIRST_AVAILABLE)
    normal = text.normalized(affiliation)
    found = F.lit(False)
    for w in wanted:
        found = found | F.contains(normal, F.lit(w))
    return F.when((F.coalesce(affiliation, F.lit("")) != "") & found, ORG_MATCH).otherwise(NAME_ONLY)


def link_authors(
    inputs: DataFrame, references: DataFrame, organizations: Sequence[str] = (), input_style: str = "auto", reference_style: str = "first_last", threshold: float = 0.85
) -> DataFrame:
    """Rows of ``LINKAGE``; what is missing is ''."""
    alike = names.names_similar_column(F.col("input_author"), F.col("ref_author_name"), input_style, reference_style, threshold)
    rows = candidates(inputs, references).where(alike)
    filled = {"input_doi": "input_doi", "input_work_id": "input_work_id", "input_author": "input_author_name", "ref_author_name": "ref_author_name", "ref_affiliation": "ref_affiliation"}
    return rows.select(*(F.coalesce(a, F.lit("")).alias(b) for a, b in filled.items()), status(F.col("ref_affiliation"), organizations).alias("linkage_status"))
