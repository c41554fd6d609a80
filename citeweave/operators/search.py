"""Affiliation search (C11: F11, J8, O2) and search by ids (an extension of the reference's documented mode)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from .discovery import exclude_known
from .linkage import ORG_MATCH, status


def search_affiliations(terms: DataFrame, column: str, references: DataFrame, native: bool = False) -> DataFrame:
    """Reference rows whose key is the normalized search term; repeated terms repeat their rows.

    ``native`` leaves out terms with characters beyond U+024F and needs no Python.
    """
    term = F.col(f"`{column}`").cast("string")
    normal = (text.normalized_latin if native else text.normalized)(term)
    rows = terms.select(term.alias("input_search_term"), normal.alias("_key")).join(references, F.col("_key") == F.col("normalized_affiliation_key"))
    return rows.select(
        "input_search_term", F.col("work_id").alias("ref_work_id"), F.col("doi").alias("ref_doi"), F.col("author_name").alias("ref_author_name"),
        F.col("normalized_affiliation_name").alias("ref_affiliation"), F.col("normalized_affiliation_key").alias("ref_affiliation_normalized_key"),
    )


def search_order(found: DataFrame) -> DataFrame:
    """K9, O2: the order of the result file, NULLs last."""
    return found.orderBy(*(F.col(c).asc_nulls_last() for c in ("input_search_term", "ref_doi", "ref_author_name")))


def search_ids(ids: DataFrame, references: DataFrame, organizations: Sequence[str]) -> dict[str, DataFrame]:
    """Extension: ``matched`` references of given ids, further ``discovered`` works of their organization-matched
    affiliations, and ``unmatched`` ids."""
    by = []
    for key in ("doi", "work_id"):
        wanted = ids.where(F.col(key).isNotNull()).select(key).distinct()
        by.append(references.join(wanted, key, "left_semi"))
    matched = by[0].unionByName(by[1]).distinct()
    keys = matched.where(status(F.col("normalized_affiliation_name"), organizations) == ORG_MATCH).select("normalized_affiliation_key").distinct()
    discovered = exclude_known(references.join(keys, "normalized_affiliation_key", "left_semi"), ids).select(*references.columns)
    return {"matched": matched, "discovered": discovered, "unmatched": exclude_known(ids.distinct(), references.select("doi", "work_id"))}
