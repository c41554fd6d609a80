"""Discovery of further works (C6, C9, C10: J2-J6, U1, W1, A7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import AFFILIATION_DISCOVERED, DISCOVERED_WORKS, ENTITY_DISCOVERED
from .linkage import FIRST_AVAILABLE, ORG_MATCH

BY_AFFILIATION, BY_ENTITY = "affiliation_exact", "entity_extracted"


def exclude_known(rows: DataFrame, known: DataFrame, doi: str = "doi", work_id: str = "work_id") -> DataFrame:
    """Rows whose DOI and work id are both unknown.

    "Known by DOI or by work id" is two anti-joins, each on one key; NULL keys match nothing.  Each side of known ids is
    distinct and without NULLs, so a popular id costs one row.
    """
    for column, key in ((doi, "doi"), (work_id, "work_id")):
        ids = known.where(F.col(key).isNotNull()).select(F.col(key).alias("_known")).distinct()
        rows = rows.join(ids, F.col(column) == F.col("_known"), "left_anti")
    return rows


def discover_by_affiliation(linkage: DataFrame, references: DataFrame, known: DataFrame | None, skip_blank: bool = False) -> DataFrame:
    """Works of the linked affiliations (J2) that are not among the known ids (J3); multiplicity is kept.

    The known works leave the reference table before the join, as the exclusion looks at nothing else.  A blank
    affiliation meets all references without one; ``skip_blank`` leaves it out.  ``known`` is None where the known works
    have left ``references`` already.
    """
    links = linkage.where(F.col("linkage_status").isin(ORG_MATCH, FIRST_AVAILABLE)).withColumn("_key", F.lower(F.trim("ref_affiliation")))
    if skip_blank:
        links = links.where("_key <> ''")
    refs = references if known is None else exclude_known(references, known)
    rows = links.join(refs, F.col("_key") == F.col("normalized_affiliation_key"))
    return rows.select(
        "input_doi", "input_work_id", "input_author_name", F.col("ref_affiliation").alias("linking_affiliation"), F.col("work_id").alias("discovered_work_id"),
        F.col("doi").alias("discovered_doi"), F.col("author_name").alias("discovered_author"), F.col("affiliation_name").alias("discovered_author_affiliation"),
        F.col("affiliation_ror").alias("discovered_ror_id"),
    ).select(*AFFILIATION_DISCOVERED.names)


def _like(text: Column, part: Column) -> Column:
    """P10: ``%part%`` with % and _ as wildcards; a backslash stands for itself."""
    return F.like(text, F.concat(F.lit("%"), F.replace(part, F.lit("\\"), F.lit("\\\\")), F.lit("%")))


def _names_any(key: Column, organizations: Sequence[str], normalize: bool) -> Column:
    """EXISTS over a given list of names, folded into one condition."""
    from ..functions import text

    named = F.lit(False)
    for name in organizations:
        # the reference doubles quotes of a name that it passes as a parameter, so such a name never matches
        plain = text.normalize_query(name) if normalize else name.lower().replace("'", "''")
        named = named | _like(key, F.lit(plain))
    return named


def matching_keys(references: DataFrame, entities: DataFrame, organizations: Sequence[str], normalize_organizations: bool = False) -> DataFrame:
    """entity_key, source_affiliations and the affiliation keys that hold them.

    The pattern test runs over distinct keys that name an organization, not over the reference rows.  Entities come from
    a list that was validated against the organizations and are small; they are sent to all tasks only if the plan can
    see that, which adaptive execution decides by their measured size.
    """
    keys = references.select("normalized_affiliation_key").where(_names_any(F.col("normalized_affiliation_key"), organizations, normalize_organizations)).distinct()
    return keys.join(entities, _like(F.col("normalized_affiliation_key"), F.col("entity_key")))


def discover_by_entities(
    entities: DataFrame, references: DataFrame, organizations: Sequence[str], known: DataFrame | None, discovered: DataFrame | None = None, normalize_organizations: bool = False
) -> DataFrame:
    """Distinct works whose affiliation holds an entity and an organization and that are not known.

    ``discovered`` (doi, work_id) are works found before (J4); the reference always starts with none.
    """
    refs = references if known is None else exclude_known(references, known)
    if discovered is not None:
        refs = exclude_known(refs, discovered)
    rows = refs.join(matching_keys(references, entities, organizations, normalize_organizations), "normalized_affiliation_key")
    return rows.select(
        F.col("source_affiliations").alias("source_embl_affiliation"), F.col("entity_key").alias("extracted_entity"), F.col("work_id").alias("discovered_work_id"),
        F.col("doi").alias("discovered_doi"), F.col("author_name").alias("discovered_author"), F.col("affiliation_name").alias("discovered_author_affiliation"),
        F.col("normalized_affiliation_name").alias("discovered_normalized_affiliation"), F.col("affiliation_ror").alias("discovered_ror_id"),
    ).select(*ENTITY_DISCOVERED.names).distinct()


def _works(found: DataFrame, matching: str, match_type: str) -> DataFrame:
    return found.select(
        F.col("discovered_work_id").alias("work_id"), F.col("discovered_doi").alias("doi"), F.col("discovered_author").alias("author"),
        F.col("discovered_author_affiliation").alias("author_affiliation"), F.col("discovered_ror_id").alias("ror_id"),
        F.col(matching).alias("matching_affiliation"), F.lit(match_type).alias("match_type"),
    ).select(*DISCOVERED_WORKS.names)


def combine(by_affiliation: DataFrame, by_entity: DataFrame, both: bool | None = None) -> DataFrame:
    """All discoveries; if there are both kinds, one per work, DOI and author, found by affiliation first.

    Ties go to the least affiliation, author affiliation and ROR.  One kind alone is not deduplicated, as in the
    reference.  ``both`` saves the look at whether the kinds have rows.  The minimum of a struct needs no sort and is
    combined before the shuffle, unlike a row number.
    """
    rows = _works(by_affiliation, "linking_affiliation", BY_AFFILIATION).unionByName(_works(by_entity, "extracted_entity", BY_ENTITY))
    if both is None:
        both = not by_affiliation.isEmpty() and not by_entity.isEmpty()
    if not both:
        return rows
    order = [F.when(F.col("match_type") == BY_AFFILIATION, 1).otherwise(2).alias("p")]
    order += [F.struct(F.col(c).isNull().alias("last"), F.col(c).alias("value")).alias(c) for c in ("matching_affiliation", "author_affiliation", "ror_id")]
    best = rows.groupBy("work_id", "doi", "author").agg(F.min(F.struct(*order, "match_type")).alias("b"))
    return best.select("work_id", "doi", "author", *(F.col(f"b.{c}.value").alias(c) for c in ("author_affiliation", "ror_id", "matching_affiliation")), "b.match_type").select(*DISCOVERED_WORKS.names)


def combine_by_row_number(by_affiliation: DataFrame, by_entity: DataFrame) -> DataFrame:
    """W1 as a window, for comparison with ``combine``."""
    rows = _works(by_affiliation, "linking_affiliation", BY_AFFILIATION).unionByName(_works(by_entity, "extracted_entity", BY_ENTITY))
    ties = [F.col(c).asc_nulls_last() for c in ("matching_affiliation", "author_affiliation", "ror_id")]
    window = Window.partitionBy("work_id", "doi", "author").orderBy(F.when(F.col("match_type") == BY_AFFILIATION, 1).otherwise(2), *ties)
    return rows.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def match_counts(works: DataFrame) -> DataFrame:
    """Distinct works per kind of match."""
    return works.groupBy("match_type").agg(F.count_distinct(F.coalesce("work_id", "doi")).alias("work_count"))


def export_works(works: DataFrame) -> DataFrame:
    """K8: distinct rows in the order of the file, NULLs last."""
    return works.distinct().orderBy(*(F.col(c).asc_nulls_last() for c in ("match_type", "doi", "author")))


def discovered_ids(*found: DataFrame) -> DataFrame:
    """The distinct ids of earlier discoveries."""
    rows = [f.select(F.col("discovered_work_id").alias("work_id"), F.col("discovered_doi").alias("doi")) for f in found]
    out = rows[0]
    for more in rows[1:]:
        out = out.unionByName(more)
    return out.distinct()
