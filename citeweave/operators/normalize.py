"""Long field rows to one row per author and affiliation (C1: A1, J9, J10, F13).

``normalize_works`` reads the fields once and shuffles them once, by work; the steps inside are grouped by (work,
author) and then by work, which that partitioning serves as it is.  ``pivot_authors``, ``pivot_affiliations`` and
``lookup_ror`` are the single steps as relations, by (work, author) and finer keys.

Where a field comes twice, the one later in path order counts.  A DataFrame has no file order, so "first" and "last"
follow (source file, path with its indexes as numbers); an institution with several RORs takes the least.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..schemas import AUTHOR_AFFILIATIONS

NAME = "authorships.author.display_name"
RAW_AFFILIATION = "authorships.affiliations.raw_affiliation_string"
AFFILIATION_INSTITUTION = "authorships.affiliations.institution_ids"
INSTITUTION_ID = "authorships.institutions.id"
INSTITUTION_ROR = "authorships.institutions.ror"


def with_places(fields: DataFrame) -> DataFrame:
    """the author, affiliation, institution and id indexes of each path, and its place in path order."""
    path = F.col("subfield_path")
    places = {"author": "authorships", "affiliation": "affiliations", "institution": "institutions", "id_place": "institution_ids"}
    # most paths lack most steps, which a plain search tells faster than a pattern
    found = {name: F.when(path.contains(step + "["), text.path_index(path, step)) for name, step in places.items()}
    rows = fields.select("*", *(column.alias(name) for name, column in found.items()))
    return rows.withColumn("place", F.struct("source_file_path", *places))


def _last(field: str) -> Column:
    """A1: the last value of a field in each group."""
    here = F.col("field_name") == field
    return F.max_by(F.when(here, F.col("value")), F.when(here, F.col("place")))


def pivot_authors(placed: DataFrame) -> DataFrame:
    """work_id, author, author_name: any path with an author index makes an author; without a name it is ''."""
    authors = placed.where("author is not null").groupBy("work_id", "author")
    return authors.agg(F.coalesce(_last(NAME), F.lit("")).alias("author_name"))


def pivot_affiliations(placed: DataFrame) -> DataFrame:
    """work_id, author, affiliation, affiliation_sequence, affiliation_name.

    An affiliation known through institution ids only keeps sequence 0 and no name.
    """
    rows = placed.where(F.col("affiliation").isNotNull() & F.col("author").isNotNull() & F.col("field_name").isin(RAW_AFFILIATION, AFFILIATION_INSTITUTION))
    named = F.bool_or(F.col("field_name") == RAW_AFFILIATION)
    return rows.groupBy("work_id", "author", "affiliation").agg(
        F.when(named, F.col("affiliation")).otherwise(0).alias("affiliation_sequence"), F.coalesce(_last(RAW_AFFILIATION), F.lit("")).alias("affiliation_name")
    )


def institution_rors(placed: DataFrame) -> DataFrame:
    """work_id, institution_id, ror over all authors of a work; of several RORs of an id, the least."""
    rows = placed.where(F.col("institution").isNotNull() & F.col("author").isNotNull() & F.col("field_name").isin(INSTITUTION_ID, INSTITUTION_ROR))
    pairs = rows.groupBy("work_id", "author", "institution").agg(_last(INSTITUTION_ID).alias("institution_id"), _last(INSTITUTION_ROR).alias("ror"))
    pairs = pairs.where("institution_id is not null and ror is not null")
    return pairs.groupBy("work_id", "institution_id").agg(F.min("ror").alias("ror"))


def lookup_ror(placed: DataFrame) -> DataFrame:
    """work_id, author, affiliation, ror: of an affiliation's institutions in order, the first that has a ROR."""
    ids = placed.where((F.col("field_name") == AFFILIATION_INSTITUTION) & F.col("affiliation").isNotNull() & F.col("author").isNotNull())
    ids = ids.select("work_id", "author", "affiliation", "place", F.col("value").alias("institution_id"))
    hits = ids.join(institution_rors(placed), ["work_id", "institution_id"])
    return hits.groupBy("work_id", "author", "affiliation").agg(F.min_by("ror", "place").alias("affiliation_ror"))


def _last_in(cells: Column, field: str) -> Column:
    """The last value of a field among cells (place, field_name, value)."""
    own = F.array_sort(F.transform(F.filter(cells, lambda c: c["field_name"] == field), lambda c: F.struct(c["place"], c["value"])))
    return F.get(F.transform(F.reverse(own), lambda c: c["value"]), F.lit(0))


def _by_index(cells: Column, index: str, make: Callable[[Column, Column], Column]) -> Column:
    """``make`` of each index of an author's cells and of the cells with it, in order of the index."""
    indexes = F.array_sort(F.array_distinct(F.transform(cells, lambda c: c[index])))
    return F.transform(indexes, lambda i: make(i, F.filter(cells, lambda c: c[index] == i)))


def _affiliation(index: Column, cells: Column) -> Column:
    ids = F.array_sort(F.transform(F.filter(cells, lambda c: c["field_name"] == AFFILIATION_INSTITUTION), lambda c: F.struct(c["place"], c["value"])))
    named = F.exists(cells, lambda c: c["field_name"] == RAW_AFFILIATION)
    return F.struct(
        F.when(named, index).otherwise(0).alias("affiliation_sequence"), F.coalesce(_last_in(cells, RAW_AFFILIATION), F.lit("")).alias("affiliation_name"),
        F.transform(ids, lambda c: c["value"]).alias("ids"),
    )


def _institution(_: Column, cells: Column) -> Column:
    return F.struct(_last_in(cells, INSTITUTION_ID).alias("id"), _last_in(cells, INSTITUTION_ROR).alias("ror"))


def normalize_works(fields: DataFrame) -> DataFrame:
    """Rows of ``AUTHOR_AFFILIATIONS`` from rows of ``EAV_WORK``.

    J10: an author without affiliation gives one row with sequence 0 and empty strings.
    """
    rows = with_places(fields).repartition("work_id")
    cell, kind = F.struct("affiliation", "institution", "place", "field_name", "value"), F.col("field_name")
    authors = rows.groupBy("work_id", "author").agg(
        F.max(F.struct("source_file_path", "subfield_path", F.coalesce("doi", F.lit("")).alias("doi"))).alias("last"), F.coalesce(_last(NAME), F.lit("")).alias("author_name"),
        F.collect_list(F.when(F.col("affiliation").isNotNull() & kind.isin(RAW_AFFILIATION, AFFILIATION_INSTITUTION), cell)).alias("a"),
        F.collect_list(F.when(F.col("institution").isNotNull() & kind.isin(INSTITUTION_ID, INSTITUTION_ROR), cell)).alias("i"),
    )
    institutions = F.filter(_by_index(F.col("i"), "institution", _institution), lambda x: x["id"].isNotNull() & x["ror"].isNotNull())
    person = F.struct("author", "author_name", _by_index(F.col("a"), "affiliation", _affiliation).alias("affiliations"))
    has_author = F.col("author").isNotNull()
    works = authors.select("work_id", "last", F.when(has_author, person).alias("person"), F.when(has_author, institutions).alias("institutions")).groupBy("work_id").agg(
        F.max("last").alias("last"), F.collect_list("person").alias("people"), F.array_sort(F.flatten(F.collect_list("institutions"))).alias("found")
    )
    first = F.filter("found", lambda x, n: (n == 0) | (F.get(F.col("found"), n - 1)["id"] != x["id"]))
    people = works.select("work_id", F.col("last.doi").alias("doi"), F.map_from_entries(first).alias("rors"), F.explode("people").alias("p"))
    rows = people.select("work_id", "doi", "rors", "p.author", "p.author_name", F.explode_outer("p.affiliations").alias("f"))
    ror = F.get(F.filter(F.transform("f.ids", lambda i: F.col("rors")[i]), lambda r: r.isNotNull()), F.lit(0))
    empty = F.lit("")
    affiliation = F.coalesce("f.affiliation_name", empty)
    return rows.select(
        "work_id", "doi", F.col("author").cast("int").alias("author_sequence"), "author_name", text.normalized(F.col("author_name"), at="ingest").alias("normalized_author_name"),
        F.coalesce("f.affiliation_sequence", F.lit(0)).cast("int").alias("affiliation_sequence"), affiliation.alias("affiliation_name"),
        text.normalized(affiliation, at="ingest").alias("normalized_affiliation_name"), F.coalesce(ror, empty).alias("affiliation_ror"),
    ).select(*AUTHOR_AFFILIATIONS.names)


def in_order(rows: DataFrame) -> DataFrame:
    """O1, O3: works together, their authors and affiliations in sequence, without a global sort."""
    return rows.repartition("work_id").sortWithinPartitions("work_id", "author_sequence", "affiliation_sequence")
