"""Row shapes of the pipeline's tables (data model M3 to M13)."""

from __future__ import annotations

from pyspark.sql import types as T


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


#: Extracted fields of works that carry a work id (M3, M5).
EAV_WORK = strings("work_id", "doi", "field_name", "subfield_path", "value", "source_id", "doi_prefix", "source_file_path")
#: Extracted fields of works that are known by DOI (M4).
EAV_DOI = strings("doi", "field_name", "subfield_path", "value", "member_id", "doi_prefix")

_PLACES = {"author_sequence", "affiliation_sequence"}
#: One row per author and affiliation (M7).
AUTHOR_AFFILIATIONS = T.StructType([
    T.StructField(n, T.IntegerType() if n in _PLACES else T.StringType())
    for n in ("work_id", "doi", "author_sequence", "author_name", "normalized_author_name", "affiliation_sequence", "affiliation_name", "normalized_affiliation_name", "affiliation_ror")
])
#: The reference table that linkage and discovery read (M8).
AUTHOR_REFERENCES = T.StructType([*AUTHOR_AFFILIATIONS.fields, T.StructField("normalized_affiliation_key", T.StringType())])
IMPORT_ERRORS = T.StructType([*strings("error_message", "row_content").fields, T.StructField("timestamp", T.TimestampType())])
INPUT_IDS = strings("doi", "work_id")
LINKAGE = strings("input_doi", "input_work_id", "input_author_name", "ref_author_name", "ref_affiliation", "linkage_status")
AFFILIATION_DISCOVERED = strings(
    "input_doi", "input_work_id", "input_author_name", "linking_affiliation", "discovered_work_id", "discovered_doi", "discovered_author",
    "discovered_author_affiliation", "discovered_ror_id",
)
ENTITY_KEYS = strings("entity_key", "source_affiliations")
ENTITY_DISCOVERED = strings(
    "source_embl_affiliation", "extracted_entity", "discovered_work_id", "discovered_doi", "discovered_author", "discovered_author_affiliation",
    "discovered_normalized_affiliation", "discovered_ror_id",
)
DISCOVERED_WORKS = strings("work_id", "doi", "author", "author_affiliation", "ror_id", "matching_affiliation", "match_type")
