"""The library's registered queries over the driver's tables, with the SQL that DuckDB holds against them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names, similarity, text
from ..operators import build, discovery, entities, extract, linkage, normalize, search, stats
from ..sources import sinks, works
from . import adapter as a

Query = Callable[[SparkSession, str], DataFrame]
_FOUND: dict[str, tuple[Query, str | None]] = {}


def _registered(sql: str | None = None) -> Callable[[Query], Query]:
    def keep(query: Query) -> Query:
        _FOUND[query.__name__] = (query, sql)
        return query

    return keep


# --- JSON extraction and pivot ---------------------------------------------------------------------------------------

EAV_SQL = "WITH " + a.STAGED_SQL + """,
heads AS (SELECT 'W' || k AS work_id, CASE WHEN k % 10 <> 0 THEN '10.' || (1000 + k % 9) || '/Ord.' || k ELSE '' END AS doi, 'authorships[' || n || ']' AS p,
  'S' || (k % 5) AS source_id, CASE WHEN k % 10 <> 0 THEN '10.' || (1000 + k % 9) ELSE '' END AS doi_prefix, 'orders' AS source_file_path, * EXCLUDE (k) FROM lines),
eav AS (
  SELECT work_id, doi, 'authorships.author.display_name' AS field_name, p || '.author.display_name' AS subfield_path, name AS value, source_id, doi_prefix, source_file_path FROM heads
  UNION ALL SELECT work_id, doi, 'authorships.affiliations.raw_affiliation_string', p || '.affiliations[0].raw_affiliation_string', affiliation, source_id, doi_prefix, source_file_path FROM heads
  UNION ALL SELECT work_id, doi, 'authorships.affiliations.institution_ids', p || '.affiliations[0].institution_ids[0]', institution, source_id, doi_prefix, source_file_path FROM heads
  UNION ALL SELECT work_id, doi, 'authorships.institutions.id', p || '.institutions[0].id', institution, source_id, doi_prefix, source_file_path FROM heads
  UNION ALL SELECT work_id, doi, 'authorships.institutions.ror', p || '.institutions[0].ror', ror, source_id, doi_prefix, source_file_path FROM heads)"""


def _eav(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract_jvm(a.work_lines(spark, sf_dir), extract.PIPELINE_FIELDS)


@_registered(EAV_SQL + " SELECT * FROM eav")
def json_extract_eav(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1-X15 over one JSON line per order."""
    return _eav(spark, sf_dir)


@_registered(EAV_SQL + " SELECT * FROM eav")
def json_extract_walked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by the walk that knows wildcards and all renderings."""
    return extract.extract(a.work_lines(spark, sf_dir), extract.PIPELINE_FIELDS)


@_registered(EAV_SQL + " SELECT * FROM eav WHERE source_id = 'S3' AND doi_prefix = '10.1004'")
def json_extract_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source and one DOI prefix."""
    return extract.extract(a.work_lines(spark, sf_dir), extract.PIPELINE_FIELDS, group="S3", prefix="10.1004")


@_registered("SELECT event_id, 'k' AS field_name, 'k' AS subfield_path, json_extract_string(props, '$.k') AS value FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL")
def json_extract_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X4, X7 for a known path, without Python."""
    return extract.extract_native(a.table(spark, sf_dir, "events").select("event_id", "props"), "props", {"k": "$.k"}).drop("props")


@_registered(
    EAV_SQL
    + """ SELECT work_id, doi, n::INTEGER AS author_sequence, name AS author_name, lower(name) AS normalized_author_name, 0 AS affiliation_sequence, affiliation AS affiliation_name,
  trim(regexp_replace(lower(affiliation), '[^\\w\\s]', '', 'g')) AS normalized_affiliation_name, ror AS affiliation_ror FROM heads"""
)
def normalize_works(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extraction, pivot, ROR lookup and normalization end to end."""
    return normalize.normalize_works(_eav(spark, sf_dir))


@_registered(EAV_SQL + " SELECT work_id, n::INTEGER AS author, name AS author_name FROM heads")
def eav_pivot_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1, F13."""
    return normalize.pivot_authors(normalize.with_places(_eav(spark, sf_dir)))


@_registered(EAV_SQL + " SELECT work_id, n::INTEGER AS author, 0 AS affiliation, ror AS affiliation_ror FROM heads")
def ror_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J9."""
    return normalize.lookup_ror(normalize.with_places(_eav(spark, sf_dir)))


# --- statistics --------------------------------------------------------------------------------------------------------


@_registered(EAV_SQL + " SELECT field_name, count(*) AS n FROM eav GROUP BY 1 ORDER BY n DESC, 1 LIMIT 20")
def top_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top-20 report."""
    return stats.top_fields(_eav(spark, sf_dir))


@_registered(EAV_SQL + " SELECT source_id, count(*) AS n FROM eav GROUP BY 1")
def source_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per source."""
    return stats.group_table(_eav(spark, sf_dir), "source_id")


@_registered(EAV_SQL + " SELECT count(*) AS total_rows, count(DISTINCT work_id) AS unique_works, count(DISTINCT nullif(doi, '')) AS unique_dois FROM eav")
def extraction_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2, A9."""
    return stats.totals(_eav(spark, sf_dir))


# --- text functions ------------------------------------------------------------------------------------------------------


@_registered(
    """SELECT doc_id, regexp_replace(regexp_replace(lower(strip_accents(replace(text, 'ß', 'ss'))), '[^\\w\\s]', '', 'g'), '^\\s+|\\s+$', '', 'g') AS normalized FROM documents"""
)
def normalize_accents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1, F2 over whole texts."""
    return a.table(spark, sf_dir, "documents").select("doc_id", text.normalized(F.col("text")).alias("normalized"))


_MESSY = """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'https://doi.org/' || d WHEN '2-HIGH' THEN ' <doi:' || d || '?x=1>' WHEN '3-MEDIUM' THEN d || ' and more'
  WHEN '4-NOT SPECIFIED' THEN '"HTTP://DX.DOI.ORG/' || d || '#a"' ELSE o_orderpriority END AS raw, d FROM (SELECT *, '10.' || (1000 + o_orderkey % 9) || '/Ord.' || o_orderkey AS d FROM orders)"""


def _messy(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, level = F.col("o_orderkey"), F.col("o_orderpriority")
    d = F.concat(F.lit("10."), (1000 + key % 9).cast("string"), F.lit("/Ord."), key.cast("string"))
    forms = {"1-URGENT": ("https://doi.org/", ""), "2-HIGH": (" <doi:", "?x=1>"), "3-MEDIUM": ("", " and more"), "4-NOT SPECIFIED": ('"HTTP://DX.DOI.ORG/', '#a"')}
    raw = level
    for name, (before, after) in forms.items():
        raw = F.when(level == name, F.concat(F.lit(before), d, F.lit(after))).otherwise(raw)
    return a.table(spark, sf_dir, "orders").select("o_orderkey", raw.alias("raw"))


@_registered(f"SELECT o_orderkey, CASE WHEN o_p THEN d END AS doi FROM (SELECT *, contains(raw, d) AS o_p FROM ({_MESSY}))")
def doi_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 over DOIs as users write them."""
    return _messy(spark, sf_dir).select("o_orderkey", text.clean_doi(F.col("raw")).alias("doi"))


@_registered(f"SELECT o_orderkey, CASE WHEN contains(p, '/') THEN split_part(p, '/', 1) ELSE '' END AS prefix FROM (SELECT o_orderkey, regexp_replace(raw, '^https://doi\\.org/', '') AS p FROM ({_MESSY}))")
def doi_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X10, X12."""
    return _messy(spark, sf_dir).select("o_orderkey", text.doi_prefix(text.doi_of_url(F.col("raw"))).alias("prefix"))


@_registered("SELECT conv_id, turn, trim(unnest(string_split(trim(text), '. '))) AS part FROM conversations WHERE trim(text) <> ''" .join(["SELECT * FROM (", ") WHERE part <> ''"]))
def author_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F5, P7."""
    rows = a.table(spark, sf_dir, "conversations").where(F.trim("text") != "")
    return rows.select("conv_id", "turn", F.explode(text.authors_of(F.col("text"), ". ")).alias("part"))


@_registered(
    """SELECT c_name, trim(x) = upper(x) AND upper(x) <> lower(x) AND length(x) <= 5 AS acronym FROM (SELECT c_name, replace(replace(c_mktsegment[1:5], '.', ''), '-', '') AS x FROM customer)"""
)
def acronyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4 over the heads of market segments."""
    return a.table(spark, sf_dir, "customer").select("c_name", text.is_likely_acronym(F.substring("c_mktsegment", 1, 5)).alias("acronym"))


@_registered(
    """SELECT DISTINCT word, trim(x) = upper(x) AND upper(x) <> lower(x) AND length(x) <= 5 AS acronym FROM (
  SELECT word, replace(replace(word, '.', ''), '-', '') AS x FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents))"""
)
def acronyms_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4 over whole values: the words of documents as spaces part them, short and long ones."""
    words = a.table(spark, sf_dir, "documents").select(F.explode(F.split("text", " ")).alias("word")).distinct()
    return words.select("word", text.is_likely_acronym(F.col("word")).alias("acronym"))


_WORDS = "SELECT DISTINCT p_name AS a, p_type AS b FROM part"


@_registered(f"SELECT a, b, round(jaro_winkler_similarity(lower(a), lower(b)), 9) AS score FROM ({_WORDS})")
def jaro_winkler_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8 over names and types of parts."""
    rows = a.table(spark, sf_dir, "part").select(F.col("p_name").alias("a"), F.col("p_type").alias("b")).distinct()
    return rows.select("a", "b", F.round(similarity.jaro_winkler_udf(F.lower("a"), F.lower("b")), 9).alias("score"))


@_registered(
    """SELECT DISTINCT a, b, jl >= 0.85 AND (jl >= 0.95 OR CASE WHEN length(f1) = 1 OR length(f2) = 1 THEN f1[1] = f2[1] ELSE jf >= 0.85 END) AS similar FROM (
  SELECT a, b, split_part(a, ' ', 1) AS f1, split_part(b, ' ', 1) AS f2, jaro_winkler_similarity(split_part(a, ' ', 2), split_part(b, ' ', 2)) AS jl,
    jaro_winkler_similarity(split_part(a, ' ', 1), split_part(b, ' ', 1)) AS jf
  FROM (SELECT p_name AS a, lead(p_name) OVER (PARTITION BY p_brand ORDER BY p_partkey) AS b FROM part) WHERE b IS NOT NULL)"""
)
def name_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6, F7, F9 over neighbouring parts of a brand."""
    from pyspark.sql import Window

    ahead = F.lead("p_name").over(Window.partitionBy("p_brand").orderBy("p_partkey"))
    rows = a.table(spark, sf_dir, "part").select(F.col("p_name").alias("a"), ahead.alias("b")).where("b is not null").distinct()
    return rows.select("a", "b", names.names_similar_column(F.col("a"), F.col("b"), "first_last", "first_last", 0.85).alias("similar"))


@_registered()
def partial_ratio_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F10 over part and type names; DuckDB has no such function."""
    rows = a.table(spark, sf_dir, "part").select(F.col("p_name").alias("a"), F.col("p_type").alias("b")).distinct()
    return rows.select("a", "b", F.round(similarity.partial_ratio_udf(F.lower("a"), F.lower("b")), 9).alias("score"))


@_registered(
    """SELECT p_partkey, jaro_winkler_similarity(split_part(p_name, ' ', 2), split_part(p_name, ' ', 2)) >= 0.85 AS same,
  trim(regexp_replace(lower(p_type || ' & ' || p_brand), '[^\\w\\s]', '', 'g')) AS key FROM part"""
)
def sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """2.9: the registered functions inside a SQL text with named parameters."""
    from ..functions.register import register_all

    register_all(spark)
    return spark.sql(
        "SELECT p_partkey, are_names_similar_udf(p_name, p_name, 'first_last', 'first_last', :least) AS same, normalize_affiliation_udf(p_type || ' & ' || p_brand) AS key FROM {part}",
        args={"least": 0.85}, part=a.table(spark, sf_dir, "part"),
    )


# --- building and profiling ----------------------------------------------------------------------------------------------


@_registered(a.REFS_SQL + " SELECT * FROM refs")
def build_author_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2, P2-P5."""
    return a.references(spark, sf_dir)


@_registered(
    "WITH " + a.STAGED_SQL + """ SELECT 'Invalid or missing required fields' AS error_message, work_id || ',' || coalesce(doi, '') || ',' || coalesce(author_name, '') AS row_content
  FROM staged WHERE work_id IN ('', 'null') OR author_name = ''"""
)
def import_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rejected rows (the log of a build keeps 100)."""
    return build.rejects(a.staged(spark, sf_dir))


@_registered(
    "WITH " + a.STAGED_SQL + """ SELECT count(*) AS staged, count(*) FILTER (WHERE work_id NOT IN ('', 'null') AND author_name <> '') AS imported,
  count(*) FILTER (WHERE work_id IN ('', 'null') OR author_name = '') AS rejected FROM staged"""
)
def import_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2."""
    return build.counts(a.staged(spark, sf_dir))


@_registered(
    a.REFS_SQL + """ SELECT count(*) AS total_rows, count(DISTINCT work_id) AS unique_works, count(DISTINCT doi) AS unique_dois, count(DISTINCT normalized_author_name) AS unique_authors,
  count(DISTINCT normalized_affiliation_key) AS unique_affiliations, count(doi) AS rows_with_doi, count(affiliation_ror) AS rows_with_ror FROM refs"""
)
def profile_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C3, A3."""
    return build.profile(a.references(spark, sf_dir))


@_registered(
    a.REFS_SQL + """, n AS (SELECT count(*) AS n, count(*) - count(work_id) AS w, count(*) - count(doi) AS d, count(*) - count(author_sequence) AS s FROM refs)
  SELECT column_name, nulls, round(nulls * 100.0 / n, 4)::DOUBLE AS percent FROM (
    SELECT 'work_id' AS column_name, w AS nulls, n FROM n UNION ALL SELECT 'doi', d, n FROM n UNION ALL SELECT 'author_sequence', s, n FROM n)"""
)
def null_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4, A5."""
    return build.null_checks(a.references(spark, sf_dir), ["work_id", "doi", "author_sequence"])


# --- linkage, discovery, search ------------------------------------------------------------------------------------------

_ALL = a.REFS_SQL + a.USER_SQL


def _linkage(spark: SparkSession, sf_dir: str, references: DataFrame) -> DataFrame:
    inputs = linkage.input_authors(a.user_table(spark, sf_dir), "authors", ";", "doi", "work_id")
    return linkage.link_authors(inputs, references, a.ORGANIZATIONS, "last_comma_first", "first_last")


def _known(spark: SparkSession, sf_dir: str) -> DataFrame:
    return works.input_ids(a.user_table(spark, sf_dir), "doi", "work_id")


@_registered(_ALL + " SELECT * FROM linkage")
def link_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C5, J1, P11."""
    return _linkage(spark, sf_dir, a.references(spark, sf_dir))


@_registered(_ALL + " SELECT * FROM linkage")
def linkage_export_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7, O2."""
    return sinks.export_order(_linkage(spark, sf_dir, a.references(spark, sf_dir)))


@_registered(_ALL + " SELECT DISTINCT doi, work_id FROM users")
def input_ids_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw ids."""
    return _known(spark, sf_dir)


@_registered(_ALL + " SELECT * FROM unknown")
def exclude_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw ids exclude, so DOIs given as URLs do not."""
    return discovery.exclude_known(a.references(spark, sf_dir), _known(spark, sf_dir)).select(*a.references(spark, sf_dir).columns)


def _by_affiliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    references = a.references(spark, sf_dir)
    return discovery.discover_by_affiliation(_linkage(spark, sf_dir, references), references, _known(spark, sf_dir))


def _by_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = spark.createDataFrame(a.ENTITIES, "entity_key string, source_affiliations string")
    return discovery.discover_by_entities(keys, a.references(spark, sf_dir), a.ENTITY_ORGANIZATIONS, _known(spark, sf_dir))


@_registered(_ALL + " SELECT * FROM discovered")
def discover_affiliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C6, J2, J3."""
    return _by_affiliation(spark, sf_dir)


@_registered(_ALL + " SELECT * FROM by_entity")
def discover_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C9, J5, J6."""
    return _by_entity(spark, sf_dir)


def _both_kinds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both discoveries from one table, as a run has it: it is built once, and known works leave it once."""
    from .file_queries import scratch

    references = works.references(spark, sinks.write_references(a.references(spark, sf_dir), scratch(spark)))
    eligible = discovery.exclude_known(references, _known(spark, sf_dir))
    keys = spark.createDataFrame(a.ENTITIES, "entity_key string, source_affiliations string")
    by_affiliation = discovery.discover_by_affiliation(_linkage(spark, sf_dir, references), eligible, None)
    return by_affiliation, discovery.discover_by_entities(keys, eligible, a.ENTITY_ORGANIZATIONS, None)


@_registered(_ALL + " SELECT * FROM combined")
def combine_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C10, U1, W1."""
    return discovery.combine(*_both_kinds(spark, sf_dir), both=True)


@_registered(_ALL + " SELECT * FROM combined")
def combine_priority_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 as a row number."""
    return discovery.combine_by_row_number(*_both_kinds(spark, sf_dir))


@_registered(_ALL + " SELECT match_type, count(DISTINCT coalesce(work_id, doi)) AS work_count FROM combined GROUP BY 1")
def match_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7."""
    return discovery.match_counts(combine_priority(spark, sf_dir))


@_registered(_ALL + " SELECT DISTINCT discovered_work_id AS work_id, discovered_doi AS doi FROM (SELECT discovered_work_id, discovered_doi FROM discovered UNION ALL SELECT discovered_work_id, discovered_doi FROM by_entity)")
def discovered_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U2."""
    return discovery.discovered_ids(*_both_kinds(spark, sf_dir))


@_registered(
    _ALL + """ SELECT normalized_affiliation_name, min(affiliation_name) AS source_affiliation FROM refs
  WHERE normalized_affiliation_name IN (SELECT ref_affiliation FROM linkage WHERE linkage_status = 'org_match_found') GROUP BY 1"""
)
def original_affiliations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6."""
    references = a.references(spark, sf_dir)
    return entities.original_affiliations(_linkage(spark, sf_dir, references), references)


def _entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.extract_entities(original_affiliations(spark, sf_dir))


@_registered()
def entity_mappings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By the rule-based extractor, which has no SQL form."""
    return entities.entity_mappings(_entities(spark, sf_dir))


@_registered()
def entity_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C8, J7, A11, A12."""
    return entities.entity_keys(_entities(spark, sf_dir), ["Supplier#000000007 Institute", "Institute of Physics"], threshold=85.0)


SEARCH_SQL = _ALL + """ SELECT t AS input_search_term, r.work_id AS ref_work_id, r.doi AS ref_doi, r.author_name AS ref_author_name, r.normalized_affiliation_name AS ref_affiliation,
  r.normalized_affiliation_key AS ref_affiliation_normalized_key
  FROM (SELECT upper(s_name) || ' Institute; unit ' || 'BRAND#13' AS t, lower(replace(s_name, '#', '')) || ' institute unit brand13' AS k FROM supplier) JOIN refs r ON r.normalized_affiliation_key = k"""


@_registered(SEARCH_SQL)
def search_affiliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One search term per supplier."""
    terms = a.table(spark, sf_dir, "supplier").select(F.concat(F.upper("s_name"), F.lit(" Institute; unit BRAND#13")).alias("t"))
    return search.search_affiliations(terms, "t", a.references(spark, sf_dir))


def _all() -> dict[str, tuple[Query, str | None]]:
    from . import file_queries

    return _FOUND | file_queries.FOUND


def queries() -> dict[str, Query]:
    return {name: query for name, (query, _) in _all().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _all().items() if sql}
