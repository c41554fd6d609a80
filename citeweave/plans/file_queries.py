"""Registered queries that go through files: scans and sinks, round trips, the entry points, a stream."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import build, discovery, extract, normalize
from ..sources import sinks, works
from ..streaming.extract import stream_fields
from . import adapter as a
from . import config, pipeline, queries

Query = Callable[[SparkSession, str], DataFrame]
FOUND: dict[str, tuple[Query, str | None]] = {}
_OWN: dict[str, str] = {}


def _registered(sql: str | None = None) -> Callable[[Query], Query]:
    def keep(query: Query) -> Query:
        FOUND[query.__name__] = (query, sql)
        return query

    return keep


def scratch(spark: SparkSession) -> str:
    """A folder of one call's own where all executors can read; in the temporary folder where the session names none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = _OWN.setdefault("here", "file://" + tempfile.mkdtemp(prefix="citeweave-"))
    return f"{named.rstrip('/')}/queries-{uuid.uuid4().hex}"


# --- works known by their DOI --------------------------------------------------------------------------------------------

_DOI_SQL = "WITH " + a.STAGED_SQL + """,
heads AS (SELECT '10.' || (1000 + k % 9) || '/Ord.' || k AS doi, (k % 5)::VARCHAR AS member_id, CASE WHEN k % 3 = 0 THEN 'P' || (k % 9) ELSE '10.' || (1000 + k % 9) END AS doi_prefix, *
  FROM lines WHERE k % 10 <> 0 AND k % 7 <> 0),
works AS (SELECT DISTINCT doi, member_id, doi_prefix, k FROM heads),
eav AS (
  SELECT doi, 'author.family' AS field_name, 'author[' || n || '].family' AS subfield_path, name AS value, member_id, doi_prefix FROM heads
  UNION ALL SELECT doi, 'author.affiliation.name', 'author[' || n || '].affiliation[0].name', affiliation, member_id, doi_prefix FROM heads
  UNION ALL SELECT doi, 'title', 'title[0]', 'Order ' || k, member_id, doi_prefix FROM works
  UNION ALL SELECT doi, 'relation.cites', 'relation.cites', '[{"id":"W' || k || '","n":' || k || '}]', member_id, doi_prefix FROM works
  UNION ALL SELECT doi, 'relation.*', 'relation.cites[0]', '{"id":"W' || k || '","n":' || k || '}', member_id, doi_prefix FROM works)"""
_DOI_FIELDS = "author.family, author.affiliation.name, title, relation.cites"


@_registered(_DOI_SQL + " SELECT * FROM eav")
def doi_extract_eav(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vocabulary of works known by their DOI; some have no field at all."""
    return extract.extract(a.doi_lines(spark, sf_dir), _DOI_FIELDS, extract.DOI)


@_registered(_DOI_SQL + " SELECT * FROM eav WHERE member_id = '3' AND doi_prefix = 'P6'")
def doi_extract_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One member and one prefix, which the prefix field names."""
    return extract.extract(a.doi_lines(spark, sf_dir), _DOI_FIELDS, extract.DOI, group="3", prefix="P6")


@_registered(
    "WITH " + a.STAGED_SQL + """ SELECT 'W' || k AS work_id, CASE WHEN k % 10 <> 0 THEN '10.' || (1000 + k % 9) || '/Ord.' || k ELSE '' END AS doi, n::INTEGER AS author_sequence, name AS author_name,
  lower(name) AS normalized_author_name, 0 AS affiliation_sequence, CASE WHEN n % 3 = 2 THEN '' ELSE affiliation END AS affiliation_name,
  CASE WHEN n % 3 = 2 THEN '' ELSE trim(regexp_replace(lower(affiliation), '[^\\w\\s]', '', 'g')) END AS normalized_affiliation_name, CASE WHEN n % 3 = 2 THEN '' ELSE ror END AS affiliation_ror FROM lines"""
)
def authors_without_affiliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third author has neither affiliation nor institution."""
    return normalize.normalize_works(extract.extract(a.work_lines(spark, sf_dir, bare=3), extract.PIPELINE_FIELDS))


# --- scans -----------------------------------------------------------------------------------------------------------------


def _written_lines(spark: SparkSession, sf_dir: str) -> str:
    """Compressed files of works, blank lines, broken lines and works without an id."""
    orders = a.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k")).distinct()
    faults = [(11, ""), (13, '{"id": "W'), (17, '{"doi": "10.1/x"}')]
    rows = a.work_lines(spark, sf_dir).select("line")
    for every, line in faults:
        rows = rows.union(orders.where(F.col("k") % every == 0).select(F.lit(line)))
    path = scratch(spark)
    rows.write.option("compression", "gzip").text(path)
    return path


@_registered(
    """WITH o AS (SELECT DISTINCT l_orderkey AS k FROM lineitem), c AS (SELECT count(*) AS usable, count(*) FILTER (WHERE k % 11 = 0) AS blank, count(*) FILTER (WHERE k % 13 = 0) AS broken,
  count(*) FILTER (WHERE k % 17 = 0) AS missing_key FROM o) SELECT usable + blank + broken + missing_key AS lines, blank, broken, missing_key, usable, 0::BIGINT AS files_failed FROM c"""
)
def file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the lines of all files below a folder are, and how many files could not be read."""
    path = _written_lines(spark, sf_dir)
    report = extract.line_report(works.read_lines(spark, path))
    names, none = ["lines", "blank", "broken", "missing_key", "usable", "files_failed"], F.lit(0).cast("long")
    files = works.file_counts(works.file_report(spark, path))
    rows = report.select(*names[:-1], none.alias("files_failed")).union(files.select(*(none.alias(c) for c in names[:-1]), "files_failed"))
    return rows.agg(*(F.sum(c).alias(c) for c in names))


@_registered(queries.EAV_SQL + " SELECT * EXCLUDE (source_file_path) FROM eav")
def stream_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """2.10: the extraction as a stream over the files."""
    path, out = _written_lines(spark, sf_dir), scratch(spark)
    stream_fields(spark, path, f"{out}/rows", f"{out}/state").awaitTermination()
    return spark.read.parquet(f"{out}/rows").drop("source_file_path")


@_registered("SELECT doc_id::VARCHAR AS doc_id, nullif(text, '') AS text, nullif(lang, '') AS lang FROM documents")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with quotes and newlines out to CSV and back; empty is NULL."""
    path = sinks.write_csv(a.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "text", "lang"), scratch(spark))
    return works.read_csv(spark, path)


@_registered("SELECT s_suppkey::VARCHAR AS s_suppkey, s_name FROM supplier")
def csv_splittable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV without newlines in values, read in splits."""
    path = sinks.write_csv(a.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("s_suppkey"), "s_name"), scratch(spark))
    return works.read_csv(spark, path, splittable=True)


@_registered(queries.EAV_SQL + " SELECT source_id AS organized_by, source_id, count(*) AS n FROM eav GROUP BY ALL")
def organized_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: one folder per source."""
    rows = extract.extract(a.work_lines(spark, sf_dir), extract.PIPELINE_FIELDS)
    return works.read_csv(spark, sinks.write_organized(rows, scratch(spark), "source_id", "gzip")).groupBy("organized_by", "source_id").agg(F.count(F.lit(1)).alias("n"))


# --- the entry points with files ---------------------------------------------------------------------------------------------


@_registered(a.REFS_SQL + " SELECT * FROM refs")
def clustered_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference table as written, clustered by work id."""
    path = scratch(spark)
    pipeline.build_table(spark, a.staged(spark, sf_dir), path)
    return works.references(spark, pipeline.cluster_copies(spark, path, ["work_id"])["work_id"])


@_registered(
    "WITH " + a.STAGED_SQL + """ SELECT 'Invalid or missing required fields' AS error_message, work_id || ',' || coalesce(doi, '') || ',' || coalesce(author_name, '') AS row_content
  FROM staged WHERE work_id IN ('', 'null') OR author_name = '' ORDER BY row_content LIMIT 5"""
)
def recent_import_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest errors of a build that logs all of them."""
    errors = build.import_errors(a.staged(spark, sf_dir), limit=2**31 - 1)
    return build.recent_errors(errors).where(F.col("timestamp") > "2020-01-01").drop("timestamp")


_CONFIG = {
    "input_columns": {"doi": "doi", "work_id": "work_id", "authors": "authors", "author_separator": ";"}, "input_name_style": "last_comma_first", "reference_name_style": "first_last",
    "organization_names": a.ORGANIZATIONS, "affiliation_search_columns": {"affiliation_name": "t"},
}


@_registered(
    a.REFS_SQL + a.USER_SQL + """ SELECT nullif(input_doi, '') AS input_doi, nullif(input_work_id, '') AS input_work_id, input_author_name, ref_author_name, nullif(ref_affiliation, '') AS ref_affiliation, linkage_status FROM linkage"""
)
def process_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's CSV in, the linkage file out and read back."""
    path = sinks.write_csv(a.user_table(spark, sf_dir), f"{scratch(spark)}/users.csv")
    out = f"{scratch(spark)}/out.csv"
    pipeline.process_file(spark, path, out, a.references(spark, sf_dir), config.from_dict(_CONFIG))
    return works.read_csv(spark, sinks.output_paths(out)["linkage"])


@_registered(queries.SEARCH_SQL)
def search_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search terms in a CSV, results in a CSV."""
    terms = a.table(spark, sf_dir, "supplier").select(F.concat(F.upper("s_name"), F.lit(" Institute; unit BRAND#13")).alias("t"))
    path = sinks.write_csv(terms, scratch(spark))
    return works.read_csv(spark, pipeline.search_file(spark, path, scratch(spark), a.references(spark, sf_dir), "t"))


@_registered(
    a.REFS_SQL + a.USER_SQL + """ SELECT * FROM by_entity b WHERE NOT EXISTS (SELECT 1 FROM discovered d WHERE d.discovered_doi = b.discovered_doi)
  AND NOT EXISTS (SELECT 1 FROM discovered d WHERE d.discovered_work_id = b.discovered_work_id)"""
)
def exclude_discovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Works that an earlier run's log names are left out."""
    found = queries.discover_affiliation(spark, sf_dir)
    log = works.discovered_log(spark, sinks.write_csv(found, scratch(spark)))
    log = log.select(F.col("discovered_doi").alias("doi"), F.col("discovered_work_id").alias("work_id"))
    keys = spark.createDataFrame(a.ENTITIES, "entity_key string, source_affiliations string")
    return discovery.discover_by_entities(keys, a.references(spark, sf_dir), a.ENTITY_ORGANIZATIONS, works.input_ids(a.user_table(spark, sf_dir), "doi", "work_id"), log)
