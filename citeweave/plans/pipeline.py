"""The four entry points (E1-E4): extract fields, build the reference table, process a user's file, search affiliations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import build, discovery, entities, extract, linkage, normalize, search, stats
from ..schemas import AFFILIATION_DISCOVERED, AUTHOR_AFFILIATIONS, ENTITY_DISCOVERED
from ..sources import sinks, works
from .config import Config, checked_column


def extract_fields(
    spark: SparkSession, folder: str, output: str, fields: str = extract.PIPELINE_FIELDS, flavour: extract.Flavour = extract.WORK, organize: bool = False,
    group: str | None = None, prefix: str | None = None, partitions: int | None = None,
) -> DataFrame | None:
    """Field rows of all works below a folder as CSV, or Parquet if ``output`` ends so; CSV per source or member if
    ``organize``.  Returns what was written.

    Without any file there is nothing to do and None comes back.
    """
    pattern = "*.gz" if flavour is extract.WORK else "*.jsonl.gz"
    lines = works.read_lines(spark, folder, pattern, partitions or works.partitions_for(works.files_below(spark, folder, pattern)))
    if lines.isEmpty():
        return None
    # the fields of the pipeline hold strings, which need no Python
    native = flavour is extract.WORK and set(extract.parse_fields(fields)) <= set(extract.parse_fields(extract.PIPELINE_FIELDS))
    rows = extract.extract_jvm(lines, fields, group, prefix) if native else extract.extract(lines, fields, flavour, group, prefix)
    if not organize:
        return works.read_table(spark, sinks.write_table(rows, output))
    sinks.write_organized(rows, output, "source_id" if flavour is extract.WORK else "member_id")
    return works.read_csv(spark, output).drop("organized_by")


def extraction_summary(rows: DataFrame) -> dict[str, DataFrame]:
    """What a summary of an extraction shows, from what was written: one pass for the totals, one for all counts."""
    group = "source_id" if "source_id" in rows.columns else "member_id"
    work = "work_id" if "work_id" in rows.columns else None
    counts = rows.groupBy("field_name", group, "doi_prefix").agg(F.count(F.lit(1)).alias("n")).persist(StorageLevel.DISK_ONLY)
    return {"totals": stats.totals(rows, work), "top_fields": stats.top_fields(counts), "groups": stats.group_table(counts, group), "prefixes": stats.rows_per(counts, "doi_prefix")}


def normalize_file(spark: SparkSession, path: str, output: str | None = None) -> str:
    """E2, first half: field rows to author x affiliation rows, each in CSV or Parquet as the names say."""
    rows = normalize.normalize_works(works.read_table(spark, path))
    return sinks.write_table(normalize.in_order(rows), output or sinks.processed_name(path))


def build_table(spark: SparkSession, source: str | DataFrame, output: str, cluster: bool = True, splittable: bool = False) -> dict[str, int]:
    """E2, second half: the validated reference table as Parquet in ``output/author_references``, and the first rejects
    in ``output/import_errors``.  The table is clustered by affiliation key, which replaces indexes.  ``splittable`` says
    that no value of the CSV holds a newline, so that many tasks can read one file; Parquet is read by many anyway."""
    staged = source
    if isinstance(source, str):
        staged = works.read_table(spark, source, True) if splittable or source.endswith(".parquet") else works.read_csv_or_plain(spark, source, AUTHOR_AFFILIATIONS.names)
    staged = staged.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sinks.write_references(build.build_references(staged), f"{output}/author_references", ["normalized_affiliation_key", "doi"] if cluster else None)
        build.import_errors(staged).write.mode("overwrite").parquet(f"{output}/import_errors")
        return build.counts(staged).first().asDict()
    finally:
        staged.unpersist()


INDEXES = {"work_id": "work_id", "doi": "doi", "norm_name": "normalized_author_name", "norm_affil": "normalized_affiliation_key", "ror": "affiliation_ror"}


def cluster_copies(spark: SparkSession, output: str, names: list[str]) -> dict[str, str]:
    """C4: for each index name a copy of the table clustered by that column."""
    chosen = list(INDEXES) if "all" in names else names
    table = works.references(spark, f"{output}/author_references")
    return {n: sinks.write_references(table, f"{output}/author_references_by_{n}", [INDEXES[n]]) for n in chosen}


def verify(spark: SparkSession, output: str, sample: int = 10) -> dict[str, DataFrame]:
    """C3."""
    table, errors = works.references(spark, f"{output}/author_references"), spark.read.parquet(f"{output}/import_errors")
    columns = spark.createDataFrame(table.dtypes, "column_name string, column_type string")
    return {"columns": columns, "profile": build.profile(table), "nulls": build.null_checks(table), "sample": build.sample_rows(table, sample), "errors": build.recent_errors(errors)}


class Processed:
    """E3's results as DataFrames."""

    def __init__(self, linked: DataFrame, mappings: DataFrame | None, by_affiliation: DataFrame, by_entity: DataFrame, kept: list[DataFrame]) -> None:
        self.linkage, self.mappings, self.by_affiliation, self.by_entity, self.kept = linked, mappings, by_affiliation, by_entity, kept

    def release(self) -> None:
        """Frees what ``process`` kept."""
        for rows in self.kept:
            rows.unpersist()

    @property
    def found(self) -> DataFrame:
        return discovery.combine(self.by_affiliation, self.by_entity)


def process(
    spark: SparkSession, user: DataFrame, references: DataFrame, config: Config, extractor: entities.Extractor = entities.no_entities,
    prepare: Callable[[], entities.Extractor] | None = None,
) -> Processed:
    """Linkage, entities and discovery for a user's table.

    Linkage and discoveries are read more than once and kept; an executor that is lost costs their recomputation.
    """
    for name in filter(None, (config.doi, config.work_id, config.authors)):
        checked_column(name, user.columns)
    known = works.input_ids(user, config.doi, config.work_id)
    if config.clean_exclusion_ids and config.doi:
        known = known.withColumn("doi", F.coalesce(text.clean_doi(F.col("doi")), "doi")).distinct()
    inputs = linkage.input_authors(user, config.authors, config.author_separator, config.doi, config.work_id)
    linked = linkage.link_authors(inputs, references, config.organization_names, config.input_name_style, config.reference_name_style, config.name_matching_threshold).persist()
    by_affiliation = discovery.discover_by_affiliation(linked, references, known, config.ignore_blank_affiliations).persist()
    kept = [linked, by_affiliation]
    mappings, by_entity = None, spark.createDataFrame([], ENTITY_DISCOVERED)
    if config.entity_extraction_enabled and config.organization_names:
        extracted = entities.extract_entities(entities.original_affiliations(linked, references), extractor, prepare).persist()
        kept.append(extracted)
        mappings = entities.entity_mappings(extracted)
        if config.use_entity_discovery:
            keys = entities.entity_keys(extracted, config.organization_names, config.entity_matching_threshold)
            by_entity = discovery.discover_by_entities(keys, references, config.organization_names, known, normalize_organizations=config.normalize_org_names).persist()
            kept.append(by_entity)
    return Processed(linked, mappings, by_affiliation, by_entity, kept)


def process_file(
    spark: SparkSession, path: str, output: str, references: DataFrame, config: Config, extractor: entities.Extractor = entities.no_entities, single: bool = False,
    prepare: Callable[[], entities.Extractor] | None = None,
) -> dict[str, int]:
    """E3 with files: writes the linkage, mappings and discovered works beside ``output`` and returns counts.

    Each result is a folder of files in order; ``single`` makes it one file, through one task.

    Discovered works and mappings are not written where there are none.
    """
    done = process(spark, works.read_csv(spark, path), references, config, extractor, prepare)
    paths = sinks.output_paths(output)
    sinks.write_csv(sinks.export_order(done.linkage), paths["linkage"], single)
    counts = {r["linkage_status"]: r["n"] for r in done.linkage.groupBy("linkage_status").agg(F.count(F.lit(1)).alias("n")).collect()}  # three statuses
    if done.mappings is not None and not done.mappings.isEmpty():
        sinks.write_csv(done.mappings, paths["entities"], single)
    found = done.found
    if not found.isEmpty():
        sinks.write_csv(discovery.export_works(found), paths["discovered"], single)
        counts |= {r["match_type"]: r["work_count"] for r in discovery.match_counts(found).collect()}  # two kinds
    done.release()
    return counts


def search_file(spark: SparkSession, path: str, output: str, references: DataFrame, column: str, single: bool = False) -> str:
    """E4."""
    terms = works.read_csv(spark, path)
    found = search.search_affiliations(terms, checked_column(column, terms.columns), references)
    return sinks.write_csv(search.search_order(found), output, single)


def empty_discoveries(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """U4."""
    return spark.createDataFrame([], AFFILIATION_DISCOVERED), spark.createDataFrame([], ENTITY_DISCOVERED)
