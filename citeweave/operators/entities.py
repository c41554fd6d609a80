"""Organization names inside affiliations (C7, C8: A6, A10-A12, J7, K10)."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..functions.similarity import partial_ratio_udf
from .linkage import ORG_MATCH

MIN_LENGTH = 15
#: Last words of institution names.
NOUNS = (
    "Academy", "Agency", "Centre", "Center", "Clinic", "College", "Department", "Faculty", "Foundation", "Hospital", "Institut", "Institute", "Laboratory",
    "Laboratories", "School", "Society", "Universidad", "Universität", "Université", "University",
)
_SPAN = re.compile(r"(?:[A-ZÀ-Þ][\w'#-]*\s+(?:(?:of|for|and|the|de|der|für)\s+)*)*(?:" + "|".join(NOUNS) + r")\b(?:\s+(?:of|for|de|der|für)\s+(?:the\s+)?[A-ZÀ-Þ][\w'#-]*(?:\s+(?:and\s+)?[A-ZÀ-Þ][\w'#-]*)*)?")

Extractor = Callable[[list[str]], list[list[str]]]


def by_rules(texts: list[str]) -> list[list[str]]:
    """Capitalized spans around an institution noun."""
    return [[m.group(0) for m in _SPAN.finditer(t)] for t in texts]


def no_entities(texts: list[str]) -> list[list[str]]:
    """What the reference gives where its model is not there."""
    return [[] for _ in texts]


def original_affiliations(linkage: DataFrame, references: DataFrame) -> DataFrame:
    """For each organization-matched affiliation, one spelling of it (the least; the reference takes any)."""
    wanted = linkage.where((F.col("linkage_status") == ORG_MATCH) & (F.col("ref_affiliation") != "")).select(F.col("ref_affiliation").alias("normalized_affiliation_name")).distinct()
    rows = references.where("affiliation_name is not null").join(wanted, "normalized_affiliation_name", "left_semi")
    return rows.groupBy("normalized_affiliation_name").agg(F.min("affiliation_name").alias("source_affiliation"))


def extract_entities(affiliations: DataFrame, extractor: Extractor = by_rules, prepare: Callable[[], Extractor] | None = None) -> DataFrame:
    """source_affiliation, pos, entity_text of each distinct affiliation; ``prepare`` loads a model once per task."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find = prepare() if prepare else extractor
        for frame in frames:
            found = find(frame["source_affiliation"].tolist())
            rows = [(a, i, e) for a, entities in zip(frame["source_affiliation"], found, strict=True) for i, e in enumerate(entities)]
            yield pd.DataFrame(rows, columns=["source_affiliation", "pos", "entity_text"])

    spellings = affiliations.where("source_affiliation <> ''").select("source_affiliation").distinct()
    return spellings.mapInPandas(run, "source_affiliation string, pos int, entity_text string")


def entity_mappings(entities: DataFrame) -> DataFrame:
    """Per affiliation its entities in order, joined by "; ", repeats kept."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct("pos", "entity_text"))), lambda e: e["entity_text"])
    return entities.groupBy("source_affiliation").agg(F.array_join(listed, "; ").alias("extracted_entities"))


def score_entities(entities: DataFrame, organizations: Sequence[str]) -> DataFrame:
    """Distinct entity_text, matched_org, score.

    Organizations are a given list: each entity row is exploded over it, so the work stays with the entities' tasks.
    """
    names = F.array(*(F.lit(o) for o in organizations)) if organizations else F.array().cast("array<string>")
    pairs = entities.select("entity_text").distinct().select("entity_text", F.explode(names).alias("matched_org"))
    return pairs.withColumn("score", partial_ratio_udf("entity_text", "matched_org"))


def best_matches(scored: DataFrame, threshold: float) -> DataFrame:
    """The best organization of each entity over the threshold (a fraction); ties go to the least name."""
    best = F.min(F.struct((-F.col("score")).alias("s"), F.col("matched_org").alias("o")))
    return scored.where(F.col("score") > threshold).groupBy("entity_text").agg(best.alias("b")).select("entity_text", F.col("b.o").alias("matched_org"), (-F.col("b.s")).alias("score"))


def entity_keys(entities: DataFrame, organizations: Sequence[str], threshold: float = 85.0) -> DataFrame:
    """entity_key and its first source affiliation.

    Acronyms and what is short, as written or normalized, go before scores are made; the score must be over, not at, the
    threshold (a percentage).  Of entities with one normalized form, the last by text gives the source.
    """
    word = F.col("entity_text")
    long = ~text.is_likely_acronym(word) & (F.char_length(word) > MIN_LENGTH) & (F.char_length(text.normalized(word)) > MIN_LENGTH)
    kept = entities.where(long)
    valid = best_matches(score_entities(kept, organizations), threshold / 100).select("entity_text")
    sources = kept.join(valid, "entity_text", "left_semi").groupBy("entity_text").agg(F.min("source_affiliation").alias("source"))
    return sources.groupBy(text.normalized(word).alias("entity_key")).agg(F.max_by("source", "entity_text").alias("source_affiliations"))


def empty_keys(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "entity_key string, source_affiliations string")
