"""One query ``opN_<name>`` per corpus operator, each over its whole table, and the SQL that DuckDB can hold against it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import substring_dedup

    out = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"), length=20)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import quality_rules

    docs = _table(spark, sf_dir, "documents")
    return quality_rules.judge(docs, quality_rules.fit(docs, _table(spark, sf_dir, "labels")))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import secret_scan

    return secret_scan.findings(_table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import decontaminate

    out = decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256)
    return out.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import packing

    return packing.pack(_table(spark, sf_dir, "documents"), packing.Tokenizer.public())


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import language_id

    docs = _table(spark, sf_dir, "documents")
    out = language_id.predict(docs, language_id.fit(docs))
    return out.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import chat_template

    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.sql("select -1L as conv_id, n as turn, r as role, '</s>[INST] ok [/INST]' as text from values (0L, 'user'), (1L, 'assistant') as t(n, r)")
    return chat_template.digests(chat_template.format_conversations(turns.unionByName(planted)))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import near_dedup

    return near_dedup.link(_table(spark, sf_dir, "documents"))


def op9_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import pu_quality

    docs = _table(spark, sf_dir, "documents")
    out = pu_quality.predict(docs, pu_quality.fit(docs, _table(spark, sf_dir, "labels")))
    return out.select("doc_id", pu_quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import sharding

    return sharding.assign(_table(spark, sf_dir, "documents"), sharding.uniform(40), grown=sharding.grow(sharding.uniform(40)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))


def oracle_sql() -> dict[str, str]:
    from . import oracles

    return oracles.oracle_sql()
