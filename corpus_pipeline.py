"""The corpus pipeline: quality rules, near-dedup, decontamination, secret scan, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's result as Parquet in the
shared folder and reads it again for the next one.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.llm import decontaminate, near_dedup, packing, quality_rules, secret_scan
from citeweave.llm._store import Store, unused


def _counted(text: Column, before: Column, n_chars: Column) -> Column:
    """n_chars, counted again where the text was changed."""
    return F.when(text.eqNullSafe(before), n_chars).otherwise(F.char_length(text).cast("long"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or hold too little content go."""
    return quality_rules.keep(docs, quality_rules.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one of least doc_id."""
    name = unused("_kept", docs.columns)
    kept = near_dedup.link(docs).where("kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col(name)), "left_semi")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words inside benchmark windows are cut out of the texts."""
    before = unused("before", docs.columns)
    out = decontaminate.scan(docs.withColumn(before, F.col("text")), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), remove=True)
    names = {c: F.col(f"`_{c}`") for c in docs.columns} | {"doc_id": F.col("doc_id"), "text": F.col("text")}
    if "n_chars" in names:
        names["n_chars"] = _counted(F.col("text"), F.col(f"`_{before}`"), names["n_chars"])
    return out.select(*(names[c].alias(c) for c in docs.columns))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts."""
    before = unused("before", docs.columns)
    out = secret_scan.redact(docs.withColumn(before, F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", _counted(F.col("text"), F.col(f"`{before}`"), F.col("n_chars")))
    return out.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of 1024."""
    return packing.pack(docs, packing.Tokenizer.public())


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secrets),
    ("best_fit_packing", pack),
]

#: Fitted models and tokenisation have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Store(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = store.save(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
