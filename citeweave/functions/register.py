"""The functions under the names that SQL texts use (2.9)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import names, similarity, text


@F.pandas_udf(T.BooleanType())
def are_names_similar_udf(a: pd.Series, b: pd.Series, style_a: pd.Series, style_b: pd.Series, threshold: pd.Series) -> pd.Series:
    rows = zip(a, b, style_a, style_b, threshold, strict=True)
    known: dict[tuple, bool] = {}
    return pd.Series([known[r] if r in known else known.setdefault(r, names.names_similar(*r)) for r in rows], dtype=bool)


@F.pandas_udf(T.StringType())
def normalize_affiliation_udf(values: pd.Series) -> pd.Series:
    return values.map(lambda x: None if x is None else text.normalize_query(x))


def register_all(spark: SparkSession) -> list[str]:
    """Registers the three functions for SQL; returns their names."""
    found = {"are_names_similar_udf": are_names_similar_udf, "partial_ratio_udf": similarity.partial_ratio_udf, "normalize_affiliation_udf": normalize_affiliation_udf}
    for name, function in found.items():
        spark.udf.register(name, function)
    return list(found)
