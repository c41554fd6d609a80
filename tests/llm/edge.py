"""Small tables with the cases that every corpus operator must have a result for."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, size string, slot string, n_words string, label string, spans string, row string, bucket string, _kept string, before string, _before string, _parts string, _row string"


def words(n: int, seed: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choices("abcdefgh", k=r.randint(2, 7))) for _ in range(n))


LONG = words(30_000, 1)
TEXTS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, words(40, 2)), (6, words(40, 2)), (7, words(200, 3)), (8, words(200, 3) + " tail end"), (9, LONG), (10, LONG + " x"),
    (11, "é 中文   ß"), (12, "a " * 500), (12, "a " * 500), (13, words(60, 4) + "\n" + words(60, 5)), (14, words(60, 5) + "\n" + words(60, 4)), (None, words(40, 2)), (15, "|" * 50),
]


def docs(spark, texts=TEXTS):
    """Documents with null columns and with columns named like those that the operators make."""
    rows = [(i, t, None if k % 3 else "en", None, None, "x", None, "y", "z", None, "s", "r", "b", "1", "2", "3", "4", "5") for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def none(spark):
    return spark.createDataFrame([], SCHEMA)
