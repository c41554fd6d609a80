"""Runs registered queries and their SQL side by side."""

from __future__ import annotations

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows_of(df) -> tuple[list[str], list[tuple]]:
    columns = sorted(df.columns)
    return columns, sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def duck_rows(sf: str, sql: str) -> tuple[list[str], list[tuple]]:
    with duckdb.connect() as con:
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
        found = con.execute(sql)
        names = [d[0] for d in found.description]
        columns = sorted(names)
        return columns, sorted((tuple(dict(zip(names, r, strict=True))[c] for c in columns) for r in found.fetchall()), key=repr)
