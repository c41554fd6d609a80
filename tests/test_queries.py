from __future__ import annotations

import pytest

from citeweave.plans import queries

from .oracle import duck_rows, rows_of


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, sf, name):
    assert rows_of(queries.queries()[name](spark, sf)) == duck_rows(sf, queries.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(queries.oracle_sql())))
def test_query_without_sql_gives_rows(spark, sf, name):
    assert queries.queries()[name](spark, sf).count() > 0


def test_entry_runs(spark, sf):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(queries.queries()) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_linkage_plans_without_nested_loops(spark, sf):
    for name in ("link_authors", "exclude_known", "discover_affiliation"):
        plan = queries.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_scans_read_only_needed_columns(spark, sf):
    plan = queries.queries()["import_counts"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan and "p_retailprice" not in plan
