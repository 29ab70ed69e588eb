"""Every registered query against its SQL on DuckDB."""

from __future__ import annotations

import oracle
import pytest

from shelfmark.plans import catalog


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_matches_sql(spark, sf_dir, con, name):
    result = catalog.QUERIES[name](spark, sf_dir)
    rows, difference = oracle.compare(result, con, catalog.ORACLE[name])
    assert difference is None
    assert rows > 0
    plan = oracle.plan_of(result)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE)))
def test_runs(spark, sf_dir, name):
    assert catalog.QUERIES[name](spark, sf_dir).count() > 0


def test_every_oracle_has_a_query():
    assert set(catalog.ORACLE) <= set(catalog.QUERIES)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.queries()) >= set(entry.oracle_sql())
