"""Every registered query against its check SQL."""

import pytest

from threatlake.plans.catalog import CHECKS, QUERIES

check = pytest.importorskip("check")
pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def con(sf):
    return check.connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf, name):
    good, note = check.compare(spark, con, name, QUERIES[name], CHECKS.get(name), sf)
    assert good, note


def test_every_query_has_a_check():
    assert set(CHECKS) == set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
