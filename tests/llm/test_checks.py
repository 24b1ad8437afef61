"""Queries with a SQL form against DuckDB."""

import pytest

from threatlake.llm.queries import CHECKS, QUERIES

check = pytest.importorskip("check")
pytest.importorskip("duckdb")


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_check(spark, sf, name):
    good, note = check.compare(spark, check.connect(sf), name, QUERIES[name], CHECKS[name], sf)
    assert good, note


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
