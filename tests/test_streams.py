"""The stream queries over a table that is a folder of files."""

import os

import pytest

from threatlake.plans.catalog import QUERIES


@pytest.mark.parametrize("name", ["stream_daily_counts", "stream_first_seen", "stream_upsert"])
def test_folder_equals_file(spark, sf, tmp_path, name):
    for table in ("events", "customer"):
        spark.read.parquet(f"{sf}/{table}.parquet").repartition(3).write.parquet(f"{tmp_path}/{table}.parquet")
    assert os.path.isdir(tmp_path / "events.parquet")
    got, want = (sorted(map(tuple, QUERIES[name](spark, folder).collect())) for folder in (str(tmp_path), sf))
    assert got == want and want


def test_late_and_kept_rows_are_the_input(spark, sf):
    rows = QUERIES["stream_late_rows"](spark, sf).collect()
    assert sum(r.count_downloaded for r in rows) == spark.read.parquet(f"{sf}/events.parquet").count()
    assert {r.late for r in rows} == {False, True}
