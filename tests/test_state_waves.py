"""Increments that go to the statement store in waves."""

import datetime as dt
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from threatlake.operators import state
from threatlake.schema import STATEMENT
from threatlake.session import shared_dir


def statements(spark, rows):
    day = dt.date(2024, 1, 1)
    return spark.createDataFrame([(f"u{i}", "T", "p", str(v), None, "s", None, day, None) for i, v in rows], STATEMENT)


def files_under(*folders):
    """Files by path, with their bytes."""
    return {f"{d}/{f}": os.path.getsize(f"{d}/{f}") for folder in folders for d, _, names in os.walk(folder) for f in names}


def test_an_upsert_leaves_the_store_only(spark, tmp_path, monkeypatch):
    """What is staged and shuffled for an increment goes with it, and a stored statement takes few bytes."""
    monkeypatch.setattr(state, "WAVE_ROWS", 6000, raising=False)
    root, shared = str(tmp_path / "state"), shared_dir(spark)
    local = list(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs())

    def kept():
        shuffled = {f: n for f, n in files_under(*[str(d) for d in local]).items() if "shuffle_" in f}
        return {f for f in os.listdir(shared) if f.startswith("fresh-")}, shuffled

    rows, before = statements(spark, [(i, i) for i in range(20_000)]), kept()
    state.upsert(spark, root, "", rows.where("value % 4 = 0"), 8)
    new = state.upsert(spark, root, "1", rows.unionByName(rows), 8)
    after = kept()
    assert new.count() == 15_000
    assert state.read_state(spark, root).count() == 20_000 == state.read_state(spark, root).distinct().count()
    assert after[0] <= before[0]
    assert sum(n for f, n in after[1].items() if f not in before[1]) < 100_000
    stored = {f: n for f, n in files_under(root).items() if f.endswith(".parquet")}
    assert sum(stored.values()) < 30 * 20_000
    assert len(stored) == 16  # eight buckets of two increments, each written by one wave


def test_statements_that_share_an_id_are_all_kept(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(state, "statement_id", lambda: F.lit(7).cast("bigint"))
    day, root = dt.date(2024, 1, 1), str(tmp_path / "state")
    rows = [("u", "T", "p", value, link, "s", publisher, day, seen) for value, link in (("x", None), (None, "x"), ("x", "x"), (None, None)) for publisher in (None, "p") for seen in (None, day)]
    state.upsert(spark, root, "", spark.createDataFrame(rows[:5] * 2, STATEMENT), 4)
    new = state.upsert(spark, root, "1", spark.createDataFrame(rows * 2, STATEMENT), 4)
    assert Counter(map(tuple, new.collect())) == Counter(rows[5:])
    assert Counter(map(tuple, state.read_state(spark, root).collect())) == Counter(rows)


def test_an_increment_that_stops_between_waves_is_made_again(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(state, "WAVE_ROWS", 10, raising=False)
    root, shared, waves = str(tmp_path / "state"), shared_dir(spark), []
    state.upsert(spark, root, "", statements(spark, [(i, i) for i in range(50)]), 8)
    before, deal = set(os.listdir(shared)), state.distinct_rows

    def stops(df, *keys):
        waves.append(df)
        if len(waves) == 3:
            raise RuntimeError("stopped")
        return deal(df, *keys)

    more = statements(spark, [(i, i) for i in range(40, 90)])
    with monkeypatch.context() as m:
        m.setattr(state, "distinct_rows", stops)
        with pytest.raises(RuntimeError, match="stopped"):
            state.upsert(spark, root, "1", more, 8)
    assert len(state.increments(spark, root)) == 1 and state.read_state(spark, root).count() == 50
    assert not {f for f in set(os.listdir(shared)) - before if f.startswith("fresh-")}
    assert state.upsert(spark, root, "1", more, 8).count() == 40
    assert state.read_state(spark, root).count() == 90 == state.read_state(spark, root).distinct().count()
