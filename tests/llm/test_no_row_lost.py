"""Rows that share an id, and vectors of several lengths."""

import numpy as np

import brute
from threatlake.llm import mixing, simhash, vectors

A, B = "the quick brown fox jumps over the lazy dog by the river", "an entirely different sentence about trees and houses on hills"


def test_a_text_is_not_lost_with_its_id(spark):
    rows = [(3, A, "x"), (7, A, "x"), (7, B, "x"), (7, B, "x"), (9, B, "y"), (None, A, "z")]
    given = spark.createDataFrame(rows, "doc_id long, text string, _mark string")
    kept = simhash.deduplicated(given)
    assert kept.columns == given.columns
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted([(3, A, "x"), (7, B, "x"), (None, A, "z")], key=repr)
    again = spark.createDataFrame([(1, A, "b"), (1, A, "a")], "doc_id long, text string, _mark string")
    assert simhash.deduplicated(again).collect() == simhash.deduplicated(again.orderBy("_mark")).collect()  # one, always the same


def test_each_length_is_compared_by_itself(spark):
    rng = np.random.default_rng(11)
    rows = []
    for size, n in ((16, 120), (8, 40), (3, 7), (1, 4)):
        centres = rng.normal(size=(4, size))
        rows += [list(map(float, np.float32(centres[i % 4] + rng.normal(size=size) * 0.15))) for i in range(n)]
    rows += [rows[130]] * 3 + [[0.0] * 8, [], None]
    given = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<float>").repartition(4)
    want = {}
    for size in {len(v or []) for v in rows}:
        at = [i for i, v in enumerate(rows) if len(v or []) == size]
        for i, (n, r) in zip(at, brute.cosine_groups([rows[i] for i in at])):
            want[i] = (n, at[r], at[r] == i)
    for block, cells in ((4096, 1024), (16, 3)):
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(given, 0.9, block=block, max_cells=cells).collect()}
        assert got == want, (block, cells)
    assert want[161][0] >= 0 and any(n for i, (n, *_) in want.items() if 120 <= i < 160)


def test_mixing_shuffles_no_text(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plan = mixing.mixed(docs)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
