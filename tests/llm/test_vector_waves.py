"""Tiles of vectors go out in waves, each tile once."""

import random

from threatlake.llm import vectors


def test_waves_have_every_tile_once_and_are_bounded():
    rng = random.Random(3)
    blocks = {k: rng.choice([1, 1, 2, 3, 40]) for k in range(12)}
    meet = [(i, j) for i in blocks for j in blocks if i <= j and (i == j or rng.random() < 0.7)]
    every = sorted((i, p, j, q) for i, j in meet for p in range(blocks[i]) for q in range(blocks[j]) if i < j or p <= q)
    for share in (0, 0.5, 4, 1e9):
        waves = vectors.waves_of(meet, blocks, share)
        got = [(i, p, j, q) for w in waves for i, j, a, z, bj in w for p in range(a, z + 1) for q in range(bj) if i < j or p <= q]
        assert sorted(got) == every
        room = max(share * sum(blocks.values()), 2 * max(blocks.values()))
        assert all(sum(2 * (z - a + 1) * bj for _, _, a, z, bj in w) <= room for w in waves)
    assert vectors.waves_of([], {}, 4) == []


def test_waves_link_the_same(spark, tmp_path):
    rng = random.Random(7)
    base = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(60)]
    rows = [(k, [x + rng.gauss(0, 0.15) for x in base[k % 60]]) for k in range(240)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = sorted(map(tuple, vectors.near_duplicates(df, block=4096).collect()))
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    assert sorted(map(tuple, vectors.near_duplicates(df, block=30, max_cells=4, share=1).collect())) == want
    assert any(r[1] for r in want) and spark.conf.get(name, None) == before


def test_no_vector_gives_no_row(spark):
    df = spark.createDataFrame([(1, None)], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in vectors.near_duplicates(df).collect()] == [(1, 0, 1, True)]
    assert vectors.near_duplicates(df.limit(0)).collect() == []
