"""Clustering against fresh distances in Python's integers."""

import hashlib
import math
import random

from pyspark.sql import functions as F

from threatlake.llm import centroids


def plain(vectors, k, rounds, size, scale, seed):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in vectors if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    kept = [(i, v) for i, v in kept if all(-centroids.LIMIT <= x < centroids.LIMIT for x in v)]
    name = {None: "null"}
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{name.get(r[0], r[0])}".encode()).hexdigest(), r[1]))
    at = [v for _, v in order[:k]]
    for r in range(rounds + 1):
        near = [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(at)) for _, v in kept]
        if r < rounds:
            for j in range(len(at)):
                own = [v for (_, v), (_, n) in zip(kept, near) if n == j]
                at[j] = [sum(x) // len(own) for x in zip(*own)] if own else at[j]
    whole = sum(d for d, _ in near) if kept else 0
    return sorted([(i, j, d, sum(e for e, n in near if n == j), whole, hashlib.sha256(",".join(map(str, at[j])).encode()).hexdigest()) for (i, _), (d, j) in zip(kept, near)], key=repr)


def rows(df, **options):
    return sorted(map(tuple, centroids.described(df, **options).collect()), key=repr)


def test_equals_fresh_distances(spark):
    rng = random.Random(6)
    middles = [[rng.uniform(-1, 1) for _ in range(5)] for _ in range(4)]
    vectors = [(i, [x + rng.gauss(0, 0.3) for x in rng.choice(middles)]) for i in range(300)]
    vectors += [(400 + i, vectors[i][1]) for i in range(20)] + [vectors[0], vectors[0], (7, [0.5] * 5), (None, [0.25] * 5), (501, None), (502, []), (503, [1.0] * 4), (504, [1.0] * 6), (505, [None] + [1.0] * 4),
                (506, [float("nan")] * 5), (507, [float("inf")] * 5), (508, [1e30] * 5), (509, [1e6] * 5), (510, [-1e6] * 5), (511, [-0.0, 1e-9, -1e-9, 1 / 64, -1 / 64])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in vectors], "vec_id long, embedding array<double>, cluster string, v int").repartition(5)
    for k, rounds in ((6, 3), (1, 2), (3, 0), (400, 1)):
        options = dict(k=k, rounds=rounds, size=5, scale=64, seed=1)
        assert rows(df, **options) == plain(vectors, **options)
    few = df.where("vec_id < 3 and vec_id > 0")
    assert rows(few, size=5) == plain(vectors[1:3], k=16, rounds=3, size=5, scale=64, seed=1)
    assert rows(df.limit(0), size=5) == [] and centroids.described(df.limit(0), size=5).columns == centroids.described(few, size=5).columns


def test_only_changed_components_are_used(spark):
    """A product that is off stays off by the same amount where no component of its centroid changes."""
    import numpy as np

    held = spark.createDataFrame([(1, [2, 3], [100, 5])], "vec_id long, v array<int>, dots array<bigint>")
    before, after = np.array([[1, 1], [1, 1]]), np.array([[1, 1], [1, 4]])
    assert centroids.updated(held, before, after).head()["dots"] == [100, 5 + 3 * 3]
    assert centroids.updated(held.select("vec_id", "v"), np.zeros_like(after), after).select(F.col("dots")).head()[0] == [5, 14]
