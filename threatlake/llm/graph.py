"""Connected components of any size, by alternating star contractions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Edges ``a, b`` to ``node, component``: the smallest node reachable, for every node that has an edge.

    A round joins every node's larger neighbours, then its smaller ones, to the smallest
    node next to it. A node of any degree is aggregated before the shuffle; the join back is a
    skewed join that adaptive execution splits. Rounds end when the edges no longer change,
    which is after about the logarithm of the longest path; each round is written to the shared folder.
    """
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    held, before = cut_lineage(pairs), None
    for _ in range(max_rounds):
        both = held.unionByName(held.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        held = cut_lineage(small.unionByName(down.select("u", F.col("m").alias("v"))).distinct())
        now = held.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components not found in {max_rounds} rounds")
    star = held.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return star.unionByName(star.select(F.col("component").alias("node"), "component").distinct())


def hook(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the trees of ``a[i]`` and ``b[i]`` in ``root``, which holds a root for every place."""
    while len(a):
        ra, rb = root[a], root[b]
        differ = ra != rb
        if not differ.any():
            return
        a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root[:] = up
