"""Centroid clustering on integers, with distances that are kept up to date rather than computed anew.

Each vector is stored with its exact integer dot products with all centroids. When centroids move, a product changes by the
vector's components where that centroid changed, times the change; the nearest centroid then follows from
|v|² - 2 v·c + |c|². All numbers are integers, so an updated product equals a fresh one. Vectors stay
in their partitions: a round reads and writes them once, and what meets is one row for each centroid and task.

Defined cases: vectors that are null, of another length, or hold null or non-finite components are left out, as are those with
a component beyond ``LIMIT`` after scaling, whose squared distances no long holds; a null id counts as the text ``null``; vectors of
one id start in the order of their components; equal vectors that are drawn are centroids that tie, and the first wins;
fewer vectors than centroids give fewer centroids; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import drop_path, release, slices

LIMIT = 1 << 27
ROWS = 4096  # rows that are multiplied at once


def integers(vectors: DataFrame, size: int, scale: int) -> DataFrame:
    """``vec_id, v`` of the vectors that are kept, in whole numbers."""
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * scale))
    fit = F.forall("embedding", lambda c: F.coalesce(F.abs(c.cast("double") * scale) < LIMIT, F.lit(False)))
    kept = vectors.where(F.coalesce(F.size("embedding") == size, F.lit(False))).where(fit)
    return kept.select("vec_id", F.transform(x, lambda c: c.cast("int")).alias("v"))


def seeds(held: DataFrame, k: int, seed: int) -> np.ndarray:
    """The first ``k`` vectors by the hash of seed and id."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))).cast("binary"), 256)
    return np.array([r["v"] for r in held.orderBy(hashed, "v").limit(k).select("v").collect()], np.int64)


def _matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(kind)


def updated(held: DataFrame, before: np.ndarray, after: np.ndarray) -> DataFrame:
    """``vec_id, v, dots, cluster, distance`` after the centroids moved; without ``dots`` they moved from zero."""
    has_dots, k, size = "dots" in held.columns, *after.shape
    moved = [(j, np.flatnonzero(after[j] != before[j])) for j in range(k)]
    norms = (after * after).sum(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, ROWS)):
            v = _matrix(batch.column(1), size, np.int64)
            dots = _matrix(batch.column(2), k, np.int64) if has_dots else np.zeros((len(v), k), np.int64)
            for j, at in moved:
                if len(at):
                    dots[:, j] += v[:, at] @ (after[j] - before[j])[at]
            far = (v * v).sum(axis=1)[:, None] - 2 * dots + norms
            nearest = far.argmin(axis=1)  # the first of equal ones
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(v) * k + 1, k, dtype=np.int32)), pa.array(dots.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), lists, pa.array(nearest.astype(np.int32)), pa.array(far[np.arange(len(v)), nearest])], names=["vec_id", "v", "dots", "cluster", "distance"])
        release()

    kind = held.schema["vec_id"].dataType.simpleString()
    return held.select("vec_id", "v", *(["dots"] if has_dots else [])).mapInArrow(run, f"vec_id {kind}, v array<int>, dots array<bigint>, cluster int, distance bigint")


def means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid's floored mean; centroids without vectors stay. The driver gets one row for each centroid."""
    sums = [F.sum(F.col("v")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(centroids.shape[1])]
    out = centroids.copy()
    for r in state.groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect():
        out[r["cluster"]] = [int(r[f"s{i}"]) // r["n"] for i in range(centroids.shape[1])]
    return out


def clustered(vectors: DataFrame, k: int = 16, rounds: int = 3, size: int = 64, scale: int = 64, seed: int = 1) -> tuple[DataFrame, np.ndarray]:
    """Each kept vector's ``vec_id, cluster, distance``, and the last centroids; ``vectors`` has vec_id and embedding."""
    spark = vectors.sparkSession

    def stored(df: DataFrame) -> tuple[DataFrame, str]:
        path = scratch_path(spark, "vectors")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path), path

    held, path = stored(integers(vectors, size, scale))
    after = seeds(held, k, seed).reshape(-1, size)
    before = np.zeros_like(after)
    for r in range(rounds + 1):
        if not len(after):
            return held.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance")).limit(0), after
        old, (held, path) = path, stored(updated(held, before, after))
        drop_path(spark, old)
        if r < rounds:
            before, after = after, means(held, after)
    return held.select("vec_id", "cluster", "distance"), after


def described(vectors: DataFrame, **options) -> DataFrame:
    """``clustered`` with each cluster's and the whole inertia and the centroid's digest."""
    found, centroids = clustered(vectors, **options)
    # One row for each cluster.
    parts = {r["cluster"]: int(r["d"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]

    def by_cluster(values: list, kind: str):
        return F.element_at(F.array(*[F.lit(x) for x in values]).cast(f"array<{kind}>"), F.col("cluster") + 1) if values else F.lit(None).cast(kind)

    return found.select(
        "vec_id", "cluster", "distance", by_cluster([parts.get(j, 0) for j in range(len(centroids))], "bigint").alias("cluster_inertia"),
        F.lit(sum(parts.values())).cast("bigint").alias("inertia"), by_cluster(digests, "string").alias("centroid_sha256"),
    )
