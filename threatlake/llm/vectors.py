"""Near-duplicate vectors by cosine, from int8 tile products with error bounds.

Equal vectors are one class first. A unit vector x is held as a scale s, int8 steps q
and the exact length e of the rest x - s·q. For two of them |x·y - s·q·s'·q'| is at most
e' + e·|s'·q'|, so a pair whose int8 product lies further below the threshold than that
cannot be linked. The others are computed again in double precision.

Vectors are dealt to the nearest of ``max_cells`` pivots at most (a sample by hash, documented
and bounded; it decides only which tiles are skipped) and cells into blocks of ``block`` at most. Two
blocks meet in a tile unless the angle between their pivots, less both cells' widest
angles, is over the threshold's angle. A tile writes each vector's count of links and
the edges of a spanning forest, never the pairs. Blocks are sent to their tiles in waves of at most ``share``
times all vectors, and what a wave shuffled is removed before the next one, so disk follows the vectors though their
tiles are as many as the square; the time stays that of the tiles.

Each length has pivots, cells and tiles of its own, so vectors of different lengths never meet.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components link with nothing; those of
different lengths are not compared; equal rows are linked with each other; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, scratch_path
from .common import shuffles_removed
from .graph import connected_components, hook

_SLACK = 1e-9


def usable(column: str):
    """Whether a vector can be linked at all."""
    sound = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(sound & F.exists(column, lambda x: x != 0), F.lit(False))


def pivots_of(classes: DataFrame, block: int, max_cells: int) -> dict[int, np.ndarray]:
    """Each length's pivots, ``max_cells`` at most: as many as it has blocks, the first by hash."""
    sizes = classes.groupBy("dim").agg(F.least(F.lit(max_cells), F.ceil(F.count("*") / block)).alias("_cells"))
    by_hash = Window.partitionBy("dim").orderBy("key")
    # The constant bound is kept in each task before rows are shuffled; a length with most vectors is no large window.
    first = classes.select("dim", "key", "vector", F.row_number().over(by_hash).alias("_at")).where(F.col("_at") <= max_cells)
    held: dict[int, list[bytes]] = {}
    for r in first.join(sizes, "dim").where(F.col("_at") <= F.col("_cells")).orderBy("dim", "_at").select("dim", "vector").collect():
        held.setdefault(r["dim"], []).append(r["vector"])
    return {d: unit_rows(np.array([np.frombuffer(v, "<f8") for v in own])) for d, own in held.items()}


def waves_of(meet: list[tuple[int, int]], blocks: dict[int, int], share: float) -> list[list[tuple[int, int, int, int, int]]]:
    """The tiles of cells that meet in waves: ``(i, j, first, last, blocks of j)``, for these blocks of ``i`` and all of ``j``.

    A wave sends at most ``share`` times all blocks, or one block's tiles with one cell if these are more.
    """
    room = max(2, int(share * sum(blocks.values())))
    waves, left = [[]], room
    for i, j in meet:
        at = 0
        while at < blocks[i]:
            most = 2 * blocks[j]  # blocks that are sent for one block of i
            n = min(blocks[i] - at, max(left // most, 0 if waves[-1] else 1))
            if n == 0:
                waves.append([])
                left = room
                continue
            waves[-1].append((i, j, at, at + n - 1, blocks[j]))
            at, left = at + n, left - n * most
    return [w for w in waves if w]


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Int8 steps, scales and the exact lengths of what they leave out."""
    scale = np.abs(unit).max(axis=1) / 127
    steps = np.rint(unit / scale[:, None]).astype(np.int8)
    return steps, scale, np.linalg.norm(unit - steps * scale[:, None], axis=1)


def unit_rows(raw: np.ndarray) -> np.ndarray:
    """Rows over their lengths; first over their largest component, so that no square overflows."""
    top = raw / np.abs(raw).max(axis=1)[:, None]
    return top / np.linalg.norm(top, axis=1)[:, None]


def tile_links(a: np.ndarray, b: np.ndarray, threshold: float, same: bool, strip: int = 512, chunk: int = 1 << 15) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) of linked unit rows of ``a`` and ``b``; with ``same`` only i < j."""
    (qa, sa, ea), (qb, sb, eb) = quantised(a), quantised(b)
    hb = np.linalg.norm(qb * sb[:, None], axis=1)
    exact = np.float32 if 127 * 127 * a.shape[1] < 1 << 24 else np.float64  # holds the integer sums exactly
    columns = np.ascontiguousarray(qb.T.astype(exact))
    for at in range(0, len(a), strip):
        product = qa[at : at + strip].astype(exact) @ columns
        sizes, errors = sa[at : at + strip], ea[at : at + strip]
        least = ((threshold - _SLACK - eb)[None, :] - errors[:, None] * hb[None, :]) / sb[None, :]
        i, j = np.nonzero(product >= (least.min(axis=1) / sizes)[:, None] * (1 - 1e-6))
        keep = product[i, j] * sizes[i] >= least[i, j]
        i, j = i[keep] + at, j[keep]
        if same:
            i, j = i[i < j], j[i < j]
        for k in range(0, len(i), chunk):
            x, y = i[k : k + chunk], j[k : k + chunk]
            near = np.einsum("ij,ij->i", a[x], b[y]) >= threshold
            if near.any():
                yield x[near], y[near]


def _tile(group: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Both blocks of one tile to each vector's links and its root in the tile."""
    group = group.sort_values("side")
    keys = [np.frombuffer(k, "S16") for k in group["keys"]]
    units = [unit_rows(np.frombuffer(v, "<f8").reshape(len(k), -1)) for k, v in zip(keys, group["vectors"])]
    times = [np.frombuffer(t, "<i8") for t in group["times"]]
    same = len(units) == 1
    first, every = len(units[0]), sum(map(len, units))
    root, count = np.arange(every), np.zeros(every, np.int64)
    for i, j in tile_links(units[0], units[-1], threshold, same):
        other = j if same else j + first
        count += np.bincount(i, times[-1][j], every).astype(np.int64) + np.bincount(other, times[0][i], every).astype(np.int64)
        hook(root, i, other)
    at = np.flatnonzero(count)
    names = [x.tobytes().ljust(16, b"\x00") for k in keys for x in k]
    return pd.DataFrame({"key": [names[x] for x in at], "links": count[at], "root": [names[x] for x in root[at]]})


def near_duplicates(df: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector: str = "embedding", block: int = 4096, max_cells: int = 1024, share: float = 4) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``df``."""
    given = df.select(F.col(id_col).alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    kind = given.schema["vec_id"].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [None if v is None else (np.asarray(v, "<f8") + 0.0).tobytes() for v in batch.column(1).to_pylist()]
            keys = [None if r is None else hashlib.blake2b(r, digest_size=16).digest() for r in raw]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array(raw, pa.binary())], names=["vec_id", "key", "vector"])

    checked = given.select("vec_id", F.when(usable("v"), F.col("v")).alias("v"))
    rows = cut_lineage(checked.mapInArrow(digest, f"vec_id {kind}, key binary, vector binary"))
    classes = cut_lineage(rows.where(F.col("key").isNotNull()).groupBy("key").agg(F.min("vec_id").alias("least"), F.count("*").alias("times"), F.first("vector").alias("vector")).withColumn("dim", (F.octet_length("vector") / 8).cast("int")))
    centres = pivots_of(classes, block, max_cells)
    firsts = dict(zip(centres, np.cumsum([0, *map(len, centres.values())]).tolist()))  # each length's first cell

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(3).to_numpy(zero_copy_only=False)
            for d in np.unique(dims).tolist():
                own = batch.filter(pa.array(dims == d))
                near = unit_rows(np.array([np.frombuffer(v, "<f8") for v in own.column(2).to_pylist()])) @ centres[d].T
                cell = near.argmax(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*own.columns[:3], pa.array((cell + firsts[d]).astype(np.int32)), pa.array(near[np.arange(len(cell)), cell])], names=["key", "times", "vector", "cell", "near"]
                )

    dealt = cut_lineage(classes.select("key", "times", "vector", "dim").mapInArrow(deal, "key binary, times bigint, vector binary, cell int, near double"))
    stats = dealt.groupBy("cell").agg(F.count("*").alias("n"), F.min("near").alias("near")).collect()  # max_cells rows for each length at most
    reach = {r["cell"]: math.acos(max(-1.0, min(1.0, r["near"]))) for r in stats}
    blocks = {r["cell"]: math.ceil(r["n"] / block) for r in stats}
    wide = math.acos(threshold) + 1e-6
    meet = []
    for d, own in centres.items():
        angles = np.arccos(np.clip(own @ own.T, -1, 1))
        cells = [firsts[d] + k for k in range(len(own)) if firsts[d] + k in blocks]
        meet += [(i, j) for i in cells for j in cells if i <= j and angles[i - firsts[d], j - firsts[d]] <= reach[i] + reach[j] + wide]

    spark = df.sparkSession
    sizes = F.broadcast(spark.createDataFrame(list(blocks.items()), "cell int, _blocks int"))
    placed = dealt.join(sizes, "cell").withColumn("part", F.pmod(F.xxhash64("key"), F.col("_blocks").cast("bigint")).cast("int"))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("key")
        return pd.DataFrame({
            "cell": group["cell"].iloc[:1].array, "part": group["part"].iloc[:1].array, "keys": [b"".join(group["key"])],
            "times": [group["times"].to_numpy("<i8").tobytes()], "vectors": [b"".join(group["vector"])],
        })

    packed = placed.select("cell", "part", "key", "times", "vector").groupBy("cell", "part").applyInPandas(pack, "cell int, part int, keys binary, times binary, vectors binary")
    tile, form, path = F.concat_ws("-", "i", "pi", "j", "pj").alias("tile"), "key binary, links bigint, root binary", scratch_path(spark, "tiles")
    with shuffles_removed(spark):
        packed = cut_lineage(packed)
        spark.createDataFrame([], form).write.parquet(path)
        for wave in waves_of(meet, blocks, share):
            pairs = spark.createDataFrame(wave, "i int, j int, first int, last int, bj int")
            pairs = pairs.withColumn("pi", F.explode(F.sequence("first", "last"))).withColumn("pj", F.explode(F.sequence(F.lit(0), F.col("bj") - 1)))
            pairs = pairs.where("i < j or pi <= pj")
            one = pairs.select(F.col("i").alias("cell"), F.col("pi").alias("part"), tile, F.lit(0).alias("side"))
            two = pairs.where("i < j or pi < pj").select(F.col("j").alias("cell"), F.col("pj").alias("part"), tile, F.lit(1).alias("side"))
            sides = one.unionByName(two).join(packed, ["cell", "part"]).select("tile", "side", "keys", "times", "vectors")
            sides.groupBy("tile").applyInPandas(lambda g: _tile(g, threshold), form).write.mode("append").parquet(path)
    found = spark.read.schema(form).parquet(path)

    edges = found.where(F.col("key") != F.col("root")).select(F.col("key").alias("a"), F.col("root").alias("b"))
    joined = connected_components(edges).withColumnRenamed("node", "key")
    counts = found.groupBy("key").agg(F.sum("links").alias("links"))
    known = classes.select("key", "least", "times").join(counts, "key", "left").join(joined, "key", "left")
    known = known.withColumn("root", F.coalesce("component", "key"))
    ids = known.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = known.join(ids, "root").select("key", (F.col("times") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    out = rows.select("vec_id", "key").join(labels, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id")).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
