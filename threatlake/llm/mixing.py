"""Mixing sources to target weights by repetition.

Words are counted per source; a source's target over its size is its repetition
rate. Each document comes floor(rate) times, and once more if a uniform number made
from a hash of its id and text lies below the rate's fraction.

Defined cases: a null text has no words; a null source is a source of its own, last in
order; a source without words has target 0 and rate 0; equal rows share one fate; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, scratch_path
from .common import free_name, n_words
from .numbering import places

WEIGHTS = (5.0, 2.0, 1.0)
#: Most times that a source is repeated.
MAX_RATE = 3.0
_BITS = 52


def uniform(seed: int, *columns: Column) -> Column:
    """A number in [0, 1), a function of the seed and the columns' values alone."""
    parts = [F.coalesce(c.cast("string"), F.lit("\x00")) for c in columns]
    digest = F.md5(F.concat_ws("\x01", F.lit(str(seed)), *parts))
    return F.conv(F.substring(digest, 1, _BITS // 4), 16, 10).cast("bigint") / F.lit(float(1 << _BITS))


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.0, max_rate: float = MAX_RATE) -> DataFrame:
    """``source, source_size`` with ``target``: shares of ``share`` times all sizes by weight.

    Weights go to the sources in code point order, null last, and repeat. No target
    passes ``max_rate`` times its source's size; what is left over is shared again
    by weight among the others until none is above. Each round is one aggregation to
    one row, and a round that caps no more sources is the last.
    """
    place = places(sizes, [F.col("source").asc_nulls_last()], "_place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_place") % len(weights) + 1).cast("int"))
    known = cut_lineage(place.select("source", "source_size", weight.alias("_w"), (F.col("source_size") * max_rate).alias("_cap")))
    level, capped = None, -1
    while True:
        over = F.lit(False) if level is None else F.col("_cap") < F.col("_w") * level
        total, taken, free, count = known.agg(
            F.sum("source_size"), F.sum(F.when(over, F.col("_cap")).otherwise(0.0)),
            F.sum(F.when(over, 0.0).otherwise(F.col("_w"))), F.sum(over.cast("bigint")),
        ).first()
        if not total or not free or count == capped:
            break
        level, capped = (share * total - taken) / free, count
    target = F.least(F.col("_cap"), F.col("_w") * level) if level is not None else F.lit(0.0)
    return known.select("source", "source_size", target.cast("double").alias("target"))


def plan(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.0, max_rate: float = MAX_RATE, seed: int = 17) -> DataFrame:
    """``docs`` with a struct column ``mix``: size, source_size, target, copies.

    The sources' table is written and read back, so that the planner knows its bytes: a small one goes to the
    documents and no text is shuffled; of a large one a source that holds most rows is split as a skewed join.
    """
    size, number, mix = free_name(docs, "_size"), free_name(docs, "_number"), free_name(docs, "mix")
    # Made before the join, so that a reader of ``mix`` alone shuffles no texts.
    chance = uniform(seed, F.col("doc_id"), F.md5(F.coalesce(F.col("text"), F.lit(""))))
    sized = docs.withColumns({size: n_words(F.col("text")), number: chance})
    sizes = sized.groupBy("source").agg(F.sum(size).alias("source_size"))
    path = scratch_path(docs.sparkSession, "targets")
    targets(sizes, weights, share, max_rate).write.parquet(path)
    aimed = docs.sparkSession.read.parquet(path).select(F.struct("source", "source_size", "target").alias("_aim"))
    joined = sized.join(aimed, F.col("source").eqNullSafe(F.col("_aim.source")))
    rate = F.when(F.col("_aim.source_size") > 0, F.col("_aim.target") / F.col("_aim.source_size")).otherwise(0.0)
    extra = F.col(number) < rate - F.floor(rate)
    copies = F.floor(rate).cast("int") + extra.cast("int")
    made = F.struct(F.col(size).alias("size"), "_aim.source_size", "_aim.target", copies.alias("copies"))
    return joined.select(*docs.columns, made.alias(mix))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mixture itself: every document as often as its plan says, with the columns of ``docs``."""
    planned = plan(docs, **options)
    copies = F.col(f"{planned.columns[-1]}.copies")
    times = F.explode(F.array_repeat(F.lit(0), copies)).alias("_time")
    return planned.where(copies > 0).select(*docs.columns, times).drop("_time")
