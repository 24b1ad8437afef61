"""Row numbers over groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

_ROW_BITS = 33  # monotonically_increasing_id keeps the place in the lower 33 bits


def number_rows(df: DataFrame, group: list[str], order: list[str], name: str = "row_number") -> DataFrame:
    """``row_number() over (partition by group order by order)`` without one task per group.

    The rows are range-sorted by group and order; each sorted partition then only
    needs the count of rows its groups have in earlier partitions. Those counts
    number (partitions + groups) at most. The sorted rows are checkpointed, so
    that counts and rows see the same placement after a lost executor too.
    """
    placed = cut_lineage(
        df.repartitionByRange(*group, *order)
        .sortWithinPartitions(*group, *order)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_id", _ROW_BITS))
    )
    spans = placed.groupBy("_part", *group).agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = spans.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    # One row per group and partition it reaches into: the range ends, not the rows.
    renamed = offsets.select(*[F.col(c).alias(f"_o_{c}") for c in offsets.columns])
    same = [F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in ["_part", *group]]
    number: Column = F.col("_id") - F.col("_o__first") + F.col("_o__before") + 1
    return placed.join(renamed, same).select(*df.columns, number.cast("bigint").alias(name))


def _bounds(df: DataFrame, order: list[str], ranges: int) -> list[Row]:
    """Keys that cut the table into about equal ranges, from eight rows for each, drawn by hash. They decide what is read, not the result."""
    drawn = df.select(*order, F.xxhash64(F.monotonically_increasing_id()).alias("_drawn")).orderBy("_drawn").limit(ranges * 8)
    keys = drawn.select(*order).orderBy(*order).collect()
    return list(dict.fromkeys(keys[4::8] or keys[:1]))


def page(df: DataFrame, order: list[str], start: int, limit: int, ranges: int = 64) -> DataFrame:
    """Rows ``start`` … ``start + limit`` in order; ties are in order of the other columns.

    Rows are counted by key range; only the ranges that the page lies in are sorted. Equal keys are in one range. Nothing is
    written, and beside a range's rows no more than the page comes to one task.
    """
    rest = [c for c in df.columns if c not in order]
    bounds = _bounds(df, order, ranges)
    if not bounds or limit <= 0:
        return df.limit(0)
    key = F.struct(*order)
    cuts = F.array(*[F.struct(*[F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(order, b)]) for b in bounds])
    # The number of cuts below the key; nulls come first, as they do when sorting.
    number = F.size(F.filter(cuts, lambda c: c <= key))
    counts = sorted((r["_range"], r["n"]) for r in df.groupBy(number.alias("_range")).agg(F.count("*").alias("n")).collect())
    first = last = None
    skipped = seen = 0
    for place, n in counts:
        if seen + n > start and seen < start + limit:
            first, skipped = (place, seen) if first is None else (first, skipped)
            last = place
        seen += n
    if first is None:
        return df.limit(0)
    return df.where(number.between(first, last)).orderBy(*order, *rest).offset(start - skipped).limit(limit)
