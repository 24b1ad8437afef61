"""Places in a global order without one task for all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

_ROW_BITS = 33  # monotonically_increasing_id keeps the place in the lower 33 bits


def places(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with each row's place in the given order, from 0.

    Rows are range-sorted and written; a partition's first place is the count of rows in the
    partitions before it, which is a table of one row for each partition.
    """
    sorted_rows = cut_lineage(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("_id", _ROW_BITS))
    spans = sorted_rows.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = spans.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    place = (F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + F.col("_before")).cast("bigint")
    return sorted_rows.join(starts, "_part").select(*df.columns, place.alias(name))
