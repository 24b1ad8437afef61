"""Merging of statements by entity, and views over the merged statements."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import PROVENANCE, STATEMENT, STATEMENT_COLUMNS
from ..session import SPREAD, cut_lineage, distinct_rows


def merge(*inputs: DataFrame) -> DataFrame:
    """Set union of statements.

    Associative, commutative and idempotent. Whole statements are the shuffle key, so no
    entity is a hot key; repeats of one statement take no room where they meet.
    """
    return distinct_rows(reduce(DataFrame.unionByName, inputs).select(*STATEMENT_COLUMNS))


def materialise(statements: DataFrame, path: str) -> DataFrame:
    """Write merged statements once, in a folder per type, and read them back.

    Framing reads the statements of a type several times; each time it then
    reads that type's folder and the columns it needs, instead of mapping the
    records again. The rebalance hint splits a type that most statements have.
    """
    merge(statements).hint("rebalance", "type").write.mode("overwrite").partitionBy("type").parquet(path)
    return statements.sparkSession.read.schema(STATEMENT).parquet(path).select(*STATEMENT_COLUMNS)


def ablate(
    statements: DataFrame,
    exclude: list[str] | None = None,
    upto: dt.date | None = None,
) -> DataFrame:
    """The evidence without some publishers, or as observed up to a day.

    Statements without a publisher or an observed date stay.
    """
    kept = statements
    if exclude:
        kept = kept.where(~F.coalesce(F.col("publisher").isin(*exclude), F.lit(False)))
    if upto is not None:
        kept = kept.where(F.coalesce(F.col("observedDate") <= F.lit(upto), F.lit(True)))
    return kept


def part_of(item: Column, parts: Column) -> Column:
    """A stable part number of an item: the first 32 bits of its md5, modulo the parts."""
    return F.conv(F.substring(F.md5(item), 1, 8), 16, 10).cast("bigint") % parts


def split_large(rows: DataFrame, key: str, item: Column, cap: int | None) -> DataFrame:
    """Add ``part`` and ``parts``, so that ``(key, part)`` holds about ``cap`` different items at most.

    Keys with up to ``cap`` items have one part. Degrees are counted with map-side
    combining; only keys above the cap are kept, which is at most rows / cap.
    Their rows are spread by content, so nothing is dropped. Without ``cap`` every key
    has one part, and nothing is counted.
    """
    one_part = {"part": F.lit(0).cast("bigint"), "parts": F.lit(1).cast("bigint")}
    if cap is None:
        return rows.withColumns(one_part)
    counted = rows.groupBy(key).agg(F.count("*").alias("_n"))
    large = cut_lineage(counted.where(F.col("_n") > cap).select(key))
    if not large.isEmpty():
        # Repeats must not count, so the few candidates are counted again without them.
        items = rows.join(large, key).select(key, item.alias("_item")).distinct()
        exact = items.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > cap)
        large = cut_lineage(exact.select(key, F.ceil(F.col("_n") / cap).alias("_parts")))
    if large.isEmpty():
        return rows.withColumns(one_part)
    joined = rows.join(large, key, "left")
    parts = F.coalesce(F.col("_parts"), F.lit(1)).cast("bigint")
    part = F.when(parts > 1, part_of(item, parts)).otherwise(F.lit(0).cast("bigint"))
    return joined.withColumns({"part": part, "parts": parts}).drop("_parts")


def statement_item() -> Column:
    """The property and value of a statement as one text."""
    return F.concat_ws("|", "property", F.coalesce("value", F.lit("")), F.coalesce("object_uri", F.lit("")))


def entities(statements: DataFrame, cap: int | None = None) -> DataFrame:
    """One row per entity, whatever its size, or with ``cap`` one per part of a large one.

    ``(uri, part, parts, types, props)``, where ``props`` maps a property to its sorted
    values and links. Where they come from is ``entity_provenance``.
    """
    cells = statements.select("uri", "property", F.coalesce("value", "object_uri").alias("value"), "type")
    cells = split_large(cells, "uri", F.concat_ws("|", "property", "value"), cap)
    # Dealt first: lists that start in the scan sort all rows of a split.
    grouped = cells.repartition(SPREAD, *(["uri"] if cap is None else ["uri", "part"])).groupBy("uri", "part", "parts").agg(
        F.array_sort(F.collect_set("type")).alias("types"),
        F.array_sort(F.collect_set(F.struct("property", "value"))).alias("pairs"),
    )
    # One shuffle; the pairs of a part, about ``cap`` at most, are then grouped in place.
    names = F.array_distinct(F.transform("pairs", lambda p: p["property"]))
    props = F.map_from_arrays("names", F.transform("names", _values_of))
    return grouped.withColumn("names", names).select("uri", "part", "parts", "types", props.alias("props"))


def entity_provenance(statements: DataFrame) -> DataFrame:
    """Who said something of an entity, and when: a row each, since nothing bounds their number."""
    return distinct_rows(statements.select("uri", *PROVENANCE))


def _values_of(name: Column) -> Column:
    of_name = F.filter(F.col("pairs"), lambda p: p["property"] == name)
    return F.transform(of_name, lambda p: p["value"])
