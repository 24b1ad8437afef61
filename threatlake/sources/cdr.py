"""Scans of the evidence table (CDR)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import epoch_day
from ..functions.json import broken_json, json_rep
from ..schema import CDR_COLUMNS, CDR_PARTITIONS

INITIAL = "initial"


def read_cdr(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def query_cdr(spark: SparkSession, sql: str) -> DataFrame:
    """Scan by SQL text; the result must offer the CDR columns."""
    return spark.sql(sql).select(*CDR_COLUMNS)


def add_partitions(cdr: DataFrame) -> DataFrame:
    """Partition columns from the record's own time, not from the day it lands."""
    day = epoch_day(F.col("timestamp"))
    return cdr.withColumns({"year": F.year(day), "month": F.month(day)})


def _month_index(epoch_seconds: int) -> int:
    day = dt.datetime.fromtimestamp(epoch_seconds, dt.timezone.utc)
    return day.year * 12 + day.month


def _month_bound(cdr: DataFrame, lo: int | None, hi: int | None) -> Column:
    """The month range of a time range.

    The planner cannot see that ``timestamp`` decides ``(year, month)``, so the
    range is stated on the partition columns as well.
    """
    if not set(CDR_PARTITIONS) <= set(cdr.columns):
        return F.lit(True)
    month = F.col("year") * 12 + F.col("month")
    bound = F.lit(True)
    if lo is not None:
        bound = bound & (month >= _month_index(lo))
    if hi is not None:
        bound = bound & (month <= _month_index(hi))
    return bound


def since(cdr: DataFrame, mark: int | str) -> DataFrame:
    """Records strictly after ``mark``; ``"initial"`` or empty means all of them."""
    if mark in (INITIAL, ""):
        return cdr
    mark = int(mark)
    return cdr.where((F.col("timestamp") > mark) & _month_bound(cdr, mark, None))


def between(cdr: DataFrame, lo: int | None, hi: int) -> DataFrame:
    """Records with ``lo <= timestamp < hi``; from the beginning without ``lo``."""
    start = F.lit(True) if lo is None else F.col("timestamp") >= lo
    return cdr.where(start & (F.col("timestamp") < hi) & _month_bound(cdr, lo, hi - 1))


def with_json(cdr: DataFrame) -> DataFrame:
    return cdr.withColumn("json_rep", json_rep(F.col("content_type"), F.col("raw_content")))


def quarantine(cdr: DataFrame) -> DataFrame:
    """Records that claim JSON but do not parse."""
    return cdr.where(broken_json(F.col("content_type"), F.col("raw_content")))


def without_target_system(cdr: DataFrame, source: str, system: str) -> DataFrame:
    """Drop the rules of one target system; records without the field stay."""
    hit = (F.col("source_name") == source) & (
        F.try_variant_get(F.col("json_rep"), "$.targetSystem", "string") == system
    )
    return cdr.where(~F.coalesce(hit, F.lit(False)))
