"""Landing of feed batches in the evidence table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import URL_BASE, content_id, content_url
from ..functions.json import JSON_TYPE, blank_fields
from ..schema import CDR_COLUMNS
from .cdr import add_partitions
from .feeds import FeedSpec

VERSION = "2.0"


def envelope(
    raw: DataFrame,
    source: Column,
    team: Column,
    landed_at: Column,
    content_type: str = JSON_TYPE,
    url_base: str = URL_BASE,
) -> DataFrame:
    """Wrap a ``raw_content`` column in the CDR columns."""
    body = F.col("raw_content")
    return raw.select(
        content_id(source, body).alias("_id"),
        landed_at.cast("bigint").alias("timestamp"),
        body,
        F.lit(content_type).alias("content_type"),
        content_url(source, body, url_base).alias("url"),
        F.lit(VERSION).alias("version"),
        team.alias("team"),
        source.alias("source_name"),
    )


def land(raw: DataFrame, feed: FeedSpec, landed_at: int) -> DataFrame:
    """One feed batch as CDR records, the feed's blanked fields emptied first."""
    if feed.blank:
        raw = raw.withColumn("raw_content", blank_fields(F.col("raw_content"), *feed.blank))
    return envelope(raw, F.lit(feed.source_name), F.lit(feed.team), F.lit(landed_at))


def drop_known(batch: DataFrame, cdr: DataFrame, *sources: str) -> DataFrame:
    """Records of the batch whose id the table does not hold, each id once.

    Ids start with the feed's name, so the feeds of the batch, where given, bound
    what is read of the table. Both sides shrink to one row per id with map-side
    combining before they meet, so a record pulled many times does not load one task.
    """
    if sources:
        cdr = cdr.where(F.col("source_name").isin(*sources))
    known = cdr.select("_id").distinct()
    return batch.dropDuplicates(["_id"]).join(known, "_id", "left_anti").select(*batch.columns)


def write_cdr(records: DataFrame, path: str, mode: str = "append") -> None:
    """Append to, or rewrite, the year/month partitions the records fall in.

    Rewriting touches only those partitions. The rebalance hint lets a month
    that holds most rows be written by many tasks.
    """
    (
        add_partitions(records.select(*CDR_COLUMNS))
        .hint("rebalance", "year", "month")
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month")
        .parquet(path)
    )


def write_bucketed(records: DataFrame, table: str, buckets: int = 256) -> None:
    """Save as a catalog table with the CDR layout: by month, bucketed by feed."""
    (
        add_partitions(records.select(*CDR_COLUMNS))
        .write.mode("append")
        .partitionBy("year", "month")
        .bucketBy(buckets, "source_name")
        .saveAsTable(table)
    )


def import_partitions(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Existing ``year=/month=`` folders, whatever tool wrote them."""
    return spark.read.option("basePath", path).format(fmt).load(path)


def backup(raw: DataFrame, root: str, source: str, pull_date: dt.date) -> None:
    """Raw copy of one pull, in the folder layout that the feed reader prunes by."""
    _write_pulls(raw.select(F.col("raw_content").alias("value"), F.lit(source).alias("source_name"), F.lit(pull_date).alias("pull_date")), root)


def backup_pulls(raw: DataFrame, root: str) -> None:
    """Raw copies of many pulls in one write; ``raw`` has ``raw_content``, ``source_name`` and ``pull_date``.

    The rebalance hint lets a pull that holds most rows be written by many tasks.
    """
    _write_pulls(raw.select(F.col("raw_content").alias("value"), "source_name", "pull_date").hint("rebalance", "source_name", "pull_date"), root)


def _write_pulls(pulls: DataFrame, root: str) -> None:
    """Only the pulls that have rows are replaced."""
    pulls.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source_name", "pull_date").text(root)


def as_keyed_json(records: DataFrame, key: str, *columns: str) -> DataFrame:
    """``(key, json)`` rows."""
    body = F.struct(*(columns or records.columns))
    return records.select(F.col(key).alias("key"), F.to_json(body).alias("json"))
