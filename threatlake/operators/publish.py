"""Publishing of framed documents and the catalog of published snapshots."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Documents per output batch by type; other types take the last one.
BATCH_ROWS = {"post": 500, "topic": 500, "blog": 10_000, "socialmedia": 2_000_000}
BATCH_ROWS_OTHER = 400_000
KEEP_DAYS = 7
ALIAS_PREFIX = "data-"


def unique_documents(docs: DataFrame) -> DataFrame:
    """Each document once. Documents of one key that differ, as two frames may make, all stay.

    They are dealt by key and hash first: a grouping that starts in the scan sorts all documents of a split.
    """
    key = ["doc_type", "uri", "part", "_hash"]
    dealt = docs.select(*key[:-1], F.md5("doc").alias("_hash"), "doc").repartition(*key)
    return dealt.groupBy(*key).agg(F.first("doc").alias("doc")).drop("_hash")


def save_frames(docs: DataFrame, folder: str) -> None:
    """Documents as one folder per type; a type without documents has none."""
    docs.hint("rebalance", "doc_type").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "doc_type"
    ).parquet(folder)


def publish(spark: SparkSession, frames: str, folder: str, types: list[str] | None = None) -> None:
    """Publish saved frames as JSON lines, in batches of the size the type calls for."""
    publish_rows(spark.read.parquet(frames), folder, types)


def publish_rows(saved: DataFrame, folder: str, types: list[str] | None = None) -> None:
    """Stored documents as JSON lines; a type is read at a time, since the batch size is set per write."""
    names = types or [r["doc_type"] for r in saved.select("doc_type").distinct().collect()]
    for name in names:
        docs = unique_documents(saved.where(F.col("doc_type") == name)).select("uri", "part", "doc")
        docs.write.mode("overwrite").option("maxRecordsPerFile", BATCH_ROWS.get(name, BATCH_ROWS_OTHER)).json(f"{folder}/{name}")


def snapshot_rows(docs: DataFrame, snapshot: dt.date, alias: str | None) -> DataFrame:
    """Catalog rows for one published snapshot; sizes that are stored beside the documents are used."""
    size = F.col("bytes") if "bytes" in docs.columns else F.octet_length("doc")
    return docs.groupBy("doc_type").agg(F.count("*").alias("rows"), F.sum(size).alias("bytes")).select(
        F.lit(snapshot).alias("snapshot"), "doc_type", "rows", "bytes", F.lit(alias).cast("string").alias("alias")
    )


def alias_of(snapshot: dt.date, prefix: str = ALIAS_PREFIX) -> str:
    return f"{prefix}{snapshot:%Y-%m-%d}"


def expired_aliases(catalog: DataFrame, as_of: dt.date, prefix: str = ALIAS_PREFIX, keep_days: int = KEEP_DAYS) -> DataFrame:
    """Dated aliases of at least ``keep_days`` days; names without a date stay."""
    head, tail = F.substr("alias", F.lit(1), F.lit(len(prefix))), F.substr("alias", F.lit(len(prefix) + 1))
    day = F.when((head == prefix) & F.regexp_like(tail, F.lit(r"^\d{4}-\d{2}-\d{2}$")), tail.try_cast("date"))
    return catalog.select("alias", day.alias("day")).distinct().where(F.datediff(F.lit(as_of), "day") >= keep_days)


def unnamed_snapshots(catalog: DataFrame, aliases: DataFrame) -> DataFrame:
    """Snapshots that no alias points to any more; these can be closed."""
    return catalog.select("snapshot").distinct().join(aliases.select("snapshot"), "snapshot", "left_anti")


def rekey(docs: DataFrame) -> DataFrame:
    """Documents under their joined type names with a sha256 id.

    ``docs`` has ``uri``, ``a`` (types) and ``doc`` (JSON).
    """
    body = F.to_json(F.map_from_arrays(F.array(F.array_join("a", "_")), F.array(F.try_parse_json("doc"))))
    return docs.select(F.sha2("uri", 256).alias("doc_id"), body.alias("doc"))
