"""Structured Streaming jobs; each runs through the files present and stops.

Checkpoints belong in a folder all executors share. They replace the ``since``
mark of the batch jobs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import idindex
from ..operators.state import increment_folder, increments, stage_done, upsert
from ..session import cut_lineage
from ..sources.cdr import add_partitions
from ..sources.feeds import FeedSpec
from ..sources.landing import land

LATE_DAYS = 2
COUNTS = "source_name string, day timestamp, count_downloaded bigint, late boolean"


def stream_files(spark: SparkSession, path: str, schema, fmt: str = "parquet", glob: str | None = None, per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.load(path)


def land_stream(spark: SparkSession, landing: str, feed: FeedSpec, landed_at: int, cdr: str, checkpoint: str, per_trigger: int = 1000) -> StreamingQuery:
    """Land the new files of a feed in the evidence table."""
    lines = stream_files(spark, landing, "value string", "text", per_trigger=per_trigger)
    raw = lines.where(F.length("value") > 0).withColumnRenamed("value", "raw_content")
    return (
        add_partitions(land(raw, feed, landed_at))
        .writeStream.format("parquet")
        .partitionBy("year", "month")
        .option("path", cdr)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def upsert_stream(statements: DataFrame, root: str, checkpoint: str, buckets: int = 64) -> StreamingQuery:
    """Merge a stream of statements into the store.

    Every micro-batch is an increment of its own name, so a batch that is run
    again after a failure adds nothing.
    """

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        upsert(batch.sparkSession, root, f"batch-{batch_id:012d}", batch, buckets)

    return (
        statements.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def daily_count_stream(records: DataFrame, out: str, checkpoint: str, late_days: int = LATE_DAYS) -> StreamingQuery:
    """Records per feed and day; those that come in too late are counted aside.

    ``records`` has ``ts`` (timestamp) and ``source_name``. Each micro-batch adds its own
    counts, a row for each feed and day, so nothing is held in memory between batches and a
    batch that is run again replaces its own rows only. A day is late when it lies more
    than ``late_days`` before the newest day of earlier batches: ``latest_counts``
    leaves it out and ``late_counts`` returns it, so that no row is lost.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        spark, folder = batch.sparkSession, increment_folder(out, f"batch-{batch_id:012d}")
        if stage_done(spark, folder):
            return
        before = increments(spark, out)
        newest = spark.read.schema(COUNTS).parquet(*before).agg(F.max("day")).head()[0] if before else None
        late = F.lit(False) if newest is None else F.coalesce(F.datediff(F.lit(newest), "day") > late_days, F.lit(False))
        counts = batch.groupBy("source_name", F.date_trunc("day", "ts").alias("day")).agg(F.count("*").alias("count_downloaded"))
        counts.withColumn("late", late).write.mode("overwrite").parquet(folder)

    return records.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _counts(spark: SparkSession, out: str, late: bool) -> DataFrame:
    rows = spark.read.schema(COUNTS).parquet(*increments(spark, out)).where(F.col("late") == late)
    return rows.groupBy("source_name", "day").agg(F.sum("count_downloaded").alias("count_downloaded"))


def latest_counts(spark: SparkSession, out: str) -> DataFrame:
    """The counts of the days that came in time, over all batches."""
    return _counts(spark, out, False)


def late_counts(spark: SparkSession, out: str) -> DataFrame:
    """The rows that came too late, counted by feed and day."""
    return _counts(spark, out, True)


def first_seen_stream(records: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Pass on each ``_id`` once, however often and however late it comes again; records without an id all pass.

    Each micro-batch is thinned to one row per id on the map side before ids are
    compared, so an id that most records share does not load one state task, as it
    would with a streaming de-duplication. Ids are compared through ``idindex``: a batch whose ids are new reads a
    bitmap of fixed size and no earlier ids. A batch that is run again replaces its own output only.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        spark, folder = batch.sparkSession, increment_folder(out, f"batch-{batch_id:012d}")
        if stage_done(spark, folder):
            return
        named = cut_lineage(batch.where(F.col("_id").isNotNull()).dropDuplicates(["_id"]))
        fresh, _ = idindex.unseen(spark, out, named)
        every = fresh.unionByName(batch.where(F.col("_id").isNull()))
        by_bucket = every.withColumn("bucket", F.coalesce(idindex.bucket(F.col("_id")), F.lit(0))).hint("rebalance", "bucket")
        by_bucket.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(folder)
        idindex.save_bitmap(spark, out)

    return (
        records.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def run(query: StreamingQuery, then: Callable[[], DataFrame]) -> DataFrame:
    """Wait for a query to work through its input, then read its result."""
    query.awaitTermination()
    return then()
