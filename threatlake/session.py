"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where that costs one more exchange behind it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


#: The most partitions that a shuffle writes straight to files; for more, a task first gathers its rows in memory.
SPREAD = 200


def build_session(app: str = "threatlake", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the engine's settings; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local-mode session without the setting gets a folder of its own; on a
    cluster a missing setting is an error, since a driver-local folder would be
    lost with its machine.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="threatlake-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder for one written table."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete one of our own written tables that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What queries shuffle in here is removed when they end."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def distinct_rows(df: DataFrame, *keys: str) -> DataFrame:
    """The distinct rows, dealt by ``keys``, else by whole rows, before any of them is held.

    A distinct that starts in the scan holds all different rows of a split, and splits grow with the input. Here a task
    holds one of ``SPREAD`` parts, and writing these needs no memory for rows.
    """
    return df.repartition(SPREAD, *(keys or df.columns)).distinct()


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    """The distinct ``keys`` of rows of any number, as ``distinct_rows`` does for whole rows.

    Rows are dealt by all their columns, so a key that most rows have is in all parts, each of which sends it on once.
    """
    return df.select(*keys, F.xxhash64(*df.columns).alias("_row")).repartition(SPREAD, *keys, "_row").select(*keys).distinct()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives executor loss and freezes row placement."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
