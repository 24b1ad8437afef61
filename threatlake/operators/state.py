"""Stored stages: done marks, increments, the statement store and version pointers."""

from __future__ import annotations

import hashlib
import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import STATEMENT, STATEMENT_COLUMNS
from ..session import distinct_rows, drop_path, scratch_path, shuffles_removed
from ..sources.cdr import INITIAL

BUCKETS = 256
#: A store that starts with more statements than its buckets hold by this number has more buckets.
BUCKET_ROWS = 100_000
#: An increment goes to the store in waves of about so many statements, ``WAVES`` at most, as each reads the staged ones again.
WAVE_ROWS, WAVES = 8_000_000, 8


def _path(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = _path(spark, path)
    return fs.exists(target)


def stage_done(spark: SparkSession, folder: str) -> bool:
    """True where a stage left its success mark; a folder without one is removed."""
    target, fs = _path(spark, folder)
    if not fs.exists(target):
        return False
    if exists(spark, folder.rstrip("/") + "/_SUCCESS"):
        return True
    fs.delete(target, True)
    return False


def stage(spark: SparkSession, folder: str, build, fmt: str = "parquet") -> DataFrame:
    """Run ``build()`` and save it, unless an earlier run finished this stage."""
    if not stage_done(spark, folder):
        build().write.mode("overwrite").format(fmt).save(folder)
    return spark.read.format(fmt).load(folder)


def increment_folder(root: str, since: str | int = "") -> str:
    return f"{root.rstrip('/')}/increment={since or INITIAL}"


def increments(spark: SparkSession, root: str) -> list[str]:
    """Finished increment folders of a stage."""
    target, fs = _path(spark, root)
    if not fs.exists(target):
        return []
    folders = [s.getPath().toString() for s in fs.listStatus(target) if s.isDirectory()]
    return sorted(f for f in folders if "/increment=" in f and exists(spark, f + "/_SUCCESS"))


def read_increments(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    """All finished increments of a stage as one table."""
    return spark.read.option("basePath", root).format(fmt).load(increments(spark, root))


def statement_id() -> Column:
    """A hash of the whole statement: equal ones have one id, whoever sends them.

    Different ones may share it, so whole statements are compared where ids meet. Even an id of
    eight bytes is half of what a stored statement takes.
    """
    return F.xxhash64(*STATEMENT_COLUMNS)


def _layout(spark: SparkSession, root: str, buckets: int, first: DataFrame | None = None) -> int:
    """The store's number of buckets: what it was made with, else ``buckets``, or as many as its ``first`` statements need.

    A task holds a bucket of new statements, so buckets that grew with the input would outgrow it. Statements that come
    more than once count as one, about.
    """
    held = pointed(spark, f"{root}/_buckets")
    if held is None:
        rows = first.count() if first is not None else 0
        if rows > buckets * BUCKET_ROWS:
            rows = min(rows, first.agg(F.approx_count_distinct(statement_id(), 0.01)).head()[0])
        held = str(max(buckets, math.ceil(rows / BUCKET_ROWS)))
        point_to(spark, f"{root}/_buckets", held)
    return int(held)


def _columns() -> str:
    return ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in STATEMENT.fields), "sid bigint", "bucket int"])


def store(spark: SparkSession, root: str, folders: list[str], buckets: int = BUCKETS) -> DataFrame:
    """Finished increments as a catalog table bucketed by statement id, so that a join by id does not shuffle them.

    The table is made over the files where the session does not have it yet; an increment is a partition of it.
    """
    name = f"statements_{hashlib.md5(root.encode()).hexdigest()}"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_columns()}, increment string) USING parquet PARTITIONED BY (increment) CLUSTERED BY (sid) INTO {_layout(spark, root, buckets)} BUCKETS LOCATION '{root}'")
    marks = [f.rsplit("increment=", 1)[1] for f in folders]
    if marks:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(f"PARTITION (increment = '{m}')" for m in marks))
    return spark.table(name).where(F.col("increment").isin(*marks))


def read_state(spark: SparkSession, root: str) -> DataFrame:
    """The merged statements of the store."""
    folders = increments(spark, root)
    if not folders:
        return spark.createDataFrame([], STATEMENT)
    return spark.read.schema(STATEMENT).parquet(*folders)


def unknown(held: DataFrame, fresh: DataFrame, buckets: int) -> DataFrame:
    """Rows of ``fresh`` (with ``sid``) that the store does not hold.

    Bucket meets bucket: only ``fresh`` is shuffled, and once: an anti-join would be moved below its shuffle, so what is not known is
    what an outer join finds nothing for. Statements are equal where their ids and all their columns are; the
    latter is asked by two bounds, since by an equation that nulls may meet the planner would deal both sides.
    """
    def equal(left: DataFrame, right: DataFrame) -> Column:
        one, other = (F.struct(*[side[c] for c in STATEMENT_COLUMNS]) for side in (left, right))
        return (left["sid"] == right["sid"]) & (one <= other) & (one >= other)

    dealt = fresh.repartition(buckets, "sid")
    known = held.join(dealt, equal(held, dealt), "left_semi").select(*STATEMENT_COLUMNS, "sid", F.lit(True).alias("_known"))
    return dealt.join(known, equal(dealt, known), "left").where(F.col("_known").isNull()).select(*[dealt[c] for c in fresh.columns])


def upsert(spark: SparkSession, root: str, increment: str, delta: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Merge statements into the store and return what was new.

    Merging is a set union, so an upsert only adds the statements the store does
    not hold yet, as one more increment; nothing already written is rewritten. A
    repeated increment is a no-op. Statements meet by their id, so a hot entity is no
    hot key. They are written as parquet and read back first, so that they are made once and counted; in the order in which
    they are made they take little room. A wave then takes a range of buckets, writes each as one file, and what it
    shuffled is removed before the next one, so that disk follows the store and not what is dealt for it.
    """
    folder = increment_folder(root, increment)
    if not stage_done(spark, folder):
        staged, name = scratch_path(spark, "fresh"), f"increment_{uuid.uuid4().hex}"
        try:
            delta.select(*STATEMENT_COLUMNS).write.option("compression", "zstd").parquet(staged)
            fresh = spark.read.schema(STATEMENT).parquet(staged)
            buckets = _layout(spark, root, buckets, fresh)
            held_in = increments(spark, root)
            held = store(spark, root, held_in, buckets) if held_in else None
            # Not a wave but the whole increment leaves a success mark.
            spark.sql(
                f"CREATE TABLE {name} ({_columns()}) USING parquet OPTIONS (compression 'zstd', 'mapreduce.fileoutputcommitter.marksuccessfuljobs' 'false') "
                f"CLUSTERED BY (sid) INTO {buckets} BUCKETS LOCATION '{folder}'"
            )
            bucket = F.pmod(F.hash("sid"), F.lit(buckets))  # as Spark deals them
            waves = min(WAVES, buckets, max(1, math.ceil(fresh.count() / WAVE_ROWS)))
            for wave in range(waves):
                # Files of other buckets are passed over; those of a store without the column are not, and fail.
                taken = F.col("bucket").isNull() | F.col("bucket").between(wave * buckets // waves, (wave + 1) * buckets // waves - 1)
                some = fresh.withColumn("sid", statement_id()).withColumn("bucket", bucket).where(taken)
                new = distinct_rows(some.select(*STATEMENT_COLUMNS)).withColumn("sid", statement_id())
                new = unknown(held.where(taken), new, buckets) if held_in else new.repartition(buckets, "sid")
                with shuffles_removed(spark):
                    new.withColumn("bucket", bucket).write.insertInto(name)
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {name}")  # its files stay
            drop_path(spark, staged)
        done, fs = _path(spark, f"{folder}/_SUCCESS")
        fs.create(done, True).close()
    return spark.read.schema(STATEMENT).parquet(folder)


def rewrite(spark: SparkSession, source: str, target: str, keep: Column | None = None, buckets: int = BUCKETS) -> str:
    """Write a store again as a single increment, optionally without some statements.

    The old store stays as it was; switch readers over with ``point_to``.
    """
    state = read_state(spark, source)
    kept = state if keep is None else state.where(keep)
    upsert(spark, target, INITIAL, kept, buckets)
    return target


def _versions(spark: SparkSession, pointer: str) -> list[int]:
    target, fs = _path(spark, pointer)
    names = [f.getPath().getName() for f in fs.listStatus(target)] if fs.exists(target) else []
    return sorted(int(n) for n in names if n.isdigit())


def point_to(spark: SparkSession, pointer: str, version: str, after: int | None = None) -> None:
    """Name the current version of a table in a new numbered file of the pointer's folder.

    The file gets its number by a rename once it is whole, so a reader finds the version
    before or this one at any time. A number that another writer took is an error; so is, with ``after``, a
    pointer that is not at that number any more.
    """
    number = (_versions(spark, pointer) or [0])[-1] + 1
    if after is not None and number != after + 1:
        raise RuntimeError(f"{pointer} was moved by another run")
    draft, fs = _path(spark, f"{pointer}/_draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(version.encode()))
    out.close()
    target, _ = _path(spark, f"{pointer}/{number:012d}")
    if fs.exists(target) or not fs.rename(draft, target):
        raise RuntimeError(f"{pointer} was moved by another run")


def pointed_at(spark: SparkSession, pointer: str) -> tuple[int, str | None]:
    """The pointer's number and the version it names; 0 and None where it was never set."""
    numbers = _versions(spark, pointer)
    if not numbers:
        return 0, None
    target, fs = _path(spark, f"{pointer}/{numbers[-1]:012d}")
    stream = fs.open(target)
    try:
        return numbers[-1], bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def pointed(spark: SparkSession, pointer: str) -> str | None:
    """The current version; None where the pointer was never set."""
    return pointed_at(spark, pointer)[1]


def changed_documents(new: DataFrame, old: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Documents that are new or differ from the last version, compared by hash."""
    key = key or ["doc_type", "uri", "part"]
    tagged = new.withColumn("_hash", F.md5("doc"))
    before = old.select(*key, F.md5("doc").alias("_hash"))
    return tagged.join(before, [*key, "_hash"], "left_anti").select(*new.columns)
