"""Documents as a log: a base, deltas on top, tombstones, and compaction as a step of its own.

A commit holds only what changed. Its rows have the key ``doc_type, uri, part``, the document with its md5 and size, the commit's
number ``seq``, and ``removed`` for a tombstone; they lie by type and by bucket of type and uri. On reading, the rows of a
key's newest commit win, so documents of one key that differ, as two frames may make, stay together.

``head`` is a pointer to numbered files: each names the folders that count, the base's number, and the increments that are covered. A
commit writes its folder, then moves the head from the number it started at; what was not named
by a head does not count, and a run that finds the head moved stops.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .state import point_to, pointed_at, stage_done

KEY = ["doc_type", "uri", "part"]
ROWS = "uri string, part bigint, doc string, hash string, bytes bigint, seq bigint, removed boolean, doc_type string, bucket int"
DOCUMENT = "uri string, part bigint, doc string, doc_type string"
BUCKETS = 64
EMPTY = {"seq": 0, "base_seq": 0, "folders": [], "covered": {}}


def head(spark: SparkSession, root: str) -> tuple[int, dict]:
    """The head's number and content."""
    number, text = pointed_at(spark, f"{root}/head")
    return number, json.loads(text) if text else dict(EMPTY)


def _empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], ROWS)


def _folder_of(spark: SparkSession, root: str, folders: list[str]) -> DataFrame:
    """Rows of several folders; each is read under itself, so that only type and bucket are partitions."""
    out = None
    for f in folders:
        rows = spark.read.schema(ROWS).parquet(f"{root}/{f}")
        out = rows if out is None else out.unionByName(rows)
    return _empty(spark) if out is None else out


def entries(spark: SparkSession, root: str, upto: int | None = None) -> DataFrame:
    """Each key's newest rows, tombstones too, as of commit ``upto`` (now by default).

    Only keys of commits after the base are compared; the base has each key from one commit.
    """
    _, top = head(spark, root)
    if upto is not None and upto < top["base_seq"]:
        raise ValueError(f"commits before {top['base_seq']} are compacted")
    rows = _folder_of(spark, root, top["folders"])
    if upto is not None:
        rows = rows.where(F.col("seq") <= upto)
    if len(top["folders"]) <= 1:
        return rows
    later = rows.where(F.col("seq") > top["base_seq"])
    newest = later.groupBy(*KEY).agg(F.max("seq").alias("seq"))
    held = rows.where(F.col("seq") <= top["base_seq"]).join(newest.select(*KEY), KEY, "left_anti")
    return held.unionByName(later.join(newest, [*KEY, "seq"], "left_semi"))


def documents(spark: SparkSession, root: str, upto: int | None = None) -> DataFrame:
    """The documents that stand."""
    return entries(spark, root, upto).where(~F.col("removed"))


def changes(spark: SparkSession, root: str, after: int, upto: int) -> DataFrame:
    """What commits after one up to another changed, each key once; folders of earlier commits give no rows."""
    return entries(spark, root, upto).where(F.col("seq") > after)


def _keyed(docs: DataFrame, buckets: int) -> DataFrame:
    bucket = F.pmod(F.xxhash64("doc_type", "uri"), F.lit(buckets)).cast("int")
    return docs.select(*KEY, "doc", F.md5("doc").alias("hash"), F.octet_length("doc").cast("bigint").alias("bytes"), bucket.alias("bucket"))


def delta(spark: SparkSession, root: str, framed: DataFrame, gone: DataFrame | None = None, buckets: int = BUCKETS) -> DataFrame:
    """The rows a commit of ``framed`` has to hold: changed keys with all their documents, and tombstones.

    ``framed`` is stored and has all parts of the documents it has; parts that it lacks now are removed, and so
    are the documents of ``gone`` (doc_type, uri) that it has not. Of the log only keys and md5s are read, in the buckets
    that are touched.
    """
    new = _keyed(framed, buckets)
    if not head(spark, root)[1]["folders"]:
        return new.withColumn("removed", F.lit(False))
    named = new.select("doc_type", "uri", "bucket").distinct()
    if gone is not None:
        named = named.unionByName(_keyed(gone.withColumns({"part": F.lit(0).cast("bigint"), "doc": F.lit("")}), buckets).select("doc_type", "uri", "bucket")).distinct()
    touched = [r["bucket"] for r in named.select("bucket").distinct().collect()]  # ``buckets`` at most
    old = documents(spark, root).where(F.col("bucket").isin(touched)).select(*KEY, "hash", "bucket").join(named, ["doc_type", "uri", "bucket"], "left_semi")
    # A key stands as it was if both sides have the same documents.
    sides = new.select(*KEY, "hash", F.lit(1).alias("side")).unionByName(old.select(*KEY, "hash", F.lit(2).alias("side")))
    per_hash = sides.groupBy(*KEY, "hash").agg(F.bit_or("side").alias("sides"))
    changed = per_hash.groupBy(*KEY).agg(F.bit_or("sides").alias("has"), F.min("sides").alias("least"), F.max("sides").alias("most")).where("least < 3 or most < 3")
    rows = new.join(changed.select(*KEY), KEY, "left_semi").withColumn("removed", F.lit(False))
    lost = changed.where(F.col("has") == 2).select(*KEY)
    return rows.unionByName(_keyed(lost.withColumn("doc", F.lit(None).cast("string")), buckets).withColumn("removed", F.lit(True)))


def commit(spark: SparkSession, root: str, name: str, rows, covered: Iterable[str]) -> None:
    """Append ``rows()`` as the folder ``name`` and cover the increments; an increment that is covered needs no commit.

    Run again after a stop it goes on: a folder that is whole is not written again, the head moves once.
    """
    number, top = head(spark, root)
    seq = top["seq"] + 1
    folder = f"seq-{seq:08d}-{name}"  # the number is part of the name: a folder made on another head is another folder
    if not stage_done(spark, f"{root}/{folder}"):
        # Rebalanced by type and bucket: a bucket with most of the rows is still written by many tasks.
        rows().withColumn("seq", F.lit(seq).cast("bigint")).hint("rebalance", "doc_type", "bucket").write.mode("overwrite").option(
            "partitionOverwriteMode", "static").partitionBy("doc_type", "bucket").parquet(f"{root}/{folder}")
    after = {**top, "seq": seq, "folders": [*top["folders"], folder], "covered": {**top["covered"], **{c: folder for c in covered}}}
    if not top["folders"]:
        after["base_seq"] = seq
    point_to(spark, f"{root}/head", json.dumps(after), number)


def committed(spark: SparkSession, root: str, increment: str) -> DataFrame | None:
    """The documents that the commit covering an increment changed; None where it is not covered."""
    folder = head(spark, root)[1]["covered"].get(increment)
    return None if folder is None else _folder_of(spark, root, [folder]).where(~F.col("removed")).select(*KEY, "doc")


def compact(spark: SparkSession, root: str, keep_after: int = 0) -> None:
    """Write the newest rows as a new base; tombstones of commits after ``keep_after`` stay, since someone has yet to read them.

    Rows keep their commit's number. Folders that no head names any more are left to ``clean``, so readers under way go on.
    """
    number, top = head(spark, root)
    if len(top["folders"]) < 2:
        return
    folder = f"base-{top['seq']:08d}"
    if not stage_done(spark, f"{root}/{folder}"):
        kept = entries(spark, root).where(~F.col("removed") | (F.col("seq") > keep_after))
        kept.hint("rebalance", "doc_type", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("doc_type", "bucket").parquet(f"{root}/{folder}")
    point_to(spark, f"{root}/head", json.dumps({**top, "base_seq": top["seq"], "folders": [folder]}), number)
