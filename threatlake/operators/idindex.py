"""Ids that passed before: buckets of ids behind a bitmap of fixed size.

Each increment of ``root`` holds its new rows by bucket of the id. One bitmap of ``BITS`` places for each bucket says which places
some id falls on, 64 to a word; it is written anew with each increment and has the same size however many ids there are. An id whose
place is empty is new, and nothing else is read for it. For the others their buckets' ids are compared. The bitmap
names the increments it covers; what a stopped run left out is added from the increments themselves.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .state import increments, point_to, pointed_at, stage_done

BUCKETS = 64
BITS = 1 << 20
WORDS = "bucket int, word int, bits bigint"


def bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def _place(key: Column) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("place")), F.lit(BITS))


def _words(ids: DataFrame) -> DataFrame:
    """Words of the bitmap that ids fall on."""
    place = _place(F.col("_id"))
    one = F.expr("bit_or(shiftleft(1L, CAST(_place % 64 AS INT)))").alias("bits")
    return ids.select(bucket(F.col("_id")).alias("bucket"), place.alias("_place")).groupBy("bucket", F.floor(F.col("_place") / 64).cast("int").alias("word")).agg(one)


def _folder(root: str) -> str:
    return f"{root}/_bitmap"


def bitmap(spark: SparkSession, root: str, names: list[str]) -> DataFrame | None:
    """Words over the increments ``names`` of ``root``; None without any."""
    _, text = pointed_at(spark, f"{_folder(root)}/head")
    held = json.loads(text) if text else {"folder": None, "covered": []}
    words = spark.read.schema(WORDS).parquet(held["folder"]) if held["folder"] else None
    rest = [n for n in names if n.rsplit("/", 1)[1] not in held["covered"]]
    if rest:
        added = _words(spark.read.schema("_id string, bucket int").option("basePath", root).parquet(*rest).where(F.col("_id").isNotNull()))
        words = added if words is None else _merged(words, added)
    return words


def _merged(one: DataFrame, other: DataFrame) -> DataFrame:
    return one.unionByName(other).groupBy("bucket", "word").agg(F.bit_or("bits").alias("bits"))


def save_bitmap(spark: SparkSession, root: str) -> None:
    """Write the bitmap over all finished increments; the head moves when it is whole."""
    names = increments(spark, root)
    number, _ = pointed_at(spark, f"{_folder(root)}/head")
    path = f"{_folder(root)}/version-{number + 1:08d}"
    if not stage_done(spark, path):
        bitmap(spark, root, names).coalesce(8).write.mode("overwrite").parquet(path)
    point_to(spark, f"{_folder(root)}/head", json.dumps({"folder": path, "covered": [n.rsplit("/", 1)[1] for n in names]}), number)


def unseen(spark: SparkSession, root: str, batch: DataFrame) -> tuple[DataFrame, list[int]]:
    """Rows of ``batch`` (stored, each ``_id`` once, not null) whose id no increment of ``root`` has; the buckets that were read for it."""
    names = increments(spark, root)
    words = bitmap(spark, root, names)
    if words is None:
        return batch, []
    place = _place(F.col("_id"))
    placed = batch.withColumns({"_bucket": bucket(F.col("_id")), "_word": F.floor(place / 64).cast("int"), "_bit": (place % 64).cast("int")})
    met = placed.join(words.withColumnsRenamed({"bucket": "_bucket", "word": "_word"}), ["_bucket", "_word"], "left")
    tested = met.withColumn("_maybe", F.coalesce(F.getbit("bits", "_bit") == 1, F.lit(False)))
    asked = [r["_bucket"] for r in tested.where("_maybe").select("_bucket").distinct().collect()]  # ``BUCKETS`` at most
    new = tested.where(~F.col("_maybe")).select(*batch.columns)
    if not asked:
        return new, []
    seen = spark.read.schema("_id string, bucket int").option("basePath", root).parquet(*names).where(F.col("bucket").isin(*asked)).select("_id")
    return new.unionByName(tested.where("_maybe").join(seen, "_id", "left_anti").select(*batch.columns)), sorted(asked)
