"""Raw tweet files, plain or as the first member of a tar archive."""

from __future__ import annotations

import io
import itertools
import sys
import tarfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LINE = "file string, line string"
CHUNK = 10_000


def _first_members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lines of each archive's first member; what stops an archive comes as a row of its own."""
    for batch in batches:
        for name, content in zip(batch["file"], batch["content"]):
            try:
                with tarfile.open(fileobj=io.BytesIO(content), mode="r:*") as tar:
                    member = next(iter(tar), None)
                    stream = member and tar.extractfile(member)
                    read = 0
                    while stream and (lines := list(itertools.islice(stream, CHUNK))):
                        read += sum(map(len, lines))
                        text = [line.decode("utf-8", "replace").rstrip("\r\n") for line in lines]
                        yield pd.DataFrame({"file": name, "line": text, "error": None})
                    if not stream:
                        raise tarfile.ReadError("no file in the archive")
                    if read < member.size:
                        raise EOFError(f"{read} of {member.size} bytes")
            except (tarfile.TarError, EOFError, OSError, zlib.error) as error:
                yield pd.DataFrame({"file": [name], "line": [None], "error": [f"{type(error).__name__}: {error}"]})


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no copy of this package


def _packed(spark: SparkSession, folder: str) -> DataFrame:
    """``(file, line, error)`` of the archives that no plain file stands for."""
    path = F.col("_metadata.file_path")
    base = F.regexp_extract(path, r"([^/]+?)(\.tar\.gz|\.json)$", 1)
    files = spark.read.format("binaryFile")
    packed = files.option("pathGlobFilter", "*.tar.gz").load(folder).select(base.alias("file"), "content")
    # Without the content column only the listing is read.
    names = files.option("pathGlobFilter", "*.json").load(folder).select(base.alias("file")).distinct()
    return packed.join(names, "file", "left_anti").mapInPandas(_first_members, f"{LINE}, error string")


def read_tweet_files(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of all tweet files as ``(file, line)``.

    ``file`` is the base name without suffixes. Where a plain file and an
    archive share it, only the plain one, first in name order, is read. Archives that
    end early give the lines they have; ``archive_quarantine`` names them.
    """
    base = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+?)\.json$", 1)
    plain = spark.read.option("pathGlobFilter", "*.json").text(folder).select(base.alias("file"), F.col("value").alias("line"))
    return plain.unionByName(_packed(spark, folder).where(F.col("error").isNull()).select("file", "line"))


def archive_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Archives that cannot be read to their end, ``(file, error)``."""
    return _packed(spark, folder).where(F.col("error").isNotNull()).select("file", "error")


def parse_tweets(lines: DataFrame) -> DataFrame:
    """Tweets as typed columns; lines that are not JSON are in ``tweet_quarantine``."""
    schema = (
        "id_str string, created_at string, text string, retweet_count bigint, favorite_count bigint,"
        " in_reply_to_status_id_str string, user struct<screen_name string>,"
        " entities struct<hashtags array<struct<text string>>, user_mentions array<struct<screen_name string>>>"
    )
    good = lines.where(F.try_parse_json("line").isNotNull())
    return good.select("file", F.from_json("line", schema).alias("t")).select("file", "t.*")


def tweet_quarantine(lines: DataFrame) -> DataFrame:
    """Lines that are no JSON, as they came: with ``parse_tweets`` these are all lines but the empty ones."""
    return lines.where(F.try_parse_json("line").isNull() & (F.length(F.trim("line")) > 0)).select("file", "line")
