"""File and database inputs as evidence records."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ids import URL_BASE
from ..schema import CDR
from .landing import VERSION, envelope


def read_delimited(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Delimited text with a header line; quotes have no meaning, short rows leave nulls."""
    return (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("quote", "")
        .option("mode", "PERMISSIVE")
        .option("ignoreLeadingWhiteSpace", False)
        .csv(path)
    )


def _flagged(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """Delimited rows with ``_line``, the line of those that have not as many fields as the header, and ``_file``."""
    def reader():
        return spark.read.option("header", True).option("sep", sep).option("quote", "").option("ignoreLeadingWhiteSpace", False)

    names = reader().csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, "_line"]])
    # A reader that parses only the columns asked for would not see that a row has more.
    rows = reader().schema(schema).option("columnPruning", False).option("columnNameOfCorruptRecord", "_line").csv(path)
    return rows.withColumn("_file", F.col("_metadata.file_path"))


def _too_many(sep: str, names: list[str]) -> Column:
    # Spark does not read a line by itself: the first field, of whatever length, is asked for too.
    read = F.length(F.coalesce(F.col(f"`{names[0]}`"), F.lit(""))) >= 0
    return read & F.coalesce(F.size(F.split("_line", re.escape(sep), -1)) > len(names), F.lit(False))


def read_delimited_whole(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """As ``read_delimited``; rows of more fields than the header has would lose some and are in ``delimited_quarantine``."""
    rows = _flagged(spark, path, sep)
    names = rows.columns[:-2]
    return rows.where(~_too_many(sep, names)).select(*[F.col(f"`{c}`") for c in names])


def delimited_quarantine(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """``(file, line)`` of the rows that have more fields than the header."""
    rows = _flagged(spark, path, sep)
    names = rows.columns[:-2]
    return rows.where(_too_many(sep, names)).select(F.col("_file").alias("file"), F.col("_line").alias("line"))


def rows_as_json(rows: DataFrame) -> DataFrame:
    """Each row as JSON text: absent values left out, decimals as numbers, ISO times."""
    plain = [
        F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f"`{f.name}`")
        for f in rows.schema.fields
    ]
    iso = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss"}
    return rows.select(F.to_json(F.struct(*plain), iso).alias("raw_content"))


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("raw_content")).where(F.length("raw_content") > 0)


def read_cdr_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines that already carry the CDR envelope."""
    return spark.read.schema(CDR).json(path)


def read_whole_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """One record per file."""
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    return reader.text(path, wholetext=True).select(F.col("value").alias("raw_content"), F.col("_metadata.file_path").alias("file"))


def modelling_records(
    spark: SparkSession, path: str, fmt: str, source: str, team: str, landed_at: Column, sep: str = ","
) -> DataFrame:
    """A local file as evidence records; ``fmt`` is csv, json, xml or cdr."""
    if fmt == "cdr":
        return read_cdr_lines(spark, path)
    if fmt == "xml":
        raw, kind = read_whole_files(spark, path).select("raw_content"), "application/xml"
    elif fmt == "csv":
        raw, kind = rows_as_json(read_delimited(spark, path, sep)), "application/json"
    elif fmt == "json":
        raw, kind = read_json_lines(spark, path), "application/json"
    else:
        raise ValueError(f"unknown format {fmt!r}")
    records = envelope(raw, F.lit(source), F.lit(team), landed_at, kind)
    # These ids join source and hash with an underscore.
    return records.withColumn("_id", F.concat(F.lit(source + "_"), F.md5("raw_content")))


def table_records(
    rows: DataFrame, database: str, table: str, team: str, landed_millis: Column, version: str = VERSION
) -> DataFrame:
    """Database rows as evidence records.

    The id carries a content hash besides the time, so rows read in the same
    millisecond stay apart.
    """
    source = f"{database}-{table}"
    mark = F.concat(landed_millis.cast("string"), F.lit("_"), F.md5("raw_content"))
    return (
        envelope(rows_as_json(rows), F.lit(source), F.lit(team), F.floor(landed_millis / 1000))
        .withColumn("_id", F.concat(F.lit(f"{database}_{table}_"), mark))
        .withColumn("url", F.concat(F.lit(f"{URL_BASE}{database}/{table}/"), mark))
        .withColumn("version", F.lit(version))
    )


def read_jdbc(spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int, parts: int, **options: str) -> DataFrame:
    """A database table read in ranges of one numeric column."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=parts)
        .options(**options)
        .load()
    )


def import_sequence(spark: SparkSession, path: str) -> DataFrame:
    """Old keyed-JSON sequence files (globs allowed) as ``(key, json)``; import only."""
    pairs = spark.sparkContext.sequenceFile(path)
    return spark.createDataFrame(pairs, "key string, json string")
