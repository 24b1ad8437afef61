"""Table contracts."""

from __future__ import annotations

from pyspark.sql import types as T

CDR_COLUMNS = [
    "_id",
    "timestamp",
    "raw_content",
    "content_type",
    "url",
    "version",
    "team",
    "source_name",
]

# `timestamp` is epoch seconds, kept as a long so that it outlives 2038.
CDR = T.StructType(
    [T.StructField(c, T.LongType() if c == "timestamp" else T.StringType()) for c in CDR_COLUMNS]
)

CDR_PARTITIONS = ["year", "month"]

STATEMENT_COLUMNS = [
    "uri",
    "type",
    "property",
    "value",
    "object_uri",
    "source",
    "publisher",
    "dateRecorded",
    "observedDate",
]

STATEMENT = T.StructType(
    [
        T.StructField(c, T.DateType() if c in ("dateRecorded", "observedDate") else T.StringType())
        for c in STATEMENT_COLUMNS
    ]
)

# The fields that say where a statement came from.
PROVENANCE = ["source", "publisher", "dateRecorded", "observedDate"]

AUDIT_FACT = "source_name string, count_downloaded bigint, date_of_pull date"

SNAPSHOT = "snapshot date, doc_type string, rows bigint, bytes bigint, alias string"
