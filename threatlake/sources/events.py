"""Ground-truth event folders: two outer layouts, scalar-or-list fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.json import as_array, is_array, json_list, json_text, strings_at
from .files import read_whole_files


def read_event_files(spark: SparkSession, folder: str) -> DataFrame:
    """Events of all ``.json`` files of a folder, with file and place in it."""
    return explode_events(read_whole_files(spark, folder, "*.json"))


def _layouts(rep: Column) -> tuple[Column, Column]:
    """The events of a document by either layout; null where it has another."""
    listed = F.try_variant_get(rep, "$.events", "array<variant>")
    whole = F.try_variant_get(rep, "$", "array<variant>")
    return listed, F.transform(whole, lambda e: F.try_variant_get(e, "$.ground_truth", "variant"))


def event_quarantine(docs: DataFrame) -> DataFrame:
    """Files without events, ``(file, bytes, reason)``: text no parser takes, or another layout.

    A file is held back too where some of its list are not events; ``lost`` counts them.
    """
    parsed = docs.select("file", F.octet_length("raw_content").cast("bigint").alias("bytes"), F.try_parse_json("raw_content").alias("rep"))
    listed, wrapped = _layouts(F.col("rep"))
    found = parsed.select("file", "bytes", F.col("rep").isNull().alias("broken"), F.coalesce(listed, wrapped).alias("events"))
    lost = F.size(F.filter("events", lambda e: e.isNull()))
    reason = F.when(F.col("broken"), F.lit("not JSON")).when(F.col("events").isNull(), F.lit("no events")).when(lost > 0, F.lit("not events"))
    rows = found.select("file", "bytes", reason.alias("reason"), F.when(F.col("events").isNull(), F.lit(0)).otherwise(lost).cast("bigint").alias("lost"))
    return rows.where(F.col("reason").isNotNull())


def explode_events(docs: DataFrame) -> DataFrame:
    """One row per event from ``(raw_content, file)``.

    Reads ``{"events": […]}`` and ``[{"ground_truth": {…}}]``; a file in neither
    layout gives no rows here and one in ``event_quarantine``.
    """
    listed, wrapped = _layouts(F.try_parse_json("raw_content"))
    # The outer form: the inner one would parse the text a second time to test for empty lists.
    return docs.select("file", F.posexplode_outer(F.coalesce(listed, wrapped)).alias("place", "event")).where(
        F.col("event").isNotNull()
    )


def _named(rep: Column, path: str, field: str) -> Column:
    """``field`` of each object in a list; objects without it are skipped."""
    found = F.transform(as_array(rep, path), lambda v: F.try_variant_get(v, "$." + field, "string"))
    return F.filter(found, lambda x: x.isNotNull())


def _targets(rep: Column) -> Column:
    """Targets as text; an object with an ip stands for that ip."""
    return F.transform(
        as_array(rep, "$.target_entity"),
        lambda v: F.coalesce(F.try_variant_get(v, "$.ip", "string"), F.try_variant_get(v, "$", "string")),
    )


def typed_events(events: DataFrame) -> DataFrame:
    """Events with every scalar-or-list field as an array."""
    e = F.col("event")

    def text(path: str) -> Column:
        return F.try_variant_get(e, "$." + path, "string")

    classification = F.try_variant_get(e, "$.detector_classification", "variant")
    classes = strings_at(e, "$.detector_classification")
    details = F.flatten(
        F.transform(
            as_array(e, "$.event_details"),
            lambda d: F.coalesce(F.try_variant_get(d, "$", "array<variant>"), F.array(d)),
        )
    )
    return events.select(
        "file",
        "place",
        text("event_type").alias("event_type"),
        text("occurred").alias("occurred"),
        text("detected").alias("detected"),
        _targets(e).alias("target_entity"),
        text("target_organization").alias("target_organization"),
        strings_at(e, "$.email_sender").alias("email_sender"),
        text("email_subject").alias("email_subject"),
        F.transform(
            as_array(e, "$.addresses"),
            lambda v: F.struct(
                F.try_variant_get(v, "$.ip", "string").alias("ip"),
                F.try_variant_get(v, "$.url", "string").alias("url"),
            ),
        ).alias("addresses"),
        _named(e, "$.files", "filename").alias("files"),
        _named(e, "$.threat_actor", "ip").alias("threat_actor"),
        strings_at(e, "$.threat_designation_family").alias("threat_designation_family"),
        strings_at(e, "$.threat_designation_type").alias("threat_designation_type"),
        strings_at(e, "$.attack_method").alias("attack_method"),
        text("detector").alias("detector"),
        classes.alias("detector_classification"),
        F.when(classification.isNull(), F.lit(None))
        .when(is_array(classification), json_list(classes))
        .otherwise(json_text(text("detector_classification")))
        .alias("classification_text"),
        F.transform(
            details,
            lambda d: F.struct(
                F.try_variant_get(d, "$.sensor", "string").alias("sensor"),
                F.try_variant_get(d, "$.sensor_classification", "string").alias("sensor_classification"),
            ),
        ).alias("event_details"),
        F.transform(
            as_array(e, "$.targets"),
            lambda t: F.struct(
                F.try_variant_get(t, "$.identity_class", "string").alias("identity_class"),
                F.try_variant_get(t, "$.name", "string").alias("name"),
            ),
        ).alias("targets"),
    )
