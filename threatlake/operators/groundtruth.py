"""Analytics over ground-truth attack events.

Lists are unfolded with the outer generators and filtered after: the inner ones
have the planner test each list's size on a second copy of its expression.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import event_time, parse_event_time
from ..functions.ids import address_host
from ..functions.text import is_email, numbered_user
from .numbering import number_rows

# Fixed value: the one event type that stands in for another in a series.
DESTINATION = "malicious-destination"
URL_EVENT = "malicious-url"
EMAIL_EVENT = "malicious-email"
UNKNOWN = "unknown"
SERIES_TYPES = ("endpoint-malware", EMAIL_EVENT, DESTINATION)


def _empty(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def _time() -> Column:
    return event_time(F.col("occurred"), F.col("detected"))


def events_per_day(events: DataFrame) -> DataFrame:
    """Events per day, days as ``yyyy/MM/dd``; events without a readable time are left out."""
    timed = events.select(_time().alias("t")).where(F.col("t").isNotNull())
    return timed.groupBy(F.date_format("t", "yyyy/MM/dd").alias("day")).agg(F.count("*").alias("n"))


def events_per_type_day(events: DataFrame) -> DataFrame:
    timed = events.select("event_type", _time().alias("t")).where(F.col("t").isNotNull())
    return timed.groupBy("event_type", F.date_format("t", "yyyy/MM/dd").alias("day")).agg(F.count("*").alias("n"))


def totals_per_type(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(F.count("*").alias("n"))


def series_type(company: Column, event_type: Column, url_companies: list[str]) -> Column:
    """Event type as a series: some companies report destinations as urls."""
    swaps = company.isin(*url_companies) if url_companies else F.lit(False)
    return (
        F.when(swaps & (event_type == URL_EVENT), F.lit(DESTINATION))
        .when(swaps & (event_type == DESTINATION), F.lit(None))
        .otherwise(event_type)
    )


def daily_series(events: DataFrame, url_companies: list[str] = ()) -> DataFrame:
    """Events per company, series and day, with every day between first and last.

    ``events`` has ``company``, ``event_type`` and ``occurred``. Counting comes
    first; the days are then filled from the first and last day of each series.
    """
    day = F.to_date(parse_event_time(F.col("occurred")))
    kind = series_type(F.col("company"), F.col("event_type"), list(url_companies))
    counted = (
        events.select("company", kind.alias("event_type"), day.alias("date"))
        .where(F.col("date").isNotNull() & F.col("event_type").isin(*SERIES_TYPES))
        .groupBy("company", "event_type", "date")
        .agg(F.count("*").alias("count"))
    )
    spine = counted.groupBy("company", "event_type").agg(F.min("date").alias("lo"), F.max("date").alias("hi")).select(
        "company", "event_type", F.explode(F.sequence("lo", "hi")).alias("date")
    )
    return spine.join(counted, ["company", "event_type", "date"], "left").withColumn("count", F.coalesce("count", F.lit(0)))


def write_series(series: DataFrame, folder: str) -> None:
    """JSON lines without the empty days, and CSV with all of them, per company and type."""
    days = series.withColumn("date", F.date_format("date", "yyyy-MM-dd"))
    days.where(F.col("count") != 0).write.mode("overwrite").partitionBy("company").json(f"{folder}/jl")
    days.repartitionByRange("company", "event_type", "date").sortWithinPartitions("company", "event_type", "date").write.mode(
        "overwrite"
    ).partitionBy("company", "event_type").csv(f"{folder}/csv", header=True)


def sensor_counts(events: DataFrame) -> DataFrame:
    """Events per sensor label.

    The label is the detector with its classification, else each sensor of the
    event details with its own.
    """
    tail = F.when(F.col("classification_text").isNotNull(), F.concat(F.lit(": "), "classification_text")).otherwise(F.lit(""))
    direct = F.concat(F.coalesce("detector", F.lit(UNKNOWN)), tail)
    details = F.transform(
        F.filter(F.coalesce("event_details", _empty("struct<sensor:string,sensor_classification:string>")), lambda d: d["sensor"].isNotNull()),
        lambda d: F.concat_ws(": ", d["sensor"], d["sensor_classification"]),
    )
    named = F.col("detector").isNotNull() | F.col("classification_text").isNotNull()
    return (
        events.select(F.explode_outer(F.when(named, F.array(direct)).otherwise(details)).alias("sensor"))
        .where(F.col("sensor").isNotNull())
        .groupBy("sensor")
        .agg(F.count("*").alias("n"))
    )


def target_counts(events: DataFrame) -> DataFrame:
    """Events per target.

    Targets are the target entities; ``unknown`` with only an organization; the
    named users of the target list otherwise. ``user_number`` is set for targets
    of that list that are already numbered users.
    """
    users = F.transform(
        F.filter(F.coalesce("targets", _empty("struct<identity_class:string,name:string>")), lambda t: t["identity_class"] == "user"),
        lambda t: F.struct(t["name"].alias("target"), numbered_user(t["name"]).alias("user_number")),
    )
    listed = F.coalesce("target_entity", F.when(F.col("target_organization").isNotNull(), F.array(F.lit(UNKNOWN))))
    plain = F.transform(listed, lambda t: F.struct(t.alias("target"), F.lit(None).cast("bigint").alias("user_number")))
    rows = events.select(F.inline_outer(F.coalesce(plain, users))).where(F.col("target").isNotNull())
    return rows.groupBy("target", "user_number").agg(F.count("*").alias("n"))


def anonymous_targets(counts: DataFrame) -> DataFrame:
    """Targets renamed ``email1…`` and ``user1…`` in name order; numbered users keep their number."""
    kind = F.when(F.col("user_number").isNotNull(), "numbered").when(is_email(F.col("target")), "email").otherwise("user")
    numbered = number_rows(counts.withColumn("kind", kind), ["kind"], ["target"], "place")
    label = F.when(F.col("kind") == "numbered", F.concat(F.lit("user"), "user_number")).otherwise(F.concat("kind", "place"))
    return numbered.select("kind", label.alias("label"), "n")


def recipient_counts(events: DataFrame) -> DataFrame:
    recipients = events.select(F.explode_outer("target_entity").alias("recipient")).where(F.col("recipient").isNotNull())
    return recipients.groupBy("recipient").agg(F.count("*").alias("n"))


def email_host_days(events: DataFrame) -> DataFrame:
    """Distinct days per host that malicious e-mail came from.

    Pairs are made distinct first, so a list holds one entry per calendar day at most.
    """
    hosts = (
        events.where(F.col("event_type") == EMAIL_EVENT)
        .select(F.date_format(_time(), "yyyy/MM/dd").alias("day"), F.explode_outer("addresses").alias("a"))
        .select(address_host(F.col("a.url"), F.col("a.ip")).alias("host"), "day")
        .where(F.col("host").isNotNull() & F.col("day").isNotNull())
        .distinct()
    )
    return hosts.groupBy("host").agg(F.array_sort(F.collect_list("day")).alias("days"))


def _pairs(name: str, values: Column) -> Column:
    return F.transform(
        F.coalesce(values, _empty("string")),
        lambda v: F.struct(F.lit(name).alias("attribute"), v.alias("value")),
    )


# The attributes of the histograms.
ATTRIBUTES = [
    "target_entity",
    "email_sender",
    "addresses_ip",
    "addresses_url",
    "email_subject",
    "files_filename",
    "threat_actor",
    "threat_designation_family",
    "threat_designation_type",
    "attack_method",
    "detector_classification",
]


def attribute_values(events: DataFrame) -> DataFrame:
    """``(attribute, value, occurred)`` for all histogram attributes, in one pass."""
    columns = {
        "addresses_ip": F.col("addresses.ip"),
        "addresses_url": F.col("addresses.url"),
        "email_subject": F.array("email_subject"),
        "files_filename": F.col("files"),
    }
    pairs = F.concat(*[_pairs(name, columns[name] if name in columns else F.col(name)) for name in ATTRIBUTES])
    return events.select("occurred", F.inline_outer(pairs)).where(F.col("value").isNotNull()).select("attribute", "value", "occurred")


def value_occurrences(values: DataFrame) -> DataFrame:
    """Times at which each value occurred, with how often.

    One row per distinct time instead of one list per value: a value that most
    events share would not fit a list, and repeats combine before the shuffle.
    """
    return values.groupBy("attribute", "value", "occurred").agg(F.count("*").alias("times"))


def value_counts(values: DataFrame) -> DataFrame:
    return values.groupBy("attribute", "value").agg(F.count("*").alias("n"))


def anonymous_values(counts: DataFrame) -> DataFrame:
    """Values renamed ``attribute_1…`` in value order within their attribute."""
    numbered = number_rows(counts, ["attribute"], ["value"], "place")
    return numbered.select("attribute", F.concat(F.lit("attribute_"), "place").alias("label"), "n")


def count_histogram(counts: DataFrame) -> DataFrame:
    """How many values were seen ``n`` times."""
    return counts.groupBy("attribute", "n").agg(F.count("*").alias("values_seen"))


def write_histograms(values: DataFrame, folder: str) -> None:
    """Occurrences, anonymous counts and the histogram of counts as CSV, by attribute."""
    counts = value_counts(values)
    outputs = {
        "occurrences": value_occurrences(values).repartitionByRange("attribute", "value", "occurred").sortWithinPartitions(
            "attribute", "value", "occurred"
        ),
        "times_value_seen": anonymous_values(counts),
        "values_seen": count_histogram(counts).repartitionByRange("attribute", "n").sortWithinPartitions("attribute", "n"),
    }
    for name, rows in outputs.items():
        rows.write.mode("overwrite").partitionBy("attribute").csv(f"{folder}/{name}", header=True)


INDICATORS = ["email_sender", "addresses_ip", "addresses_url", "email_subject", "files_filename"]


def latest_indicators(events: DataFrame, *order: str) -> DataFrame:
    """Per indicator value, the time given by the last event in file order."""
    place = F.struct(*(order or ("file", "place")))
    values = attribute_values_with(events, place).where(F.col("attribute").isin(*INDICATORS))
    return values.groupBy("attribute", "value").agg(F.max_by("occurred", "at").alias("occurred"))


def attribute_values_with(events: DataFrame, place: Column) -> DataFrame:
    """``attribute_values`` with the place of the event."""
    return attribute_values(events.withColumn("occurred", F.struct(F.col("occurred").alias("occurred"), place.alias("at")))).select(
        "attribute", "value", "occurred.occurred", "occurred.at"
    )


def concat_event_tables(*tables: DataFrame) -> DataFrame:
    """Event tables whose columns differ, one below the other."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
