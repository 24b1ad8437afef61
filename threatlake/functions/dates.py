"""Time columns. Days and epochs are UTC and do not depend on the session zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400


def epoch_day(epoch_seconds: Column) -> Column:
    """UTC calendar day of an epoch-seconds column."""
    return F.date_from_unix_date(F.floor(epoch_seconds / SECONDS_PER_DAY).cast("int"))


def day_start(day: dt.date) -> int:
    """Epoch seconds at which a UTC day starts."""
    return (day - dt.date(1970, 1, 1)).days * SECONDS_PER_DAY


def ntz_epoch(ts: Column) -> Column:
    """Epoch seconds of a zone-less timestamp read as UTC."""
    ts = ts.cast("timestamp_ntz")
    return (
        F.unix_date(F.to_date(ts)).cast("bigint") * SECONDS_PER_DAY
        + F.hour(ts) * 3600
        + F.minute(ts) * 60
        + F.floor(F.second(ts))
    )


def parse_event_time(text: Column) -> Column:
    """First 19 characters, ``T`` or a space between day and time; null if they do not fit."""
    head = F.substring(text, 1, 19)
    fits = F.regexp_like(head, F.lit(r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}$"))
    return F.when(fits, head.try_cast("timestamp_ntz"))


def event_time(occurred: Column, detected: Column) -> Column:
    """Time of an event: when it occurred, else when it was detected."""
    return parse_event_time(F.coalesce(occurred, detected))


def offset_epoch_millis(text: Column) -> Column:
    """Epoch milliseconds (whole seconds) of an ISO time with ``Z`` or an offset.

    Both ``+02:00`` and ``+0200`` are read; the offset is subtracted.
    """
    text = F.trim(text)
    parsed = F.coalesce(
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")),
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ssXX")),
    )
    return F.unix_seconds(parsed) * 1000


def week_of_month(day: Column) -> Column:
    return F.ceil(F.dayofmonth(day) / 7).cast("int")


def parse_tweet_time(text: Column) -> Column:
    """Parse ``Wed Jan 03 10:00:00 +0000 2024``.

    The weekday is skipped, since the parser has no pattern letter for it in
    this position that is safe across locales.
    """
    return F.try_to_timestamp(F.substring(text, 5, 30), F.lit("MMM dd HH:mm:ss xx yyyy"))


def format_tweet_time(ts: Column) -> Column:
    """Render as ``Wed Jan 03 10:00:00 UTC 2024``."""
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), ts.cast("timestamp_ntz"))
    return F.date_format(utc, "EEE MMM dd HH:mm:ss 'UTC' yyyy")


def first_dates(*fields: Column) -> Column:
    """First non-empty date list by priority; each field is an array of dates."""
    return F.coalesce(*[F.when(F.size(f) > 0, f) for f in fields])
