"""The streaming jobs, run over the driver tables to their end; each equals a batch result."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.mapping import statements
from ..operators.state import read_increments, read_state
from ..session import scratch_path
from ..sources.feeds import FEEDS
from ..sources.landing import import_partitions
from ..streaming import jobs
from . import linked
from . import views as v
from .registry import query

#: Days from here on come first.
SECOND_WAVE = "2024-01-16"


def _whole(sf: str, name: str) -> str:
    """A table's path as a glob of one name, which a stream takes for a file and for a folder of files."""
    return f"{sf}/{name}.parque[t]"


def _day():
    day = F.date_from_unix_date(F.floor(F.unix_seconds("day") / 86400).cast("int"))
    return F.date_format(day, "yyyy-MM-dd").alias("date_of_pull")


def _events(spark, sf):
    schema = v.table(spark, sf, "events").schema
    return _numbered(jobs.stream_files(spark, _whole(sf, "events"), schema))


def _numbered(rows):
    return rows.withColumn("k", F.regexp_extract("props", r"([0-9]+)", 1).cast("int"))


def _records(rows):
    return v.event_records(rows).withColumn("ts", F.timestamp_seconds("timestamp"))


@query("stream_daily_counts", "cdr", """
SELECT source_name, strftime(day, '%Y-%m-%d') AS date_of_pull, count(*) AS count_downloaded FROM cdr GROUP BY 1, 2""")
def stream_daily_counts(spark, sf):
    out = scratch_path(spark, "stream-counts")
    job = jobs.daily_count_stream(_records(_events(spark, sf)), out, out + "-checkpoint")
    return jobs.run(job, lambda: jobs.latest_counts(spark, out)).select("source_name", _day(), "count_downloaded")


@query("stream_late_rows", "cdr", f"""
WITH days AS (SELECT source_name, CAST(day AS DATE) AS d FROM cdr), cut AS (SELECT max(d) AS newest FROM days)
SELECT source_name, strftime(d, '%Y-%m-%d') AS date_of_pull, count(*) AS count_downloaded,
       d < DATE '{SECOND_WAVE}' AND date_diff('day', d, newest) > {jobs.LATE_DAYS} AS late FROM days, cut GROUP BY 1, 2, 4""")
def stream_late_rows(spark, sf):
    """Two pulls, the older days second: what is too late is counted aside, and the sum is the input."""
    landing, out = scratch_path(spark, "waves"), scratch_path(spark, "stream-waves")
    events = v.table(spark, sf, "events")
    first = F.col("ts") >= F.lit(SECOND_WAVE).cast("timestamp")
    for wave, rows in enumerate((events.where(first), events.where(~first))):
        rows.write.parquet(f"{landing}/wave-{wave}")
        records = _records(_numbered(jobs.stream_files(spark, f"{landing}/*", events.schema)))
        jobs.run(jobs.daily_count_stream(records, out, out + "-checkpoint"), lambda: None)
    parts = [c.withColumn("late", F.lit(late)) for late, c in ((False, jobs.latest_counts(spark, out)), (True, jobs.late_counts(spark, out)))]
    return parts[0].unionByName(parts[1]).select("source_name", _day(), "count_downloaded", "late")


@query("stream_first_seen", "cdr", "SELECT DISTINCT _id FROM cdr")
def stream_first_seen(spark, sf):
    """Each id once."""
    out = scratch_path(spark, "stream-first")
    job = jobs.first_seen_stream(_records(_events(spark, sf)).select("_id", "source_name"), out, out + "-checkpoint")
    return jobs.run(job, lambda: read_increments(spark, out).select("_id"))


@query("stream_landing", "", """
SELECT 'hackmageddon/' || md5(props) AS _id, count(*) AS n FROM events GROUP BY 1""")
def stream_landing(spark, sf):
    """Landed lines picked up by the landing job, page by page."""
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "stream-cdr")
    v.table(spark, sf, "events").select("props").write.text(landing)
    job = jobs.land_stream(spark, landing, FEEDS["hackmageddon"], 1706572800, out, out + "-checkpoint", per_trigger=1)
    landed = jobs.run(job, lambda: import_partitions(spark, out))
    return landed.groupBy("_id").agg(F.count("*").alias("n"))


@query("stream_upsert", "stm", f"""SELECT {linked.STATEMENTS} FROM stm WHERE "type" = 'Customer'""")
def stream_upsert(spark, sf):
    """Customer records mapped and merged as a stream."""
    schema = v.table(spark, sf, "customer").schema
    rows = jobs.stream_files(spark, _whole(sf, "customer"), schema)
    records = rows.select(
        F.lit("crm").alias("source_name"), F.lit("crm").alias("model"), F.try_parse_json(F.to_json(F.struct("*"))).alias("json_rep")
    )
    root = scratch_path(spark, "stream-state")
    job = jobs.upsert_stream(statements(records, v.sales_models()), root, root + "-checkpoint", buckets=8)
    return linked._as_text(jobs.run(job, lambda: read_state(spark, root)))
