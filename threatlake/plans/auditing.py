"""Queries of the feed audit."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import audit
from ..operators.publish import expired_aliases, unnamed_snapshots
from ..session import scratch_path
from . import views as v
from .daily import saved_reports
from .registry import query

AS_OF = v.AS_OF
# Stand-ins for the feed policy, named after the feeds of the evidence view.
POLICY = {"excluded": ["hg-3", "asu-4"], "zero_tolerant": ["isi-5", "ruhr-6"], "highlighted": ["hg-7", "armstrong-8"]}

FACTS = """facts AS (SELECT source_name, day AS d, count(*) AS c FROM cdr GROUP BY 1, 2),
spans AS (SELECT source_name, min(d) AS lo, CAST(sum(c) AS BIGINT) AS total FROM facts GROUP BY 1)"""

# One row per feed and history day; the second week only for feeds seen by its last day.
RUNS = """
spine AS (SELECT source_name, lo, total, CAST(as_of - CAST(b AS INTEGER) AS DATE) AS d, b
          FROM spans, day_of_report, range(0, 14) AS r(b) WHERE b <= 6 OR lo <= as_of - 7),
hist AS (SELECT s.source_name, s.b, coalesce(f.c, 0) AS c FROM spine s LEFT JOIN facts f ON f.source_name = s.source_name AND f.d = s.d),
islands AS (SELECT source_name, b, c, sum(CASE WHEN c <> 0 THEN 1 ELSE 0 END) OVER (PARTITION BY source_name ORDER BY b) AS g FROM hist WHERE b > 0),
island_runs AS (SELECT source_name, g, count(*) AS n FROM islands WHERE c = 0 GROUP BY 1, 2),
runs AS (SELECT s.source_name, CAST(coalesce(max(r.n), 0) AS BIGINT) AS longest_run,
                CAST(coalesce(max(CASE WHEN r.g = 0 THEN r.n END), 0) + 1 AS BIGINT) AS leading_run
         FROM spans s LEFT JOIN island_runs r ON r.source_name = s.source_name GROUP BY 1),
now AS (SELECT source_name, c AS today FROM hist WHERE b = 0)"""
HISTORY = f"day_of_report AS (SELECT DATE '2024-01-30' AS as_of), {FACTS}, {RUNS}"
USER_HISTORY = f"day_of_report AS (SELECT DATE '2024-01-31' AS as_of), {FACTS.replace('FROM cdr', 'FROM user_cdr')}, {RUNS}"

REPORT_COLUMNS = """source_name, max(CASE WHEN c > 0 THEN d END) AS last_day,
    CAST(coalesce(sum(CASE WHEN d = DATE '2024-01-30' THEN c END), 0) AS BIGINT) AS count_downloaded_today""" + "".join(
    f""",
    CAST(coalesce(sum(CASE WHEN d = DATE '2024-01-30' - {k} THEN c END), 0) AS BIGINT) AS count_today_minus_{k}""" for k in range(1, 7)
)


def facts(spark, sf) -> DataFrame:
    return audit.daily_counts(v.cdr(spark, sf))


def _text(column: str):
    return F.date_format(column, "yyyy-MM-dd").alias(column)


def _policy(spark) -> DataFrame:
    return audit.source_policy(spark, **POLICY)


@query("audit_daily_counts", "cdr", """
SELECT source_name, strftime(day, '%Y-%m-%d') AS date_of_pull, count(*) AS count_downloaded FROM cdr GROUP BY 1, 2""")
def audit_daily_counts(spark, sf):
    return facts(spark, sf).select("source_name", _text("date_of_pull"), "count_downloaded")


@query("audit_recent_recount", "cdr", """
SELECT source_name, strftime(day, '%Y-%m-%d') AS date_of_pull, count(*) AS count_downloaded FROM cdr
WHERE day IN (DATE '2024-01-30', DATE '2024-01-29') GROUP BY 1, 2""")
def audit_recent_recount(spark, sf):
    return audit.recent_counts(v.cdr(spark, sf), AS_OF).select("source_name", _text("date_of_pull"), "count_downloaded")


@query("audit_first_last_day", "cdr", """
SELECT source_name, strftime(min(day), '%Y-%m-%d') AS first_day, strftime(max(day), '%Y-%m-%d') AS last_day, count(DISTINCT day) AS active_days
FROM cdr GROUP BY 1""")
def audit_first_last_day(spark, sf):
    rows = facts(spark, sf).where(F.col("count_downloaded") > 0)
    return rows.groupBy("source_name").agg(
        F.min("date_of_pull").cast("string").alias("first_day"), F.max("date_of_pull").cast("string").alias("last_day"),
        F.count("*").alias("active_days"),
    )


@query("audit_overwrite_days", "cdr", """
SELECT source_name, strftime(day, '%Y-%m-%d') AS date_of_pull, count(*) AS count_downloaded FROM cdr GROUP BY 1, 2""")
def audit_overwrite_days(spark, sf):
    """Backfill up to the day before, then the two-day recount over it: together every day once."""
    path, records = scratch_path(spark, "audit"), v.cdr(spark, sf)
    audit.write_counts(audit.counts_before(records, AS_OF), path)
    audit.write_counts(audit.recent_counts(records, AS_OF), path)
    return spark.read.parquet(path).select("source_name", _text("date_of_pull"), "count_downloaded")


@query("audit_report", "cdr", f"""
WITH {FACTS}
SELECT r.* EXCLUDE (last_day), strftime(last_day, '%Y-%m-%d') AS last_date_of_pull,
       CASE WHEN lo = DATE '2024-01-30' THEN '-' ELSE CAST(CAST(trunc(total / date_diff('day', lo, DATE '2024-01-30')) AS BIGINT) AS VARCHAR) END AS average
FROM (SELECT {REPORT_COLUMNS} FROM facts GROUP BY 1) r JOIN spans USING (source_name)""")
def audit_report(spark, sf):
    return audit.report(facts(spark, sf), AS_OF).withColumns(
        {
            "last_date_of_pull": F.date_format("last_date_of_pull", "yyyy-MM-dd"),
            "average": F.coalesce(F.col("average").cast("string"), F.lit("-")),
        }
    )


@query("audit_median", "cdr", f"""
WITH {FACTS},
days AS (SELECT source_name, unnest(generate_series(lo, DATE '2024-01-30', INTERVAL 1 DAY))::DATE AS d FROM spans)
SELECT source_name, quantile_cont(coalesce(c, 0), 0.5) AS median FROM days LEFT JOIN facts USING (source_name, d) GROUP BY 1""")
def audit_median(spark, sf):
    return audit.medians(facts(spark, sf), AS_OF)


@query("audit_full_report", "cdr", f"""
WITH {FACTS},
days AS (SELECT source_name, unnest(generate_series(lo, DATE '2024-01-30', INTERVAL 1 DAY))::DATE AS d FROM spans),
med AS (SELECT source_name, CAST(floor(quantile_cont(coalesce(c, 0), 0.5)) AS BIGINT) AS median FROM days LEFT JOIN facts USING (source_name, d) GROUP BY 1)
SELECT source_name, CAST(coalesce(t.c, 0) AS BIGINT) AS count_downloaded_today, median, '2024-01-30' AS date_of_pull
FROM spans JOIN med USING (source_name) LEFT JOIN (SELECT source_name, c FROM facts WHERE d = DATE '2024-01-30') t USING (source_name)""")
def audit_full_report(spark, sf):
    return audit.full_report(facts(spark, sf), AS_OF).select("source_name", "count_downloaded_today", "median", _text("date_of_pull"))


@query("audit_saved_reports", "cdr", f"""
WITH {FACTS},
d AS (SELECT unnest([DATE '2024-01-30', DATE '2024-01-23']) AS day),
known AS (SELECT DISTINCT day, source_name FROM d JOIN facts f ON f.d <= day)
SELECT strftime(day, '%Y-%m-%d') AS date_of_pull, k.source_name, CAST(coalesce(c, 0) AS BIGINT) AS count_downloaded_today
FROM known k LEFT JOIN facts f ON f.source_name = k.source_name AND f.d = day""")
def audit_saved_reports(spark, sf):
    """Reports saved day by day; those of a day and of the week before are read back, the others' folders are not."""
    out, every = scratch_path(spark, "reports"), facts(spark, sf)
    for back in (0, 3, 7):
        day = AS_OF - dt.timedelta(days=back)
        rows = audit.full_report(every.where(F.col("date_of_pull") <= F.lit(day)), day)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date_of_pull").parquet(f"{out}/report")
    return saved_reports(spark, out, AS_OF).select(_text("date_of_pull"), "source_name", "count_downloaded_today")


@query("audit_zero_runs", "cdr", f"""
WITH {HISTORY}
SELECT source_name, CAST(today AS BIGINT) AS today, longest_run, CASE WHEN today = 0 THEN leading_run ELSE 0 END AS current_run
FROM runs JOIN now USING (source_name)""")
def audit_zero_runs(spark, sf):
    return audit.zero_runs(audit.history(facts(spark, sf), AS_OF)).select("source_name", "today", "longest_run", "current_run")


@query("audit_alerts", "user_cdr", f"""
WITH {USER_HISTORY}
SELECT source_name, CASE WHEN source_name LIKE 'hg-%' THEN 'hg' WHEN source_name LIKE 'asu-%' THEN 'asu' WHEN source_name LIKE 'ruhr-%' THEN 'ruhr'
            WHEN source_name LIKE 'armstrong%' THEN 'armstrong' ELSE 'isi' END AS owner,
       CAST(trunc(total / date_diff('day', lo, as_of)) AS BIGINT) AS average, leading_run AS current_run, longest_run,
       source_name IN ('hg-7', 'armstrong-8') AS highlighted
FROM runs JOIN now USING (source_name) JOIN spans USING (source_name), day_of_report
WHERE today = 0 AND lo < as_of AND trunc(total / date_diff('day', lo, as_of)) <> 0 AND leading_run > longest_run
  AND source_name NOT IN ('hg-3', 'asu-4', 'isi-5', 'ruhr-6')""")
def audit_alerts(spark, sf):
    """The alert rule on the day after the last pull, over one feed per user."""
    counts = audit.daily_counts(v.user_cdr(spark, sf))
    return audit.alerts(counts, _policy(spark), AS_OF + dt.timedelta(days=1))


@query("audit_team_alerts", "cdr", """
WITH facts AS (SELECT team AS source_name, raw_content::JSON ->> 'targetSystem' AS s, day AS d, count(*) AS c FROM cdr GROUP BY 1, 2, 3),
spans AS (SELECT source_name || '-' || coalesce(s, 'none') AS source_name, min(d) AS lo, CAST(sum(c) AS BIGINT) AS total FROM facts GROUP BY 1),
f AS (SELECT source_name || '-' || coalesce(s, 'none') AS source_name, d, c FROM facts),
h AS (SELECT s.source_name, s.lo, s.total, b, coalesce(c, 0) AS c
      FROM (SELECT *, unnest(range(0, 14)) AS b FROM spans) s LEFT JOIN f ON f.source_name = s.source_name AND f.d = DATE '2024-01-30' - CAST(b AS INTEGER)
      WHERE b <= 6 OR lo <= DATE '2024-01-23'),
lead AS (SELECT source_name, min(CASE WHEN c <> 0 THEN b END) AS first_hit, max(b) AS last_b, any_value(lo) AS lo, any_value(total) AS total,
                string_agg(CASE WHEN c = 0 THEN '0' ELSE '1' END, '' ORDER BY b) AS bits FROM h GROUP BY 1)
SELECT source_name, CAST(coalesce(first_hit, last_b + 1) AS BIGINT) AS current_run,
       CAST(list_max(list_transform(string_split(bits[2:], '1'), lambda x: length(x))) AS BIGINT) AS longest_run
FROM lead WHERE bits[1] = '0' AND lo < DATE '2024-01-30' AND total >= date_diff('day', lo, DATE '2024-01-30')
  AND coalesce(first_hit, last_b + 1) > list_max(list_transform(string_split(bits[2:], '1'), lambda x: length(x)))""")
def audit_team_alerts(spark, sf):
    """The alert rule over busier feeds: one per team and target system."""
    system = F.coalesce(F.try_variant_get(F.try_parse_json("raw_content"), "$.targetSystem", "string"), F.lit("none"))
    records = v.cdr(spark, sf).withColumn("source_name", F.concat_ws("-", "team", system))
    rows = audit.alerts(audit.daily_counts(records), _policy(spark), AS_OF)
    return rows.select("source_name", "current_run", "longest_run")


@query("audit_week_on_week", "cdr", f"""
WITH {FACTS}
SELECT s.source_name, CAST(coalesce(t.c, 0) AS BIGINT) AS count_downloaded_today,
       CASE WHEN s.lo <= DATE '2024-01-23' THEN CAST(coalesce(w.c, 0) AS BIGINT) ELSE -1 END AS count_week_ago
FROM spans s LEFT JOIN facts t ON t.source_name = s.source_name AND t.d = DATE '2024-01-30'
LEFT JOIN facts w ON w.source_name = s.source_name AND w.d = DATE '2024-01-23'""")
def audit_week_on_week(spark, sf):
    rows = audit.week_on_week(facts(spark, sf), AS_OF)
    return rows.select("source_name", "count_downloaded_today", F.coalesce("count_week_ago", F.lit(-1)).alias("count_week_ago"))


@query("audit_silent_feeds", "cdr", """
SELECT DISTINCT source_name FROM cdr WHERE source_name NOT IN (SELECT source_name FROM cdr WHERE day = DATE '2024-01-30')""")
def audit_silent_feeds(spark, sf):
    records = v.cdr(spark, sf)
    return audit.silent_feeds(records, records, AS_OF)


@query("snapshot_shrink", "snap", """
SELECT doc_type, strftime(snapshot, '%Y-%m-%d') AS snapshot, bytes, strftime(ps, '%Y-%m-%d') AS previous_snapshot, pb AS previous_bytes FROM (
    SELECT *, lag(snapshot) OVER w AS ps, lag(bytes) OVER w AS pb FROM (
        SELECT *, row_number() OVER (PARTITION BY doc_type ORDER BY snapshot DESC) AS place FROM snap) WHERE place <= 10
    WINDOW w AS (PARTITION BY doc_type ORDER BY snapshot)) WHERE bytes < pb""")
def snapshot_shrink(spark, sf):
    rows = audit.shrunk_snapshots(v.snapshots(spark, sf))
    return rows.select("doc_type", _text("snapshot"), "bytes", _text("previous_snapshot"), "previous_bytes")


@query("snapshot_expired_aliases", "snap", """
SELECT DISTINCT alias, strftime(CAST(alias[6:] AS DATE), '%Y-%m-%d') AS day FROM snap
WHERE alias <> 'data-latest-5' AND date_diff('day', TRY_CAST(alias[6:] AS DATE), DATE '2024-01-30') >= 7""")
def snapshot_expired_aliases(spark, sf):
    return expired_aliases(v.snapshots(spark, sf), AS_OF).select("alias", _text("day"))


@query("snapshot_unnamed", "snap", """
SELECT DISTINCT strftime(snapshot, '%Y-%m-%d') AS snapshot FROM snap
WHERE alias <> 'data-latest-5' AND snapshot <= DATE '2024-01-23'""")
def snapshot_unnamed(spark, sf):
    """Snapshots left without an alias once the expired ones are gone."""
    catalog = v.snapshots(spark, sf)
    kept = catalog.join(expired_aliases(catalog, AS_OF).select("alias"), "alias", "left_anti")
    return unnamed_snapshots(catalog, kept).select(_text("snapshot"))
