"""Queries of the ground-truth analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import groundtruth as gt
from ..session import scratch_path
from . import views as v
from .registry import query


@query("gt_typed_events", "gt", """
SELECT file, kind AS event_type, coalesce(occurred, '-') AS occurred, CASE event_type WHEN 'error' THEN spaced ELSE '-' END AS detected,
       CASE event_type WHEN 'click' THEN 'user' || user_id WHEN 'view' THEN 'user' || user_id || '@corp.com,desk' || k
                       WHEN 'purchase' THEN '10.1.0.' || user_id ELSE '-' END AS targets,
       CASE WHEN event_type IN ('click', 'view') THEN 's' || k || '@mail.com' ELSE '-' END AS senders,
       CASE event_type WHEN 'click' THEN '["a", "b' || k || '"]' WHEN 'purchase' THEN '["x"]' ELSE '-' END AS classification
FROM gt""")
def gt_typed_events(spark, sf):
    """Both outer layouts and all scalar-or-list fields, as typed columns."""
    dash = F.lit("-")
    return v.ground_truth(spark, sf).select(
        "file", "event_type", F.coalesce("occurred", dash).alias("occurred"), F.coalesce("detected", dash).alias("detected"),
        F.coalesce(F.array_join("target_entity", ","), dash).alias("targets"),
        F.coalesce(F.array_join("email_sender", ","), dash).alias("senders"),
        F.coalesce("classification_text", dash).alias("classification"),
    )


@query("gt_events_per_day", "gt", "SELECT strftime(event_day, '%Y/%m/%d') AS day, count(*) AS n FROM gt WHERE event_day IS NOT NULL GROUP BY 1 ORDER BY 1")
def gt_events_per_day(spark, sf):
    return gt.events_per_day(v.ground_truth(spark, sf)).orderBy("day")


@query("gt_events_per_type_day", "gt", """
SELECT kind AS event_type, strftime(event_day, '%Y/%m/%d') AS day, count(*) AS n FROM gt WHERE event_day IS NOT NULL GROUP BY 1, 2""")
def gt_events_per_type_day(spark, sf):
    return gt.events_per_type_day(v.ground_truth(spark, sf))


@query("gt_totals_per_type", "gt", "SELECT kind AS event_type, count(*) AS n FROM gt GROUP BY 1")
def gt_totals_per_type(spark, sf):
    return gt.totals_per_type(v.ground_truth(spark, sf))


@query("gt_daily_series", "gt", """
WITH s AS (SELECT company, CASE WHEN company = 'globex' AND kind = 'malicious-url' THEN 'malicious-destination' ELSE kind END AS event_type, event_day AS d
           FROM gt WHERE occurred <> 'soon' AND NOT (company = 'globex' AND kind = 'malicious-destination')),
c AS (SELECT company, event_type, d, count(*) AS n FROM s WHERE event_type IN ('endpoint-malware', 'malicious-email', 'malicious-destination') GROUP BY 1, 2, 3),
days AS (SELECT company, event_type, unnest(generate_series(min(d), max(d), INTERVAL 1 DAY))::DATE AS d FROM c GROUP BY 1, 2)
SELECT company, event_type, strftime(d, '%Y-%m-%d') AS "date", coalesce(n, 0) AS "count" FROM days LEFT JOIN c USING (company, event_type, d)""")
def gt_daily_series(spark, sf):
    events = v.ground_truth(spark, sf).withColumn("company", F.split_part("file", F.lit("/"), F.lit(1)))
    return gt.daily_series(events, ["globex"]).withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query("gt_series_files", "gt", """
WITH s AS (SELECT company, CASE WHEN company = 'globex' AND kind = 'malicious-url' THEN 'malicious-destination' ELSE kind END AS event_type, event_day AS d
           FROM gt WHERE occurred <> 'soon' AND NOT (company = 'globex' AND kind = 'malicious-destination')),
c AS (SELECT company, event_type, d, count(*) AS n FROM s WHERE event_type IN ('endpoint-malware', 'malicious-email', 'malicious-destination') GROUP BY 1, 2, 3),
days AS (SELECT company, event_type, unnest(generate_series(min(d), max(d), INTERVAL 1 DAY))::DATE AS d FROM c GROUP BY 1, 2)
SELECT 'csv' AS form, company, event_type, strftime(d, '%Y-%m-%d') AS "date", coalesce(n, 0) AS "count" FROM days LEFT JOIN c USING (company, event_type, d)
UNION ALL SELECT 'jl', company, event_type, strftime(d, '%Y-%m-%d'), n FROM c""")
def gt_series_files(spark, sf):
    """The daily series as they are written: CSV with the empty days, JSON lines without."""
    out = scratch_path(spark, "series")
    events = v.ground_truth(spark, sf).withColumn("company", F.split_part("file", F.lit("/"), F.lit(1)))
    gt.write_series(gt.daily_series(events, ["globex"]), out)
    kind = "company string, event_type string, date string, count bigint"
    csv = spark.read.schema("date string, count bigint, company string, event_type string").option("header", True).csv(f"{out}/csv")
    lines = spark.read.schema(kind).json(f"{out}/jl")
    columns = ["company", "event_type", "date", "count"]
    return csv.select(F.lit("csv").alias("form"), *columns).unionByName(lines.select(F.lit("jl").alias("form"), *columns))


@query("gt_histogram_files", "attr", """
WITH n AS (SELECT attribute, value, count(*) AS n FROM attr GROUP BY 1, 2)
SELECT 'occurrences' AS form, attribute, CAST(count(*) AS BIGINT) AS n, CAST(sum(times) AS BIGINT) AS k FROM (SELECT attribute, value, occurred, count(*) AS times FROM attr GROUP BY 1, 2, 3) GROUP BY 2
UNION ALL SELECT 'times_value_seen', attribute, CAST(n AS BIGINT), CAST(count(*) AS BIGINT) FROM n GROUP BY 2, 3
UNION ALL SELECT 'values_seen', attribute, CAST(n AS BIGINT), CAST(count(*) AS BIGINT) FROM n GROUP BY 2, 3""")
def gt_histogram_files(spark, sf):
    """The three histogram files, read back."""
    out = scratch_path(spark, "histograms")
    gt.write_histograms(gt.attribute_values(v.ground_truth(spark, sf)), out)

    def read(name, columns):
        return spark.read.schema(f"{columns}, attribute string").option("header", True).csv(f"{out}/{name}").withColumn("form", F.lit(name))

    times = read("occurrences", "value string, occurred string, times bigint").groupBy("form", "attribute").agg(F.count("*").alias("n"), F.sum("times").alias("k"))
    seen = read("times_value_seen", "label string, n bigint").groupBy("form", "attribute", "n").agg(F.count_distinct("label").alias("k"))
    return times.unionByName(seen).unionByName(read("values_seen", "n bigint, k bigint").select("form", "attribute", "n", "k"))


@query("gt_user_series", "gt", """
WITH c AS (SELECT CAST(user_id AS VARCHAR) AS company, 'malicious-email' AS event_type, event_day AS d, count(*) AS n FROM gt
           WHERE event_type = 'view' GROUP BY 1, 2, 3),
days AS (SELECT company, event_type, unnest(generate_series(min(d), max(d), INTERVAL 1 DAY))::DATE AS d FROM c GROUP BY 1, 2)
SELECT company, event_type, strftime(d, '%Y-%m-%d') AS "date", coalesce(n, 0) AS "count" FROM days LEFT JOIN c USING (company, event_type, d)""")
def gt_user_series(spark, sf):
    """The dense series per user, where most days are empty and have to be filled."""
    mails = v.ground_truth(spark, sf).where(F.col("event_type") == gt.EMAIL_EVENT)
    events = mails.withColumn("company", F.regexp_extract(F.element_at("target_entity", 1), "user([0-9]+)@", 1))
    return gt.daily_series(events).withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query("gt_sensor_counts", "gt", """
SELECT sensor, count(*) AS n FROM (
    SELECT 'ids: ["a", "b' || k || '"]' AS sensor FROM gt WHERE event_type = 'click'
    UNION ALL SELECT 'unknown: ["x"]' FROM gt WHERE event_type = 'purchase'
    UNION ALL SELECT 'edr' FROM gt WHERE event_type = 'error'
    UNION ALL SELECT unnest(['s1: c' || k, 's2']) FROM gt WHERE event_type = 'signup') GROUP BY 1 ORDER BY 1""")
def gt_sensor_counts(spark, sf):
    return gt.sensor_counts(v.ground_truth(spark, sf)).orderBy("sensor")


@query("gt_target_counts", "targets", "SELECT target, coalesce(CAST(user_number AS VARCHAR), '-') AS user_number, count(*) AS n FROM targets GROUP BY 1, 2")
def gt_target_counts(spark, sf):
    counts = gt.target_counts(v.ground_truth(spark, sf))
    return counts.withColumn("user_number", F.coalesce(F.col("user_number").cast("string"), F.lit("-")))


@query("gt_anonymous_targets", "targets", """
SELECT kind, CASE WHEN kind = 'numbered' THEN target ELSE kind || row_number() OVER (PARTITION BY kind ORDER BY target) END AS label, n FROM (
    SELECT target, CASE WHEN user_number IS NOT NULL THEN 'numbered' WHEN contains(target, '@') THEN 'email' ELSE 'user' END AS kind, count(*) AS n
    FROM targets GROUP BY 1, 2)""")
def gt_anonymous_targets(spark, sf):
    return gt.anonymous_targets(gt.target_counts(v.ground_truth(spark, sf)))


@query("gt_recipient_counts", "attr", "SELECT value AS recipient, count(*) AS n FROM attr WHERE attribute = 'target_entity' GROUP BY 1")
def gt_recipient_counts(spark, sf):
    return gt.recipient_counts(v.ground_truth(spark, sf))


@query("gt_email_host_days", "gt", """
SELECT host, string_agg(day, chr(9) ORDER BY day) AS days FROM (
    SELECT DISTINCT unnest(['h' || k || '.example.com', 'unknown', '10.0.0.' || k]) AS host, strftime(event_day, '%Y/%m/%d') AS day
    FROM gt WHERE event_type = 'view') GROUP BY 1""")
def gt_email_host_days(spark, sf):
    return gt.email_host_days(v.ground_truth(spark, sf)).withColumn("days", F.array_join("days", "\t"))


@query("gt_value_occurrences", "attr", "SELECT attribute, value, occurred, count(*) AS times FROM attr GROUP BY 1, 2, 3")
def gt_value_occurrences(spark, sf):
    return gt.value_occurrences(gt.attribute_values(v.ground_truth(spark, sf)))


@query("gt_value_counts", "attr", "SELECT attribute, value, count(*) AS n FROM attr GROUP BY 1, 2")
def gt_value_counts(spark, sf):
    return gt.value_counts(gt.attribute_values(v.ground_truth(spark, sf)))


@query("gt_anonymous_values", "attr", """
SELECT attribute, 'attribute_' || row_number() OVER (PARTITION BY attribute ORDER BY value) AS label, n FROM (
    SELECT attribute, value, count(*) AS n FROM attr GROUP BY 1, 2)""")
def gt_anonymous_values(spark, sf):
    return gt.anonymous_values(gt.value_counts(gt.attribute_values(v.ground_truth(spark, sf))))


@query("gt_count_histogram", "attr", """
SELECT attribute, n, count(*) AS values_seen FROM (SELECT attribute, value, count(*) AS n FROM attr GROUP BY 1, 2) GROUP BY 1, 2 ORDER BY 1, 2""")
def gt_count_histogram(spark, sf):
    counts = gt.value_counts(gt.attribute_values(v.ground_truth(spark, sf)))
    return gt.count_histogram(counts).orderBy("attribute", "n")


@query("gt_latest_indicators", "attr", """
SELECT attribute, value, arg_max(occurred, file) AS occurred FROM attr
WHERE attribute IN ('email_sender', 'addresses_ip', 'addresses_url', 'email_subject', 'files_filename') GROUP BY 1, 2""")
def gt_latest_indicators(spark, sf):
    return gt.latest_indicators(v.ground_truth(spark, sf))


@query("gt_concat_layouts", "gt", """
SELECT kind AS event_type, count(*) AS n, count(CASE WHEN event_type = 'error' THEN 1 END) AS with_organization FROM gt GROUP BY 1""")
def gt_concat_layouts(spark, sf):
    """The two layouts as tables of their own columns, one below the other."""
    events = v.ground_truth(spark, sf)
    wrapped = F.col("target_organization").isNotNull()
    joined = gt.concat_event_tables(
        events.where(~wrapped).select("event_type", "occurred"), events.where(wrapped).select("event_type", "target_organization")
    )
    return joined.groupBy("event_type").agg(F.count("*").alias("n"), F.count("target_organization").alias("with_organization"))
