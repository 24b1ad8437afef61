"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the cores; BENCH_QUERIES=all, or a
comma-separated list, replaces the headline set.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F

from threatlake.plans import views
from threatlake.plans.catalog import QUERIES
from threatlake.plans.daily import refresh
from threatlake.plans.linked import LAST_DAY
from threatlake.session import build_session, scratch_path

HEADLINE = [
    "cdr_full_scan",
    "cdr_json_fields",
    "cdr_partition_append",
    "feed_landing_new_ids",
    "model_routing",
    "extract_identifiers",
    "extract_context",
    "attribute_paths",
    "audit_daily_counts",
    "audit_report",
    "audit_median",
    "audit_alerts",
    "gt_daily_series",
    "gt_sensor_counts",
    "gt_anonymous_targets",
    "gt_value_occurrences",
    "gt_count_histogram",
    "gt_latest_indicators",
    "search_monthly_histogram",
    "search_phrase_join",
    "search_short_phrase_top_hits",
    "search_publisher_matches",
    "tweet_flat_record",
    "merge_statements",
    "merged_entities",
    "frame_documents",
    "frame_large_entities",
    "state_upsert",
    "frame_delta",
    "stream_daily_counts",
]


def refresh_times(spark, sf: str) -> dict[str, float]:
    """The daily refresh over all days, and over the last day on top of the others."""
    records, routes, models = views.activity(spark, sf)
    spec, early = {"user": views.ACTIVITY_FRAME}, records.where(F.col("timestamp") <= LAST_DAY)
    whole, steps = scratch_path(spark, "bench"), scratch_path(spark, "bench")
    refresh(spark, early, steps, routes, models, spec, buckets=8)
    times = {}
    for name, out, mark in (("refresh_full", whole, ""), ("refresh_one_day", steps, LAST_DAY)):
        started = time.perf_counter()
        refresh(spark, records, out, routes, models, spec, mark, buckets=8)
        times[name] = round(time.perf_counter() - started, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    return times


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["audit_daily_counts"](spark, sf).count()  # start-up is not a query's time
    times = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    if not chosen:
        times.update(refresh_times(spark, sf))
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
