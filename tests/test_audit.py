import datetime as dt
import random

import pytest

from threatlake.operators import audit
from threatlake.plans.daily import audit_day, saved_reports

AS_OF = dt.date(2024, 3, 20)
FACT = "source_name string, count_downloaded bigint, date_of_pull date"


def facts(spark, histories):
    """``{source: (today, [t-1, t-2, …])}`` as audit facts; zero days have no row."""
    rows = []
    for source, (today, counts) in histories.items():
        for back, c in enumerate([today, *counts]):
            if c:
                rows.append((source, c, AS_OF - dt.timedelta(days=back)))
    return spark.createDataFrame(rows, FACT)


def ints(text):
    return [int(c) for c in text.split()]


def expected(today, counts):
    """The rule as a plain loop."""
    run = best = 0
    for c in counts:
        run = run + 1 if c == 0 else 0
        best = max(best, run)
    lead = next((i for i, c in enumerate(counts) if c), len(counts))
    return today == 0 and lead + 1 > best


# A day long before the history keeps the second week part of it.
OLD = [0] * 7 + [40]


@pytest.mark.parametrize(
    "name, history, alert",
    [
        ("weekend", "5 0 0 5 5 5 5 5 0 0 5 5 5", False),
        ("ties-longest", "0 0 5 5 5 0 0 5 5 5 5 5 5", True),
        ("never-silent", "5 5 5 5 5 5 5 5 5 5 5 5 5", True),
    ],
)
def test_alert_cases(spark, name, history, alert):
    rows = facts(spark, {name: (0, ints(history) + OLD)})
    policy = audit.source_policy(spark)
    assert (audit.alerts(rows, policy, AS_OF).count() == 1) is alert


def test_alerts_equal_the_loop_on_random_histories(spark):
    rng = random.Random(7)
    histories = {f"hg-{i}": (0, [rng.choice([0, 0, 30]) for _ in range(13)] + OLD + [400]) for i in range(120)}
    got = {r["source_name"] for r in audit.alerts(facts(spark, histories), audit.source_policy(spark), AS_OF).collect()}
    assert got == {s for s, (today, counts) in histories.items() if expected(today, counts[:13])}


def test_average_zero_and_policy_give_no_alert(spark):
    rows = facts(spark, {"hg-rare": (0, [0] * 13 + [1]), "hg-zdi": (0, [9] * 13 + OLD), "isi-twitter": (0, [9] * 13 + OLD)})
    assert audit.alerts(rows, audit.source_policy(spark), AS_OF).count() == 0


def test_missing_second_week_is_absent_not_zero(spark):
    rows = facts(spark, {"asu-new": (0, [0, 0, 9, 9])})
    row = audit.zero_runs(audit.history(rows, AS_OF)).head()
    assert (len(row["counts"]), row["longest_run"], row["current_run"]) == (6, 2, 3)


def test_source_seen_only_today_keeps_its_name_and_has_no_average(spark):
    row = audit.report(facts(spark, {"hg-first": (7, [])}), AS_OF).head()
    assert (row["source_name"], row["count_downloaded_today"], row["average"]) == ("hg-first", 7, None)


def test_reports_match_by_name_not_by_position(spark):
    rows = facts(spark, {"b": (1, [0] * 6 + [5]), "a": (2, [0] * 6 + [6]), "new": (3, [])})
    got = {r["source_name"]: r["count_week_ago"] for r in audit.week_on_week(rows, AS_OF).collect()}
    assert got == {"a": 6, "b": 5, "new": None}


def test_median_pads_missing_days_and_interpolates(spark):
    rows = facts(spark, {"s": (4, [0, 2, 0]), "t": (1, [2])})
    got = {r["source_name"]: r["median"] for r in audit.medians(rows, AS_OF).collect()}
    assert got == {"s": 2.0, "t": 1.5}


@pytest.mark.parametrize("source, who", [("hg-x", "hg"), ("asu-x", "asu"), ("ruhr-x", "ruhr"), ("armstrong", "armstrong"), ("other", "isi")])
def test_owner(spark, source, who):
    from pyspark.sql import functions as F

    assert spark.range(1).select(audit.owner(F.lit(source))).head()[0] == who


def test_audit_day_overwrites_and_reads_two_report_folders(spark, tmp_path):
    base = 1710892800  # 2024-03-20
    cdr = spark.createDataFrame([("a", base + 5), ("a", base - 86400), ("b", base - 8 * 86400)], "source_name string, timestamp long")
    out = str(tmp_path)
    policy = audit.source_policy(spark)
    for back in (7, 1, 0, 0):
        audit_day(spark, cdr, out, policy, AS_OF - dt.timedelta(days=back))
    counts = {(r["source_name"], r["date_of_pull"], r["count_downloaded"]) for r in spark.read.parquet(f"{out}/counts").collect()}
    assert counts == {("a", AS_OF, 1), ("a", AS_OF - dt.timedelta(days=1), 1), ("b", AS_OF - dt.timedelta(days=8), 1)}
    reports = saved_reports(spark, out, AS_OF)
    assert {r["date_of_pull"] for r in reports.select("date_of_pull").distinct().collect()} == {AS_OF, AS_OF - dt.timedelta(days=7)}
    assert "PartitionFilters: [date_of_pull" in reports._jdf.queryExecution().toString().replace("cast(", "") or "PartitionFilters" in reports._jdf.queryExecution().toString()


def test_snapshot_shrink_looks_at_the_last_ten(spark):
    days = [(dt.date(2024, 1, d), "post", 1, size, "x") for d, size in enumerate([99, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 3], start=1)]
    rows = audit.shrunk_snapshots(spark.createDataFrame(days, "snapshot date, doc_type string, rows long, bytes long, alias string")).collect()
    assert [(r["snapshot"].day, r["bytes"], r["previous_bytes"]) for r in rows] == [(12, 3, 10)]
