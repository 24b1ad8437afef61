"""Feed audit: daily counts, the seven-day report, gap alerts, snapshot checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import SECONDS_PER_DAY, day_start, epoch_day
from ..sources.cdr import between

REPORT_DAYS = 7
HISTORY_DAYS = 13

# Feeds never reported, feeds whose zero days are normal, feeds shown first.
EXCLUDED = [
    "hackmageddon", "hg-msbulletin", "hg-taxii", "isi-twitter", "isi-company-cpe-linkedin", "ruhr-cerber-domains",
    "asu-dark-mentions",
]
ZERO_TOLERANT = [
    "asu-dark-mention-rules", "hg-abusech", "hg-zdi", "asu-dark-mentions", "hg-umich-phish-alerts", "hg-unc-phish-alerts",
    "armstrong",
]
HIGHLIGHTED = [
    "hg-abusech", "asu-twitter", "hg-blogs", "asu-dark-mention-rules", "asu-hacking-items", "asu-hacking-posts", "hg-cpe",
    "hg-cve", "asu-exploit-db",
]


def source_policy(
    spark: SparkSession, excluded: list[str] = EXCLUDED, zero_tolerant: list[str] = ZERO_TOLERANT, highlighted: list[str] = HIGHLIGHTED
) -> DataFrame:
    """``(source_name, excluded, zero_tolerant, highlighted)``."""
    names = sorted({*excluded, *zero_tolerant, *highlighted})
    rows = [(n, n in excluded, n in zero_tolerant, n in highlighted) for n in names]
    return spark.createDataFrame(rows, "source_name string, excluded boolean, zero_tolerant boolean, highlighted boolean")


def daily_counts(cdr: DataFrame) -> DataFrame:
    """Records per feed and UTC day."""
    return cdr.groupBy("source_name", epoch_day(F.col("timestamp")).alias("date_of_pull")).agg(
        F.count("*").alias("count_downloaded")
    )


def recent_counts(cdr: DataFrame, as_of: dt.date, days: int = 2) -> DataFrame:
    """The recount of the last ``days`` days up to ``as_of``, which takes in late records."""
    end = day_start(as_of) + SECONDS_PER_DAY
    return daily_counts(between(cdr, end - days * SECONDS_PER_DAY, end))


def counts_before(cdr: DataFrame, as_of: dt.date) -> DataFrame:
    """The backfill: every day before ``as_of``; later months are not read."""
    return daily_counts(between(cdr, None, day_start(as_of)))


def write_counts(counts: DataFrame, path: str) -> None:
    """Replace the audit days present in ``counts``; other days stay."""
    (
        counts.hint("rebalance", "date_of_pull")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date_of_pull")
        .parquet(path)
    )


def _day_sum(as_of: dt.date, back: int) -> Column:
    """Sum of the counts ``back`` days before ``as_of``, 0 without any."""
    hit = F.col("date_of_pull") == F.lit(as_of - dt.timedelta(days=back))
    return F.coalesce(F.sum(F.when(hit, F.col("count_downloaded"))), F.lit(0)).cast("bigint")


def report(facts: DataFrame, as_of: dt.date) -> DataFrame:
    """The seven-day report per feed, all columns from one aggregation.

    The average runs over calendar days since the feed's first day and is null
    for a feed that began on ``as_of``.
    """
    known = facts.where(F.col("date_of_pull") <= F.lit(as_of))
    total, first = F.sum("count_downloaded"), F.min("date_of_pull")
    return known.groupBy("source_name").agg(
        F.max(F.when(F.col("count_downloaded") > 0, F.col("date_of_pull"))).alias("last_date_of_pull"),
        _day_sum(as_of, 0).alias("count_downloaded_today"),
        *[_day_sum(as_of, k).alias(f"count_today_minus_{k}") for k in range(1, REPORT_DAYS)],
        F.try_divide(total, F.datediff(F.lit(as_of), first)).cast("bigint").alias("average"),
    )


def medians(facts: DataFrame, as_of: dt.date) -> DataFrame:
    """Median daily count per feed over all its calendar days, days without rows as 0.

    The missing days enter as one row with their number as frequency.
    """
    known = facts.where(F.col("date_of_pull") <= F.lit(as_of))
    present = known.select("source_name", F.col("count_downloaded").alias("c"), F.lit(1).cast("bigint").alias("f"))
    missing = (
        known.groupBy("source_name")
        .agg((F.datediff(F.lit(as_of), F.min("date_of_pull")) + 1 - F.count("*")).cast("bigint").alias("f"))
        .where(F.col("f") > 0)
        .select("source_name", F.lit(0).cast("bigint").alias("c"), "f")
    )
    return present.unionByName(missing).groupBy("source_name").agg(F.percentile("c", 0.5, F.col("f")).alias("median"))


def full_report(facts: DataFrame, as_of: dt.date) -> DataFrame:
    """The report with the median column filled in and the day it is for."""
    return (
        report(facts, as_of)
        .join(medians(facts, as_of), "source_name")
        .withColumn("median", F.floor("median").cast("bigint"))
        .withColumn("date_of_pull", F.lit(as_of))
    )


def history(facts: DataFrame, as_of: dt.date) -> DataFrame:
    """Per feed: today's count, the average, and up to 13 earlier daily counts, latest first.

    The second week counts only for feeds that had been seen by its last day.
    """
    known = facts.where(F.col("date_of_pull") <= F.lit(as_of))
    week = as_of - dt.timedelta(days=REPORT_DAYS)
    near = F.array(*[_day_sum(as_of, k) for k in range(1, REPORT_DAYS)])
    far = F.array(*[_day_sum(as_of, k) for k in range(REPORT_DAYS, HISTORY_DAYS + 1)])
    first = F.min("date_of_pull")
    return known.groupBy("source_name").agg(
        _day_sum(as_of, 0).alias("today"),
        F.try_divide(F.sum("count_downloaded"), F.datediff(F.lit(as_of), first)).cast("bigint").alias("average"),
        F.when(first <= F.lit(week), F.concat(near, far)).otherwise(near).alias("counts"),
    )


def zero_runs(hist: DataFrame) -> DataFrame:
    """Add the longest zero run of the history and the current one, which includes today.

    A history has 13 values at most, so both are folds over the array.
    """
    run = F.struct(F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(acc: Column, c: Column) -> Column:
        length = F.when(c == 0, acc["run"] + 1).otherwise(F.lit(0))
        return F.struct(length.alias("run"), F.greatest(acc["best"], length).alias("best"))

    longest = F.aggregate("counts", run, step, lambda acc: acc["best"])
    first_hit = F.array_position(F.transform("counts", lambda c: c != 0), True)
    leading = F.when(first_hit > 0, first_hit - 1).otherwise(F.size("counts"))
    return hist.withColumns(
        {"longest_run": longest.cast("bigint"), "current_run": F.when(F.col("today") == 0, leading + 1).otherwise(F.lit(0)).cast("bigint")}
    )


def owner(source: Column) -> Column:
    """Who is told about a feed, by the prefix of its name."""
    return (
        F.when(source.startswith("hg-"), "hg")
        .when(source.startswith("asu-"), "asu")
        .when(source.startswith("ruhr-"), "ruhr")
        .when(source.startswith("armstrong"), "armstrong")
        .otherwise("isi")
    )


def with_policy(rows: DataFrame, policy: DataFrame) -> DataFrame:
    """Rows of feeds that are not excluded, with the policy flags."""
    flags = ["excluded", "zero_tolerant", "highlighted"]
    joined = rows.join(policy, "source_name", "left")
    return joined.withColumns({f: F.coalesce(f, F.lit(False)) for f in flags}).where(~F.col("excluded")).drop("excluded")


def alerts(facts: DataFrame, policy: DataFrame, as_of: dt.date) -> DataFrame:
    """Feeds that are silent today for longer than they ever were in two weeks."""
    runs = with_policy(zero_runs(history(facts, as_of)), policy)
    silent = (F.col("today") == 0) & (F.col("average") != 0) & ~F.col("zero_tolerant")
    return runs.where(silent & (F.col("current_run") > F.col("longest_run"))).select(
        "source_name", owner(F.col("source_name")).alias("owner"), "average", "current_run", "longest_run", "highlighted"
    )


def week_on_week(facts: DataFrame, as_of: dt.date) -> DataFrame:
    """Today's report next to the one of a week ago, matched by feed name."""
    now, before = report(facts, as_of), report(facts, as_of - dt.timedelta(days=REPORT_DAYS))
    then = before.select("source_name", F.col("count_downloaded_today").alias("count_week_ago"), F.col("average").alias("average_week_ago"))
    return now.select("source_name", "count_downloaded_today", "average").join(then, "source_name", "left")


def silent_feeds(expected: DataFrame, cdr: DataFrame, as_of: dt.date) -> DataFrame:
    """Expected feeds with no record on a day."""
    start = day_start(as_of)
    seen = between(cdr, start, start + SECONDS_PER_DAY).select("source_name").distinct()
    return expected.select("source_name").distinct().join(seen, "source_name", "left_anti")


def shrunk_snapshots(catalog: DataFrame, last: int = 10) -> DataFrame:
    """Snapshots smaller than the one before, among the last ones of each type.

    The catalog has one row per snapshot and type, so its windows stay small.
    """
    by_date = Window.partitionBy("doc_type").orderBy("snapshot")
    newest = Window.partitionBy("doc_type").orderBy(F.desc("snapshot"))
    recent = catalog.withColumn("_place", F.row_number().over(newest)).where(F.col("_place") <= last)
    return (
        recent.withColumns({"previous_snapshot": F.lag("snapshot").over(by_date), "previous_bytes": F.lag("bytes").over(by_date)})
        .where(F.col("bytes") < F.col("previous_bytes"))
        .select("doc_type", "snapshot", "bytes", "previous_snapshot", "previous_bytes")
    )
