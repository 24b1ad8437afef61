"""The feed catalog and the rule for which landed pulls one run reads."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A pull "since" this date asks for everything.
FULL_LOAD = dt.date(1970, 1, 1)
# Fields that one downloader's feeds come with and that are emptied before landing.
BLANKED = ("postCve", "itemCve")


@dataclass(frozen=True)
class FeedSpec:
    """One feed: who delivers it and how its pulls are chosen.

    ``mode`` is ``since`` (pulls from a date on), ``full`` (always everything)
    or ``window`` (the asked day and the day before).
    """

    source_name: str
    team: str
    mode: str = "since"
    blank: tuple[str, ...] = ()


# Feed names and delivering teams.
FEEDS = {
    feed.source_name: feed
    for feed in [
        FeedSpec("hg-blogs", "hyperiongray"),
        FeedSpec("hg-abusech", "hyperiongray"),
        FeedSpec("hg-cpe", "hyperiongray"),
        FeedSpec("hg-cve", "hyperiongray"),
        FeedSpec("hg-conference", "hyperiongray"),
        FeedSpec("hg-msbulletin", "hyperiongray"),
        FeedSpec("hg-phishtank", "hyperiongray"),
        FeedSpec("hg-reddit", "hyperiongray"),
        FeedSpec("hg-taxii", "hyperiongray"),
        FeedSpec("hg-unc-phish-alerts", "hyperiongray"),
        FeedSpec("hg-umich-phish-alerts", "hyperiongray"),
        FeedSpec("hg-zdi", "hyperiongray"),
        FeedSpec("hg-leaked-source", "hyperiongray", "full"),
        FeedSpec("isi-news", "isi"),
        FeedSpec("isi-twitter", "isi"),
        FeedSpec("isi-company-cpe-linkedin", "isi", "full"),
        FeedSpec("asu-zero-day-products", "asu", blank=BLANKED),
        FeedSpec("asu-hacking-items", "asu", blank=BLANKED),
        FeedSpec("asu-hacking-posts", "asu", blank=BLANKED),
        FeedSpec("asu-twitter", "asu", blank=BLANKED),
        FeedSpec("asu-exploit-db", "asu", blank=BLANKED),
        FeedSpec("asu-dark-mention-rules", "asu", blank=BLANKED),
        FeedSpec("asu-dumps-s3-mapping", "asu", blank=BLANKED),
        FeedSpec("armstrong", "armstrong", "window"),
        FeedSpec("ruhr-cerber-domains", "ruhr", "full"),
        FeedSpec("hackmageddon", "hackmageddon", "full"),
    ]
}


def pulls(spark: SparkSession, root: str, feed: FeedSpec, day: dt.date) -> DataFrame:
    """Landed lines of one feed as ``(raw_content, source_name, pull_date)``.

    The landing folder is ``source_name=…/pull_date=…``, so both choices prune
    directories. Pages of a pull are simply files of its folder.
    """
    landed = (
        spark.read.schema("value string, source_name string, pull_date date")
        .format("text")
        .load(root)
        .where(F.col("source_name") == feed.source_name)
        .where(F.length("value") > 0)
        .withColumnRenamed("value", "raw_content")
    )
    if feed.mode == "full" or day == FULL_LOAD:
        return landed
    if feed.mode == "window":
        return landed.where(F.col("pull_date").between(day - dt.timedelta(days=1), day))
    return landed.where(F.col("pull_date") >= F.lit(day))


def completeness(batch: DataFrame, declared: DataFrame) -> DataFrame:
    """Landed rows and last pull per feed against the declared ``(source_name, total)``."""
    landed = batch.groupBy("source_name").agg(
        F.count("*").alias("landed"), F.max("pull_date").alias("last_pull")
    )
    return declared.join(landed, "source_name", "left").select(
        "source_name",
        F.col("total").cast("bigint").alias("total"),
        F.coalesce("landed", F.lit(0)).alias("landed"),
        "last_pull",
        (F.coalesce("landed", F.lit(0)) >= F.col("total")).alias("complete"),
    )


def page_chains(pages: DataFrame) -> DataFrame:
    """Whether the pages of each pull make up the whole: one row for each pull.

    ``pages`` has ``source_name, pull_date, start`` (rows before the page), ``n`` (its rows), ``page_limit`` and ``total`` (what the
    service declares, or null). Of a page that came more than once the longest counts, the others are ``repeats``. Pages that
    follow each other are an island; rows between two islands are ``missing``, and so is what lies before the first; rows that
    two pages share are ``overlap``. A pull has ended when a page is shorter than its limit or the total is reached, and is
    complete when it has ended with nothing missing and, where a total is declared, just as many rows.
    """
    pull = ["source_name", "pull_date"]
    by_page = pages.groupBy(*pull, "start").agg(F.max("n").alias("n"), F.count("*").alias("_times"), F.max("page_limit").alias("page_limit"), F.max("total").alias("total"))
    # Pages of one pull, a number each: a long pull is a few thousand rows.
    before = Window.partitionBy(*pull).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.coalesce(F.max(F.col("start") + F.col("n")).over(before), F.lit(0))
    placed = by_page.withColumn("_reach", reach).withColumn("_gap", F.greatest(F.col("start") - F.col("_reach"), F.lit(0)))
    shared = F.greatest(F.least(F.col("_reach"), F.col("start") + F.col("n")) - F.col("start"), F.lit(0))
    whole = placed.groupBy(*pull).agg(
        F.count("*").alias("pages"), F.sum(F.col("_times") - 1).alias("repeats"), (F.count_if(F.col("_gap") > 0) + F.max((F.col("start") == 0).cast("int"))).alias("islands"),
        F.sum("_gap").alias("missing"), F.sum(shared).alias("overlap"), F.sum(F.col("n") - shared).alias("rows"), F.max("total").alias("total"),
        F.max_by(F.col("n") < F.col("page_limit"), "start").alias("_short"), F.max(F.col("start") + F.col("n")).alias("_end"),
    )
    ended = F.col("_short") | F.coalesce(F.col("_end") >= F.col("total"), F.lit(False))
    complete = ended & (F.col("missing") == 0) & F.coalesce(F.col("rows") == F.col("total"), F.lit(True))
    return whole.select(*pull, "pages", "repeats", "islands", "missing", "overlap", "rows", "total", ended.alias("ended"), complete.alias("complete"))
