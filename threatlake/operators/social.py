"""Tweets: filters, the flat record, paging."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import epoch_day, format_tweet_time, parse_tweet_time
from ..functions.text import quoted_list
from .numbering import page


def conversation() -> Column:
    return F.coalesce("in_reply_to_status_id_str", "id_str")


def filter_tweets(
    tweets: DataFrame,
    retweets: int | None = None,
    user: str | None = None,
    tweet_id: str | None = None,
    conversation_id: str | None = None,
    hashtag: str | None = None,
) -> DataFrame:
    """Tweets that pass any of the given filters; all tweets when none is given."""
    tests = []
    if retweets is not None:
        tests.append(F.col("retweet_count") == retweets)
    if user is not None:
        tests.append(F.col("user.screen_name") == user)
    if tweet_id is not None:
        tests.append(F.col("id_str") == tweet_id)
    if conversation_id is not None:
        tests.append(conversation() == conversation_id)
    if hashtag is not None:
        tests.append(F.exists("entities.hashtags", lambda h: F.contains(h["text"], F.lit(hashtag))))
    if not tests:
        return tweets
    passed = reduce(or_, [F.coalesce(t, F.lit(False)) for t in tests])
    return tweets.where(F.col("id_str").isNotNull() & passed)


def filter_dates(tweets: DataFrame, lo: dt.date | None, hi: dt.date, day: Column | None = None) -> DataFrame:
    """Tweets of a range of days: by ``day`` (the file's date) or by their own time."""
    day = epoch_day(F.unix_seconds(parse_tweet_time(F.col("created_at")))) if day is None else day
    kept = tweets.where(day <= F.lit(hi))
    return kept if lo is None else kept.where(day >= F.lit(lo))


def flat_tweets(tweets: DataFrame) -> DataFrame:
    """The flat record of each tweet that has entities."""
    empty = F.array().cast("array<string>")
    return tweets.where(F.col("entities").isNotNull()).select(
        F.lit("Tweet").alias("content_type"),
        F.concat(F.lit("@"), "user.screen_name").alias("userName"),
        F.col("text").alias("tweetContent"),
        quoted_list(F.coalesce("entities.hashtags.text", empty)).alias("hashtags"),
        F.col("retweet_count").alias("retweet"),
        F.col("favorite_count").alias("favorites"),
        format_tweet_time(parse_tweet_time(F.col("created_at"))).alias("recorded_time_seconds"),
        F.col("id_str").alias("tweet_id"),
        conversation().alias("conversation_id"),
        quoted_list(F.coalesce("entities.user_mentions.screen_name", empty)).alias("mentions"),
    )


def tweet_page(tweets: DataFrame, start: int = 0, limit: int = 10) -> tuple[DataFrame, DataFrame]:
    """A page of flat tweets by id, and the number of all matches."""
    return flat_tweets(page(tweets, ["id_str"], start, limit)), tweets.agg(F.count("*").alias("count"))
