"""Queries over published documents and over tweets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.text import BREAK, any_field
from ..operators import search, social
from . import views as v
from .registry import query

WORDS = ["in the", "of", "que la", "der"]
PUBLISHER = "unknown-publisher"


def _phrases(spark, sf):
    return v.table(spark, sf, "benchmark").select(F.col("text").alias("phrase"))


def _hits(spark, sf):
    return search.phrase_hits(v.doc_index(spark, sf).select("uri", "text"), _phrases(spark, sf))


@query("search_by_uri", "docs", "SELECT doc_type, uri, name FROM docs WHERE uri = 'doc/7' AND doc_type = 'en'")
def search_by_uri(spark, sf):
    return search.by_uri(v.doc_index(spark, sf), "en", "doc/7").select("doc_type", "uri", "name")


@query("search_phrase", "docs", "SELECT doc_type, uri FROM docs WHERE contains(' ' || norm || ' ', ' in the ')")
def search_phrase(spark, sf):
    return search.with_phrase(v.doc_index(spark, sf), F.col("text"), "In the").select("doc_type", "uri")


@query("search_any_field", "docs", "SELECT uri FROM docs WHERE contains(' ' || norm || ' ', ' que la ') OR contains(' ' || lower(name) || ' ', ' que la ')")
def search_any_field(spark, sf):
    docs = v.doc_index(spark, sf)
    return search.with_phrase(docs, any_field(F.col("name"), F.col("text")), "que la").select("uri")


@query("search_newest", "docs", """
SELECT uri, coalesce(strftime(observed_date, '%Y-%m-%d'), '-') AS newest FROM docs WHERE doc_type = 'en' AND contains(' ' || norm || ' ', ' of the ')
ORDER BY observed_date DESC NULLS LAST, uri""")
def search_newest(spark, sf):
    rows = search.newest_with_phrase(v.doc_index(spark, sf), "en", F.col("text"), "of the")
    return rows.select("uri", F.coalesce(F.date_format("newest", "yyyy-MM-dd"), F.lit("-")).alias("newest"))


@query("search_word_and_dates", "docs", """
SELECT uri, strftime(date_published, '%Y-%m-%d') AS published FROM docs
WHERE date_published BETWEEN DATE '2024-01-01' AND DATE '2024-03-08' AND contains(' ' || norm || ' ', ' of ')""")
def search_word_and_dates(spark, sf):
    docs = v.doc_index(spark, sf)
    rows = search.with_word_between(docs, F.col("text"), "of", "datePublished", dt.date(2024, 1, 1), dt.date(2024, 3, 8))
    return rows.select("uri", F.date_format(F.element_at("datePublished", 1), "yyyy-MM-dd").alias("published"))


@query("search_all_counts", "docs", "SELECT doc_type, count(*) AS n FROM docs GROUP BY 1 ORDER BY n DESC, doc_type")
def search_all_counts(spark, sf):
    return v.doc_index(spark, sf).groupBy("doc_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "doc_type")


@query("search_publisher_counts", "docs", """
SELECT publisher, count(*) AS n FROM (SELECT unnest(publisher) AS publisher FROM docs) GROUP BY 1 ORDER BY n DESC, publisher LIMIT 100""")
def search_publisher_counts(spark, sf):
    return search.publisher_counts(v.doc_index(spark, sf))


@query("search_monthly_histogram", "docs", """
WITH w AS (SELECT unnest(['in the', 'of', 'que la', 'der', 'src3', 'document 7']) AS phrase),
m AS (SELECT phrase, CAST(date_trunc('month', d) AS DATE) AS month, count(*) AS n FROM (
    SELECT phrase, unnest([start_date, date_published, observed_date]) AS d FROM docs JOIN w ON contains(' ' || norm || ' ', ' ' || phrase || ' ')
        OR lower(name) = phrase OR list_contains(publisher, phrase))
    WHERE d IS NOT NULL GROUP BY 1, 2),
spine AS (SELECT phrase, unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH))::DATE AS month FROM m GROUP BY 1)
SELECT phrase, strftime(month, '%Y-%m-%d') AS month, coalesce(n, 0) AS n FROM spine LEFT JOIN m USING (phrase, month)""")
def search_monthly_histogram(spark, sf):
    """Phrase matches in any field by month: texts, names and publishers."""
    every = any_field(F.col("name"), F.col("text"), F.array_join("publisher", f" {BREAK} "))
    rows = search.monthly_histogram(v.doc_index(spark, sf), every, [*WORDS, "src3", "document 7"])
    return rows.withColumn("month", F.date_format("month", "yyyy-MM-dd"))


@query("search_phrase_join", "hits", "SELECT phrase, uri, score FROM hits")
def search_phrase_join(spark, sf):
    return _hits(spark, sf)


@query("search_top_hits", "hits", """
SELECT phrase, uri, score, place FROM (SELECT *, CAST(row_number() OVER (PARTITION BY phrase ORDER BY score DESC, uri) AS INTEGER) AS place FROM hits) WHERE place <= 100""")
def search_top_hits(spark, sf):
    return search.top_hits(_hits(spark, sf))


@query("search_short_phrase_top_hits", "docs", """
WITH w AS (SELECT unnest(['in the', 'of', 'que la', 'der']) AS phrase),
h AS (SELECT phrase, uri, CAST((length(wide) - length(replace(wide, needle, ''))) / length(needle) AS BIGINT) AS score FROM (
    SELECT phrase, uri, ' ' || replace(norm, ' ', '  ') || ' ' AS wide, ' ' || replace(phrase, ' ', '  ') || ' ' AS needle
    FROM docs JOIN w ON contains(' ' || norm || ' ', ' ' || phrase || ' ')))
SELECT phrase, uri, score, place FROM (SELECT *, CAST(row_number() OVER (PARTITION BY phrase ORDER BY score DESC, uri) AS INTEGER) AS place FROM h) WHERE place <= 100""")
def search_short_phrase_top_hits(spark, sf):
    """Phrases of one and two tokens that a large part of the documents has."""
    words = spark.createDataFrame([(w,) for w in WORDS], "phrase string")
    return search.top_hits(search.phrase_hits(v.doc_index(spark, sf).select("uri", "text"), words))


@query("search_publisher_matches", "hits", """
WITH top AS (SELECT phrase, uri FROM (SELECT *, CAST(row_number() OVER (PARTITION BY phrase ORDER BY score DESC, uri) AS INTEGER) AS place FROM hits) WHERE place <= 100),
dated AS (SELECT uri, unnest(CASE WHEN len(publisher) = 0 THEN ['unknown-publisher'] ELSE publisher END) AS publisher,
                 coalesce(date_published, start_date, observed_date, date_recorded) AS d FROM docs)
SELECT publisher, md5(phrase) AS phrase_id, count(DISTINCT uri) AS documents, coalesce(strftime(min(d), '%Y-%m-%d'), '-') AS first_date,
       coalesce(strftime(max(d), '%Y-%m-%d'), '-') AS last_date, '2024-01-30' AS occurred
FROM top JOIN dated USING (uri) GROUP BY publisher, phrase""")
def search_publisher_matches(spark, sf):
    indicators = _phrases(spark, sf).distinct().withColumn("occurred", F.lit("2024-01-30"))
    rows = search.publisher_matches(search.top_hits(_hits(spark, sf)), v.doc_index(spark, sf), indicators, PUBLISHER)
    day = lambda c: F.coalesce(F.date_format(c, "yyyy-MM-dd"), F.lit("-")).alias(c)
    return rows.select("publisher", F.md5("phrase").alias("phrase_id"), "documents", day("first_date"), day("last_date"), "occurred")


@query("indicator_matches", "docs ev", """
WITH i AS (SELECT k, strftime(max(CAST(ts AS DATE)), '%Y-%m-%d') AS occurred FROM ev GROUP BY 1),
dated AS (SELECT uri, unnest(CASE WHEN len(publisher) = 0 THEN ['unknown-publisher'] ELSE publisher END) AS publisher,
                 coalesce(date_published, start_date, observed_date, date_recorded) AS d FROM docs)
SELECT publisher, 'document ' || k AS phrase, count(DISTINCT uri) AS documents, coalesce(strftime(min(d), '%Y-%m-%d'), '-') AS first_date,
       coalesce(strftime(max(d), '%Y-%m-%d'), '-') AS last_date, occurred FROM i JOIN dated ON uri = 'doc/' || k GROUP BY publisher, k, occurred""")
def indicator_matches(spark, sf):
    """Each indicator's last occurrence, its matches in names, texts and publishers, and their publishers."""
    events = v.numbered_events(spark, sf)
    latest = events.groupBy(F.concat(F.lit("document "), F.col("k").cast("string")).alias("phrase")).agg(F.date_format(F.max("ts"), "yyyy-MM-dd").alias("occurred"))
    rows = search.indicator_matches(v.doc_index(spark, sf), latest, ["name", "text", "publisher"], PUBLISHER)
    day = lambda c: F.coalesce(F.date_format(c, "yyyy-MM-dd"), F.lit("-")).alias(c)
    return rows.select("publisher", "phrase", "documents", day("first_date"), day("last_date"), "occurred")


@query("search_gazetteer", "docs", r"""
WITH terms AS (SELECT DISTINCT term, kind, trim(regexp_replace(lower(term), '[^\p{L}\p{N}]+', ' ', 'g')) AS pnorm FROM (
    SELECT text AS term, 'passage' AS kind FROM benchmark
    UNION ALL SELECT r_name, 'region' FROM region))
SELECT uri, term, kind, CAST((length(wide) - length(replace(wide, needle, ''))) / length(needle) AS BIGINT) AS mentions FROM (
    SELECT uri, term, kind, ' ' || replace(norm, ' ', '  ') || ' ' AS wide, ' ' || replace(pnorm, ' ', '  ') || ' ' AS needle
    FROM docs JOIN terms ON contains(' ' || norm || ' ', ' ' || pnorm || ' ') AND pnorm <> '')""")
def search_gazetteer(spark, sf):
    """Listed names found in texts, here whole passages and the regions."""
    passages = v.table(spark, sf, "benchmark").select(F.col("text").alias("term"), F.lit("passage").alias("kind"))
    regions = v.table(spark, sf, "region").select(F.col("r_name").alias("term"), F.lit("region").alias("kind"))
    return search.extract_entities(v.doc_index(spark, sf).select("uri", "text"), passages.unionByName(regions).distinct())


# --- tweets -----------------------------------------------------------------------


@query("tweet_filter_any", "tw", """
SELECT id AS id_str, role AS screen_name FROM tw WHERE turn = 1 OR role = 'system' OR id = '5-2' OR conversation = '7-0' OR contains('tag' || conv_id % 10, 'g3')
       OR contains('t' || turn, 'g3')""")
def tweet_filter_any(spark, sf):
    rows = social.filter_tweets(v.tweets(spark, sf), retweets=1, user="system", tweet_id="5-2", conversation_id="7-0", hashtag="g3")
    return rows.select("id_str", F.col("user.screen_name").alias("screen_name"))


@query("tweet_filter_dates", "tw", "SELECT id AS id_str, strftime(day, '%Y-%m-%d') AS file FROM tw WHERE day BETWEEN DATE '2024-01-10' AND DATE '2024-02-05'")
def tweet_filter_dates(spark, sf):
    return social.filter_dates(v.tweets(spark, sf), dt.date(2024, 1, 10), dt.date(2024, 2, 5)).select("id_str", "file")


FLAT = """'Tweet' AS content_type, '@' || role AS "userName", text AS "tweetContent", 'u''tag' || conv_id % 10 || ''', u''t' || turn || '''' AS hashtags,
       turn AS retweet, conv_id % 7 AS favorites, strftime(day, '%a %b %d 10:00:00 UTC %Y') AS recorded_time_seconds, id AS tweet_id,
       conversation AS conversation_id, CASE WHEN turn > 0 THEN 'u''m' || turn || '''' ELSE '' END AS mentions"""


@query("tweet_flat_record", "tw", f"SELECT {FLAT} FROM tw")
def tweet_flat_record(spark, sf):
    return social.flat_tweets(v.tweets(spark, sf))


@query("tweet_page", "tw", f"SELECT {FLAT} FROM (SELECT * FROM tw WHERE contains('tag' || conv_id % 10, '3') OR contains('t' || turn, '3') ORDER BY id LIMIT 20 OFFSET 10)")
def tweet_page(spark, sf):
    rows, _ = social.tweet_page(social.filter_tweets(v.tweets(spark, sf), hashtag="3"), 10, 20)
    return rows


@query("tweet_page_total", "tw", "SELECT count(*) AS count FROM tw WHERE contains('tag' || conv_id % 10, '3') OR contains('t' || turn, '3')")
def tweet_page_total(spark, sf):
    _, total = social.tweet_page(social.filter_tweets(v.tweets(spark, sf), hashtag="3"), 10, 20)
    return total
