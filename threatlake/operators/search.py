"""Search over published documents.

Documents have ``doc_type, uri, name, text``, an array of publishers and arrays of
dates by field.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import first_dates
from ..functions.text import contains_phrase, match_phrase, normalise
from ..session import scratch_path

DATE_PRIORITY = ["datePublished", "startDate", "observedDate", "datePosted", "dateRecorded"]
HISTOGRAM_DATES = ["startDate", "datePublished", "observedDate"]
TOP_HITS = 100
ANCHOR_TOKENS = 3


def by_uri(docs: DataFrame, doc_type: str, uri: str) -> DataFrame:
    return docs.where((F.col("doc_type") == doc_type) & (F.col("uri") == uri))


def with_phrase(docs: DataFrame, field: Column, phrase: str) -> DataFrame:
    return docs.where(match_phrase(field, phrase))


def newest_with_phrase(docs: DataFrame, doc_type: str, field: Column, phrase: str, date: str = "observedDate") -> DataFrame:
    """Documents of a type with a phrase, newest first; a document's newest date counts."""
    hits = with_phrase(docs.where(F.col("doc_type") == doc_type), field, phrase)
    return hits.withColumn("newest", F.array_max(date)).orderBy(F.desc("newest"), "uri")


def with_word_between(docs: DataFrame, field: Column, word: str, date: str, lo: dt.date, hi: dt.date) -> DataFrame:
    """Documents with a word and any date in a range of days; the cheap test comes first."""
    dated = F.exists(date, lambda d: d.between(F.lit(lo), F.lit(hi)))
    return docs.where(dated & match_phrase(field, word))


def publisher_counts(docs: DataFrame, top: int = TOP_HITS) -> DataFrame:
    """The publishers with most documents; equal counts by name."""
    return (
        docs.select(F.explode("publisher").alias("publisher"))
        .groupBy("publisher")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "publisher")
        .limit(top)
    )


def monthly_histogram(docs: DataFrame, field: Column, phrases: list[str], dates: list[str] = HISTOGRAM_DATES) -> DataFrame:
    """Hits per phrase and month over several date fields, empty months included.

    Date fields are arrays. The text is normalised once for all phrases of the list.
    """
    hits = F.filter(
        F.array(*[F.lit(p) for p in phrases]),
        lambda p: contains_phrase(F.col("_norm"), normalise(p)),
    )
    # A document counts once per field and month, however many dates it has there.
    months = [
        F.coalesce(
            F.array_distinct(F.transform(d, lambda x: F.trunc(x, "month"))), F.array().cast("array<date>")
        )
        for d in dates
    ]
    counted = (
        docs.withColumn("_norm", normalise(field))
        .select(F.explode(hits).alias("phrase"), F.concat(*months).alias("months"))
        .select("phrase", F.explode("months").alias("month"))
        .where(F.col("month").isNotNull())
        .groupBy("phrase", "month")
        .agg(F.count("*").alias("n"))
    )
    spine = counted.groupBy("phrase").agg(F.min("month").alias("lo"), F.max("month").alias("hi")).select(
        "phrase", F.explode(F.expr("sequence(lo, hi, interval 1 month)")).alias("month")
    )
    return spine.join(counted, ["phrase", "month"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


#: Places of the anchor filter, a bit each; its size does not follow the number of phrases.
FILTER_BITS = 1 << 19


def _run_of(tokens: Column, at: Column, size: int) -> list[Column]:
    return [F.get(tokens, at + k) for k in range(size)]


def _anchors(phrases: DataFrame) -> DataFrame:
    """``(phrase, tokens, size, off, anchor)``: the longest run of up to three tokens of each phrase, and its first place.

    Long runs are rare ones as a rule, which keeps the candidates few. The table is written and read back, so that the planner
    knows its bytes.
    """
    norm = phrases.select("phrase", normalise(F.col("phrase")).alias("_norm")).where(F.length("_norm") > 0).distinct()
    sized = norm.select("phrase", F.split("_norm", " ").alias("tokens")).withColumn("size", F.least(F.size("tokens"), F.lit(ANCHOR_TOKENS)))

    def longest(size: int) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.size("tokens") - size), lambda i: F.struct(F.concat_ws(" ", *_run_of(F.col("tokens"), i, size)).alias("run"), (-i).alias("back")))
        return F.array_max(F.transform(runs, lambda r: F.struct(F.length(r["run"]).alias("n"), r["run"].alias("run"), r["back"].alias("back"))))

    best = F.coalesce(*[F.when(F.col("size") == k, longest(k)) for k in range(1, ANCHOR_TOKENS + 1)])
    path = scratch_path(phrases.sparkSession, "anchors")
    sized.withColumn("_best", best).select("phrase", "tokens", "size", (-F.col("_best.back")).alias("off"), F.col("_best.run").alias("anchor")).write.parquet(path)
    return phrases.sparkSession.read.parquet(path)


def _place(run: list[Column]) -> Column:
    return F.pmod(F.xxhash64(*run), F.lit(FILTER_BITS))


def _filter_words(anchors: DataFrame, size: int) -> Column:
    """A constant of ``FILTER_BITS`` bits, 64 to a word: those that the anchors of a size fall on."""
    place = _place(_run_of(F.split("anchor", " "), F.lit(0), size))
    word = F.expr("bit_or(shiftleft(1L, CAST(place % 64 AS INT)))")
    found = anchors.where(F.col("size") == size).select(place.alias("place")).groupBy(F.floor(F.col("place") / 64).alias("word")).agg(word.alias("bits"))
    words = [0] * (FILTER_BITS // 64)
    for r in found.collect():  # a row for each word at most
        words[r["word"]] = r["bits"]
    return F.split(F.lit(",".join(map(str, words))), ",").cast("array<bigint>")


def _candidates_of(tokens: Column, size: int, words: Column, left: int, width: int) -> Column:
    """Of an array of tokens, the runs of a size whose bits are set, with ``width`` tokens from ``left`` before them."""

    def may_be(i: Column) -> Column:
        place = _place(_run_of(tokens, i, size))
        return F.getbit(F.get(words, F.floor(place / 64).cast("int")), (place % 64).cast("int")) == 1

    def row(i: Column) -> Column:
        start = F.greatest(i - left, F.lit(0))
        return F.struct(
            F.lit(size).alias("size"), F.concat_ws(" ", *_run_of(tokens, i, size)).alias("anchor"), i.alias("place"),
            (i - start).alias("at"), F.slice(tokens, start + 1, F.lit(width)).alias("piece"),
        )

    last = F.size(tokens) - size
    places = F.when(last >= 0, F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), may_be))
    return F.transform(F.coalesce(places, F.array().cast("array<int>")), row)


def candidate_runs(docs: DataFrame, anchors: DataFrame) -> DataFrame:
    """``(uri, size, anchor, place, at, piece)``: the runs of the texts that may be anchors, as their bits say.

    Only these become rows, each with the tokens around it that its phrases can need, so no text is
    read or moved again. A run that is an anchor is never missed; what is none goes with the join by anchor.
    """
    spans = anchors.groupBy("size").agg(F.max("off").alias("left"), F.max(F.size("tokens") - F.col("off")).alias("right")).collect()  # three rows at most
    given = docs.select("uri", normalise(F.col("text")).alias("_norm")).where(F.length("_norm") > 0).select("uri", F.split("_norm", " ").alias("_tokens"))
    found = [_candidates_of(F.col("_tokens"), s["size"], _filter_words(anchors, s["size"]), s["left"], s["left"] + s["right"]) for s in spans]
    # The outer form: for the inner one the planner computes the array twice.
    return given.select("uri", F.explode_outer(F.concat(*found)).alias("_run")).where(F.col("_run").isNotNull()).select("uri", "_run.*")


def occurrences(docs: DataFrame, phrases: DataFrame) -> DataFrame:
    """Every place of a phrase: ``(phrase, uri, place, n_tokens)``, where ``place`` counts tokens.

    ``docs`` has ``uri`` and ``text``, ``phrases`` has ``phrase``. Runs of the texts meet phrases over an anchor, never pair by
    pair, and the whole phrase is then compared in place. Adaptive execution broadcasts a small phrase table by its
    bytes and splits skewed anchors of a larger one.
    """
    anchors = _anchors(phrases)
    if anchors.isEmpty():
        return docs.select(F.lit("").alias("phrase"), "uri", F.lit(0).alias("place"), F.lit(0).alias("n_tokens")).where(F.lit(False))
    met = candidate_runs(docs, anchors).join(anchors, ["size", "anchor"])
    start, n = F.col("at") - F.col("off"), F.size("tokens")
    whole = (start >= 0) & (F.slice("piece", F.greatest(start, F.lit(0)) + 1, n) == F.col("tokens"))
    return met.where(whole).select("phrase", "uri", (F.col("place") - F.col("off")).alias("place"), n.alias("n_tokens"))


def phrase_hits(docs: DataFrame, phrases: DataFrame) -> DataFrame:
    """Every document that holds a phrase: ``(phrase, uri, score)``.

    Score is the number of occurrences, from the left, that do not overlap.
    """
    places = occurrences(docs, phrases).groupBy("phrase", "uri", "n_tokens").agg(F.array_sort(F.collect_set("place")).alias("_places"))
    start = F.struct(F.lit(0).alias("free"), F.lit(0).cast("bigint").alias("n"))
    taken = F.aggregate("_places", start, lambda acc, p: F.when(p >= acc["free"], F.struct((p + F.col("n_tokens")).alias("free"), (acc["n"] + 1).alias("n"))).otherwise(acc))
    return places.select("phrase", "uri", taken["n"].alias("score"))


def phrase_hits_any(docs: DataFrame, phrases: DataFrame, fields: list[str]) -> DataFrame:
    """As ``phrase_hits``, over several text fields: a phrase lies within one field, and scores add up.

    ``fields`` are columns of texts or of arrays of texts.
    """
    kinds = dict(docs.dtypes)
    texts = F.flatten(F.array(*[F.coalesce(f, F.array().cast("array<string>")) if kinds[f].startswith("array") else F.array(f) for f in fields]))
    parts = docs.select("uri", F.posexplode(texts).alias("_field", "text")).where(F.col("text").isNotNull())
    hits = phrase_hits(parts.select(F.struct("uri", "_field").alias("uri"), "text"), phrases)
    return hits.groupBy("phrase", F.col("uri.uri").alias("uri")).agg(F.sum("score").alias("score"))


def indicator_matches(docs: DataFrame, indicators: DataFrame, fields: list[str], default_publisher: str, top: int = TOP_HITS) -> DataFrame:
    """Indicators ``(phrase, occurred)`` looked up in any field, then counted by publisher.

    The best hits of each indicator are kept, and each match shows when the indicator last occurred.
    """
    best = top_hits(phrase_hits_any(docs, indicators.select("phrase"), fields), top)
    return publisher_matches(best, docs, indicators, default_publisher)


def top_hits(hits: DataFrame, top: int = TOP_HITS) -> DataFrame:
    """The best hits per phrase; a popular phrase is cut down before the shuffle."""
    best = Window.partitionBy("phrase").orderBy(F.desc("score"), "uri")
    return hits.withColumn("place", F.row_number().over(best)).where(F.col("place") <= top)


def extract_entities(docs: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Mentions of listed names: ``(uri, term, kind, mentions)``.

    ``gazetteer`` has ``term`` and ``kind``.
    """
    hits = phrase_hits(docs, gazetteer.select(F.col("term").alias("phrase")))
    named = gazetteer.select(F.col("term").alias("phrase"), "kind").distinct()
    return hits.join(named, "phrase").select("uri", F.col("phrase").alias("term"), "kind", F.col("score").alias("mentions"))


def hit_dates(docs: DataFrame, default_publisher: str) -> DataFrame:
    """``(uri, publisher, date, dated_by)``: each publisher of a document with its dates.

    The dates are those of the first field, by priority, that has any; date
    fields and publishers are arrays.
    """
    publishers = F.when(F.size("publisher") > 0, F.col("publisher")).otherwise(F.array(F.lit(default_publisher)))
    dated_by = F.coalesce(*[F.when(F.size(d) > 0, F.lit(d)) for d in DATE_PRIORITY])
    return docs.select(
        "uri", publishers.alias("publisher"), first_dates(*[F.col(d) for d in DATE_PRIORITY]).alias("dates"), dated_by.alias("dated_by")
    ).select("uri", F.explode("publisher").alias("publisher"), "dates", "dated_by").select(
        "uri", "publisher", F.explode_outer("dates").alias("date"), "dated_by"
    )


def publisher_matches(hits: DataFrame, docs: DataFrame, indicators: DataFrame, default_publisher: str) -> DataFrame:
    """Matches per publisher and indicator, with the first and last date.

    ``indicators`` has ``phrase`` and ``occurred``. Hits are at most a hundred per
    indicator; dates are compared as dates.
    """
    dated = hit_dates(docs, default_publisher)
    found = dated.join(hits.select("uri", "phrase"), "uri")
    return (
        found.groupBy("publisher", "phrase")
        .agg(F.countDistinct("uri").alias("documents"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))
        .join(indicators, "phrase")
        .select("publisher", "phrase", "occurred", "documents", "first_date", "last_date")
    )
