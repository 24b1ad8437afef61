"""Named entities and identifiers found in records, as rows that models map to statements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .extract import entity_inputs, extraction_rows
from .search import occurrences


def leftmost_longest(found: DataFrame) -> DataFrame:
    """Of places ``(uri, phrase, place, n_tokens)`` those that a reader from the left takes: the longest at each free place.

    Of names that are equal but for case and punctuation the first in order counts. A document's places are one row.
    """
    # The longest first where places are equal.
    spans = F.array_sort(F.collect_set(F.struct("place", (-F.col("n_tokens")).alias("back"), "phrase")))
    held = found.groupBy("uri").agg(spans.alias("_spans"))
    kind = "array<struct<place:int,back:int,phrase:string>>"
    taken = F.aggregate(
        "_spans", F.struct(F.lit(0).alias("free"), F.array().cast(kind).alias("took")),
        lambda acc, s: F.when(s["place"] >= acc["free"], F.struct((s["place"] - s["back"]).alias("free"), F.concat(acc["took"], F.array(s)).alias("took"))).otherwise(acc),
        lambda acc: acc["took"],
    )
    rows = held.select("uri", F.explode_outer(taken).alias("_s")).where(F.col("_s").isNotNull())
    return rows.select("uri", F.col("_s.phrase").alias("phrase"), F.col("_s.place").alias("place"), (-F.col("_s.back")).alias("n_tokens"))


def mentions(records: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Listed names in the cleaned texts of the feeds that go to recognition, by place, not overlapping.

    ``records`` has ``json_rep``, ``gazetteer`` has ``term`` and ``kind``. Returns
    ``_id, source_name, content_type, field, term, kind, place, n_tokens``; a term of two kinds gives two rows.
    """
    texts = entity_inputs(records)
    about = ["_id", "source_name", "content_type", "field"]
    terms = gazetteer.select("term").distinct().withColumnRenamed("term", "phrase")
    kept = leftmost_longest(occurrences(texts.select(F.struct(*about).alias("uri"), "text"), terms))
    named = gazetteer.select(F.col("term").alias("phrase"), "kind").distinct()
    return kept.join(named, "phrase").select("uri.*", F.col("phrase").alias("term"), "kind", "place", "n_tokens")


def mention_rows(records: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Mentions for mapping: model ``mention.<content type>`` for who mentions, ``name`` for what is mentioned."""
    found = mentions(records, gazetteer)
    models = F.array(F.concat(F.lit("mention."), "content_type"), F.lit("name"))
    return found.withColumn("model", F.explode(models))


def identifier_rows(records: DataFrame, *outputs: str) -> DataFrame:
    """Extracted identifiers for mapping, in lower case: model ``identifier.<kind>``."""
    rows = extraction_rows(records, *outputs).select("source_name", "kind", F.lower("value").alias("value")).distinct()
    return rows.withColumn("model", F.concat(F.lit("identifier."), "kind"))
