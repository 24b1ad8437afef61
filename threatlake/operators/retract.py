"""Leaving out evidence by retraction: only what nobody else says goes, and only the documents it reaches are framed again."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import SPREAD, cut_lineage
from .frames import FrameSpec, affected, frame
from .merge import ablate

FACT = ["uri", "type", "property", "value", "object_uri"]
DOCUMENT = ["doc_type", "uri"]


def support(statements: DataFrame) -> DataFrame:
    """For each fact how many statements say it, by publisher and observed day: a row each, whoever says it how often.

    Statements are dealt by fact before they are counted, since the facts of a split would be held at once.
    """
    return statements.repartition(SPREAD, *FACT).groupBy(*FACT, "publisher", "observedDate").agg(F.count("*").alias("n"))


def lost_facts(statements: DataFrame, exclude: list[str] | None = None, upto: dt.date | None = None) -> DataFrame:
    """Facts that are only said by the left-out publishers, or only after a day.

    Of all facts only those of the left-out statements are compared with what stays.
    """
    said = support(statements)
    return _without(_left_out(said, exclude, upto).select(*FACT).distinct(), ablate(said, exclude, upto).select(*FACT))


def _left_out(said: DataFrame, exclude: list[str] | None, upto: dt.date | None) -> DataFrame:
    """What ``ablate`` takes away."""
    gone = F.lit(False)
    if exclude:
        gone = gone | F.coalesce(F.col("publisher").isin(*exclude), F.lit(False))
    if upto is not None:
        gone = gone | F.coalesce(F.col("observedDate") > F.lit(upto), F.lit(False))
    return said.where(gone)


def _without(facts: DataFrame, others: DataFrame) -> DataFrame:
    named = others.distinct().select(*[F.col(c).alias(f"_{c}") for c in FACT])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in FACT])
    return facts.join(named, same, "left_anti")


def ablated_documents(
    statements: DataFrame, docs: DataFrame, frames: dict[str, FrameSpec], exclude: list[str] | None = None, upto: dt.date | None = None
) -> tuple[DataFrame, DataFrame]:
    """The documents ``(doc_type, uri, part, doc)`` as they are without some evidence, and the roots ``(doc_type, uri)`` framed again.

    ``docs`` are those of all evidence, ``statements`` its store. Documents that no lost fact reaches are taken as they are;
    a root of which nothing stays has no document.
    """
    touched = cut_lineage(lost_facts(statements, exclude, upto).select("uri").distinct())
    left, again, roots = ablate(statements, exclude, upto), [], []
    for name, spec in frames.items():
        reached = affected(statements, spec, touched)
        roots.append(reached.select(F.lit(name).alias("doc_type"), "uri"))
        again.append(frame(left, name, spec, only=reached))
    every = cut_lineage(reduce(DataFrame.unionByName, roots))
    # Child rows of a root have its type's name in front.
    root_type = F.split_part("doc_type", F.lit("."), F.lit(1))
    kept = docs.withColumn("_type", root_type).join(every.withColumnRenamed("doc_type", "_type"), ["_type", "uri"], "left_anti").select(*docs.columns)
    return kept.unionByName(reduce(DataFrame.unionByName, again).select(*docs.columns)), every
