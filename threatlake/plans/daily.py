"""The daily jobs: evidence to published documents, and the feed audit."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audit, doclog
from ..operators.extract import CVE, MSID, ExtractorSpec, extract
from ..operators.frames import FrameSpec, affected, frame
from ..operators.mapping import MappingSpec, route, statements
from ..operators.publish import alias_of, expired_aliases, publish_rows, save_frames, snapshot_rows, unique_documents
from ..operators.state import BUCKETS, increment_folder, increments, point_to, pointed, pointed_at, read_state, stage, stage_done, upsert
from ..schema import STATEMENT
from ..session import cut_lineage, distinct_keys
from ..sources.cdr import INITIAL, since, with_json

CATALOG = "snapshot date, doc_type string, rows bigint, bytes bigint, alias string"


def refresh(
    spark: SparkSession,
    cdr: DataFrame,
    out: str,
    routes: DataFrame,
    models: list[MappingSpec],
    frames: dict[str, FrameSpec],
    mark: str | int = "",
    extractors: Sequence[ExtractorSpec] = (CVE, MSID),
    buckets: int = BUCKETS,
    derived: Sequence[tuple[Callable[[DataFrame], DataFrame], list[MappingSpec]]] = (),
) -> DataFrame:
    """Extract, map, merge and frame the records after ``mark``; return the changed documents.

    Without a mark all records are taken. Every stage is saved under its increment and skipped when an earlier run
    finished it. Statements merge into the store, so increments give the same documents as one full run. After the
    first run only the documents that new statements can reach are framed again, and only those that
    came out different are written, as a commit of the document log (``doclog``). ``derived`` are further rows to map, each with
    its models: what is found in the records, such as identifiers and mentions of names, becomes entities of its own.

    An increment that the log covers returns the delta that it had and changes nothing. Increments that reached the
    store while their run stopped before the commit are covered by the next one.
    """
    log, name = f"{out}/documents", str(mark) or INITIAL
    done = doclog.committed(spark, log, name)
    if done is not None:
        return done
    picked = since(cdr, mark)
    extracted = stage(
        spark,
        increment_folder(f"{out}/extractions", mark),
        lambda: extract(with_json(picked), *extractors).drop("json_rep"),
    )
    records = with_json(extracted)
    mapped = [statements(route(records, routes), models)] + [statements(rows(records), specs) for rows, specs in derived]
    upsert(spark, f"{out}/state", str(mark), reduce(DataFrame.unionByName, mapped), buckets)
    _, top = doclog.head(spark, log)
    pending = [f for f in increments(spark, f"{out}/state") if f.rsplit("increment=", 1)[1] not in top["covered"]]
    merged = read_state(spark, f"{out}/state")

    def framed(uris: DataFrame | None) -> DataFrame:
        docs = [frame(merged, n, spec, only=None if uris is None else affected(merged, spec, uris)) for n, spec in frames.items()]
        return unique_documents(reduce(DataFrame.unionByName, docs))

    def changed() -> DataFrame:
        if not top["folders"]:
            return doclog.delta(spark, log, framed(None), buckets=buckets)
        uris = cut_lineage(distinct_keys(spark.read.schema(STATEMENT).parquet(*pending), "uri"))
        return doclog.delta(spark, log, cut_lineage(framed(uris)), buckets=buckets)

    doclog.commit(spark, log, name, changed, [f.rsplit("increment=", 1)[1] for f in pending])
    return doclog.committed(spark, log, name)


def publish_day(spark: SparkSession, out: str, day: dt.date, whole: bool = False) -> DataFrame:
    """Publish what changed since the last published version as that day's version; return the catalog.

    First an intent names the commits that the day takes, so a run that goes on after a stop publishes the same ones. Then come
    changed documents as JSON by type, the keys of removed ones, the catalog's row for each type with its totals and the
    day's alias, and the ``latest`` pointer, which only moves to a later day. Every step is skipped when it is done.
    Aliases of ``KEEP_DAYS`` days or more are taken away, and their snapshots are named by none. With ``whole`` the version holds
    all documents that stand, for an index that is made anew for each day.
    """
    version, log, latest = f"{out}/published/{day:%Y-%m-%d}", f"{out}/documents", f"{out}/published/latest"
    if pointed(spark, f"{version}/_intent") is None:
        last = pointed(spark, latest)
        before = json.loads(pointed(spark, f"{last}/_intent"))["upto"] if last else 0
        point_to(spark, f"{version}/_intent", json.dumps({"after": before, "upto": doclog.head(spark, log)[1]["seq"]}), 0)
    intent = json.loads(pointed(spark, f"{version}/_intent"))
    folder = f"{out}/catalog"
    entry = f"{folder}/day={day:%Y-%m-%d}"
    if not stage_done(spark, entry):
        news = doclog.changes(spark, log, intent["after"], intent["upto"])
        docs = doclog.documents(spark, log, intent["upto"]) if whole else news.where(~F.col("removed"))
        save_frames(docs.select(*doclog.KEY, "doc"), f"{version}/frames")
        publish_rows(spark.read.schema(doclog.DOCUMENT).parquet(f"{version}/frames"), f"{version}/json")
        news.where("removed").select(*doclog.KEY).write.mode("overwrite").json(f"{version}/removed")
        snapshot_rows(doclog.documents(spark, log, intent["upto"]), day, alias_of(day)).write.mode("overwrite").parquet(entry)
    number, last = pointed_at(spark, latest)
    if last is None or last.rsplit("/", 1)[1] < f"{day:%Y-%m-%d}":
        point_to(spark, latest, version, number)
    catalog = spark.read.schema(CATALOG).parquet(folder)
    newest = catalog.agg(F.max("snapshot")).head()[0]
    old = expired_aliases(catalog, newest).select("alias")
    gone = old.withColumn("_gone", F.lit(True))
    named = F.when(F.col("_gone").isNull(), F.col("alias"))
    return catalog.join(gone, "alias", "left").select("snapshot", "doc_type", "rows", "bytes", named.alias("alias"))


def published(spark: SparkSession, out: str, day: dt.date | None = None) -> DataFrame:
    """All documents of a published version, the latest by default."""
    version = f"{out}/published/{day:%Y-%m-%d}" if day else pointed(spark, f"{out}/published/latest")
    return doclog.documents(spark, f"{out}/documents", json.loads(pointed(spark, f"{version}/_intent"))["upto"]).select(*doclog.KEY, "doc")


def audit_day(spark: SparkSession, cdr: DataFrame, out: str, policy: DataFrame, as_of: dt.date) -> DataFrame:
    """Recount two days, write the day's report, return the alerts."""
    audit.write_counts(audit.recent_counts(cdr, as_of), f"{out}/counts")
    facts = spark.read.schema("source_name string, count_downloaded bigint, date_of_pull date").parquet(f"{out}/counts")
    (
        audit.full_report(facts, as_of)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date_of_pull")
        .parquet(f"{out}/report")
    )
    return audit.alerts(facts, policy, as_of)


def saved_reports(spark: SparkSession, out: str, as_of: dt.date) -> DataFrame:
    """The saved reports of a day and of the day a week before; two folders are read."""
    days = [as_of, as_of - dt.timedelta(days=audit.REPORT_DAYS)]
    return spark.read.parquet(f"{out}/report").where(F.col("date_of_pull").isin(*days))
