"""Queries over all of their tables, held against the tables themselves."""

import datetime as dt
import re

from pyspark.sql import functions as F

from threatlake.plans import views
from threatlake.plans.catalog import QUERIES


def test_feed_pulls_lands_every_event(spark, sf):
    days = [r["d"] for r in spark.read.parquet(f"{sf}/events.parquet").select(F.to_date("ts").alias("d")).collect()]
    day, before = dt.date(2024, 1, 16), dt.date(2024, 1, 15)
    assert min(days) < before and day < max(days)
    got = {r["source_name"]: r for r in QUERIES["feed_pulls"](spark, sf).collect()}
    pulled = {"hg-blogs": sum(d >= day for d in days), "armstrong": sum(before <= d <= day for d in days), "hackmageddon": len(days)}
    assert {s: r["pulled"] for s, r in got.items()} == pulled
    assert all((r["total"], r["landed"], r["last_pull"], r["complete"]) == (len(days), len(days), max(days).isoformat(), True) for r in got.values())


def test_search_gazetteer_looks_up_whole_passages(spark, sf):
    def plain(s):
        return " ".join(re.findall(r"[^\W_]+", s.lower()))

    terms = {(r["text"], "passage") for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    terms |= {(r["r_name"], "region") for r in spark.read.parquet(f"{sf}/region.parquet").collect()}
    docs = [(r["uri"], f" {plain(r['text'])} ") for r in views.doc_index(spark, sf).select("uri", "text").collect()]
    want = {(u, t, k) for t, k in terms if plain(t) for u, text in docs if f" {plain(t)} " in text}
    got = QUERIES["search_gazetteer"](spark, sf).collect()
    assert {(r["uri"], r["term"], r["kind"]) for r in got} == want and len(got) == len(want)
    assert any(k == "passage" for _, _, k in want)
