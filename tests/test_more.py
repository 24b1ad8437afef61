"""Mentions, page chains, ragged rows, paging and the id index, against plain versions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from threatlake.operators import idindex, mentions, numbering, search
from threatlake.operators.state import increments, read_increments
from threatlake.sources import feeds, files
from threatlake.streaming import jobs


def norm(t):
    return "".join(c if c.isalnum() else " " for c in t.lower()).split()


def plain_mentions(text, terms):
    """From the left, the longest at each place."""
    tokens, out, at = norm(text), [], 0
    while at < len(tokens):
        here = [t for t in terms if norm(t) and tokens[at : at + len(norm(t))] == norm(t)]
        if here:
            best = min(here, key=lambda t: (-len(norm(t)), t))
            out.append((best, at))
            at += len(norm(best))
        else:
            at += 1
    return out


def test_mentions_are_leftmost_longest(spark):
    rng = random.Random(12)
    words = ["Red", "red", "fox", "den", "of", "the", "a"]
    terms = ["red fox", "Red Fox", "red", "fox den of the", "den of", "the red fox den", "of the", "a a", "!!", "fox-den"]
    texts = {f"d{i}": " ".join(rng.choice(words) + rng.choice(["", ",", "."]) for _ in range(rng.randint(0, 40))) for i in range(60)}
    docs = spark.createDataFrame(list(texts.items()), "uri string, text string")
    found = search.occurrences(docs, spark.createDataFrame([(t,) for t in terms], "phrase string"))
    got = {}
    for r in mentions.leftmost_longest(found).collect():
        got.setdefault(r["uri"], []).append((r["phrase"], r["place"]))
    assert {u: sorted(m, key=lambda x: x[1]) for u, m in got.items()} == {u: plain_mentions(t, terms) for u, t in texts.items() if plain_mentions(t, terms)}


def test_only_runs_that_may_be_anchors_become_rows(spark, sf):
    """At most five rows for each that is one, whatever the texts hold."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id").cast("string").alias("uri"), "text")
    phrases = spark.createDataFrame([(p,) for p in ("in the", "of", "que la", "der", "one two three four")], "phrase string")
    anchors = search._anchors(phrases)
    runs = search.candidate_runs(docs, anchors)
    n, hits = runs.count(), runs.join(anchors, ["size", "anchor"]).count()
    assert 0 < hits <= n <= 5 * hits


def test_page_chains(spark):
    def page(pull, start, n, total=None, limit=10):
        return ("s", dt.date(2024, 1, pull), start, n, limit, total)

    rows = [
        *(page(1, k, 10) for k in (0, 10)), page(1, 20, 4),  # whole, by its short last page
        *(page(2, k, 10, 30) for k in (0, 10, 20)),  # whole, by its total
        *(page(3, k, 10, 60) for k in (0, 10, 40, 50)),  # twenty rows missing
        page(4, 0, 10), page(4, 0, 7), page(4, 10, 10),  # a page twice; not ended
        page(5, 10, 3),  # begins late
        page(6, 0, 10, 15), page(6, 5, 10, 15),  # pages that overlap
        page(7, 0, 0),  # an empty pull
        page(8, 0, 10, 12), page(8, 10, 1, 12),  # short, and less than declared
    ]
    df = spark.createDataFrame(rows, "source_name string, pull_date date, start long, n long, page_limit long, total long")
    got = {r["pull_date"].day: (r["pages"], r["repeats"], r["islands"], r["missing"], r["overlap"], r["rows"], r["ended"], r["complete"]) for r in feeds.page_chains(df).collect()}
    assert got == {
        1: (3, 0, 1, 0, 0, 24, True, True), 2: (3, 0, 1, 0, 0, 30, True, True), 3: (4, 0, 2, 20, 0, 40, True, False), 4: (2, 1, 1, 0, 0, 20, False, False),
        5: (1, 0, 1, 10, 0, 3, True, False), 6: (2, 0, 1, 0, 5, 15, True, True), 7: (1, 0, 1, 0, 0, 0, True, True), 8: (2, 0, 1, 0, 0, 11, True, False),
    }


def test_ragged_rows_are_kept_or_held(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a;b;c\n1;2;3\n1;2\n\n1;2;3;4\n"x;y;z\n;;\n')
    (tmp_path / "b.csv").write_text("a;b;c\n7;8;9;\n")
    kept = files.read_delimited_whole(spark, str(tmp_path), ";").collect()
    assert sorted(map(tuple, kept), key=repr) == sorted([("1", "2", "3"), ("1", "2", None), ('"x', "y", "z"), (None, None, None)], key=repr)
    held = files.delimited_quarantine(spark, str(tmp_path), ";").collect()
    assert sorted((r["file"].rsplit("/", 1)[1], r["line"]) for r in held) == [("a.csv", "1;2;3;4"), ("b.csv", "7;8;9;")]


@pytest.mark.parametrize("ranges", [1, 4, 64])
def test_pages_by_range(spark, ranges):
    rng = random.Random(ranges)
    rows = [(rng.choice(["hot", "hot", None, f"k{rng.randrange(40):02d}"]), rng.randrange(1000), f"v{i}") for i in range(400)]
    df = spark.createDataFrame(rows, "k string, n int, v string").repartition(5)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2]))
    for start, limit in ((0, 10), (3, 1), (150, 37), (390, 50), (400, 5), (0, 400), (7, 0)):
        got = numbering.page(df, ["k"], start, limit, ranges).collect()
        assert [tuple(r) for r in got] == order[start : start + limit], (start, limit)
    assert numbering.page(df.limit(0), ["k"], 0, 5, ranges).count() == 0


def test_a_page_sorts_only_its_ranges(spark):
    df = spark.range(10_000).selectExpr("format_string('%05d', id) as k", "id")
    got = numbering.page(df, ["k"], 5000, 20)
    assert [r["id"] for r in got.collect()] == list(range(5000, 5020))
    assert got.count() == 20 and "Exchange rangepartitioning" not in got._jdf.queryExecution().executedPlan().toString()


def test_new_ids_read_no_earlier_ones(spark, tmp_path):
    root = str(tmp_path / "ids")

    def batch(*ids):
        return spark.createDataFrame([(i,) for i in ids], "_id string")

    def save(k, *ids):
        fresh, read = idindex.unseen(spark, root, batch(*ids))
        kept = sorted(r["_id"] for r in fresh.collect())
        fresh.withColumn("bucket", idindex.bucket(F.col("_id"))).write.partitionBy("bucket").parquet(f"{root}/increment=b{k}")
        return kept, read

    assert save(0, "a", "b") == (["a", "b"], [])
    idindex.save_bitmap(spark, root)
    size = idindex.bitmap(spark, root, increments(spark, root)).count()
    assert save(1, "c", "d", "e") == (["c", "d", "e"], []) and size <= 2  # nothing was read; the run stops before its bitmap
    kept, read = save(2, "a", "e", "f")
    known = {r["b"] for r in batch("a", "e").select(idindex.bucket(F.col("_id")).alias("b")).collect()}
    assert kept == ["f"] and set(read) == known
    idindex.save_bitmap(spark, root)
    idindex.save_bitmap(spark, root)


def test_a_full_bitmap_loses_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(idindex, "BITS", 64)
    root = str(tmp_path / "ids")
    old = spark.range(3000).selectExpr("concat('o', id) as _id")
    old.withColumn("bucket", idindex.bucket(F.col("_id"))).coalesce(2).write.partitionBy("bucket").parquet(f"{root}/increment=a")
    idindex.save_bitmap(spark, root)
    fresh, read = idindex.unseen(spark, root, old.limit(500).unionByName(spark.range(300).selectExpr("concat('n', id) as _id")))
    assert sorted(r["_id"] for r in fresh.collect()) == sorted(f"n{i}" for i in range(300)) and len(read) > 40


def test_stream_passes_rows_without_an_id(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for ids in (["a", None, None], ["a", "b", None]):
        spark.createDataFrame([(i,) for i in ids], "_id string").coalesce(1).write.mode("append").parquet(source)
    jobs.run(jobs.first_seen_stream(jobs.stream_files(spark, source, "_id string", per_trigger=1), out, str(tmp_path / "c")), lambda: None)
    got = [r["_id"] for r in read_increments(spark, out).collect()]
    assert sorted(got, key=repr) == sorted(["a", "b", None, None, None], key=repr)
