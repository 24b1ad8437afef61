"""The document log, the bucketed store, and runs that stop between any two steps."""

import datetime as dt
import json
import re

import pytest
from pyspark.sql import functions as F

from threatlake.operators import doclog, frames, publish, state
from threatlake.operators.mapping import MappingSpec, many, model_routes
from threatlake.plans import daily
from threatlake.schema import STATEMENT

DOC = "doc_type string, uri string, part long, doc string"
RECORD = "_id string, timestamp long, raw_content string, content_type string, source_name string"


def commit(spark, root, name, rows, gone=(), buckets=4):
    framed = spark.createDataFrame(rows, DOC)
    away = spark.createDataFrame(list(gone), "doc_type string, uri string") if gone else None
    doclog.commit(spark, root, name, lambda: doclog.delta(spark, root, framed, away, buckets), [name])


def held(spark, root, **options):
    return sorted(tuple(r) for r in doclog.documents(spark, root, **options).select("doc_type", "uri", "part", "doc").collect())


def test_log_newest_rows_win(spark, tmp_path):
    root = str(tmp_path / "log")
    assert held(spark, root) == [] and doclog.committed(spark, root, "a") is None
    first = [("t", "a", 0, "1"), ("t", "a", 1, "2"), ("t", "b", 0, "1"), ("u", "a", 0, "x"), ("t", "two", 0, "p"), ("t", "two", 0, "q")]
    commit(spark, root, "a", first)
    assert held(spark, root) == sorted(first)
    # b is as it was, a's part 1 is gone and part 2 new, one of two documents of a key differs
    commit(spark, root, "b", [("t", "a", 0, "1"), ("t", "a", 2, "3"), ("t", "b", 0, "1"), ("t", "two", 0, "p"), ("t", "two", 0, "r")])
    second = [("t", "a", 0, "1"), ("t", "a", 2, "3"), ("t", "b", 0, "1"), ("u", "a", 0, "x"), ("t", "two", 0, "p"), ("t", "two", 0, "r")]
    assert held(spark, root) == sorted(second) and held(spark, root, upto=1) == sorted(first)
    written = doclog.committed(spark, root, "b").collect()
    assert sorted((r["uri"], r["part"], r["doc"]) for r in written) == [("a", 2, "3"), ("two", 0, "p"), ("two", 0, "r")]
    commit(spark, root, "c", [], gone=[("u", "a"), ("t", "none")])
    third = [r for r in second if r[0] != "u"]
    assert held(spark, root) == sorted(third)
    changed = doclog.changes(spark, root, 1, 3).select("uri", "part", "removed").distinct().collect()
    assert sorted(map(tuple, changed)) == [("a", 0, True), ("a", 1, True), ("a", 2, False), ("two", 0, False)]
    doclog.compact(spark, root, keep_after=2)
    doclog.compact(spark, root)  # one folder: nothing to do
    assert held(spark, root) == sorted(third)
    assert [tuple(r) for r in doclog.changes(spark, root, 2, 3).select("doc_type", "uri", "removed").collect()] == [("u", "a", True)]
    with pytest.raises(ValueError):
        held(spark, root, upto=1)
    commit(spark, root, "d", [("u", "a", 0, "back"), ("t", "b", 0, "1")])
    assert held(spark, root) == sorted([*third, ("u", "a", 0, "back")])


def test_a_commit_goes_on_and_is_fenced(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "log")
    commit(spark, root, "a", [("t", "a", 0, "1")])

    def stop(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(doclog, "point_to", stop)
        with pytest.raises(RuntimeError, match="stopped"):
            commit(spark, root, "b", [("t", "b", 0, "1")])
    assert held(spark, root) == [("t", "a", 0, "1")]
    doclog.commit(spark, root, "b", stop, ["b"])  # the folder is whole, so nothing is made again
    assert held(spark, root) == [("t", "a", 0, "1"), ("t", "b", 0, "1")]

    def another_run():
        commit(spark, root, "other", [("t", "o", 0, "1")])
        return doclog.delta(spark, root, spark.createDataFrame([("t", "c", 0, "1")], DOC), buckets=4)

    with pytest.raises(RuntimeError, match="moved"):
        doclog.commit(spark, root, "c", another_run, ["c"])
    assert [r[1] for r in held(spark, root)] == ["a", "b", "o"]


def statements(spark, rows):
    day = dt.date(2024, 1, 1)
    return spark.createDataFrame([(f"u{i}", "T", "p", str(v), None, "s", None, day, None) for i, v in rows], STATEMENT)


def test_the_store_is_not_shuffled(spark, tmp_path):
    root = str(tmp_path / "state")
    state.upsert(spark, root, "", statements(spark, [(i, i) for i in range(50)]), 8)
    state.upsert(spark, root, "1", statements(spark, [(i, i) for i in range(40, 60)] * 3), 4)  # the store keeps its eight buckets
    assert state.read_state(spark, root).count() == 60 == state.read_state(spark, root).distinct().count()
    fresh = statements(spark, [(1, 2), (59, 59)]).withColumn("sid", state.statement_id())
    held_in = state.store(spark, root, state.increments(spark, root))
    for limit in ("-1", "10m"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        new = state.unknown(held_in, fresh, 8)
        assert [r["value"] for r in new.collect()] == ["2"]
        lines = new._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].split("\n")
        at = next(i for i, x in enumerate(lines) if "FileScan parquet spark_catalog" in x)
        assert limit == "10m" or "Bucketed: true" in lines[at]
        depth, above = len(re.match("[ :+-]*", lines[at])[0]), []
        for x in reversed(lines[:at]):  # the nodes that the scan's rows pass through
            indent = len(re.match("[ :+-]*", x)[0])
            if indent < depth:
                above.append(x)
                depth = indent
        joined = next(i for i, x in enumerate(above) if "Join" in x)
        assert not any("Exchange" in x for x in above[:joined]), above
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def job(spark, tmp_path):
    def record(i):
        return (f"r{i}", i, json.dumps({"id": i % 3, "text": f"see CVE-2017-{1000 + i}"}), "application/json", "hg-blogs")

    cdr = spark.createDataFrame([record(i) for i in range(1, 10)], RECORD)
    found = F.transform("extractions.cve", lambda h: F.concat(F.lit("vuln/"), F.lower(h["value"])))
    blog = MappingSpec("hg-blogs", "Blog", F.concat(F.lit("blog/"), F.try_variant_get("json_rep", "$.id", "string")), {}, {"mentions": many(found)})
    spec = {"blog": frames.FrameSpec("Blog", {"mentions": frames.FrameSpec("Vulnerability", {})})}
    routes, out = model_routes(spark, ["hg-blogs"]), str(tmp_path / "out")

    def run(upto, mark="", to=out):
        return daily.refresh(spark, cdr.where(F.col("timestamp") <= upto), to, routes, [blog], spec, mark=mark, buckets=4)

    return run, out


def stopping(monkeypatch, module, name, times=1):
    """The function stops ``times`` calls from now."""
    kept, left = getattr(module, name), [times]

    def one(*a, **b):
        left[0] -= 1
        if left[0] == 0:
            raise RuntimeError("stopped")
        return kept(*a, **b)

    monkeypatch.setattr(module, name, one)


def test_one_day_writes_what_it_changes(spark, job, tmp_path):
    run, out = job
    run(8)
    run(9, mark=8)
    top = doclog.head(spark, f"{out}/documents")[1]
    rows = spark.read.parquet(f"{out}/documents/{top['folders'][1]}").collect()
    assert [r["uri"] for r in rows] == ["blog/0"] and len(top["folders"]) == 2
    once = str(tmp_path / "once")
    run(9, to=once)
    assert held(spark, f"{out}/documents") == held(spark, f"{once}/documents")


def test_a_refresh_covers_what_stopped_before_it(spark, job, monkeypatch, tmp_path):
    run, out = job
    run(7)
    with monkeypatch.context() as m:
        stopping(m, doclog, "commit")
        with pytest.raises(RuntimeError):
            run(8, mark=7)
    assert sorted(r["uri"] for r in run(9, mark=8).collect()) == ["blog/0", "blog/2"]
    assert sorted(r["uri"] for r in run(8, mark=7).collect()) == ["blog/0", "blog/2"]  # covered by the later commit
    once = str(tmp_path / "once")
    run(9, to=once)
    assert held(spark, f"{out}/documents") == held(spark, f"{once}/documents")


STEPS = [("point_to", 1), ("save_frames", 1), ("publish_rows", 1), ("snapshot_rows", 1), ("point_to", 2), ("expired_aliases", 1)]


@pytest.mark.parametrize("name, times", STEPS)
def test_a_publish_that_stops_ends_right(spark, job, monkeypatch, name, times):
    run, out = job
    run(8)
    daily.publish_day(spark, out, dt.date(2024, 1, 1))
    run(9, mark=8)
    with monkeypatch.context() as m:
        stopping(m, daily, name, times)
        with pytest.raises(RuntimeError, match="stopped"):
            daily.publish_day(spark, out, dt.date(2024, 1, 2))
    rows = daily.publish_day(spark, out, dt.date(2024, 1, 2)).orderBy("snapshot").collect()
    assert [(str(r["snapshot"]), r["doc_type"], r["rows"]) for r in rows] == [("2024-01-01", "blog", 3), ("2024-01-02", "blog", 3)]
    assert state.pointed(spark, f"{out}/published/latest").endswith("/2024-01-02")
    assert [r["uri"] for r in spark.read.json(f"{out}/published/2024-01-02/json/blog").collect()] == ["blog/0"]
    assert sorted(map(tuple, daily.published(spark, out).select("doc_type", "uri", "part", "doc").collect())) == held(spark, f"{out}/documents")
    daily.publish_day(spark, out, dt.date(2023, 12, 31))  # an older day leaves the pointer
    assert state.pointed(spark, f"{out}/published/latest").endswith("/2024-01-02")
    assert publish.alias_of(dt.date(2024, 1, 2)) in {r["alias"] for r in rows}


def test_a_whole_version_has_the_documents_that_did_not_change(spark, job):
    run, out = job
    run(8)
    daily.publish_day(spark, out, dt.date(2024, 1, 1), whole=True)
    run(9, mark=8)
    rows = daily.publish_day(spark, out, dt.date(2024, 1, 2), whole=True).where("snapshot = '2024-01-02'").collect()
    assert sorted(r["uri"] for r in spark.read.json(f"{out}/published/2024-01-02/json/blog").collect()) == ["blog/0", "blog/1", "blog/2"]
    assert [r["rows"] for r in rows] == [3]


def test_a_large_store_has_more_buckets(spark, tmp_path, monkeypatch):
    """What a task holds of an increment follows the buckets, so these follow the rows the store starts with."""
    monkeypatch.setattr(state, "BUCKET_ROWS", 10, raising=False)
    root = str(tmp_path / "state")
    state.upsert(spark, root, "", statements(spark, [(i, i) for i in range(50)]), 2)
    new = state.upsert(spark, root, "1", statements(spark, [(i, i) for i in range(40, 60)] * 3), 2)
    assert state.pointed(spark, f"{root}/_buckets") == "5"
    assert sorted(int(r["value"]) for r in new.collect()) == list(range(50, 60))
    assert state.read_state(spark, root).count() == 60 == state.read_state(spark, root).distinct().count()
