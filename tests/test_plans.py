"""What the physical plans must and must not hold."""

import pytest

from threatlake.operators import audit, frames, merge, publish
from threatlake.plans import views
from threatlake.plans.catalog import QUERIES
from threatlake.schema import STATEMENT
from threatlake.session import distinct_keys, shared_dir

WRITING = {n for n in QUERIES if n.startswith(("stream_", "state_", "cdr_partition", "cdr_pruned", "frame_", "publish_", "merged_", "search_", "audit_overwrite", "audit_saved", "ablate_retraction", "document_log", "evidence_run", "csv_run", "refresh_", "gt_series_files", "gt_histogram_files", "json_line"))}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_no_cross_joins_and_no_python(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "Pandas" not in text


def test_daily_counts_read_two_columns(spark, sf):
    text = plan(audit.daily_counts(views.cdr(spark, sf)))
    assert "partial_count" in text and text.count("Exchange") == 1
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in text


def test_report_is_one_aggregation_over_the_counts(spark, sf):
    text = plan(audit.report(audit.daily_counts(views.cdr(spark, sf)), views.AS_OF))
    assert "Join" not in text and text.count("FileScan") == 1


def test_shared_dir_follows_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


@pytest.mark.parametrize("name", ["search_phrase_join", "search_short_phrase_top_hits", "search_gazetteer"])
def test_phrases_go_to_the_texts(spark, sf, name):
    """The small side is broadcast by its bytes, and no text is shuffled or joined by pairs."""
    text = plan(QUERIES[name](spark, sf))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text and "Python" not in text


@pytest.mark.parametrize("name", sorted(n for n in WRITING if n.startswith(("frame_", "merged_", "search_"))))
def test_no_cross_joins_in_the_costly_queries(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text and "Python" not in text


@pytest.mark.parametrize("name", ["map_statements", "properties_per_type", "unique_properties"])
def test_records_are_not_dealt_by_feed(spark, sf, name):
    """Routes go to the records, however large these are: a feed with most records is no task of its own."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES[name](spark, sf))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in text and "hashpartitioning(source_name" not in text and "BroadcastHashJoin" in text


@pytest.mark.parametrize("name", ["merge_statements", "ablate_evidence"])
def test_statements_are_dealt_before_they_are_held(spark, sf, name):
    """No distinct starts in the scan, where it would hold all rows of a split."""
    lines = plan(QUERIES[name](spark, sf)).split("Initial Plan")[0].split("\n")
    dealt = next(i for i, x in enumerate(lines) if "Exchange hashpartitioning(uri" in x)
    assert any("HashAggregate" in x for x in lines[:dealt]) and not any("Aggregate" in x for x in lines[dealt:])


def test_entities_are_dealt_before_they_are_listed(spark, tmp_path):
    """No list starts in the scan, where all rows of a split would be sorted."""
    row = ("u", "T", "p", "v", None, "s", "f", None, None)
    spark.createDataFrame([row, row], STATEMENT).write.parquet(str(tmp_path / "s"))
    made = merge.entities(spark.read.schema(STATEMENT).parquet(str(tmp_path / "s")))
    lines = plan(made).split("Initial Plan")[0].split("\n")
    dealt = next(i for i, x in enumerate(lines) if "Exchange hashpartitioning(uri" in x)
    assert any("Aggregate" in x for x in lines[:dealt]) and not any("Aggregate" in x for x in lines[dealt:])
    assert [(r.uri, r.types, r.props) for r in made.collect()] == [("u", ["T"], {"p": ["v"]})]


def dealt_first(text, exchange):
    """That no aggregate or sort lies below the last exchange, which is the given one."""
    lines = text.split("Initial Plan")[0].split("\n")
    dealt = max(i for i, x in enumerate(lines) if "Exchange" in x)
    return exchange in lines[dealt] and any("Aggregate" in x for x in lines[:dealt]) and not any("Aggregate" in x or "Sort" in x for x in lines[dealt:])


def test_documents_are_dealt_before_they_are_grouped(spark, tmp_path):
    """no grouping of documents starts in the scan, where all documents of a split would be sorted."""
    rows = [("t", "u", 0, "a"), ("t", "u", 0, "a"), ("t", "u", 0, "b"), ("t", None, None, None), ("t", None, None, None)]
    spark.createDataFrame(rows, "doc_type string, uri string, part long, doc string").write.parquet(str(tmp_path / "d"))
    made = publish.unique_documents(spark.read.parquet(str(tmp_path / "d")))
    assert dealt_first(plan(made), "Exchange hashpartitioning(doc_type")
    assert sorted(map(str, made.collect())) == sorted(map(str, spark.createDataFrame([rows[0], rows[2], rows[3]], made.schema).collect()))


def test_affected_uris_are_dealt_before_they_are_held(spark, tmp_path, monkeypatch):
    """uris are made distinct in parts of all rows, not in a split, and a uri that most rows have is no task."""
    rows = [("o1", "O", "to", None, "c1", "s", "f", None, None), ("o2", "O", "to", None, "c1", "s", "f", None, None), ("o2", "O", "n", "x", None, "s", "f", None, None), ("c1", "C", "n", "x", None, "s", "f", None, None)]
    spark.createDataFrame(rows, STATEMENT).write.parquet(str(tmp_path / "s"))
    stated, held, cut = spark.read.schema(STATEMENT).parquet(str(tmp_path / "s")), [], frames.cut_lineage
    monkeypatch.setattr(frames, "cut_lineage", lambda df: held.append(plan(df)) or cut(df))
    spec = frames.FrameSpec("O", {"to": frames.FrameSpec("C", {"n": None})})
    changed = spark.createDataFrame([("c1",)], "uri string")
    roots = frames.affected(stated, spec, changed)
    assert sorted(r.uri for r in roots.collect()) == ["o1", "o2"]
    assert frames.frame(stated, "o", spec, only=roots).count() == 2
    assert len(held) == 3 and all("uri#" in x and ", _row#" in x for x in held)
    keys = distinct_keys(stated, "uri")
    assert dealt_first(plan(keys), "Exchange hashpartitioning(uri") and sorted(r.uri for r in keys.collect()) == ["c1", "o1", "o2"]
