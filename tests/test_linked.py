import datetime as dt
import itertools
import json
import re

import pytest
from pyspark.sql import functions as F

from threatlake.operators import extract as ex
from threatlake.operators import doclog, frames, groundtruth, merge, numbering, profile, publish, search, state
from threatlake.operators.mapping import MappingSpec, many, model_routes, route, statements
from threatlake.plans.daily import refresh
from threatlake.schema import STATEMENT
from threatlake.sources.cdr import with_json
from threatlake.streaming import jobs


def stm(spark, rows):
    """``(uri, type, property, value, object_uri[, publisher])`` as statements."""
    full = [(*r[:5], "src", r[5] if len(r) > 5 else "pub", None, None) for r in rows]
    return spark.createDataFrame(full, STATEMENT)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


A = ("a", "T", "a", "T", None)
ALL = [A, ("a", "T", "p", "1", None), ("a", "T", "p", "2", None, "other"), ("b", "U", "a", "U", None), ("a", "T", "link", None, "b"), ("b", "U", "link", None, "a")]


def test_merge_is_a_set_union(spark):
    parts = [stm(spark, ALL[:3]), stm(spark, ALL[2:5]), stm(spark, ALL[4:])]
    whole = rows_of(merge.merge(stm(spark, ALL)))
    for order in itertools.permutations(parts):
        assert rows_of(merge.merge(*order)) == whole
    assert rows_of(merge.merge(stm(spark, ALL), stm(spark, ALL))) == whole


def test_provenance_is_kept(spark):
    two = stm(spark, [("a", "T", "p", "1", None, "x"), ("a", "T", "p", "1", None, "y")])
    row = merge.entities(two).head()
    assert row["props"] == {"p": ["1"]} and {p["publisher"] for p in merge.entity_provenance(two).collect()} == {"x", "y"}


@pytest.mark.parametrize("cap", [3, 1000])
def test_large_entities_come_in_parts_with_nothing_lost(spark, cap):
    rows = [("big", "T", "p", str(i), None) for i in range(20)] + [("small", "T", "p", "1", None)]
    got = merge.entities(stm(spark, rows), cap).collect()
    values = sorted(v for r in got if r["uri"] == "big" for v in r["props"]["p"])
    assert values == sorted(str(i) for i in range(20))
    assert (len([r for r in got if r["uri"] == "big"]) > 1) is (cap == 3)


def test_repeats_do_not_split_an_entity(spark):
    rows = [("a", "T", "p", "1", None, f"pub{i}") for i in range(9)]
    assert [r["parts"] for r in merge.entities(stm(spark, rows), 3).collect()] == [1]


def test_frame_embeds_and_ends_on_circles_and_missing_links(spark):
    rows = stm(spark, [*ALL, ("a", "T", "link", None, "gone")])
    spec = frames.FrameSpec.from_dict({"@type": "T", "@explicit": True, "p": {}, "link": {"@type": "U", "link": {"@type": "T", "p": {}}}})
    doc = json.loads(frames.frame(rows, "t", spec).head()["doc"])
    assert doc["p"] == ["1", "2"]
    inner = {c["uri"]: c for c in doc["link"]}
    assert inner["gone"] == {"uri": "gone"} and inner["b"]["link"] == [{"uri": "a", "a": ["T"], "p": ["1", "2"]}]


def test_frame_without_explicit_keeps_other_properties(spark):
    spec = frames.FrameSpec("T", {"link": None}, explicit=False)
    doc = json.loads(frames.frame(stm(spark, ALL), "t", spec).head()["doc"])
    assert doc["link"] == ["b"] and doc["other"] == [{"property": "p", "value": "1"}, {"property": "p", "value": "2"}]


def test_large_linked_entity_is_linked_by_uri_and_kept_whole(spark):
    many_rows = [("hub", "U", "p", str(i), None) for i in range(10)] + [("hub", "U", "a", "U", None)]
    rows = stm(spark, [A, ("a", "T", "link", None, "hub"), *many_rows])
    docs = frames.frame(rows, "t", frames.FrameSpec("T", {"link": frames.FrameSpec("U", {"p": None})}), cap=4).collect()
    root = [json.loads(d["doc"]) for d in docs if d["doc_type"] == "t"]
    assert root == [{"uri": "a", "a": ["T"], "link": [{"uri": "hub"}]}]
    values = sorted(v for d in docs if d["doc_type"] == "U" for v in json.loads(d["doc"]).get("p", []))
    assert values == sorted(str(i) for i in range(10))


def test_shape_does_not_follow_size(spark):
    spec = frames.FrameSpec("T", {"link": frames.FrameSpec("U", {"p": None}), "p": None}, rows=frozenset({"p"}))

    def made(n):
        rows = [("hub", "U", "p", str(i), None) for i in range(n)] + [("a", "T", "p", str(i), None) for i in range(n)] + [("hub", "U", "a", "U", None)]
        docs = frames.frame(stm(spark, [A, ("a", "T", "link", None, "hub"), *rows]), "t", spec).collect()
        root = [json.loads(d["doc"]) for d in docs if d["doc_type"] == "t"]
        return root, [json.loads(d["doc"])["p"] for d in docs if d["doc_type"] == "t.p"]

    for n in (3, 3000):
        root, values = made(n)
        assert [r["uri"] for r in root] == ["a"] and "p" not in root[0] and len(root[0]["link"][0]["p"]) == n
        assert sorted(values) == sorted(map(str, range(n)))
    assert frames.FrameSpec.from_dict({"@type": "T", "p": {"@rows": True}}).rows == {"p"}


def test_documents_of_one_key_all_stay(spark):
    docs = spark.createDataFrame([("U", "x", 0, "1"), ("U", "x", 0, "2"), ("U", "x", 0, "1")], "doc_type string, uri string, part long, doc string")
    assert rows_of(publish.unique_documents(docs)) == [("U", "x", 0, "1"), ("U", "x", 0, "2")]


def test_ablation(spark):
    rows = merge.ablate(stm(spark, ALL), ["other"])
    assert rows.count() == len(ALL) - 1


def test_mapping_routes_aliases_lists_and_nulls(spark):
    cdr = spark.createDataFrame([("isi-twitter", "1", ["x", "y"]), ("asu-twitter", "2", None), ("zzz", "3", None)], "source_name string, k string, tags array<string>")
    spec = MappingSpec("asu-twitter", "Post", F.concat(F.lit("post/"), "k"), {"tag": many(F.col("tags")), "none": F.lit(None)}, publisher=F.lit("p"))
    routed = route(cdr, model_routes(spark, ["asu-twitter"]))
    got = {(r["uri"], r["property"], r["value"], r["source"]) for r in statements(routed, [spec]).collect()}
    assert got == {("post/1", "a", "Post", "isi-twitter"), ("post/1", "tag", "x", "isi-twitter"), ("post/1", "tag", "y", "isi-twitter"), ("post/2", "a", "Post", "asu-twitter")}


def test_model_routes_do_not_grow(spark):
    assert model_routes(spark, ["asu-twitter"]).count() == model_routes(spark, ["asu-twitter"]).count() == 2


def test_upsert_is_idempotent_and_incremental_equals_full(spark, tmp_path):
    root, once = str(tmp_path / "s"), str(tmp_path / "once")
    state.upsert(spark, root, "", stm(spark, ALL[:4]), 4)
    assert state.upsert(spark, root, "2", stm(spark, ALL[3:]), 4).count() == 2
    assert state.upsert(spark, root, "2", stm(spark, ALL), 4).count() == 2  # finished already
    state.upsert(spark, once, "", stm(spark, ALL), 4)
    assert rows_of(state.read_state(spark, root)) == rows_of(state.read_state(spark, once))
    state.rewrite(spark, root, str(tmp_path / "v2"), F.col("publisher") != "other", 4)
    assert state.read_state(spark, str(tmp_path / "v2")).count() == len(ALL) - 1
    pointer = str(tmp_path / "current")
    for version in ("v1", "v2"):
        state.point_to(spark, pointer, version)
        assert state.pointed(spark, pointer) == version


def test_unfinished_stage_is_removed_and_done_again(spark, tmp_path):
    folder = tmp_path / "stage"
    folder.mkdir()
    (folder / "part-0").write_text("half")
    runs = []

    def build():
        runs.append(1)
        return spark.range(3)

    for _ in range(2):
        assert state.stage(spark, str(folder), build).count() == 3
    assert len(runs) == 1 and not (folder / "part-0").exists()
    assert state.increment_folder("r", "") == "r/increment=initial" and state.increment_folder("r", 5) == "r/increment=5"
    for since in ("", 5):
        state.stage(spark, state.increment_folder(str(tmp_path / "many"), since), lambda: spark.range(2))
    assert state.read_increments(spark, str(tmp_path / "many")).count() == 4


def test_unchanged_documents_are_not_in_the_delta(spark):
    schema = "doc_type string, uri string, part long, doc string"
    old = spark.createDataFrame([("t", "a", 0, "1"), ("t", "b", 0, "1")], schema)
    new = spark.createDataFrame([("t", "a", 0, "1"), ("t", "b", 0, "2"), ("t", "c", 0, "1")], schema)
    assert {r["uri"] for r in state.changed_documents(new, old).collect()} == {"b", "c"}


RECORD = "_id string, timestamp long, raw_content string, content_type string, source_name string"


def test_daily_refresh_incremental_equals_full(spark, tmp_path):
    def record(i):
        return (f"r{i}", i, json.dumps({"id": i % 3, "text": f"see CVE-2017-{1000 + i}"}), "application/json", "hg-blogs")

    cdr = spark.createDataFrame([record(i) for i in range(1, 9)], RECORD)
    found = F.transform("extractions.cve", lambda h: F.concat(F.lit("vuln/"), F.lower(h["value"])))
    blog = MappingSpec("hg-blogs", "Blog", F.concat(F.lit("blog/"), F.try_variant_get("json_rep", "$.id", "string")), {}, {"mentions": many(found)})
    spec = {"blog": frames.FrameSpec("Blog", {"mentions": frames.FrameSpec("Vulnerability", {})})}
    routes = model_routes(spark, ["hg-blogs"])

    def current(out):
        return rows_of(doclog.documents(spark, f"{out}/documents").select("doc_type", "uri", "part", "doc"))

    full, steps = str(tmp_path / "full"), str(tmp_path / "steps")
    refresh(spark, cdr, full, routes, [blog], spec, buckets=4)
    refresh(spark, cdr.where("timestamp <= 7"), steps, routes, [blog], spec, buckets=4)
    changed = refresh(spark, cdr, steps, routes, [blog], spec, mark=7, buckets=4)
    assert current(steps) == current(full)
    assert [r["uri"] for r in changed.collect()] == ["blog/2"]
    assert refresh(spark, cdr, steps, routes, [blog], spec, mark=7, buckets=4).count() == 1  # run again: nothing new happens
    before = doclog.head(spark, f"{steps}/documents")
    refresh(spark, cdr.where("timestamp <= 7"), steps, routes, [blog], spec, buckets=4)  # one that is covered commits nothing
    assert doclog.head(spark, f"{steps}/documents") == before


def test_publish_by_type_in_batches(spark, tmp_path):
    docs = spark.range(1200).select(F.lit("post").alias("doc_type"), F.concat(F.lit("u"), "id").alias("uri"), F.lit(0).cast("long").alias("part"), F.lit("{}").alias("doc"))
    saved, out = str(tmp_path / "f"), tmp_path / "p"
    publish.save_frames(docs.unionByName(docs), saved)
    publish.publish(spark, saved, str(out))
    assert spark.read.json(str(out / "post")).count() == 1200
    assert all(len(f.read_text().splitlines()) <= 500 for f in (out / "post").glob("*.json"))
    catalog = publish.snapshot_rows(docs, dt.date(2024, 1, 1), publish.alias_of(dt.date(2024, 1, 1)))
    assert catalog.head()["bytes"] == 2400
    names = catalog.unionByName(publish.snapshot_rows(docs, dt.date(2024, 1, 2), "data-2024-99-99")).unionByName(publish.snapshot_rows(docs, dt.date(2024, 1, 2), "latest"))
    assert [r["alias"] for r in publish.expired_aliases(names, dt.date(2024, 1, 8)).collect()] == ["data-2024-01-01"]


def test_stream_upsert_equals_batch(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    for i in range(0, len(ALL), 2):
        stm(spark, ALL[i : i + 3]).coalesce(1).write.mode("append").parquet(source)
    rows = jobs.stream_files(spark, source, STATEMENT, per_trigger=1)
    jobs.run(jobs.upsert_stream(rows, root, str(tmp_path / "c"), 4), lambda: None)
    assert rows_of(state.read_state(spark, root)) == rows_of(merge.merge(stm(spark, ALL)))


def test_stream_passes_each_id_once_over_batches(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for ids in (["hot"] * 50 + ["a"], ["hot", "b", "b"], ["a", "c"]):
        spark.createDataFrame([(i,) for i in ids], "_id string").coalesce(1).write.mode("append").parquet(source)
    for _ in range(2):  # the second run finds nothing new
        rows = jobs.stream_files(spark, source, "_id string", per_trigger=1)
        jobs.run(jobs.first_seen_stream(rows, out, str(tmp_path / "c")), lambda: None)
    assert sorted(r["_id"] for r in state.read_increments(spark, out).collect()) == ["a", "b", "c", "hot"]


# --- extraction, search, numbering -------------------------------------------------


def test_extraction_reads_the_feed_s_field_with_context(spark):
    raw = [("hg-blogs", json.dumps({"text": ["see CVE-2017-0144x", "MS17-010"], "other": "cve-2011-9999"})), ("x", "cve-2014-123456789 CVE-2015-1111")]
    cdr = spark.createDataFrame([(s, s, r, "application/json") for s, r in raw], "_id string, source_name string, raw_content string, content_type string")
    rows = ex.extraction_rows(ex.extract(with_json(cdr), ex.CVE, ex.MSID), "cve", "msid").collect()
    got = {(r["source_name"], r["kind"], r["value"]) for r in rows}
    assert got == {("hg-blogs", "cve", "CVE-2017-0144"), ("hg-blogs", "msid", "MS17-010"), ("x", "cve", "cve-2014-1234567"), ("x", "cve", "CVE-2015-1111")}
    text = raw[1][1]
    want = {text[max(m.start() - 20, 0) : m.end() + 20] for m in re.finditer(ex.CVE_PATTERN, text)}
    assert {r["context"] for r in rows if r["source_name"] == "x"} == want
    assert {r["field"] for r in rows if r["source_name"] == "hg-blogs"} == {"json_rep.text"}


def test_phrase_hits_equal_brute_force(spark):
    words = "alpha beta gamma alpha-beta".split()
    texts = [" ".join(words[(i * j) % 4] for j in range(1, 9)) for i in range(1, 12)] + ["", "alphabeta"]
    phrases = ["alpha", "Beta gamma", "alpha beta alpha", "gamma alpha beta alpha", "nothing", "!!"]
    docs = spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(texts)], "uri string, text string")
    got = {(r["phrase"], r["uri"]) for r in search.phrase_hits(docs, spark.createDataFrame([(p,) for p in phrases], "phrase string")).collect()}

    def norm(t):
        return " ".join("".join(c if c.isalnum() else " " for c in t.lower()).split())

    want = {(p, f"d{i}") for p in phrases if norm(p) for i, t in enumerate(texts) if f" {norm(p)} " in f" {norm(t)} "}
    assert got == want and got


@pytest.mark.parametrize("limit", ["-1", "10m"])
def test_phrase_hits_do_not_depend_on_the_broadcast(spark, limit):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    docs = spark.createDataFrame([("d", "a b c d"), ("e", "x b c y")], "uri string, text string")
    phrases = spark.createDataFrame([("b c",), ("a b c d",)], "phrase string")
    got = {(r["phrase"], r["uri"], r["score"]) for r in search.phrase_hits(docs, phrases).collect()}
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == {("b c", "d", 1), ("b c", "e", 1), ("a b c d", "d", 1)}


def test_row_numbers_equal_the_window_on_a_hot_group(spark):
    rows = [("hot" if i % 3 else f"g{i % 5}", f"v{i * 7 % 1000:04d}") for i in range(1000)] + [(None, "x"), (None, "y")]
    df = spark.createDataFrame(rows, "g string, v string").distinct()
    got = rows_of(numbering.number_rows(df, ["g"], ["v"], "n"))
    assert got == rows_of(df.selectExpr("g", "v", "cast(row_number() over (partition by g order by v) as bigint) as n"))


def test_pages(spark):
    df = spark.range(100).selectExpr("format_string('%03d', id) as k")
    assert [r["k"] for r in numbering.page(df, ["k"], 40, 5).orderBy("k").collect()] == ["040", "041", "042", "043", "044"]


def test_attribute_paths(spark):
    body = {"a": 1, "b": {"c": {"d": [1, 2]}, "e": [{"f": 1}, 3, [{"no": 1}]], "empty": {}}, "affected_products": {"x": 1}, "n": None}
    cdr = spark.createDataFrame([("s", json.dumps(body), "application/json"), ("s", "bad", "application/json")], "source_name string, raw_content string, content_type string")
    assert {r["path"] for r in profile.attribute_paths(cdr).collect()} == {"a", "b.e.f", "affected_products", "n"}


def test_observed_counts_come_with_the_action(spark):
    rows, seen = profile.observed(spark.range(10), "stage", odd=F.count_if(F.col("id") % 2 == 1))
    assert rows.where("id > 100").count() == 0 and seen.get == {"rows": 10, "odd": 5}


def test_frame_definitions_give_properties_per_type(spark, tmp_path):
    (tmp_path / "malware.json").write_text(json.dumps({"@type": "M", "@explicit": True, "a": {}, "name": {}, "p": {"@type": "V", "name": {}}}, indent=2))
    assert frames.typed_properties(frames.read_frames(spark, str(tmp_path))) == [("M", "name"), ("M", "p"), ("V", "name")]


def test_hits_take_the_first_dated_field_and_a_default_publisher(spark):
    schema = "uri string, publisher array<string>, datePublished array<date>, startDate array<date>, observedDate array<date>, datePosted array<date>, dateRecorded array<date>"
    day = dt.date(2024, 1, 2)
    docs = spark.createDataFrame([("a", [], [], [], [day], [], [dt.date(2020, 1, 1)]), ("b", ["x", "y"], None, None, None, None, [day])], schema)
    got = {(r["uri"], r["publisher"], r["date"], r["dated_by"]) for r in search.hit_dates(docs, "none").collect()}
    assert got == {("a", "none", day, "observedDate"), ("b", "x", day, "dateRecorded"), ("b", "y", day, "dateRecorded")}


def test_monthly_counts_are_plain_sums_with_empty_months(spark):
    days = lambda *d: [dt.date.fromisoformat(x) for x in d]
    docs = spark.createDataFrame(
        [("An invoice", days("2024-01-05", "2024-01-09"), days("2024-01-20"), None), ("Invoice!", None, days("2024-03-01"), []), ("other", None, days("2024-02-01"), None)],
        "text string, startDate array<date>, datePublished array<date>, observedDate array<date>",
    )
    got = {(r["month"].month, r["n"]) for r in search.monthly_histogram(docs, F.col("text"), ["Invoice"]).collect()}
    assert got == {(1, 2), (2, 0), (3, 1)}


def test_email_extractor_reads_the_post(spark):
    cdr = spark.createDataFrame([("a", "x", '{"postContent": "to Bob.B@mail.example.org, now", "other": "no@no.no"}', "application/json")], "_id string, source_name string, raw_content string, content_type string")
    assert [r["value"] for r in ex.extraction_rows(ex.extract(with_json(cdr), ex.EMAIL), "email").collect()] == ["Bob.B@mail.example.org"]


def test_series_and_histogram_files(spark, tmp_path):
    events = spark.createDataFrame([("c", "malicious-email", "2024-01-01 00:00:00"), ("c", "malicious-email", "2024-01-04T00:00:00"), ("c", "malicious-email", "bad")], "company string, event_type string, occurred string")
    series = groundtruth.daily_series(events)
    assert series.count() == 4 and series.agg(F.sum("count")).head()[0] == 2
    groundtruth.write_series(series, str(tmp_path))
    assert spark.read.json(str(tmp_path / "jl")).count() == 2 and spark.read.csv(str(tmp_path / "csv"), header=True).count() == 4
    values = spark.createDataFrame([("email_sender", "x", "1"), ("email_sender", "x", "2"), ("email_sender", "y", "1")], "attribute string, value string, occurred string")
    groundtruth.write_histograms(values, str(tmp_path / "h"))
    seen = spark.read.csv(str(tmp_path / "h" / "values_seen"), header=True)
    assert {(r["n"], r["values_seen"]) for r in seen.collect()} == {("1", "1"), ("2", "1")}
