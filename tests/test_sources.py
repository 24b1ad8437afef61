import datetime as dt
import io
import json
import tarfile

import pytest
from pyspark.sql import functions as F

from threatlake.functions import dates, ids, text
from threatlake.functions import json as js
from threatlake.operators import social
from threatlake.sources import cdr as cdr_scan
from threatlake.sources import events, feeds, files, landing, tweets


def one(spark, column):
    return spark.range(1).select(column.alias("x")).head()["x"]


def records(spark, rows):
    columns = "_id string, timestamp long, raw_content string, content_type string, url string, version string, team string, source_name string"
    return spark.createDataFrame([(i, t, raw, kind, None, "2.0", "team", source) for i, t, raw, kind, source in rows], columns)


JSON = "application/json"


def test_since_is_strict_and_initial_takes_all(spark):
    rows = records(spark, [("a", 10, "{}", JSON, "s"), ("b", 11, "{}", JSON, None)])
    assert [r["_id"] for r in cdr_scan.since(rows, 10).collect()] == ["b"]
    assert cdr_scan.since(rows, "initial").count() == cdr_scan.since(rows, "").count() == 2


def test_json_rep_null_for_other_types_and_bad_json_is_quarantined(spark):
    rows = records(spark, [("a", 1, '{"x":1}', JSON, "s"), ("b", 1, '{"x":', JSON, "s"), ("c", 1, "<x/>", "application/xml", "s")])
    parsed = {r["_id"]: r["ok"] for r in cdr_scan.with_json(rows).select("_id", F.col("json_rep").isNotNull().alias("ok")).collect()}
    assert parsed == {"a": True, "b": False, "c": False}
    assert [r["_id"] for r in cdr_scan.quarantine(rows).collect()] == ["b"]


def test_partition_comes_from_the_record_time(spark, tmp_path):
    path = str(tmp_path / "cdr")
    landing.write_cdr(records(spark, [("a", 0, "{}", JSON, "s"), ("b", 1709251200, "{}", JSON, "s")]), path)
    got = {(r["_id"], r["year"], r["month"]) for r in cdr_scan.read_cdr(spark, path).collect()}
    assert got == {("a", 1970, 1), ("b", 2024, 3)}
    plan = cdr_scan.between(cdr_scan.read_cdr(spark, path), 1709251200, 1709251300)._jdf.queryExecution().toString()
    assert "PartitionFilters: [((((year" in plan or "PartitionFilters: [isnotnull(year" in plan


def test_known_target_system_is_dropped_and_missing_stays(spark):
    rows = cdr_scan.with_json(
        records(spark, [("a", 1, '{"targetSystem": "K"}', JSON, "rules"), ("b", 1, "{}", JSON, "rules"), ("c", 1, '{"targetSystem": "K"}', JSON, "x")])
    )
    assert {r["_id"] for r in cdr_scan.without_target_system(rows, "rules", "K").collect()} == {"b", "c"}


def test_landing_repeats_are_dropped(spark):
    raw = spark.createDataFrame([('{"a": 1}',), ('{"a": 1}',), ('{"a": 2}',)], "raw_content string")
    feed = feeds.FEEDS["hg-cve"]
    first = landing.land(raw, feed, 5)
    assert first.count() == 3 and set(first.columns) == set(landing.CDR_COLUMNS)
    assert landing.drop_known(first, first.where(F.col("raw_content") == '{"a": 1}')).count() == 1


def test_landing_blanks_fields_only_where_present(spark):
    raw = spark.createDataFrame([('{"postCve": "x", "n": {"postCve": "y"}}',), ('{"z": [1, {"k": null}]}',)], "raw_content string")
    got = {r["raw_content"] for r in landing.land(raw, feeds.FEEDS["asu-hacking-posts"], 5).collect()}
    assert got == {'{"postCve":"","n":{"postCve":"y"}}', '{"z":[1,{"k":null}]}'}


def test_feed_pulls_by_mode_and_completeness(spark, tmp_path):
    root = str(tmp_path / "landing")
    for source in ("hg-cve", "armstrong", "hg-leaked-source"):
        for day in (1, 2, 3):
            raw = spark.createDataFrame([(f'{{"{source}": {day}}}',), (f'{{"p": {day}}}',)], "raw_content string")
            landing.backup(raw, root, source, dt.date(2024, 1, day))

    def days(source, day):
        rows = feeds.pulls(spark, root, feeds.FEEDS[source], day)
        return sorted({r["pull_date"].day for r in rows.select("pull_date").collect()})

    assert days("hg-cve", dt.date(2024, 1, 2)) == [2, 3]
    assert days("hg-cve", feeds.FULL_LOAD) == [1, 2, 3]
    assert days("armstrong", dt.date(2024, 1, 2)) == [1, 2]
    assert days("hg-leaked-source", dt.date(2024, 1, 3)) == [1, 2, 3]
    batch = feeds.pulls(spark, root, feeds.FEEDS["hg-cve"], feeds.FULL_LOAD)
    declared = spark.createDataFrame([("hg-cve", 6), ("hg-zdi", 4)], "source_name string, total long")
    got = {r["source_name"]: (r["landed"], r["complete"]) for r in feeds.completeness(batch, declared).collect()}
    assert got == {"hg-cve": (6, True), "hg-zdi": (0, False)}


def test_delimited_short_rows_leave_keys_out(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('a|b|c\n1|"x|3\n4|5\n')
    got = [json.loads(r["raw_content"]) for r in files.rows_as_json(files.read_delimited(spark, str(path), "|")).collect()]
    assert got == [{"a": "1", "b": '"x', "c": "3"}, {"a": "4", "b": "5"}]


@pytest.mark.parametrize("fmt, body, n, kind", [("csv", "a,b\n1,2\n", 1, JSON), ("json", '{"a": 1}\n\n{"b": 2}\n', 2, JSON), ("xml", "<a>\n<b/>\n</a>\n", 1, "application/xml")])
def test_modelling_records(spark, tmp_path, fmt, body, n, kind):
    path = tmp_path / f"in.{fmt}"
    path.write_text(body)
    rows = files.modelling_records(spark, str(path), fmt, "src", "team", F.lit(9)).collect()
    assert len(rows) == n and all(r["content_type"] == kind and r["_id"].startswith("src_") and len(r["_id"]) == 36 for r in rows)


def test_cdr_lines(spark, tmp_path):
    path = tmp_path / "in.jl"
    path.write_text('{"_id": "x/1", "timestamp": 5, "raw_content": "{}", "source_name": "x"}\n')
    row = files.modelling_records(spark, str(path), "cdr", "", "", F.lit(0)).head()
    assert (row["_id"], row["timestamp"], row["team"]) == ("x/1", 5, None)


def test_table_rows_read_in_one_millisecond_stay_apart(spark):
    rows = spark.sql("select explode(array(1, 2)) as k, cast(1.50 as decimal(9,2)) as price, date'2024-01-02' as d")
    got = files.table_records(rows, "db", "tab", "team", F.lit(1700000000123)).collect()
    assert len({r["_id"] for r in got}) == 2 and got[0]["source_name"] == "db-tab" and got[0]["timestamp"] == 1700000000
    assert json.loads(got[0]["raw_content"]) == {"k": 1, "price": 1.5, "d": "2024-01-02"}


def test_sequence_files_import(spark, tmp_path):
    path = str(tmp_path / "seq")
    spark.sparkContext.parallelize([("feed", '{"a": 1}'), ("feed", '{"a": 2}')], 1).saveAsSequenceFile(path)
    assert {tuple(r) for r in files.import_sequence(spark, path).collect()} == {("feed", '{"a": 1}'), ("feed", '{"a": 2}')}


def test_bucketed_table(spark):
    landing.write_bucketed(records(spark, [("a", 1, "{}", JSON, "s")]), "cdr_bucketed_test", 4)
    assert spark.table("cdr_bucketed_test").count() == 1
    described = {r["col_name"]: r["data_type"] for r in spark.sql("describe extended cdr_bucketed_test").collect()}
    assert described["Num Buckets"] == "4" and described["Bucket Columns"] == "[`source_name`]"
    spark.sql("drop table cdr_bucketed_test")


def test_event_folder_in_two_layouts(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"events": [{"event_type": "x", "target_entity": "t"},\n {"event_type": "y"}]\n}\n')
    (tmp_path / "b.json").write_text('[{"ground_truth": {"event_type": "z", "target_entity": ["p", {"ip": "1.1.1.1"}]}}]')
    (tmp_path / "c.txt").write_text('{"events": [{"event_type": "no"}]}')
    (tmp_path / "d.json").write_text("not json")
    rows = events.typed_events(events.read_event_files(spark, str(tmp_path))).collect()
    got = {r["event_type"]: r["target_entity"] for r in rows}
    assert got == {"x": ["t"], "y": None, "z": ["p", "1.1.1.1"]}


def tweet(i, **more):
    body = {
        "id_str": str(i), "created_at": "Wed Jan 03 10:00:00 +0000 2024", "text": f"t{i}", "retweet_count": i, "favorite_count": 0,
        "in_reply_to_status_id_str": None, "user": {"screen_name": f"u{i}"},
        "entities": {"hashtags": [{"text": "zeroday"}] if i == 1 else [], "user_mentions": []},
    }
    body.update(more)
    return json.dumps({k: v for k, v in body.items() if v != "drop"})


def test_tweet_files_plain_and_packed(spark, tmp_path):
    (tmp_path / "2024-01-03.json").write_text(tweet(1) + "\nnot json\n")

    def pack(name, *bodies):
        with tarfile.open(tmp_path / name, "w:gz") as tar:
            for i, body in enumerate(bodies):
                info = tarfile.TarInfo(f"m{i}")
                info.size = len(body.encode())
                tar.addfile(info, io.BytesIO(body.encode()))

    pack("2024-01-03.tar.gz", tweet(9))  # the plain file of the same day is read instead
    pack("2024-01-04.tar.gz", tweet(2) + "\n" + tweet(3), tweet(8))  # only the first member counts
    (tmp_path / "2024-01-05.tar.gz").write_bytes(b"broken")
    got = tweets.parse_tweets(tweets.read_tweet_files(spark, str(tmp_path)))
    assert [tuple(r) for r in tweets.tweet_quarantine(tweets.read_tweet_files(spark, str(tmp_path))).collect()] == [("2024-01-03", "not json")]
    assert {(r["file"], r["id_str"]) for r in got.collect()} == {("2024-01-03", "1"), ("2024-01-04", "2"), ("2024-01-04", "3")}


def test_archives_that_end_early_are_held_back(spark, tmp_path):
    lines = "\n".join(tweet(i) for i in range(5000)).encode()
    whole = io.BytesIO()
    with tarfile.open(fileobj=whole, mode="w:gz") as tar:
        info = tarfile.TarInfo("x.json")
        info.size = len(lines)
        tar.addfile(info, io.BytesIO(lines))
    (tmp_path / "good.tar.gz").write_bytes(whole.getvalue())
    (tmp_path / "short.tar.gz").write_bytes(whole.getvalue()[: len(whole.getvalue()) // 2])
    (tmp_path / "junk.tar.gz").write_bytes(b"no archive")
    assert {r["file"] for r in tweets.archive_quarantine(spark, str(tmp_path)).collect()} == {"short", "junk"}
    read = {r["file"]: r["count"] for r in tweets.read_tweet_files(spark, str(tmp_path)).groupBy("file").count().collect()}
    assert read["good"] == 5000 and read.get("short", 0) < 5000


def test_broken_lines_of_blanked_feeds_keep_their_text(spark):
    raw = spark.createDataFrame([('{"postCve": "x", "a": 1}',), ('{"postCve": "x"',), ("[1]",)], "raw_content string")
    landed = landing.land(raw, feeds.FEEDS["asu-twitter"], 5)
    assert {r["raw_content"] for r in landed.collect()} == {'{"postCve":"","a":1}', '{"postCve": "x"', "[1]"}
    assert landed.where("_id is null").isEmpty() and cdr_scan.quarantine(landed).count() == 1


def test_event_files_add_up(spark):
    docs = spark.createDataFrame([("a", '{"events": [{"event_type": "x"}]}'), ("b", "{"), ("c", "{}"), ("d", '[{"ground_truth": {}}, 5]'), ("e", "[]")], "file string, raw_content string")
    held = {r["file"]: (r["reason"], r["lost"]) for r in events.event_quarantine(docs).collect()}
    assert held == {"b": ("not JSON", 0), "c": ("no events", 0), "d": ("not events", 1)}
    assert {r["file"] for r in events.explode_events(docs).collect()} == {"a", "d"}


def test_tweet_filters_join_with_or_and_compare_numbers(spark):
    lines = [tweet(1), tweet(2, in_reply_to_status_id_str="1"), tweet(3, id_str="drop"), tweet(4, entities="drop")]
    rows = tweets.parse_tweets(spark.createDataFrame([("f", line) for line in lines], tweets.LINE))

    def chosen(**filters):
        return sorted(str(r["id_str"]) for r in social.filter_tweets(rows, **filters).collect())

    assert chosen(hashtag="day", user="u2") == ["1", "2"]
    assert chosen(retweets=4) == ["4"]
    assert chosen(conversation_id="1") == ["1", "2"]
    assert chosen(user="u3") == []  # without an id it passes no filter
    assert len(chosen()) == 4
    flat = {r["tweet_id"]: r for r in social.flat_tweets(rows).collect()}
    assert "4" not in flat and flat["1"]["hashtags"] == "u'zeroday'" and flat["2"]["conversation_id"] == "1"
    assert flat["1"]["recorded_time_seconds"] == "Wed Jan 03 10:00:00 UTC 2024"


def test_offset_is_subtracted_and_zulu_is_read(spark):
    assert one(spark, dates.offset_epoch_millis(F.lit("2016-10-02T14:00:00+02:00"))) == 1475409600000
    assert one(spark, dates.offset_epoch_millis(F.lit("2016-10-02T12:00:00Z"))) == 1475409600000


@pytest.mark.parametrize("value, want", [("2024-01-03 10:00:00.5", "2024-01-03 10:00:00"), ("2024-01-03T10:00:00Z", "2024-01-03 10:00:00"), ("2024-01-03", None), ("x", None)])
def test_event_time(spark, value, want):
    got = one(spark, dates.event_time(F.lit(value), F.lit("2020-01-01 00:00:00")).cast("string"))
    assert got == want


def test_text_functions(spark):
    assert one(spark, text.drop_blank_lines(F.lit(" a \r\n\n\t\n b"))) == "a \n b"
    assert one(spark, text.match_phrase(F.lit("A CVE-2017, found"), "cve 2017 FOUND")) is True
    assert one(spark, text.match_phrase(F.lit("invoices"), "invoice")) is False
    assert one(spark, text.phrase_count(F.lit("a a a"), F.lit("a"))) == 3
    assert one(spark, text.is_email(F.lit("a@b"))) is True and one(spark, text.is_email(F.lit("a.com"))) is False
    assert one(spark, ids.url_authority(F.lit("http://u@h:1/x"))) == "u@h:1" and one(spark, ids.url_authority(F.lit("h/x"))) == "unknown"


def test_path_lookup(spark):
    rep = F.parse_json(F.lit('{"a": {"b": "x", "e": ""}, "l": ["p", "q"]}'))
    assert one(spark, js.text_at(rep, "a.b")) == "x"
    assert one(spark, js.text_at(rep, "a.e")) is None and one(spark, js.text_at(rep, "a.z")) is None
    assert one(spark, js.strings_at(rep, "$.l")) == ["p", "q"] and one(spark, js.strings_at(rep, "$.a.b")) == ["x"]
