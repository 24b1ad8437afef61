"""Queries over the evidence table: scans, landing, filters, extraction."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import epoch_day
from ..functions.ids import document_id, url_authority
from ..functions.json import blank_fields, text_at
from ..functions.text import drop_blank_lines, is_email, numbered_user, table_name
from ..functions.dates import offset_epoch_millis, week_of_month
from ..operators.extract import CVE, EMAIL, MSID, ExtractorSpec, CVE_PATTERN, SOURCE_FIELDS, entity_inputs, extract, extraction_rows
from ..operators.frames import FrameSpec, frame
from ..operators.mapping import MappingSpec, route, statements
from ..operators.merge import materialise
from ..operators.profile import attribute_paths, shared_attributes, source_schemas
from ..session import scratch_path
from ..sources.cdr import add_partitions, between, quarantine, query_cdr, since, with_json, without_target_system
from ..sources.events import event_quarantine
from ..sources.feeds import FEEDS, FULL_LOAD, completeness, page_chains, pulls
from ..sources.files import delimited_quarantine, modelling_records, read_delimited_whole, rows_as_json
from ..sources.landing import as_keyed_json, backup_pulls, drop_known, import_partitions, land, write_cdr
from . import views as v
from .registry import query

MARK = 1705795200  # 2024-01-21 00:00:00 UTC


@query("cdr_full_scan", "cdr", '''
SELECT _id, "timestamp", raw_content, content_type, url, version, team, source_name,
       CAST(year(day) AS INTEGER) AS "year", CAST(month(day) AS INTEGER) AS "month" FROM cdr''')
def cdr_full_scan(spark, sf):
    return add_partitions(v.cdr(spark, sf))


@query("cdr_scan_by_sql", "cdr", '''
SELECT _id, "timestamp", raw_content, content_type, url, version, team, source_name FROM cdr WHERE team = 'hg' AND "timestamp" >= 1705795200''')
def cdr_scan_by_sql(spark, sf):
    v.cdr(spark, sf).createOrReplaceTempView("cdr")
    return query_cdr(spark, f"SELECT * FROM cdr WHERE team = 'hg' AND timestamp >= {MARK}")


@query("cdr_scan_since", "cdr", 'SELECT _id, "timestamp", source_name FROM cdr WHERE "timestamp" > 1705795200')
def cdr_scan_since(spark, sf):
    return since(add_partitions(v.cdr(spark, sf)), MARK).select("_id", "timestamp", "source_name")


@query("cdr_json_fields", "cdr ev", '''
SELECT _id, "timestamp", CAST(raw_content::JSON ->> 'user' AS BIGINT) AS user_id, raw_content::JSON ->> 'kind' AS kind,
       coalesce(raw_content::JSON ->> 'targetSystem', 'none') AS target_system, CAST(raw_content::JSON -> 'detail' ->> 'k' AS BIGINT) AS k
FROM cdr''')
def cdr_json_fields(spark, sf):
    rep = F.col("json_rep")
    return with_json(v.cdr(spark, sf)).select(
        "_id",
        "timestamp",
        F.try_variant_get(rep, "$.user", "bigint").alias("user_id"),
        text_at(rep, "kind").alias("kind"),
        F.coalesce(text_at(rep, "targetSystem"), F.lit("none")).alias("target_system"),
        F.try_variant_get(rep, "$.detail.k", "bigint").alias("k"),
    )


@query("cdr_quarantine", "cdr", "SELECT source_name, count(*) AS n FROM cdr WHERE NOT json_valid(CASE team WHEN 'isi' THEN rtrim(raw_content, '}') ELSE raw_content END) GROUP BY 1")
def cdr_quarantine(spark, sf):
    broken = F.when(F.col("team") == "isi", F.rtrim("raw_content", F.lit("}"))).otherwise(F.col("raw_content"))
    return quarantine(v.cdr(spark, sf).withColumn("raw_content", broken)).groupBy("source_name").agg(F.count("*").alias("n"))


@query("feed_landing", "", '''
SELECT 'hackmageddon/' || md5(props) AS _id, CAST(1706572800 AS BIGINT) AS "timestamp", props AS raw_content, 'application/json' AS content_type,
       'http://evidence.example.org/input/hackmageddon/' || md5(props) AS url, '2.0' AS version, 'hackmageddon' AS team,
       'hackmageddon' AS source_name FROM events''')
def feed_landing(spark, sf):
    raw = v.table(spark, sf, "events").select(F.col("props").alias("raw_content"))
    return land(raw, FEEDS["hackmageddon"], 1706572800)


@query("feed_landing_new_ids", "cdr", '''
SELECT DISTINCT _id, source_name FROM cdr
WHERE "timestamp" >= 1705795200 AND _id NOT IN (SELECT _id FROM cdr WHERE "timestamp" < 1705795200)''')
def feed_landing_new_ids(spark, sf):
    records = v.cdr(spark, sf)
    late, early = F.col("timestamp") >= MARK, F.col("timestamp") < MARK
    return drop_known(records.where(late), records.where(early)).select("_id", "source_name")


@query("feed_blanked_fields", "ev", '''
SELECT event_id, '{"user":' || user_id || ',"postCve":"","detail":' || replace(props, ' ', '') || '}' AS raw_content FROM ev''')
def feed_blanked_fields(spark, sf):
    raw = F.format_string('{"user": %d, "postCve": "CVE-2024-%d", "detail": %s}', "user_id", "k", "props")
    return v.numbered_events(spark, sf).select("event_id", blank_fields(raw, "postCve", "itemCve").alias("raw_content"))


DOWNLOADED = ["asu-zero-day-products", "asu-hacking-items", "asu-hacking-posts", "asu-twitter", "asu-exploit-db", "asu-dark-mention-rules", "asu-dumps-s3-mapping"]


def _downloaded(spark, sf):
    """Lines of one downloader's seven feeds; every fourth is cut short and is no JSON."""
    whole = F.format_string('{"itemCve":"CVE-2024-%d","user":%d}', "k", "user_id")
    line = F.when(F.col("k") % 4 == 0, F.substring(whole, 1, 12)).otherwise(whole)
    return v.numbered_events(spark, sf).select((F.col("event_id") % len(DOWNLOADED)).alias("feed"), line.alias("raw_content"))


def _landed(spark, sf):
    lines = _downloaded(spark, sf)
    parts = [land(lines.where(F.col("feed") == i).select("raw_content"), FEEDS[name], MARK) for i, name in enumerate(DOWNLOADED)]
    return reduce(DataFrame.unionByName, parts)


DOWNLOADED_SQL = f"""d AS (SELECT ({DOWNLOADED})[CAST(event_id % 7 + 1 AS INTEGER)] AS source_name, k,
       CASE WHEN k % 4 = 0 THEN '{{"itemCve":"' ELSE '{{"itemCve":"","user":' || user_id || '}}' END AS raw_content FROM ev)"""


@query("feed_blanked_sources", "ev", f"""WITH {DOWNLOADED_SQL}
SELECT source_name, raw_content, source_name || '/' || md5(raw_content) AS _id, count(*) AS n FROM d GROUP BY 1, 2""")
def feed_blanked_sources(spark, sf):
    """All seven feeds of the downloader land with the field emptied, and broken lines as they came."""
    return _landed(spark, sf).groupBy("source_name", "raw_content", "_id").agg(F.count("*").alias("n"))


@query("landing_quarantine", "ev", f"""WITH {DOWNLOADED_SQL}
SELECT source_name, count(*) AS landed, count(*) FILTER (k % 4 = 0) AS held FROM d GROUP BY 1""")
def landing_quarantine(spark, sf):
    """Landed lines of each feed, and those of them that are held back: the others are the difference."""
    landed = _landed(spark, sf)
    held = quarantine(landed).groupBy("source_name").agg(F.count("*").alias("held"))
    return landed.groupBy("source_name").agg(F.count("*").alias("landed")).join(held, "source_name", "left").select(
        "source_name", "landed", F.coalesce("held", F.lit(0)).alias("held")
    )


@query("event_quarantine", "", """
SELECT 'file-' || doc_id AS file, CASE doc_id % 4 WHEN 1 THEN octet_length(encode('{' || text)) WHEN 2 THEN 12 ELSE 53 END AS bytes,
       CASE doc_id % 4 WHEN 1 THEN 'not JSON' WHEN 2 THEN 'no events' ELSE 'not events' END AS reason, CAST(doc_id % 4 = 3 AS BIGINT) AS lost
FROM documents WHERE doc_id % 4 > 0""")
def event_quarantine_files(spark, sf):
    """Event files that are cut short, of another layout, or hold something else among the events."""
    d = F.col("doc_id") % 4
    raw = (
        F.when(d == 0, F.lit('{"events": [{"event_type": "a"}]}')).when(d == 1, F.concat(F.lit("{"), "text"))
        .when(d == 2, F.lit('{"other": 1}')).otherwise(F.lit('[{"ground_truth": {"event_type": "b"}}, {"other": 1}]'))
    )
    return event_quarantine(v.table(spark, sf, "documents").select(F.concat(F.lit("file-"), "doc_id").alias("file"), raw.alias("raw_content")))


PULL_DAY = dt.date(2024, 1, 16)  # asked for by the since and window modes
PULL_MODES = {"hg-blogs": "since", "armstrong": "window", "hackmageddon": "full"}


@query("feed_pulls", "ev", """
WITH p AS (SELECT CAST(ts AS DATE) AS d, count(*) AS n FROM ev GROUP BY 1),
m AS (SELECT * FROM (VALUES ('hg-blogs', DATE '2024-01-16', DATE '2024-01-31'), ('armstrong', DATE '2024-01-15', DATE '2024-01-16'), ('hackmageddon', DATE '2024-01-01', DATE '2024-01-31')) v(source_name, a, b))
SELECT source_name, CAST(sum(n) FILTER (d BETWEEN a AND b) AS BIGINT) AS pulled, (SELECT CAST(sum(n) AS BIGINT) FROM p) AS total, CAST(sum(n) AS BIGINT) AS landed,
       strftime(max(d), '%Y-%m-%d') AS last_pull, true AS complete FROM p, m GROUP BY 1""")
def feed_pulls(spark, sf):
    """Every event backed up for three feeds as a pull of its own day, each read by its mode and held against its total."""
    root, events = scratch_path(spark, "pulls"), v.table(spark, sf, "events")
    lines = events.select(F.col("props").alias("raw_content"), F.to_date("ts").alias("pull_date"))
    sources = F.array(*[F.lit(s) for s in PULL_MODES])
    backup_pulls(lines.withColumn("source_name", F.explode(sources)), root)
    read = [pulls(spark, root, FEEDS[s], PULL_DAY).groupBy("source_name").agg(F.count("*").alias("pulled")) for s in PULL_MODES]
    whole = reduce(DataFrame.unionByName, [pulls(spark, root, FEEDS[s], FULL_LOAD) for s in PULL_MODES])
    totals = lines.agg(F.count("*").alias("total")).select(F.explode(sources).alias("source_name"), "total")
    done = completeness(whole, totals)
    return done.join(reduce(DataFrame.unionByName, read), "source_name").select(
        "source_name", "pulled", "total", "landed", F.date_format("last_pull", "yyyy-MM-dd").alias("last_pull"), "complete"
    )


@query("json_line_records", "", """
SELECT 'clicks_' || md5(props) AS _id, props AS raw_content, 'clicks' AS source_name, 'isi' AS team, 1706572800 AS "timestamp", count(*) AS n FROM events WHERE length(trim(props)) > 0 GROUP BY ALL""")
def json_line_records(spark, sf):
    """A file of JSON lines, with blank ones between, as evidence records."""
    path = scratch_path(spark, "lines")
    line = F.when(F.col("event_id") % 3 == 0, F.concat("props", F.lit("\n \n"))).otherwise(F.concat(F.lit("  "), "props"))
    v.table(spark, sf, "events").select(line.alias("value")).write.text(path)
    records = modelling_records(spark, path, "json", "clicks", "isi", F.lit(1706572800))
    return records.groupBy("_id", "raw_content", "source_name", "team", "timestamp").agg(F.count("*").alias("n"))


#: Pages of ten rows; of every pull some pages are lost, come twice, or come once more with fewer rows.
PAGE = 10


@query("feed_pages", "", f"""
WITH r AS (SELECT coalesce(source, 'none') AS source_name, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS k FROM documents),
p AS (SELECT source_name, (k // {PAGE}) * {PAGE} AS start, count(*) AS n, k // {PAGE} AS page FROM r GROUP BY ALL),
t AS (SELECT source_name, sum(n) AS total FROM p GROUP BY 1),
kept AS (SELECT *, CASE WHEN page % 5 = 2 THEN 1 ELSE 0 END AS again FROM p WHERE page % 7 <> 3 OR source_name IN ('src1', 'src2', 'src4')),
g AS (SELECT *, greatest(start - coalesce(max(start + n) OVER (PARTITION BY source_name ORDER BY start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0) AS gap FROM kept),
w AS (SELECT source_name, count(*) AS pages, sum(again) AS repeats, count(*) FILTER (gap > 0) + max(CASE WHEN start = 0 THEN 1 ELSE 0 END) AS islands, sum(gap) AS missing, sum(n) AS rows,
      arg_max(n < {PAGE}, start) AS short, max(start + n) AS reach FROM g GROUP BY 1)
SELECT source_name, pages, CAST(repeats AS BIGINT) AS repeats, CAST(islands AS BIGINT) AS islands, CAST(missing AS BIGINT) AS missing, CAST(0 AS BIGINT) AS overlap, CAST(rows AS BIGINT) AS rows,
       CASE WHEN source_name <> 'src2' THEN CAST(total AS BIGINT) ELSE -1 END AS total, short OR (source_name <> 'src2' AND reach >= total) AS ended,
       (short OR (source_name <> 'src2' AND reach >= total)) AND missing = 0 AND (source_name = 'src2' OR rows = total) AS complete
FROM w JOIN t USING (source_name)""")
def feed_pages(spark, sf):
    """Pages of feed pulls held against what their service declared: gaps, repeats, the short last page."""
    by_source = Window.partitionBy("source").orderBy("doc_id")
    rows = v.table(spark, sf, "documents").select(F.coalesce("source", F.lit("none")).alias("source_name"), (F.row_number().over(by_source) - 1).alias("k"))
    page = F.floor(F.col("k") / PAGE).alias("page")
    pages = rows.groupBy("source_name", page).agg(F.count("*").alias("n"))
    totals = pages.groupBy("source_name").agg(F.sum("n").alias("total")).withColumn("total", F.when(F.col("source_name") != "src2", F.col("total")))
    landed = pages.where((F.col("page") % 7 != 3) | F.col("source_name").isin("src1", "src2", "src4"))
    twice = landed.where(F.col("page") % 5 == 2).withColumn("n", F.col("n") - 1)  # the second try got fewer rows
    every = landed.unionByName(twice).join(totals, "source_name")
    chains = page_chains(every.select("source_name", F.lit(dt.date(2024, 1, 30)).alias("pull_date"), (F.col("page") * PAGE).alias("start"), "n", F.lit(PAGE).alias("page_limit"), "total"))
    return chains.select("source_name", "pages", "repeats", F.col("islands").cast("bigint").alias("islands"), "missing", "overlap", "rows", F.coalesce("total", F.lit(-1)).alias("total"), "ended", "complete")


@query("csv_run", "", """
WITH c AS (SELECT s_suppkey AS k, s_name AS name, s_nationkey AS n FROM supplier)
SELECT 'supplier' AS doc_type, 'supplier/' || k AS uri, '{"uri":"supplier/' || k || '","a":["Supplier"],"name":["' || name || '"]' ||
       CASE WHEN k % 5 = 1 THEN '' ELSE ',"nation":[{"uri":"nation/' || n || '","a":["Nation"],"name":["' || n_name || '"]}]' END || '}' AS doc
FROM c JOIN nation ON n = n_nationkey WHERE k % 5 <> 2
UNION ALL SELECT 'held', k || ',' || name || ',' || n || ',more,fields', '-' FROM c WHERE k % 5 = 2
UNION ALL SELECT 'lines', CAST(count(*) AS VARCHAR), '-' FROM c""")
def csv_run(spark, sf):
    """One CSV folder mapped and framed at once; short rows keep what they have, rows of too many fields are held with their line."""
    path = scratch_path(spark, "csv")
    supplier = v.table(spark, sf, "supplier")
    line = F.concat_ws(",", F.col("s_suppkey").cast("string"), "s_name", F.when(F.col("s_suppkey") % 5 != 1, F.col("s_nationkey").cast("string")), F.when(F.col("s_suppkey") % 5 == 2, F.lit("more,fields")))
    # One file: its first line is the header, and Spark's own CSV writer would not write ragged rows.
    header = spark.createDataFrame([("key,name,nation",)], "value string")
    lines = header.withColumn("_at", F.lit(-1).cast("bigint")).unionByName(supplier.select(line.alias("value"), F.col("s_suppkey").cast("bigint").alias("_at")))
    lines.repartition(1).sortWithinPartitions("_at").select("value").write.text(path)
    rows, held = read_delimited_whole(spark, path), delimited_quarantine(spark, path)
    nation = v.table(spark, sf, "nation").select(F.lit("nations").alias("source_name"), F.lit("nations").alias("model"), F.col("n_nationkey").cast("string").alias("key"), F.col("n_name").alias("name"), F.lit(None).cast("string").alias("nation"))
    records = rows.select(F.lit("csv").alias("source_name"), F.lit("csv").alias("model"), "key", "name", "nation").unionByName(nation)
    models = [
        MappingSpec("csv", "Supplier", F.concat(F.lit("supplier/"), "key"), {"name": F.col("name")}, {"nation": F.concat(F.lit("nation/"), "nation")}),
        MappingSpec("nations", "Nation", F.concat(F.lit("nation/"), "key"), {"name": F.col("name")}),
    ]
    graph = materialise(statements(records, models), scratch_path(spark, "csv-statements"))
    docs = frame(graph, "supplier", FrameSpec("Supplier", {"name": None, "nation": FrameSpec("Nation", {"name": None})})).select("doc_type", "uri", "doc")
    none = F.lit("-").alias("doc")
    total = rows.agg(F.count("*").alias("n")).unionByName(held.agg(F.count("*").alias("n"))).agg(F.sum("n").cast("string").alias("uri"))
    return docs.unionByName(held.select(F.lit("held").alias("doc_type"), F.col("line").alias("uri"), none)).unionByName(total.select(F.lit("lines").alias("doc_type"), "uri", none))


@query("cdr_partition_append", "order_cdr", '''
SELECT "year", "month", count(*) AS n, count(DISTINCT _id) AS ids FROM order_cdr GROUP BY 1, 2''')
def cdr_partition_append(spark, sf):
    path, records = scratch_path(spark, "cdr-append"), v.order_cdr(spark, sf)
    write_cdr(records.where(F.col("source_name") == "orders-f"), path)
    write_cdr(records.where(F.col("source_name") != "orders-f"), path)
    return import_partitions(spark, path).groupBy("year", "month").agg(
        F.count("*").alias("n"), F.countDistinct("_id").alias("ids")
    )


@query("cdr_partition_rewrite", "order_cdr", '''
SELECT "year", "month", count(*) AS n FROM order_cdr
WHERE NOT ("year" = (SELECT max("year") FROM order_cdr) AND o_orderstatus = 'P')
   OR ("year", "month") NOT IN (SELECT ("year", "month") FROM order_cdr WHERE o_orderstatus <> 'P') GROUP BY 1, 2''')
def cdr_partition_rewrite(spark, sf):
    """Rewrite the last year's months without one status.

    Only months the new rows fall in are replaced, so a month of that status alone stays.
    """
    path, records = scratch_path(spark, "cdr-rewrite"), add_partitions(v.order_cdr(spark, sf))
    write_cdr(records, path)
    last = records.agg(F.max("year")).head()[0]
    write_cdr(records.where((F.col("year") == last) & (F.col("source_name") != "orders-p")), path, "overwrite")
    return import_partitions(spark, path).groupBy("year", "month").agg(F.count("*").alias("n"))


@query("cdr_pruned_range", "order_cdr", '''
SELECT source_name, count(*) AS n, min("timestamp") AS first_seen, max("timestamp") AS last_seen FROM order_cdr
WHERE "timestamp" >= 788918400 AND "timestamp" < 804556800 GROUP BY 1''')
def cdr_pruned_range(spark, sf):
    """A half-open time range over the partitioned table; only its months are read."""
    path = scratch_path(spark, "cdr-range")
    write_cdr(v.order_cdr(spark, sf), path)
    return between(import_partitions(spark, path), 788918400, 804556800).groupBy("source_name").agg(
        F.count("*").alias("n"), F.min("timestamp").alias("first_seen"), F.max("timestamp").alias("last_seen")
    )


@query("source_filters", "cdr", '''
SELECT source_name, count(*) AS n FROM cdr
WHERE team IN ('hg', 'asu', 'isi') AND source_name <> 'hg-1' AND source_name NOT IN ('asu-2', 'asu-3') GROUP BY 1''')
def source_filters(spark, sf):
    name = F.col("source_name")
    kept = v.cdr(spark, sf).where(F.col("team").isin("hg", "asu", "isi") & (name != "hg-1") & ~name.isin("asu-2", "asu-3"))
    return kept.groupBy("source_name").agg(F.count("*").alias("n"))


@query("raw_like", "cdr", """SELECT _id, "timestamp" FROM cdr WHERE team = 'asu' AND raw_content LIKE '%"targetSystem": "sys7"%'""")
def raw_like(spark, sf):
    hit = F.col("raw_content").like('%"targetSystem": "sys7"%')
    return v.cdr(spark, sf).where((F.col("team") == "asu") & hit).select("_id", "timestamp")


@query("nested_predicate_keep", "cdr", '''
SELECT team, count(*) AS n FROM cdr WHERE NOT coalesce(team = 'isi' OR raw_content::JSON ->> 'targetSystem' = 'sys7', false) GROUP BY 1''')
def nested_predicate_keep(spark, sf):
    """Records stay unless the nested field says otherwise; a missing field does not drop any."""
    records = with_json(v.cdr(spark, sf)).where(F.col("team") != "isi")
    # The feed of these rules is one per user here, so all of them are tested under one name.
    kept = without_target_system(records.withColumn("source_name", F.lit("rules")), "rules", "sys7")
    return kept.groupBy("team").agg(F.count("*").alias("n"))


@query("drop_listed_records", "cdr", '''
SELECT c._id, c."timestamp" FROM cdr c WHERE NOT EXISTS (
    SELECT 1 FROM cdr x WHERE x._id = c._id AND x.raw_content LIKE '%"sys1%')''')
def drop_listed_records(spark, sf):
    records = v.cdr(spark, sf)
    listed = records.where(F.col("raw_content").like('%"sys1%')).select("_id").distinct()
    return records.join(listed, "_id", "left_anti").select("_id", "timestamp")


@query("model_routing", "cdr", '''
SELECT model, source_name, count(*) AS n FROM (
    SELECT 'm-' || team AS model, source_name FROM cdr UNION ALL SELECT 'm-asu', source_name FROM cdr WHERE team = 'isi') GROUP BY 1, 2''')
def model_routing(spark, sf):
    """Every feed goes to its team's model; the feeds of one team also go to another's."""
    records = v.cdr(spark, sf)
    feeds = records.select("team", "source_name").distinct()
    own = feeds.select("source_name", F.concat(F.lit("m-"), "team").alias("model"))
    routes = own.unionByName(feeds.where(F.col("team") == "isi").select("source_name", F.lit("m-asu").alias("model")))
    return route(records, routes).groupBy("model", "source_name").agg(F.count("*").alias("n"))


@query("source_branches_union", "cdr", "SELECT team, count(*) AS n FROM cdr WHERE team IN ('hg', 'ruhr', 'isi') GROUP BY 1")
def source_branches_union(spark, sf):
    records = v.cdr(spark, sf)
    branches = [records.where(F.col("team") == t) for t in ("hg", "ruhr", "isi")]
    return branches[0].unionByName(branches[1]).unionByName(branches[2]).groupBy("team").agg(F.count("*").alias("n"))


@query("keyed_json_pairs", "cdr", """
SELECT source_name AS key, '{"_id":"' || _id || '","timestamp":' || "timestamp" || ',"team":"' || team || '"}' AS json FROM cdr""")
def keyed_json_pairs(spark, sf):
    return as_keyed_json(v.cdr(spark, sf), "source_name", "_id", "timestamp", "team")


@query("rows_as_json", "", """
SELECT '{"p_partkey":' || p_partkey || ',"p_name":"' || p_name || '","p_size":' || p_size || ',"price":' || CAST(CAST(round(p_retailprice) AS BIGINT) AS VARCHAR)
       || '.0,"day":"2024-01-02T03:04:05"}' AS raw_content FROM part""")
def part_rows_as_json(spark, sf):
    """Database rows as JSON: decimals as plain numbers, times in ISO form, nulls left out."""
    rows = v.table(spark, sf, "part").select(
        "p_partkey", "p_name", "p_size", F.round("p_retailprice").cast("decimal(12,2)").alias("price"),
        F.lit("2024-01-02 03:04:05").cast("timestamp_ntz").alias("day"), F.lit(None).cast("string").alias("absent"),
    )
    return rows_as_json(rows)


# --- extraction -------------------------------------------------------------------


@query("extract_identifiers", "evidence", r'''
SELECT _id, source_name, kind, value, count(*) AS n FROM (
    SELECT _id, source_name, 'cve' AS kind, unnest(regexp_extract_all(full_text, '(?i)(cve-[0-9]{4}-[0-9]{4,7})', 1)) AS value FROM evidence
    UNION ALL
    SELECT _id, source_name, 'msid', unnest(regexp_extract_all(full_text, '(?i)(ms[0-9]{2}-[0-9]{3})', 1)) FROM evidence)
GROUP BY ALL''')
def extract_identifiers(spark, sf):
    """Both identifier kinds, each feed read from its own field, in one pass."""
    found = extract(v.evidence_text(spark, sf), CVE, MSID)
    return extraction_rows(found, "cve", "msid").groupBy("_id", "source_name", "kind", "value").agg(F.count("*").alias("n"))


@query("extract_emails", "evidence", r'''
SELECT _id, value, count(*) AS n FROM (
    SELECT _id, unnest(regexp_extract_all(full_text, '([A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)', 1)) AS value FROM evidence
    WHERE source_name NOT IN ('hg-blogs', 'isi-news')) GROUP BY ALL''')
def extract_emails(spark, sf):
    found = extract(v.evidence_text(spark, sf), EMAIL)
    return extraction_rows(found, "email").groupBy("_id", "value").agg(F.count("*").alias("n"))


@query("extract_context", "evidence", r'''
SELECT _id, value, context, 'cve-context' AS extractor,
       CASE source_name WHEN 'hg-blogs' THEN 'json_rep.text' WHEN 'isi-news' THEN 'json_rep.readable_text' ELSE 'postContent' END AS field
FROM (SELECT _id, source_name, found[i] AS value, substr(full_text, greatest(pos - 20, 1), least(pos - 1, 20) + length(found[i]) + 20) AS context
      FROM (SELECT _id, source_name, full_text, found, i,
                   1 + CAST(list_sum(list_transform(gaps[:i], lambda g: length(g))) + coalesce(list_sum(list_transform(found[:i - 1], lambda f: length(f))), 0) AS BIGINT) AS pos
            FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i
                  FROM (SELECT *, regexp_extract_all(full_text, '(?i)(cve-[0-9]{4}-[0-9]{4,7})', 1) AS found,
                               string_split_regex(full_text, '(?i)cve-[0-9]{4}-[0-9]{4,7}') AS gaps FROM evidence))))''')
def extract_context(spark, sf):
    spec = ExtractorSpec("cve-context", CVE_PATTERN, "cve", SOURCE_FIELDS, "json:postContent")
    found = extract(v.evidence_text(spark, sf), spec)
    return extraction_rows(found, "cve").select("_id", "value", "context", "extractor", "field")


@query("clean_blank_lines", "", r'''
SELECT doc_id, array_to_string(list_filter(list_transform(string_split(text, chr(10)),
       lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: length(x) > 0), ' ' || chr(10) || ' ') AS cleaned FROM documents''')
def clean_blank_lines(spark, sf):
    return v.table(spark, sf, "documents").select("doc_id", drop_blank_lines(F.col("text")).alias("cleaned"))


@query("entity_inputs", "evidence", r'''
SELECT _id, source_name, CASE source_name WHEN 'hg-blogs' THEN 'Blog' ELSE 'NewsArticle' END AS content_type,
       CASE source_name WHEN 'hg-blogs' THEN 'json_rep.text' ELSE 'json_rep.readable_text' END AS field,
       array_to_string(list_filter(list_transform(string_split(full_text, chr(10)),
       lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: length(x) > 0), ' ' || chr(10) || ' ') AS text
FROM evidence WHERE source_name IN ('hg-blogs', 'isi-news')''')
def recognition_inputs(spark, sf):
    return entity_inputs(v.evidence_text(spark, sf))


# --- profiling --------------------------------------------------------------------


@query("attribute_paths", "cdr", '''
SELECT DISTINCT source_name, unnest(CASE WHEN team = 'isi' THEN ['user', 'kind', 'detail.k'] ELSE ['user', 'kind', 'targetSystem', 'detail.k'] END) AS path
FROM cdr''')
def feed_attribute_paths(spark, sf):
    return attribute_paths(v.cdr(spark, sf))


@query("shared_attributes", "cdr", '''
SELECT path, count(*) AS sources, string_agg(team, ',' ORDER BY team) AS teams FROM (
    SELECT DISTINCT team, unnest(CASE WHEN team = 'isi' THEN ['user', 'kind', 'detail.k'] ELSE ['user', 'kind', 'targetSystem', 'detail.k'] END) AS path
    FROM cdr) GROUP BY 1''')
def feed_shared_attributes(spark, sf):
    by_team = v.cdr(spark, sf).withColumn("source_name", F.col("team"))
    shared = shared_attributes(attribute_paths(by_team))
    return shared.select("path", "sources", F.array_join("source_names", ",").alias("teams"))


@query("source_schemas", "cdr", '''
SELECT DISTINCT team AS source_name, 'OBJECT<detail: OBJECT<k: BIGINT>, kind: STRING' || CASE WHEN team = 'isi' THEN '' ELSE ', targetSystem: STRING' END
       || ', user: BIGINT>' AS "schema" FROM cdr''')
def feed_schemas(spark, sf):
    return source_schemas(with_json(v.cdr(spark, sf).withColumn("source_name", F.col("team"))))


# --- scalar functions -------------------------------------------------------------


@query("scalar_text", "", r"""
SELECT c_custkey, left(c_name, 10) AS head, starts_with(c_mktsegment, 'AUTO') AS is_auto, replace(c_mktsegment || '-feed', '-', '_') AS table_name,
       c_custkey % 3 = 0 AS is_email, CAST(c_custkey AS BIGINT) AS user_number, sha256('customer/' || c_custkey) AS doc_id,
       'crm_' || md5(c_name) AS record_id FROM customer""")
def scalar_text(spark, sf):
    name, key = F.col("c_name"), F.col("c_custkey")
    return v.table(spark, sf, "customer").select(
        "c_custkey",
        F.left(name, F.lit(10)).alias("head"),
        F.startswith("c_mktsegment", F.lit("AUTO")).alias("is_auto"),
        table_name(F.concat("c_mktsegment", F.lit("-feed"))).alias("table_name"),
        is_email(F.concat(name, F.when(key % 3 == 0, F.lit("@example.com")).otherwise(F.lit(".example.com")))).alias("is_email"),
        numbered_user(F.concat(F.lit("user"), key.cast("string"))).alias("user_number"),
        document_id(F.concat(F.lit("customer/"), key.cast("string"))).alias("doc_id"),
        F.concat(F.lit("crm_"), F.md5(name)).alias("record_id"),
    )


@query("scalar_dates", "cdr", r"""
SELECT _id, "timestamp", strftime(day, '%Y-%m-%d') AS day, CAST(ceil(day(day) / 7.0) AS INTEGER) AS week_of_month,
       CAST(date_diff('day', day, DATE '2024-01-30') AS INTEGER) AS age, strftime(CAST(day - INTERVAL 1 DAY AS DATE), '%Y-%m-%d') AS day_before,
       CAST(epoch(CAST(day AS TIMESTAMP)) * 1000 - 5400000 AS BIGINT) AS offset_millis,
       CAST(epoch(CAST(day AS TIMESTAMP)) * 1000 AS BIGINT) AS zulu_millis FROM cdr""")
def scalar_dates(spark, sf):
    day = epoch_day(F.col("timestamp"))
    text = day.cast("string")
    return v.cdr(spark, sf).select(
        "_id",
        "timestamp",
        text.alias("day"),
        week_of_month(day).alias("week_of_month"),
        F.datediff(F.lit(v.AS_OF), day).alias("age"),
        F.date_sub(day, 1).cast("string").alias("day_before"),
        offset_epoch_millis(F.concat(text, F.lit("T00:00:00+01:30"))).alias("offset_millis"),
        offset_epoch_millis(F.concat(text, F.lit("T00:00:00Z"))).alias("zulu_millis"),
    )


@query("url_authorities", "", r"""
SELECT authority, count(*) AS n FROM (
    SELECT CASE WHEN regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1) = '' THEN 'unknown'
                ELSE regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1) END AS authority FROM pages) GROUP BY 1""")
def url_authorities(spark, sf):
    hosts = v.table(spark, sf, "pages").select(url_authority(F.col("url")).alias("authority"))
    return hosts.groupBy("authority").agg(F.count("*").alias("n"))
