"""Engine inputs derived from the driver tables.

Each view has a Spark form here and an SQL form of the same name in ``SQL``, which
builds the check queries.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import ntz_epoch
from ..functions.ids import URL_BASE
from ..operators.frames import FrameSpec
from ..operators.mapping import MappingSpec, listed_routes, route, statements
from ..operators.merge import materialise
from ..session import scratch_path
from ..sources.cdr import with_json
from ..sources.events import explode_events, typed_events
from ..sources.landing import envelope
from ..sources.tweets import parse_tweets

AS_OF = dt.date(2024, 1, 30)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _concat(*items: str | Column) -> Column:
    return F.concat(*[F.lit(i) if isinstance(i, str) else i.cast("string") for i in items])


def _case(column: str, choices: dict[str, str], other: str) -> Column:
    result = F.lit(other)
    for key, value in choices.items():
        result = F.when(F.col(column) == key, F.lit(value)).otherwise(result)
    return result


# --- evidence table from events ---------------------------------------------------

TEAMS = {"click": "hg", "view": "asu", "purchase": "ruhr", "signup": "armstrong"}


def numbered_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events with ``k``, the number in their properties."""
    return table(spark, sf, "events").withColumn("k", F.regexp_extract("props", r"([0-9]+)", 1).cast("int"))


def event_records(events: DataFrame) -> DataFrame:
    """Events as CDR records, also of a stream; one feed per team and user."""
    team = _case("event_type", TEAMS, "isi")
    system = F.when(F.col("event_type") != "error", _concat(', "targetSystem": "sys', F.col("k"), '"')).otherwise(F.lit(""))
    raw = _concat('{"user": ', F.col("user_id"), ', "kind": "', F.col("event_type"), '"', system, ', "detail": ', F.col("props"), "}")
    named = events.select(
        F.col("ts"), team.alias("team"), _concat(team, "-", F.col("user_id")).alias("source_name"), raw.alias("raw_content")
    )
    return envelope(named, F.col("source_name"), F.col("team"), ntz_epoch(F.col("ts")))


def cdr(spark: SparkSession, sf: str) -> DataFrame:
    return event_records(numbered_events(spark, sf))


def user_cdr(spark: SparkSession, sf: str) -> DataFrame:
    """The same records with one feed per user, whatever the kind of event."""
    user = F.regexp_extract("source_name", r"-(\d+)$", 1)
    team = F.element_at(F.array(*[F.lit(t) for t in ("hg", "asu", "ruhr", "armstrong", "isi")]), (user.cast("int") % 5 + 1))
    return cdr(spark, sf).withColumn("source_name", F.concat_ws("-", team, user))


def order_cdr(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as CDR records, over seven years of months."""
    orders = table(spark, sf, "orders")
    raw = _concat('{"order": ', F.col("o_orderkey"), ', "customer": ', F.col("o_custkey"), ', "status": "', F.col("o_orderstatus"), '"}')
    named = orders.select(
        F.col("o_orderdate"), _concat("orders-", F.lower("o_orderstatus")).alias("source_name"), raw.alias("raw_content")
    )
    return envelope(named, F.col("source_name"), F.lit("sales"), ntz_epoch(F.col("o_orderdate")))


# --- evidence text from documents -------------------------------------------------


def evidence_text(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as CDR records whose text ends in identifiers.

    ``src0`` and ``src1`` stand for the two feeds whose text sits in a JSON field.
    """
    docs = table(spark, sf, "documents")
    d = F.col("doc_id")
    suffix = _concat(
        " CVE-", 2000 + d % 20, "-", 1000 + d * 37 % 90000,
        " ms", F.lpad((d % 18).cast("string"), 2, "0"), "-", F.lpad((d * 7 % 200).cast("string"), 3, "0"),
        " cve-2014-123456789",
    )
    text = F.concat("text", suffix)
    source = _case("source", {"src0": "hg-blogs", "src1": "isi-news"}, "")
    source = F.when(source == "", F.col("source")).otherwise(source)
    body = F.to_json(
        F.struct(
            F.when(source == "hg-blogs", text).alias("text"),
            F.when(source == "isi-news", F.array(text)).alias("readable_text"),
            F.when(~source.isin("hg-blogs", "isi-news"), text).alias("postContent"),
        )
    )
    named = docs.select("doc_id", "text", source.alias("source_name"), body.alias("raw_content"))
    records = named.select(
        _concat("doc/", d).alias("_id"), F.lit("application/json").alias("content_type"), "raw_content", "source_name"
    )
    return with_json(records)


# --- ground truth from events -----------------------------------------------------

EVENT_TYPES = {
    "click": "malicious-url",
    "view": "malicious-email",
    "purchase": "endpoint-malware",
    "signup": "malicious-destination",
}


def event_files(spark: SparkSession, sf: str) -> DataFrame:
    """Events as ground-truth JSON documents in both layouts: ``(file, raw_content)``."""
    e = numbered_events(spark, sf)
    k, u = F.col("k"), F.col("user_id")
    spaced = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".123"))
    kind = F.col("event_type")
    addresses = lambda port: _concat(
        ', "addresses": [{"url": "http://h', k, ".example.com", port, '/p"}, {"url": "h', k, '.example.org/x"}, {"ip": "10.0.0.', k, '"}]'
    )
    click = _concat(
        '"occurred": "', spaced, '", "target_entity": "user', u, '"', addresses(":8080"),
        ', "email_sender": ["s', k, '@mail.com"], "detector": "ids", "detector_classification": ["a", "b', k, '"]',
    )
    view = _concat(
        '"occurred": "', iso, '", "target_entity": ["user', u, '@corp.com", "desk', k, '"]', addresses(""),
        ', "email_sender": "s', k, '@mail.com", "email_subject": "subject ', k, '"',
    )
    purchase = _concat(
        '"occurred": "', iso, '", "target_entity": [{"ip": "10.1.0.', u, '"}], "files": [{"filename": "f', k,
        '.exe"}, {}], "threat_actor": [{"ip": "1.2.3.', k, '"}], "threat_designation_family": ["fam', k,
        '"], "threat_designation_type": ["trojan"], "detector_classification": ["x"]',
    )
    signup = _concat(
        '"occurred": "', spaced, '", "targets": [{"identity_class": "user", "name": "user', u,
        '"}, {"identity_class": "org", "name": "o"}], "attack_method": ["phish"], "event_details": [{"sensor": "s1", '
        '"sensor_classification": "c', k, '"}, [{"sensor": "s2"}, {"note": "n"}]]',
    )
    # One event type has no time of its own, or an unreadable one.
    error = _concat(
        F.when(k < 10, F.lit('"occurred": "soon", ')).otherwise(F.lit("")),
        '"detected": "', spaced, '", "target_organization": "org", "detector": "edr"',
    )
    fields = F.when(kind == "click", click).when(kind == "view", view).when(kind == "purchase", purchase).when(kind == "signup", signup)
    event = _concat('{"event_type": "', _case("event_type", EVENT_TYPES, "atoifs"), '", ', fields.otherwise(error), "}")
    body = F.when(kind == "error", _concat('[{"ground_truth": ', event, "}]")).otherwise(_concat('{"events": [', event, "]}"))
    company = F.when(u % 2 == 0, F.lit("acme")).otherwise(F.lit("globex"))
    return e.select(
        _concat(company, "/", F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("file"), body.alias("raw_content")
    )


def ground_truth(spark: SparkSession, sf: str) -> DataFrame:
    return typed_events(explode_events(event_files(spark, sf)))


# --- published documents from documents -------------------------------------------


def doc_index(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as published ones: type = language, publisher = source."""
    d = F.col("doc_id")

    def day(start: str, span: int, when: Column) -> Column:
        value = F.date_add(F.lit(dt.date.fromisoformat(start)), (d % span).cast("int"))
        return F.when(when, F.array(value)).otherwise(F.array().cast("array<date>"))

    publishers = (
        F.when(d % 11 == 0, F.array().cast("array<string>"))
        .when(d % 5 == 0, F.array(F.col("source"), F.lit("mirror")))
        .otherwise(F.array("source"))
    )
    return table(spark, sf, "documents").select(
        F.col("lang").alias("doc_type"),
        _concat("doc/", d).alias("uri"),
        _concat("Document ", d).alias("name"),
        "text",
        publishers.alias("publisher"),
        day("2024-01-01", 300, d % 3 == 0).alias("datePublished"),
        day("2023-03-01", 200, d % 3 == 1).alias("startDate"),
        day("2023-06-01", 500, d % 4 != 0).alias("observedDate"),
        F.array().cast("array<date>").alias("datePosted"),
        day("2022-01-01", 900, d % 2 == 0).alias("dateRecorded"),
    )


# --- linked entities from the sales tables ----------------------------------------


def sales_records(spark: SparkSession, sf: str) -> DataFrame:
    """Nations, customers and orders as JSON records of four feeds.

    Finished orders come from a second feed as well, which the same model serves.
    """
    nation = table(spark, sf, "nation").select(F.lit("geo").alias("source_name"), F.to_json(F.struct("*")).alias("raw_content"))
    customer = table(spark, sf, "customer").select(
        F.lit("crm").alias("source_name"),
        F.to_json(F.struct("c_custkey", "c_name", "c_nationkey", "c_mktsegment")).alias("raw_content"),
    )
    orders = table(spark, sf, "orders")
    body = F.to_json(
        F.struct(
            "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")
        )
    )
    feeds = F.when(F.col("o_orderstatus") == "F", F.array(F.lit("shop"), F.lit("shop-mirror"))).otherwise(F.array(F.lit("shop")))
    # The body is built first: beside a generator the struct would lose the name of its last field.
    shop = orders.select(feeds.alias("feeds"), body.alias("raw_content")).select(F.explode("feeds").alias("source_name"), "raw_content")
    return nation.unionByName(customer).unionByName(shop).withColumn("json_rep", F.try_parse_json("raw_content"))


def _json(path: str) -> Column:
    return F.try_variant_get("json_rep", "$." + path, "string")


def _json_key(path: str) -> Column:
    """A whole number, read as one: reading it as text costs a general cast per value."""
    return F.try_variant_get("json_rep", "$." + path, "bigint").cast("string")


def sales_models() -> list[MappingSpec]:
    recorded = F.lit(dt.date(2024, 1, 2))
    return [
        MappingSpec(
            "geo", "Nation", F.concat(F.lit("nation/"), _json_key("n_nationkey")), {"name": _json("n_name")},
            {"region": F.concat(F.lit("region/"), _json_key("n_regionkey"))}, publisher=F.lit("geo-feed"), recorded=recorded,
        ),
        MappingSpec(
            "crm", "Customer", F.concat(F.lit("customer/"), _json_key("c_custkey")),
            {"name": _json("c_name"), "segment": _json("c_mktsegment")},
            {"nation": F.concat(F.lit("nation/"), _json_key("c_nationkey"))}, publisher=F.lit("crm-feed"), recorded=recorded,
        ),
        MappingSpec(
            "shop", "Order", F.concat(F.lit("order/"), _json_key("o_orderkey")),
            {"status": _json("o_orderstatus"), "priority": _json("o_orderpriority")},
            {"customer": F.concat(F.lit("customer/"), _json_key("o_custkey"))},
            publisher=F.concat(F.col("source_name"), F.lit("-feed")), recorded=recorded, observed=_json("day").cast("date"),
        ),
    ]


SALES_ROUTES = [("geo", "geo"), ("crm", "crm"), ("shop", "shop"), ("shop-mirror", "shop")]


def sales_statements(spark: SparkSession, sf: str) -> DataFrame:
    return statements(route(sales_records(spark, sf), listed_routes(spark, SALES_ROUTES)), sales_models())


def sales_graph(spark: SparkSession, sf: str) -> DataFrame:
    """The merged statements of the sales feeds, written once."""
    return materialise(sales_statements(spark, sf), scratch_path(spark, "sales"))


# --- activity of users, for the daily refresh --------------------------------------

ACTIVITY_FRAME = FrameSpec("User", {"kind": None, "system": FrameSpec("System", {"name": None})})


def activity(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, list[MappingSpec]]:
    """Event records with one feed per team, their routes and the models of users and systems."""
    records = cdr(spark, sf).withColumn("source_name", F.col("team"))
    teams = [*TEAMS.values(), "isi"]
    routes = listed_routes(spark, [(t, m) for t in teams for m in ("users", "systems")])
    system = F.concat(F.lit("system/"), _json("targetSystem"))
    models = [
        MappingSpec("users", "User", F.concat(F.lit("user/"), _json_key("user")), {"kind": _json("kind")}, {"system": system}),
        MappingSpec("systems", "System", system, {"name": _json("targetSystem")}),
    ]
    return records, routes, models


def supply_statements(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers linked to every part they sold, and the parts' names."""
    line = table(spark, sf, "lineitem").select("l_suppkey", "l_partkey").select(
        F.lit("supply").alias("source_name"), F.lit("supply").alias("model"), F.col("l_suppkey").alias("s"), F.col("l_partkey").alias("p"),
        F.lit(None).cast("string").alias("n"),
    )
    part = table(spark, sf, "part").select(
        F.lit("parts").alias("source_name"), F.lit("parts").alias("model"), F.lit(None).cast("bigint").alias("s"),
        F.col("p_partkey").alias("p"), F.col("p_name").alias("n"),
    )
    models = [
        MappingSpec("supply", "Supplier", _concat("supplier/", F.col("s")), {}, {"supplies": _concat("part/", F.col("p"))}),
        MappingSpec("parts", "Part", _concat("part/", F.col("p")), {"name": F.col("n")}),
    ]
    return materialise(statements(line.unionByName(part), models), scratch_path(spark, "supply"))


# --- tweets from conversations ----------------------------------------------------


def tweet_lines(spark: SparkSession, sf: str) -> DataFrame:
    c, t = F.col("conv_id"), F.col("turn")
    day = F.date_add(F.lit(dt.date(2024, 1, 1)), (c % 60).cast("int"))
    created = F.concat(F.date_format(day, "EEE MMM dd"), F.lit(" 10:00:00 +0000 "), F.date_format(day, "yyyy"))
    body = F.struct(
        _concat(c, "-", t).alias("id_str"),
        created.alias("created_at"),
        F.col("text"),
        t.alias("retweet_count"),
        (c % 7).alias("favorite_count"),
        F.when(t > 0, _concat(c, "-0")).alias("in_reply_to_status_id_str"),
        F.struct(F.col("role").alias("screen_name")).alias("user"),
        F.struct(
            F.array(F.struct(_concat("tag", c % 10).alias("text")), F.struct(_concat("t", t).alias("text"))).alias("hashtags"),
            F.filter(F.array(F.struct(_concat("m", t).alias("screen_name"))), lambda m: t > 0).alias("user_mentions"),
        ).alias("entities"),
    )
    return table(spark, sf, "conversations").select(
        F.date_format(day, "yyyy-MM-dd").alias("file"), F.to_json(body).alias("line")
    )


def tweets(spark: SparkSession, sf: str) -> DataFrame:
    return parse_tweets(tweet_lines(spark, sf))


def snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """A snapshot catalog: one snapshot per event day and type; one alias has no date."""
    day = F.to_date("ts")
    dated = F.concat(F.lit("data-"), F.date_format("snapshot", "yyyy-MM-dd"))
    return (
        table(spark, sf, "events")
        .groupBy(day.alias("snapshot"), F.col("event_type").alias("doc_type"))
        .agg(F.count("*").alias("rows"), F.sum(F.octet_length("props")).cast("bigint").alias("bytes"))
        .withColumn("alias", F.when(F.dayofmonth("snapshot") == 5, F.lit("data-latest-5")).otherwise(dated))
    )


# --- the same views in SQL --------------------------------------------------------

SQL: dict[str, tuple[list[str], str]] = {
    "ev": ([], "SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events"),
    "cdr": (
        ["ev"],
        f"""SELECT source_name || '/' || md5(raw_content) AS _id, "timestamp", raw_content,
               'application/json' AS content_type, '{URL_BASE}' || source_name || '/' || md5(raw_content) AS url,
               '2.0' AS version, team, source_name, CAST(make_timestamp("timestamp" * 1000000) AS DATE) AS day
        FROM (SELECT team, team || '-' || user_id AS source_name, CAST(floor(epoch(ts)) AS BIGINT) AS "timestamp",
                     '{{"user": ' || user_id || ', "kind": "' || event_type || '"' ||
                     CASE WHEN event_type <> 'error' THEN ', "targetSystem": "sys' || k || '"' ELSE '' END ||
                     ', "detail": ' || props || '}}' AS raw_content
              FROM (SELECT *, CASE event_type WHEN 'click' THEN 'hg' WHEN 'view' THEN 'asu' WHEN 'purchase' THEN 'ruhr'
                              WHEN 'signup' THEN 'armstrong' ELSE 'isi' END AS team FROM ev))""",
    ),
    "user_cdr": (
        ["ev"],
        """SELECT (['hg', 'asu', 'ruhr', 'armstrong', 'isi'])[CAST(user_id % 5 + 1 AS INTEGER)] || '-' || user_id AS source_name, CAST(ts AS DATE) AS day
        FROM ev""",
    ),
    "order_cdr": (
        [],
        """SELECT source_name || '/' || md5(raw_content) AS _id, *
        FROM (SELECT 'orders-' || lower(o_orderstatus) AS source_name, CAST(floor(epoch(o_orderdate)) AS BIGINT) AS "timestamp",
                     CAST(year(o_orderdate) AS INTEGER) AS "year", CAST(month(o_orderdate) AS INTEGER) AS "month", o_orderstatus,
                     '{"order": ' || o_orderkey || ', "customer": ' || o_custkey || ', "status": "' || o_orderstatus || '"}' AS raw_content
              FROM orders)""",
    ),
    "evidence": (
        [],
        """SELECT 'doc/' || doc_id AS _id, CASE source WHEN 'src0' THEN 'hg-blogs' WHEN 'src1' THEN 'isi-news' ELSE source END AS source_name,
               text || ' CVE-' || (2000 + doc_id % 20) || '-' || (1000 + doc_id * 37 % 90000) || ' ms' ||
               lpad(CAST(doc_id % 18 AS VARCHAR), 2, '0') || '-' || lpad(CAST(doc_id * 7 % 200 AS VARCHAR), 3, '0') ||
               ' cve-2014-123456789' AS full_text
        FROM documents""",
    ),
    "gt": (
        ["ev"],
        """SELECT *, strftime(ts, '%Y-%m-%d %H:%M:%S') AS spaced, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.123' AS iso,
               CASE event_type WHEN 'click' THEN 'malicious-url' WHEN 'view' THEN 'malicious-email' WHEN 'purchase' THEN 'endpoint-malware'
                    WHEN 'signup' THEN 'malicious-destination' ELSE 'atoifs' END AS kind,
               CASE WHEN event_type IN ('view', 'purchase') THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.123'
                    WHEN event_type = 'error' THEN CASE WHEN k < 10 THEN 'soon' END
                    ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS occurred,
               CASE WHEN event_type = 'error' AND k < 10 THEN NULL ELSE CAST(ts AS DATE) END AS event_day,
               CASE WHEN user_id % 2 = 0 THEN 'acme' ELSE 'globex' END AS company,
               CASE WHEN user_id % 2 = 0 THEN 'acme' ELSE 'globex' END || '/' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS file
        FROM ev""",
    ),
    "attr": (
        ["gt"],
        """SELECT 'target_entity' AS attribute, 'user' || user_id AS value, occurred, file FROM gt WHERE event_type = 'click'
        UNION ALL SELECT 'target_entity', 'user' || user_id || '@corp.com', occurred, file FROM gt WHERE event_type = 'view'
        UNION ALL SELECT 'target_entity', 'desk' || k, occurred, file FROM gt WHERE event_type = 'view'
        UNION ALL SELECT 'target_entity', '10.1.0.' || user_id, occurred, file FROM gt WHERE event_type = 'purchase'
        UNION ALL SELECT 'email_sender', 's' || k || '@mail.com', occurred, file FROM gt WHERE event_type IN ('click', 'view')
        UNION ALL SELECT 'addresses_ip', '10.0.0.' || k, occurred, file FROM gt WHERE event_type IN ('click', 'view')
        UNION ALL SELECT 'addresses_url', 'http://h' || k || '.example.com:8080/p', occurred, file FROM gt WHERE event_type = 'click'
        UNION ALL SELECT 'addresses_url', 'http://h' || k || '.example.com/p', occurred, file FROM gt WHERE event_type = 'view'
        UNION ALL SELECT 'addresses_url', 'h' || k || '.example.org/x', occurred, file FROM gt WHERE event_type IN ('click', 'view')
        UNION ALL SELECT 'email_subject', 'subject ' || k, occurred, file FROM gt WHERE event_type = 'view'
        UNION ALL SELECT 'files_filename', 'f' || k || '.exe', occurred, file FROM gt WHERE event_type = 'purchase'
        UNION ALL SELECT 'threat_actor', '1.2.3.' || k, occurred, file FROM gt WHERE event_type = 'purchase'
        UNION ALL SELECT 'threat_designation_family', 'fam' || k, occurred, file FROM gt WHERE event_type = 'purchase'
        UNION ALL SELECT 'threat_designation_type', 'trojan', occurred, file FROM gt WHERE event_type = 'purchase'
        UNION ALL SELECT 'attack_method', 'phish', occurred, file FROM gt WHERE event_type = 'signup'
        UNION ALL SELECT 'detector_classification', 'a', occurred, file FROM gt WHERE event_type = 'click'
        UNION ALL SELECT 'detector_classification', 'b' || k, occurred, file FROM gt WHERE event_type = 'click'
        UNION ALL SELECT 'detector_classification', 'x', occurred, file FROM gt WHERE event_type = 'purchase'""",
    ),
    "targets": (
        ["gt"],
        """SELECT 'user' || user_id AS target, NULL AS user_number FROM gt WHERE event_type = 'click'
        UNION ALL SELECT 'user' || user_id || '@corp.com', NULL FROM gt WHERE event_type = 'view'
        UNION ALL SELECT 'desk' || k, NULL FROM gt WHERE event_type = 'view'
        UNION ALL SELECT '10.1.0.' || user_id, NULL FROM gt WHERE event_type = 'purchase'
        UNION ALL SELECT 'user' || user_id, user_id FROM gt WHERE event_type = 'signup'
        UNION ALL SELECT 'unknown', NULL FROM gt WHERE event_type = 'error'""",
    ),
    "docs": (
        [],
        """SELECT lang AS doc_type, 'doc/' || doc_id AS uri, 'Document ' || doc_id AS name, text,
               trim(regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', ' ', 'g')) AS norm,
               CASE WHEN doc_id % 11 = 0 THEN [] WHEN doc_id % 5 = 0 THEN [source, 'mirror'] ELSE [source] END AS publisher,
               CASE WHEN doc_id % 3 = 0 THEN DATE '2024-01-01' + CAST(doc_id % 300 AS INTEGER) END AS date_published,
               CASE WHEN doc_id % 3 = 1 THEN DATE '2023-03-01' + CAST(doc_id % 200 AS INTEGER) END AS start_date,
               CASE WHEN doc_id % 4 <> 0 THEN DATE '2023-06-01' + CAST(doc_id % 500 AS INTEGER) END AS observed_date,
               CASE WHEN doc_id % 2 = 0 THEN DATE '2022-01-01' + CAST(doc_id % 900 AS INTEGER) END AS date_recorded
        FROM documents""",
    ),
    "phrases": (
        [],
        """SELECT DISTINCT text AS phrase, trim(regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', ' ', 'g')) AS pnorm
        FROM benchmark""",
    ),
    "hits": (
        ["docs", "phrases"],
        """SELECT phrase, uri, score FROM (
            SELECT phrase, uri,
                   CAST((length(wide) - length(replace(wide, needle, ''))) / length(needle) AS BIGINT) AS score
            FROM (SELECT phrase, uri, ' ' || replace(norm, ' ', '  ') || ' ' AS wide,
                         ' ' || replace(pnorm, ' ', '  ') || ' ' AS needle
                  FROM docs JOIN phrases ON contains(' ' || norm || ' ', ' ' || pnorm || ' ') AND pnorm <> ''))""",
    ),
    "stm": (
        [],
        """SELECT DISTINCT uri, "type", property, value, object_uri, source, publisher, recorded, observed FROM (
            WITH o AS (SELECT *, unnest(CASE WHEN o_orderstatus = 'F' THEN ['shop', 'shop-mirror'] ELSE ['shop'] END) AS src FROM orders)
            SELECT 'nation/' || n_nationkey AS uri, 'Nation' AS "type", 'a' AS property, 'Nation' AS value, NULL AS object_uri, 'geo' AS source,
                   'geo-feed' AS publisher, '2024-01-02' AS recorded, NULL AS observed FROM nation
            UNION ALL SELECT 'nation/' || n_nationkey, 'Nation', 'name', n_name, NULL, 'geo', 'geo-feed', '2024-01-02', NULL FROM nation
            UNION ALL SELECT 'nation/' || n_nationkey, 'Nation', 'region', NULL, 'region/' || n_regionkey, 'geo', 'geo-feed', '2024-01-02', NULL FROM nation
            UNION ALL SELECT 'customer/' || c_custkey, 'Customer', 'a', 'Customer', NULL, 'crm', 'crm-feed', '2024-01-02', NULL FROM customer
            UNION ALL SELECT 'customer/' || c_custkey, 'Customer', 'name', c_name, NULL, 'crm', 'crm-feed', '2024-01-02', NULL FROM customer
            UNION ALL SELECT 'customer/' || c_custkey, 'Customer', 'segment', c_mktsegment, NULL, 'crm', 'crm-feed', '2024-01-02', NULL FROM customer
            UNION ALL SELECT 'customer/' || c_custkey, 'Customer', 'nation', NULL, 'nation/' || c_nationkey, 'crm', 'crm-feed', '2024-01-02', NULL FROM customer
            UNION ALL SELECT 'order/' || o_orderkey, 'Order', 'a', 'Order', NULL, src, src || '-feed', '2024-01-02', strftime(o_orderdate, '%Y-%m-%d') FROM o
            UNION ALL SELECT 'order/' || o_orderkey, 'Order', 'status', o_orderstatus, NULL, src, src || '-feed', '2024-01-02', strftime(o_orderdate, '%Y-%m-%d') FROM o
            UNION ALL SELECT 'order/' || o_orderkey, 'Order', 'priority', o_orderpriority, NULL, src, src || '-feed', '2024-01-02', strftime(o_orderdate, '%Y-%m-%d') FROM o
            UNION ALL SELECT 'order/' || o_orderkey, 'Order', 'customer', NULL, 'customer/' || o_custkey, src, src || '-feed', '2024-01-02', strftime(o_orderdate, '%Y-%m-%d') FROM o)""",
    ),
    "order_docs": (
        [],
        """SELECT 'order' AS doc_type, 'order/' || o_orderkey AS uri, 0 AS part, o_orderdate,
               '{"uri":"order/' || o_orderkey || '","a":["Order"],"status":["' || o_orderstatus || '"],"priority":["' || o_orderpriority ||
               '"],"customer":[' || CASE WHEN c_custkey IS NULL THEN '{"uri":"customer/' || o_custkey || '"}' ELSE
               '{"uri":"customer/' || c_custkey || '","a":["Customer"],"name":["' || c_name || '"],"nation":[{"uri":"nation/' || n_nationkey ||
               '","a":["Nation"],"name":["' || n_name || '"]}]}' END || ']}' AS doc
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""",
    ),
    "tw": (
        [],
        """SELECT conv_id || '-' || turn AS id, text, role, turn, conv_id, DATE '2024-01-01' + CAST(conv_id % 60 AS INTEGER) AS day,
               CASE WHEN turn > 0 THEN conv_id || '-0' ELSE conv_id || '-' || turn END AS conversation
        FROM conversations""",
    ),
    "snap": (
        [],
        """SELECT CAST(ts AS DATE) AS snapshot, event_type AS doc_type, count(*) AS "rows", CAST(sum(strlen(props)) AS BIGINT) AS bytes,
               CASE WHEN day(CAST(ts AS DATE)) = 5 THEN 'data-latest-5' ELSE 'data-' || strftime(CAST(ts AS DATE), '%Y-%m-%d') END AS alias
        FROM events GROUP BY ALL""",
    ),
}


def check_sql(uses: str, body: str) -> str:
    """``body`` with the views it names in ``uses``, and those they build on, in front."""
    order: list[str] = []

    def add(name: str) -> None:
        for inner in SQL[name][0]:
            add(inner)
        if name not in order:
            order.append(name)

    for name in uses.split():
        add(name)
    if not order:
        return body
    heads = ",\n".join(f"{name} AS ({SQL[name][1]})" for name in order)
    # A body with CTEs of its own continues the list.
    if body.lstrip().upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {heads},\n{body.lstrip()[15:]}"
    if body.lstrip().upper().startswith("WITH "):
        return f"WITH {heads},\n{body.lstrip()[5:]}"
    return f"WITH {heads}\n{body}"
