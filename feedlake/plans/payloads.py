"""Registered queries: payload framing, unwrapping, classification and text rules.

Vendor bodies are built from the driver tables with string and JSON functions
(so their volume grows with the tables), then fed through the library's
operators. The DuckDB statements state the expected items directly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions.identity import canonical_json, event_hash_pipe, event_hash_struct
from feedlake.functions.scalars import (archive_name, file_date_key, file_day, iso_local, parse_dotnet_date,
                                        parse_envelope_ts, parse_logged, safe_prefix, split_list, stream_class,
                                        stream_group, to_local)
from feedlake.operators import ids as id_ops
from feedlake.operators.filters import object_rows, reject_html
from feedlake.operators.lookups import catalog_with_fallback, full_pair, parse_catalog, version_text
from feedlake.operators.monitor import classify_bustime
from feedlake.operators.projections import first_per_id, infopoint_alert, infopoint_vehicle
from feedlake.sinks.archive import error_rows
from feedlake.plans.feeds import feed_envelopes
from feedlake.plans.oracle import iso_local_sql, iso_seconds_sql, local, with_feed
from feedlake.schema import DEFAULT_TZ
from feedlake.sources import unwrap as uw
from feedlake.sources.sse import sse_records
from feedlake.sources.tables import read_table

TZ = DEFAULT_TZ
QUERIES: dict = {}
ORACLE: dict = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _item2():
    return F.to_json(F.struct(F.col("user_id").alias("id")))


@register
def q_unwrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-03/04/07/10: six body shapes (bulk entity list, bare list, single object,
    JSON:API data, BusTime envelope, one-key wrapper) unwrapped by platform config."""
    f = feed_envelopes(spark, sf_dir, TZ).select("event_id", "user_id", "data")
    shape = (F.col("event_id") % 6).cast("int")
    two = F.concat(F.col("data"), F.lit(","), _item2())
    body = (F.when(shape == 0, F.concat(F.lit('{"entity":['), two, F.lit("]}")))
            .when(shape == 1, F.concat(F.lit("["), two, F.lit("]")))
            .when(shape == 2, F.col("data"))
            .when(shape == 3, F.concat(F.lit('{"data":['), two, F.lit('],"meta":{"n":2}}')))
            .when(shape == 4, F.concat(F.lit('{"bustime-response":{"vehicle":['), two, F.lit("]}}")))
            .otherwise(F.concat(F.lit('{"routes":{"route":['), two, F.lit("]}}"))))
    v = F.try_parse_json(body)
    items = (F.when(shape <= 2, uw.unwrap_items(v, uw.BULK))
             .when(shape == 3, uw.unwrap_items(v, uw.JSONAPI))
             .when(shape == 4, uw.unwrap_items(uw.bustime_body(v), uw.bustime(("vehicle",))))
             .otherwise(uw.unwrap_items(uw.bustime_body(v), uw.bustime(("routes",)))))
    out = f.select("event_id", F.posexplode(items).alias("item_no", "item"))
    return out.select("event_id", "item_no", F.to_json("item").alias("item"))


ORACLE["q_unwrap"] = """
SELECT event_id, 0 AS item_no, CAST(json(props) AS VARCHAR) AS item FROM events
UNION ALL
SELECT event_id, 1, '{"id":' || CAST(user_id AS VARCHAR) || '}' FROM events WHERE event_id % 6 <> 2"""


@register
def q_number_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IDN-06, IDN-01/03: payloads whose numbers have fractions, exponents, signs of zero and thirty
    digits; canonical text and hashes are those of ``json.dumps``."""
    f = feed_envelopes(spark, sf_dir, TZ)
    cents = F.format_string("%.3f", "value")  # 6.55 is written 6.550
    data = F.concat(F.lit('{"z":[1.0,-0.0,-0,1.5E-7,1e5,1E16,0.00010],"v":'), cents, F.lit(',"s":"1.0 e5","n":'),
                    (F.col("event_id") + 1).cast("string"), F.lit('000000000000000000000000000001,"k":'), F.col("user_id").cast("string"),
                    F.lit('e-1,"a":{"b":-2.50e+3}}'))
    t = f.select("event_id", "endpoint", "event", "id", "agency", "stream", data.alias("data"))
    return t.select("event_id", canonical_json("data").alias("text"),
                    event_hash_pipe("endpoint", "event", "id", "data").alias("hash_pipe"),
                    event_hash_struct("agency", "stream", "event", "endpoint", "data").alias("hash_struct"))


ORACLE["q_number_text"] = with_feed("""
SELECT event_id, t AS text,
       sha256(endpoint || '|' || event || '|' || id || '|' || replace(replace(t, ',', ', '), '":', '": ')) AS hash_pipe,
       sha256('{"agency":"' || agency || '","data":' || t || ',"endpoint":"' || endpoint || '","event":"' || event
              || '","metadata":null,"stream":"' || stream || '"}') AS hash_struct
FROM (SELECT *, '{"a":{"b":-2500.0},"k":' || (CAST(user_id AS DOUBLE) / 10)::VARCHAR
             || ',"n":' || (event_id + 1) || '000000000000000000000000000001'
             || ',"s":"1.0 e5","v":' || CAST(CAST(printf('%.3f', value) AS DOUBLE) AS VARCHAR)
             || ',"z":[1.0,-0.0,0,1.5e-07,100000.0,1e+16,0.0001]}' AS t FROM feed)""")


@register
def q_sse_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-02, WIN-03: per entity and local hour one captured SSE segment (frames in
    capture order, multi-line data, list payloads, unnamed frames, a bad frame and
    an unclosed tail), framed back into records."""
    f = feed_envelopes(spark, sf_dir, TZ)
    name = F.when(F.col("stream") == "signup", F.lit("")).otherwise(
        F.concat(F.lit("event: "), F.col("stream"), F.lit("\n")))
    data = (F.when(F.col("stream") == "view",
                   F.concat(F.lit("data: "), F.regexp_replace("data", ": ", ":\ndata: "), F.lit("\n")))
            .when(F.col("stream") == "purchase",
                  F.concat(F.lit("data: ["), F.col("data"), F.lit(", "), _item2(), F.lit("]\n")))
            .otherwise(F.concat(F.lit("data: "), F.col("data"), F.lit("\n"))))
    bad = F.when(F.col("stream") == "click", F.lit("event: click\ndata: {oops\n\n")).otherwise(F.lit(""))
    frame = F.concat(name, data, F.lit("\n"), bad)
    # One capture segment per entity and local hour (captures rotate; frames never
    # span segments), so a segment is bounded by an hour of one entity's stream.
    f = f.withColumn("hour", F.hour(to_local("ts", TZ)))
    seg = f.groupBy("agency", "id", "day", "hour").agg(
        F.array_sort(F.collect_list(F.struct("ts", "event_id", frame.alias("frame")))).alias("_fr"))
    seg = seg.select("agency", "id", "day",
                     F.concat(F.array_join(F.transform("_fr", lambda e: e["frame"]), ""),
                              F.lit('event: tail\ndata: {"tail": 1}\n')).alias("body"))
    rec = sse_records(seg)
    return rec.select("agency", "id", "day", "event", F.to_json("record").alias("record"))


ORACLE["q_sse_frames"] = with_feed("""
SELECT agency, id, day, CASE WHEN stream = 'signup' THEN 'message' ELSE stream END AS event,
       CAST(json(data) AS VARCHAR) AS record FROM feed
UNION ALL
SELECT agency, id, day, stream, '{"id":' || CAST(user_id AS VARCHAR) || '}' FROM feed WHERE stream = 'purchase'""")


@register
def q_reject_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-05: captured bodies — web pages, JSON payloads, plain names, blanks —
    classified as rejected, json, text or empty with the normalized payload."""
    pages = read_table(spark, sf_dir, "pages").select(F.lit("pages").alias("source"),
                                                       F.col("page_id").alias("key"), F.col("html").alias("body"))
    ev = read_table(spark, sf_dir, "events").select(F.lit("events").alias("source"),
                                                    F.col("event_id").alias("key"), F.col("props").alias("body"))
    cu = read_table(spark, sf_dir, "customer").select(
        F.lit("customer").alias("source"), F.col("c_custkey").alias("key"),
        F.when(F.col("c_acctbal") < 0, F.lit("  ")).otherwise(F.col("c_name")).alias("body"))
    # Pages and names once more behind line breaks and tabs: white space of any kind is stripped.
    odd = pages.select(F.lit("odd pages").alias("source"), "key", F.concat(F.lit("\n\t"), "body", F.lit("\r\n")).alias("body"))
    text = cu.select(F.lit("odd names").alias("source"), "key", F.concat(F.lit("\t\n"), "body", F.lit("\n")).alias("body"))
    bodies = pages.unionByName(ev).unionByName(cu).unionByName(odd).unionByName(text)
    return reject_html(bodies, "body").select("source", "key", "outcome", "payload")


ORACLE["q_reject_html"] = """
SELECT source, key,
  CASE WHEN trim(body) = '' THEN 'empty'
       WHEN starts_with(lower(trim(body)), '<html') OR starts_with(lower(trim(body)), '<!doctype')
            OR contains(lower(body), '<title>request rejected</title>') THEN 'rejected'
       WHEN json_valid(body) THEN 'json' ELSE 'text' END AS outcome,
  CASE WHEN trim(body) = '' THEN NULL
       WHEN starts_with(lower(trim(body)), '<html') OR starts_with(lower(trim(body)), '<!doctype')
            OR contains(lower(body), '<title>request rejected</title>') THEN NULL
       WHEN json_valid(body) THEN CAST(json(body) AS VARCHAR) ELSE CAST(json_object('data', body) AS VARCHAR) END AS payload
FROM (SELECT 'pages' AS source, page_id AS key, html AS body FROM pages
      UNION ALL SELECT 'events', event_id, props FROM events
      UNION ALL SELECT 'customer', c_custkey, CASE WHEN c_acctbal < 0 THEN '  ' ELSE c_name END FROM customer
      UNION ALL SELECT 'odd pages', page_id, chr(10) || chr(9) || html || chr(13) || chr(10) FROM pages
      UNION ALL SELECT 'odd names', c_custkey, chr(9) || chr(10) || (CASE WHEN c_acctbal < 0 THEN '  ' ELSE c_name END) || chr(10)
                FROM customer)""".replace("trim(body)", "trim(body, ' ' || chr(9) || chr(10) || chr(13))") \
    .replace("json_object('data', body)", "json_object('data', trim(body, ' ' || chr(9) || chr(10) || chr(13)))")


@register
def q_dotnet_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL-06: ``/Date(ms-0500)/`` texts from capture instants parsed back; error rows
    carry 'n/a' (kept as text), signup rows a blank (null); the anchored TransLoc
    form rejects a prefixed text."""
    f = feed_envelopes(spark, sf_dir, TZ)
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    txt = (F.when(F.col("stream") == "error", F.lit("n/a"))
           .when(F.col("stream") == "signup", F.lit(""))
           .otherwise(F.format_string("/Date(%d-0500)/", ms)))
    prefixed = F.concat(F.lit("at "), txt)
    return f.select("event_id", parse_dotnet_date(txt).alias("parsed"),
                    parse_dotnet_date(prefixed, anchored=True).alias("parsed_anchored"))


ORACLE["q_dotnet_date"] = f"""
SELECT event_id,
  CASE WHEN event_type = 'error' THEN 'n/a' WHEN event_type = 'signup' THEN NULL
       ELSE {iso_seconds_sql('epoch_ms(epoch_us(ts) // 1000)')} END AS parsed,
  CASE WHEN event_type = 'error' THEN 'at n/a' WHEN event_type = 'signup' THEN 'at '
       ELSE 'at /Date(' || CAST(epoch_us(ts) // 1000 AS VARCHAR) || '-0500)/' END AS parsed_anchored
FROM events"""


@register
def q_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL-01/02/18, PRJ-14: archive file names from orders, their date keys parsed
    back, both label styles and list splitting."""
    o = read_table(spark, sf_dir, "orders")
    label = F.concat(F.col("o_orderpriority"), F.lit(" é#"), F.col("o_orderstatus"))
    name = archive_name(safe_prefix("o_orderpriority"), F.lower("o_orderstatus"),
                        F.col("o_orderdate").cast("date"), "jsonl")
    return o.select("o_orderkey", name.alias("file_name"), file_date_key(name).alias("date_key"),
                    file_day(name).alias("file_day"),
                    safe_prefix(label, style="unicode").alias("label_unicode"),
                    safe_prefix(label, style="main").alias("label_main"),
                    F.size(split_list(F.concat_ws(",", F.col("o_orderpriority"), F.lit(" "), F.col("o_orderstatus"))))
                    .alias("n_items"))


def _safe_main_sql(x: str) -> str:
    return f"coalesce(nullif(regexp_replace(regexp_replace(trim({x}), '[^A-Za-z0-9_-]+', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'agency')"


def _safe_uni_sql(x: str) -> str:
    return f"coalesce(nullif(regexp_replace(regexp_replace(trim({x}), '[^\\p{{L}}\\p{{N}}_-]', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'agency')"


ORACLE["q_names"] = f"""
SELECT o_orderkey, file_name, strftime(CAST(o_orderdate AS DATE), '%m%d%Y') AS date_key, CAST(o_orderdate AS DATE) AS file_day,
       {_safe_uni_sql("o_orderpriority || ' é#' || o_orderstatus")} AS label_unicode,
       {_safe_main_sql("o_orderpriority || ' é#' || o_orderstatus")} AS label_main,
       CAST(2 AS INTEGER) AS n_items
FROM (SELECT *, {_safe_main_sql('o_orderpriority')} || '_' || lower(o_orderstatus) || '_'
                || strftime(CAST(o_orderdate AS DATE), '%m%d%Y') || '.jsonl' AS file_name FROM orders)"""


@register
def q_error_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-04, IDN-04, SCL-05: error captures as error envelopes with naive local
    time text, their hash, and the instant parsed back from the text."""
    f = feed_envelopes(spark, sf_dir, TZ).filter(F.col("stream") == "error")
    msg = F.concat(F.lit("poll failed for "), F.col("endpoint"), F.lit(" k="),
                   F.try_variant_get(F.try_parse_json("data"), "$.k", "string"))
    e = error_rows(f, F.col("agency"), msg, F.col("ts"), TZ, keep=["event_id"])
    return e.select("event_id", "agency", "stream", "event", "hash_id", "data",
                    F.date_format(parse_envelope_ts("ts_raw", TZ), "yyyy-MM-dd HH:mm:ss").alias("ts_utc"))


ORACLE["q_error_rows"] = with_feed(f"""
SELECT event_id, agency, 'Errors' AS stream, 'error' AS event,
       sha256(agency || '|error|' || ts_text || '|' || message) AS hash_id,
       CAST(json_object('message', message) AS VARCHAR) AS data, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_utc
FROM (SELECT *, strftime({local('ts')}, '%Y-%m-%d %H:%M:%S') AS ts_text,
             'poll failed for ' || endpoint || ' k=' || json_extract_string(data, '$.k') AS message
      FROM feed WHERE stream = 'error')""")


@register
def q_parse_logged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL-04: logged dates written four ways (ISO with offset, ISO date, MMDDYYYY,
    junk) parsed to one local text form."""
    o = read_table(spark, sf_dir, "orders")
    d = F.col("o_orderdate")
    txt = (F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit("T08:00:00+00:00")))
           .when(F.col("o_orderkey") % 4 == 1, F.date_format(d, "yyyy-MM-dd"))
           .when(F.col("o_orderkey") % 4 == 2, F.date_format(d, "MMddyyyy"))
           .otherwise(F.lit("n/a")))
    p = parse_logged(txt, TZ)
    return o.select("o_orderkey", F.when(p.isNotNull(), iso_local(p, TZ)).alias("logged"))


ORACLE["q_parse_logged"] = f"""
SELECT o_orderkey, CASE WHEN t IS NULL THEN NULL ELSE {iso_local_sql('t')} END AS logged FROM (
  SELECT o_orderkey,
    CASE o_orderkey % 4 WHEN 0 THEN CAST(o_orderdate AS DATE) + INTERVAL 8 HOUR
         WHEN 1 THEN CAST(timezone('UTC', timezone('{TZ}', CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP))) AS TIMESTAMP)
         WHEN 2 THEN CAST(timezone('UTC', timezone('{TZ}', CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP))) AS TIMESTAMP)
    END AS t
  FROM orders)"""


@register
def q_config_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON-06, PRJ-11: per agency (nation) a config document (all regions but 3) and a
    version document (regions 2-3; an object or a bare string), full outer joined."""
    n = read_table(spark, sf_dir, "nation")
    cfg = n.filter(F.col("n_regionkey") != 3).select(
        F.col("n_name").alias("agency"),
        F.to_json(F.struct(F.col("n_nationkey").alias("nation"), F.col("n_regionkey").alias("region"))).alias("config"))
    ver_doc = F.when(F.col("n_nationkey") % 2 == 0,
                     F.to_json(F.struct(F.concat(F.lit("v"), F.col("n_nationkey")).alias("version"))))\
        .otherwise(F.concat(F.lit('"v'), F.col("n_nationkey").cast("string"), F.lit('"')))
    ver = n.filter(F.col("n_regionkey").isin(2, 3)).select(F.col("n_name").alias("agency"), ver_doc.alias("doc"))
    ver = ver.select("agency", version_text("doc").alias("version"))
    return full_pair(cfg, ver, "agency").select("agency", "config", "version")


ORACLE["q_config_version"] = """
SELECT COALESCE(c.agency, v.agency) AS agency, c.config, v.version FROM
  (SELECT n_name AS agency, '{"nation":' || CAST(n_nationkey AS VARCHAR) || ',"region":' || CAST(n_regionkey AS VARCHAR) || '}' AS config
   FROM nation WHERE n_regionkey <> 3) c
FULL OUTER JOIN
  (SELECT n_name AS agency, 'v' || CAST(n_nationkey AS VARCHAR) AS version FROM nation WHERE n_regionkey IN (2, 3)) v
ON c.agency = v.agency"""

CATALOG_TARGETS = ("1", "2", "7", "11", "16")


@register
def q_agency_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON-09, SRT-03: per region an ``id:NAME`` catalog text (with blank and
    half-empty entries) parsed, intersected with target ids, falling back to all."""
    n = read_table(spark, sf_dir, "nation")
    text = n.groupBy("n_regionkey").agg(
        F.concat(F.array_join(F.array_sort(F.collect_list(
            F.concat(F.col("n_nationkey").cast("string"), F.lit(" : "), F.col("n_name")))), ", "),
            F.lit(", , 99:, :X")).alias("text"))
    cat = text.select(F.col("n_regionkey").alias("region"), F.explode(parse_catalog(F.col("text"))).alias("e"))
    cat = cat.select("region", F.col("e.key").alias("agency_id"), F.col("e.value").alias("abbrev"))
    targets = spark.createDataFrame([(t,) for t in CATALOG_TARGETS], "agency_id string")
    targets = cat.select("region", "agency_id").join(targets, "agency_id", "left_semi")
    return catalog_with_fallback(cat, targets, "region", "agency_id")


ORACLE["q_agency_catalog"] = """
WITH cat AS (SELECT n_regionkey AS region, CAST(n_nationkey AS VARCHAR) AS agency_id, n_name AS abbrev FROM nation),
hit AS (SELECT * FROM cat WHERE agency_id IN ('1', '2', '7', '11', '16'))
SELECT * FROM hit UNION ALL SELECT * FROM cat WHERE region NOT IN (SELECT region FROM hit)"""


@register
def q_stream_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL-14/15, AGG-17, SRT-04: per year and stream the coverage-page group and
    the stream type under each platform's keyword rules."""
    f = feed_envelopes(spark, sf_dir, TZ)
    renamed = (F.when(F.col("stream") == "view", F.lit("vehicles"))
               .when(F.col("stream") == "click", F.lit("VehiclePositions_enhanced"))
               .when(F.col("stream") == "purchase", F.lit("TripUpdates"))
               .when(F.col("stream") == "error", F.lit("StopArrivalTimes"))
               .otherwise(F.lit("SystemConfig")))
    s = f.select(F.year("day").alias("year"), renamed.alias("stream")).distinct()
    # The platforms with exact names see other names for the same streams.
    bus = (F.when(F.col("stream") == "vehicles", F.lit("Stops")).when(F.col("stream") == "TripUpdates", F.lit("Agencies"))
           .when(F.col("stream") == "StopArrivalTimes", F.lit("Predictions")).otherwise(F.lit("MasterRoute")))
    return s.select("year", "stream", stream_group("stream").alias("group"),
                    stream_class("stream", "gtfsrt").alias("class_gtfsrt"),
                    stream_class("stream", "transloc").alias("class_transloc"),
                    stream_class("stream", "swiv").alias("class_swiv"),
                    *[stream_class(bus, p).alias(f"class_{p}") for p in ("bustime", "passiogo", "routematch", "massport")])


ORACLE["q_stream_groups"] = with_feed("""
SELECT year, stream,
  CASE WHEN contains(lower(stream), 'enhanced') THEN 'enhanced'
       WHEN stream IN ('vehicles', 'TripUpdates') THEN 'main' ELSE 'custom' END AS "group",
  CASE WHEN contains(lower(stream), 'vehicle') THEN 'vehicle' WHEN contains(lower(stream), 'trip') THEN 'trip'
       WHEN contains(lower(stream), 'alert') THEN 'alert' ELSE 'general' END AS class_gtfsrt,
  CASE WHEN contains(lower(stream), 'vehicle') THEN 'vehicle'
       WHEN contains(lower(stream), 'arrival') OR contains(lower(stream), 'stop') THEN 'prediction'
       WHEN contains(lower(stream), 'route') THEN 'config' WHEN contains(lower(stream), 'capacit') THEN 'occupancy'
       ELSE 'general' END AS class_transloc,
  CASE WHEN contains(lower(stream), 'vehicle') THEN 'vehicle' WHEN contains(lower(stream), 'alert') THEN 'alert'
       WHEN contains(lower(stream), 'config') OR contains(lower(stream), 'version') THEN 'config'
       WHEN contains(lower(stream), 'topo') THEN 'topo' ELSE 'general' END AS class_swiv,
  CASE stream WHEN 'vehicles' THEN 'Hourly' WHEN 'TripUpdates' THEN 'Bi-Weekly' ELSE 'Streamed' END AS class_bustime,
  CASE stream WHEN 'vehicles' THEN 'Hourly' ELSE 'Streamed' END AS class_passiogo,
  CASE WHEN stream IN ('vehicles', 'TripUpdates', 'StopArrivalTimes') THEN 'Streamed' ELSE 'Hourly' END AS class_routematch,
  CASE stream WHEN 'vehicles' THEN 'Hourly' WHEN 'StopArrivalTimes' THEN 'Live' ELSE 'Streamed' END AS class_massport
FROM (SELECT DISTINCT year(day) AS year,
        CASE stream WHEN 'view' THEN 'vehicles' WHEN 'click' THEN 'VehiclePositions_enhanced'
             WHEN 'purchase' THEN 'TripUpdates' WHEN 'error' THEN 'StopArrivalTimes' ELSE 'SystemConfig' END AS stream
      FROM feed)""")


@register
def q_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-06, SCL-19: BusTime answers built per capture — unsupported, missing
    parameter, empty, unknown error (no msg), and data — classified."""
    f = feed_envelopes(spark, sf_dir, TZ)
    body = (F.when(F.col("stream") == "signup",
                   F.lit('{"bustime-response":{"error":[{"msg":"Unsupported function"}]}}'))
            .when(F.col("stream") == "purchase",
                  F.lit('{"bustime-response":{"error":{"msg":" No parameter provided "}}}'))
            .when(F.col("stream") == "view",
                  F.format_string('{"bustime-response":{"error":[{"msg":"No %s found"}]}}',
                                  F.when(F.col("value") > 100, F.lit("vehicles")).otherwise(F.lit("data"))))
            .when(F.col("stream") == "click", F.lit('{"bustime-response":{"error":[{"code":1}]}}'))
            .otherwise(F.concat(F.lit('{"bustime-response":{"vehicle":['), F.col("data"), F.lit("]}}"))))
    return f.select("event_id", classify_bustime(F.try_parse_json(body)).alias("status"))


ORACLE["q_classify"] = """
SELECT event_id, CASE event_type WHEN 'signup' THEN 'UNSUPPORTED' WHEN 'purchase' THEN 'NEEDS_PARAM'
  WHEN 'view' THEN 'EMPTY' WHEN 'click' THEN 'ERROR' ELSE 'OK' END AS status FROM events"""


@register
def q_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-19, FLT-14: websocket messages — bus objects, other objects, lists and
    non-JSON noise — keeping JSON objects that carry ``busId``."""
    f = feed_envelopes(spark, sf_dir, TZ)
    msg = (F.when(F.col("stream") == "purchase",
                  F.concat(F.lit('{"busId":'), F.col("user_id").cast("string"), F.lit(","), F.substr("data", F.lit(2))))
           .when(F.col("stream") == "view", F.lit("[1,2]"))
           .when(F.col("stream") == "click", F.lit("ping"))
           .otherwise(F.col("data")))
    m = object_rows(f.select("event_id", F.try_parse_json(msg).alias("v")), "v")
    m = m.filter(F.try_variant_get("v", "$.busId", "variant").isNotNull())
    return m.select("event_id", F.try_variant_get("v", "$.busId", "string").alias("bus_id"))


ORACLE["q_locations"] = """
SELECT event_id, CAST(user_id AS VARCHAR) AS bus_id FROM events WHERE event_type = 'purchase'"""


@register
def q_detours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-12: detour documents whose ``rt`` is a string, a list of strings or a
    list of ``{rt}`` objects, folded to route -> sorted set of detour ids."""
    f = feed_envelopes(spark, sf_dir, TZ)
    k = F.try_variant_get(F.try_parse_json("data"), "$.k", "int")
    r1 = F.concat(F.lit("R"), (k % 7).cast("string"))
    r2 = F.concat(F.lit("R"), ((k + 1) % 7).cast("string"))
    rt = (F.when(F.col("stream") == "signup", F.concat(F.lit('"'), r1, F.lit('"')))
          .when(F.col("stream") == "purchase", F.to_json(F.array(r1, r2)))
          .when(F.col("stream") == "view", F.to_json(F.array(F.struct(r1.alias("rt")))))
          .otherwise(F.lit("null")))
    doc = F.concat(F.lit('{"id":"D'), (F.col("event_id") % 50).cast("string"), F.lit('","rt":'), rt, F.lit("}"))
    d = f.select("agency", F.try_parse_json(doc).alias("v"))
    d = d.select("agency", id_ops.detour_id(F.col("v")).alias("detour_id"),
                 F.explode(id_ops.detour_routes(F.try_variant_get("v", "$.rt", "variant"))).alias("route"))
    s = id_ops.id_set(d, ["agency", "route"], "detour_id", "detours")
    return s.select("agency", "route", F.array_join("detours", ",").alias("detours"))


ORACLE["q_detours"] = with_feed("""
SELECT agency, route, array_to_string(list_sort(list(DISTINCT detour_id)), ',') AS detours FROM (
  SELECT agency, 'D' || CAST(event_id % 50 AS VARCHAR) AS detour_id,
         unnest(CASE stream WHEN 'signup' THEN ['R' || CAST(k % 7 AS VARCHAR)]
                            WHEN 'purchase' THEN ['R' || CAST(k % 7 AS VARCHAR), 'R' || CAST((k + 1) % 7 AS VARCHAR)]
                            WHEN 'view' THEN ['R' || CAST(k % 7 AS VARCHAR)] ELSE [] END) AS route
  FROM (SELECT *, CAST(json_extract_string(data, '$.k') AS INTEGER) AS k FROM feed))
GROUP BY agency, route""")


def _route_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One InfoPoint poll per customer (route): its orders as vehicles, the first
    vehicle repeated at the end (a duplicate inside the poll)."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    o = read_table(spark, sf_dir, "orders")
    veh = F.struct(
        F.col("o_orderkey").alias("VehicleId"), F.concat(F.lit("V"), F.col("o_orderkey")).alias("Name"),
        F.col("o_orderstatus").alias("OpStatus"), F.col("o_orderpriority").alias("Destination"),
        F.format_string("/Date(%d-0500)/", F.unix_millis(F.col("o_orderdate").cast("timestamp"))).alias("LastUpdated"))
    per = o.groupBy("o_custkey").agg(F.array_sort(F.collect_list(veh)).alias("vs"))
    per = per.withColumn("vs", F.concat("vs", F.slice("vs", 1, 1)))
    j = per.join(c, per.o_custkey == c.c_custkey, "inner")
    route = F.struct(F.col("c_custkey").alias("RouteId"), F.lit("").alias("RouteAbbreviation"),
                     F.concat(F.lit("R"), F.col("c_custkey")).alias("ShortName"),
                     F.col("c_name").alias("GoogleDescription"), F.col("vs").alias("Vehicles"))
    return j.select(F.col("c_custkey").cast("string").alias("poll_id"), F.to_json(F.array(route)).alias("body"),
                    F.col("o_custkey"))


@register
def q_infopoint_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-08, PRJ-04, WIN-02: routes -> Vehicles[] with route context, first row per
    vehicle id in a poll, 30-column projection."""
    p = _route_polls(spark, sf_dir)
    routes = p.select("poll_id", F.explode(F.try_variant_get(F.try_parse_json("body"), "$", "array<variant>"))
                      .alias("r"))
    # A vehicle that comes twice in one answer is dropped inside the array: no shuffle.
    vehicles = first_per_id(F.try_variant_get("r", "$.Vehicles", "array<variant>"), "$.VehicleId")
    veh = routes.select("poll_id", "r", F.explode(vehicles).alias("v"))
    return veh.select("poll_id", *infopoint_vehicle("r", "v"))


_VEH_NULLS = ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in (
    "vehicle_farebox_id", "run_id", "trip_id", "block_farebox_id", "latitude", "longitude", "heading", "speed",
    "direction", "direction_long", "last_stop", "stop_id", "on_board", "occupancy_status", "occupancy_label",
    "deviation", "display_status", "comm_status", "gps_status", "seating_capacity", "total_capacity",
    "property_name"))

ORACLE["q_infopoint_vehicles"] = f"""
SELECT CAST(c_custkey AS VARCHAR) AS poll_id, CAST(c_custkey AS VARCHAR) AS route_id, 'R' || CAST(c_custkey AS VARCHAR) AS route_abbr,
       c_name AS route_name, CAST(o_orderkey AS VARCHAR) AS vehicle_id, 'V' || CAST(o_orderkey AS VARCHAR) AS vehicle_name,
       o_orderstatus AS op_status, o_orderpriority AS destination,
       {iso_seconds_sql('epoch_ms(epoch_ms(o_orderdate))')} AS last_updated, {_VEH_NULLS}
FROM orders JOIN customer ON o_custkey = c_custkey"""


@register
def q_infopoint_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-09, PRJ-05: one alert per order in a per-customer poll; ``Routes`` missing
    on finished orders (defaults to [])."""
    o = read_table(spark, sf_dir, "orders")
    routes = F.when(F.col("o_orderstatus") != "F", F.array(F.col("o_custkey")))
    alert = F.struct(F.col("o_orderkey").alias("MessageId"), F.col("o_orderpriority").alias("Header"),
                     F.concat(F.lit("status "), F.col("o_orderstatus")).alias("Message"), routes.alias("Routes"),
                     F.format_string("/Date(%d)/", F.unix_millis(F.col("o_orderdate").cast("timestamp")))
                     .alias("FromDate"))
    per = o.groupBy("o_custkey").agg(F.to_json(F.collect_list(alert)).alias("body"))
    a = per.select("o_custkey", F.explode(F.try_variant_get(F.try_parse_json("body"), "$", "array<variant>"))
                   .alias("a"))
    return a.select(*infopoint_alert("a"))


ORACLE["q_infopoint_alerts"] = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS message_id, o_orderpriority AS header, 'status ' || o_orderstatus AS message,
       CAST(NULL AS VARCHAR) AS priority, CAST(NULL AS VARCHAR) AS cause, CAST(NULL AS VARCHAR) AS effect,
       CAST(NULL AS VARCHAR) AS days_of_week, CAST(NULL AS VARCHAR) AS url, CAST(NULL AS VARCHAR) AS published,
       CAST(NULL AS VARCHAR) AS is_primary_record,
       CASE WHEN o_orderstatus <> 'F' THEN '[' || CAST(o_custkey AS VARCHAR) || ']' ELSE '[]' END AS routes,
       {iso_seconds_sql('epoch_ms(epoch_ms(o_orderdate))')} AS from_date, CAST(NULL AS VARCHAR) AS to_date
FROM orders"""
