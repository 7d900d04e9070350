"""Registered queries: per-platform reshapes of captured answers (PassioGO,
RouteMatch, SWIV, TransLoc, Logan Express), metadata envelopes, audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions.identity import json_string
from feedlake.functions.scalars import from_local
from feedlake.operators.ids import nonempty_id
from feedlake.operators.lookups import agency_of, gtfs_stem
from feedlake.operators.monitor import countable_rows, pull_audit, status_rank
from feedlake.operators.projections import attach_key, canonical_route, occupancy_payload, to_envelope
from feedlake.plans.feeds import feed_envelopes
from feedlake.plans.oracle import local, with_feed
from feedlake.schema import DEFAULT_TZ
from feedlake.sources import passio
from feedlake.sources import unwrap as uw
from feedlake.sources.tables import read_table

TZ = DEFAULT_TZ
QUERIES: dict = {}
ORACLE: dict = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _orders(spark, sf_dir):
    return read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
                                                      "o_totalprice")


def _per_customer(df: DataFrame, member) -> DataFrame:
    """One captured answer per customer (a poll): its orders' members collected
    (bounded: a customer's orders)."""
    return df.groupBy("o_custkey").agg(F.array_sort(F.collect_list(member)).alias("members"))


@register
def q_passio_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-11, PRJ-07, PRJ-09: route dictionaries keyed by ``k<order>``, at the top
    or wrapped in an agency id, members with id, with myid only, with another *Id
    key, scalars, and bare objects; canonical route id and ``myid`` dropped."""
    o = _orders(spark, sf_dir)
    kind = F.col("o_orderkey") % 5
    prio = F.col("o_orderpriority")
    okey = F.col("o_orderkey").cast("string")
    member = (F.when(kind == 0, F.to_json(F.struct(F.concat(F.lit("R"), okey).alias("id"), prio.alias("name"),
                                                   F.concat(F.lit("M"), okey).alias("myid"))))
              .when(kind == 1, F.to_json(F.struct(F.concat(F.lit("M"), okey).alias("myid"), prio.alias("name"))))
              .when(kind == 2, F.to_json(F.struct(prio.alias("name"), F.lit("X").alias("routeId"))))
              .when(kind == 3, F.lit('"closed"'))
              .otherwise(F.to_json(F.struct(prio.alias("name")))))
    pair = F.concat(F.lit('"k'), okey, F.lit('":'), member)
    polls = _per_customer(o.withColumn("pair", pair), F.col("pair"))
    routes = F.concat(F.lit('{"routes":{'), F.array_join("members", ","), F.lit("}}"))
    body = F.when(F.col("o_custkey") % 2 == 0, routes).otherwise(
        # The first member of the document is not the first by key.
        F.concat(F.lit('{"z'), (F.col("o_custkey") % 3).cast("string"), F.lit('":'), routes,
                 F.lit(',"a":{"routes":{"wrong":{"id":"wrong"}}}}')))
    p = polls.select(F.col("o_custkey").alias("poll_id"), F.try_parse_json(body).alias("v"), body.alias("body"))
    items = p.select("poll_id", F.explode(passio.passio_items(F.col("v"), "routes", F.col("body"))).alias("item"))
    rid = canonical_route(F.col("item"))
    return items.select("poll_id", F.when(nonempty_id(rid), rid).alias("route_id"),
                        F.to_json(passio.drop_keys(F.col("item"), "myid")).alias("item"))


ORACLE["q_passio_items"] = """
SELECT o_custkey AS poll_id,
  CASE o_orderkey % 5 WHEN 0 THEN 'R' || CAST(o_orderkey AS VARCHAR) WHEN 1 THEN 'M' || CAST(o_orderkey AS VARCHAR) END AS route_id,
  CASE o_orderkey % 5
    WHEN 0 THEN '{"id":"R' || CAST(o_orderkey AS VARCHAR) || '","name":"' || o_orderpriority || '"}'
    WHEN 1 THEN '{"_PASSIOGO_dict_key":"k' || CAST(o_orderkey AS VARCHAR) || '","name":"' || o_orderpriority || '"}'
    WHEN 2 THEN '{"name":"' || o_orderpriority || '","routeId":"X"}'
    WHEN 3 THEN '{"_key":"k' || CAST(o_orderkey AS VARCHAR) || '","value":"closed"}'
    ELSE '{"_PASSIOGO_dict_key":"k' || CAST(o_orderkey AS VARCHAR) || '","name":"' || o_orderpriority || '"}' END AS item
FROM orders"""

# Fixed values of the stand-in catalog: PassioGO user ids of the target agencies.
TARGET_USERS = (("1", "AGY1"), ("2", "AGY2"), ("3", "AGY3"), ("4", "AGY4"))


@register
def q_bus_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-12, JON-01, PRJ-06: ``{"buses": {bucket: [bus]}}`` per poll with a non-list
    bucket and a non-object element; buses of target agencies (userId lookup,
    inner) with the occupancy label of the enhanced copy."""
    o = _orders(spark, sf_dir)
    bus = F.to_json(F.struct(F.col("o_orderkey").alias("busId"), (F.col("o_custkey") % 7).alias("userId"),
                             F.col("o_orderpriority").alias("routeId"),
                             (F.col("o_totalprice") / 500000).alias("paxLoad")))
    polls = _per_customer(o.withColumn("bus", bus), F.col("bus"))
    body = F.concat(F.lit('{"buses":{"b1":['), F.array_join("members", ","), F.lit(',5],"note":"x"}}'))
    p = polls.select(F.col("o_custkey").alias("poll_id"), F.try_parse_json(body).alias("v"))
    buses = p.select("poll_id", F.explode(passio.bus_map(F.col("v"))).alias("bus"))
    buses = buses.withColumn("user_id", F.trim(F.try_variant_get("bus", "$.userId", "string")))
    cat = spark.createDataFrame(list(TARGET_USERS), "user_id string, agency string")
    j = agency_of(buses, cat, "user_id")
    return j.select("poll_id", "agency", F.try_variant_get("bus", "$.busId", "bigint").alias("bus_id"),
                    F.try_variant_get("bus", "$.routeId", "string").alias("route_id"),
                    occupancy_payload(F.col("bus")).alias("occupancy"))


ORACLE["q_bus_map"] = """
SELECT o_custkey AS poll_id, 'AGY' || CAST(o_custkey % 7 AS VARCHAR) AS agency, o_orderkey AS bus_id,
       o_orderpriority AS route_id,
       CASE WHEN p = 0 THEN 'EMPTY' WHEN p < 0.3 THEN 'MANY_SEATS_AVAILABLE' WHEN p < 0.7 THEN 'FEW_SEATS_AVAILABLE'
            WHEN p < 0.9 THEN 'STANDING_ROOM_ONLY' ELSE 'FULL' END AS occupancy
FROM (SELECT *, o_totalprice / 500000 AS p FROM orders) WHERE o_custkey % 7 BETWEEN 1 AND 4"""


@register
def q_eta_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-13, PRJ-08: ``{"ETAs": {stop: [eta]}}`` per poll (stop = order status, one
    non-list stop entry): one row per ETA, ``error`` removed, parent stop added."""
    o = _orders(spark, sf_dir)
    eta = F.to_json(F.struct(F.col("o_orderkey").alias("tripId"), (F.col("o_orderkey") % 60).alias("eta"),
                             F.lit("none").alias("error")))
    per = o.groupBy("o_custkey", "o_orderstatus").agg(F.array_join(F.array_sort(F.collect_list(eta)), ",").alias("l"))
    per = per.withColumn("entry", F.concat(F.lit('"'), F.col("o_orderstatus"), F.lit('":['), F.col("l"), F.lit("]")))
    polls = per.groupBy("o_custkey").agg(F.array_join(F.array_sort(F.collect_list("entry")), ",").alias("entries"))
    body = F.concat(F.lit('{"ETAs":{'), F.col("entries"), F.lit(',"ZZ":"none"}}'))
    p = polls.select(F.col("o_custkey").alias("poll_id"), F.try_parse_json(body).alias("v"))
    e = p.select("poll_id", F.explode(passio.eta_map(F.col("v"))).alias("eta"))
    return e.select("poll_id", F.try_variant_get("eta", "$._parent_stop_id", "string").alias("stop_id"),
                    F.to_json("eta").alias("eta"))


ORACLE["q_eta_map"] = """
SELECT o_custkey AS poll_id, o_orderstatus AS stop_id,
       '{"_parent_stop_id":"' || o_orderstatus || '","eta":' || CAST(o_orderkey % 60 AS VARCHAR) || ',"tripId":'
       || CAST(o_orderkey AS VARCHAR) || '}' AS eta
FROM orders"""


@register
def q_platform_unwrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-14..18, PRJ-10: RouteMatch (scalar, ``data`` list, one-key document), SWIV (named key),
    TransLoc (``d`` list with a non-object, ``_routeId`` attached), Logan Express
    (collection key) and PassioGO alert (``msgs`` list) answers, one per order,
    unwrapped by platform config."""
    o = _orders(spark, sf_dir)
    kind = (F.col("o_orderkey") % 6).cast("int")
    item = F.to_json(F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("s")))
    body = (F.when(kind == 0, json_string(F.col("o_orderpriority")))
            .when(kind == 1, F.concat(F.lit('{"data":['), item, F.lit("]}")))
            .when(kind == 2, F.concat(F.lit('{"Stops":['), item, F.lit("]}")))
            .when(kind == 3, F.concat(F.lit('{"vehicule":['), item, F.lit("],\"version\":1}")))
            .when(kind == 4, F.concat(F.lit('{"d":['), item, F.lit(",5]}")))
            .when(F.col("o_orderkey") % 12 == 5, F.concat(F.lit('{"msgs":['), item, F.lit("]}")))
            # An empty list under the first collection key decides: nothing comes of such an answer.
            .when(F.col("o_orderkey") % 24 == 11, F.concat(F.lit('{"routes":[],"stops":['), item, F.lit("]}")))
            .otherwise(F.concat(F.lit('{"routes":['), item, F.lit("]}"))))
    v = F.try_parse_json(body)
    items = (F.when(kind <= 2, uw.unwrap_items(v, uw.ROUTEMATCH))
             .when(kind == 3, uw.unwrap_items(v, uw.swiv("vehicule")))
             .when(kind == 4, uw.unwrap_items(v, uw.transloc("arrivals")))
             .when(F.col("o_orderkey") % 12 == 5, uw.unwrap_items(v, uw.PASSIO_ALERTS))
             .otherwise(uw.unwrap_items(v, uw.massport(("routes", "stops")))))
    x = o.select("o_orderkey", kind.alias("kind"), F.posexplode(items).alias("item_no", "item"))
    route = F.concat(F.lit("R"), (F.col("o_orderkey") % 10).cast("string"))
    out = F.when(F.col("kind") == 4, attach_key(F.col("item"), "_routeId", route)).otherwise(F.to_json("item"))
    return x.select("o_orderkey", "item_no", out.alias("item"))


ORACLE["q_platform_unwrap"] = """
SELECT o_orderkey, 0 AS item_no,
  CASE o_orderkey % 6
    WHEN 0 THEN '{"data":"' || o_orderpriority || '"}'
    WHEN 4 THEN '{"_routeId":"R' || CAST(o_orderkey % 10 AS VARCHAR) || '","id":' || CAST(o_orderkey AS VARCHAR)
                || ',"s":"' || o_orderstatus || '"}'
    ELSE '{"id":' || CAST(o_orderkey AS VARCHAR) || ',"s":"' || o_orderstatus || '"}' END AS item
FROM orders WHERE o_orderkey % 24 <> 11
UNION ALL
SELECT o_orderkey, 1, '{"_routeId":"R' || CAST(o_orderkey % 10 AS VARCHAR) || '","raw":5}' FROM orders WHERE o_orderkey % 6 = 4"""


@register
def q_route_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-01, PRJ-13, IDN-03: envelopes built with ``to_envelope`` carrying
    ``{route_id, direction}`` metadata beside the payload; the hash covers it."""
    ev = read_table(spark, sf_dir, "events")
    meta = F.to_json(F.struct(F.when(F.col("value") > 50, F.lit("IN")).otherwise(F.lit("OUT")).alias("direction"),
                              F.col("event_type").alias("route_id")))
    e = ev.select("event_id", "ts", "user_id", "event_type", "props", meta.alias("meta"))
    env = to_envelope(e.withColumn("_ag", F.format_string("A%d", F.col("user_id") % 5)), agency=F.col("_ag"),
                      stream=F.col("event_type"), event=F.lit("update"), data=F.col("props"),
                      endpoint=F.col("event_type"), id_=F.col("user_id"), ts=F.col("ts"), metadata=F.col("meta"),
                      tz=TZ)
    return env.select("hash_id", "agency", "stream", "day", "metadata").distinct()


ORACLE["q_route_metadata"] = f"""
SELECT DISTINCT sha256('{{"agency":"' || agency || '","data":' || CAST(json(props) AS VARCHAR) || ',"endpoint":"'
         || event_type || '","event":"update","metadata":' || meta || ',"stream":"' || event_type || '"}}') AS hash_id,
       agency, event_type AS stream, CAST({local('ts')} AS DATE) AS day, meta AS metadata
FROM (SELECT *, 'A' || CAST(user_id % 5 AS VARCHAR) AS agency,
             '{{"direction":"' || CASE WHEN value > 50 THEN 'IN' ELSE 'OUT' END || '","route_id":"' || event_type || '"}}' AS meta
      FROM events)"""

# Local hours of the twice-daily schedule pulls.
PULL_HOURS = (3, 15)


@register
def q_gtfs_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-06: schedule pulls per local day (order dates at 03:00 or 15:00 local by
    order parity, some at other hours) against the expected 03/15 slots."""
    o = read_table(spark, sf_dir, "orders")
    hour = F.when(F.col("o_orderkey") % 7 == 0, F.lit(9)).when(F.col("o_orderkey") % 2 == 0, F.lit(3)) \
        .otherwise(F.lit(15))
    local_ts = F.col("o_orderdate").cast("timestamp_ntz") + F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0),
                                                                          hour)
    logged = from_local(local_ts, TZ)
    return pull_audit(o.select(logged.alias("logged_at")), "logged_at", PULL_HOURS, TZ)


ORACLE["q_gtfs_audit"] = """
SELECT day, CAST(count(DISTINCT h) AS BIGINT) AS n_slots,
       array_to_string([x FOR x IN [3, 15] IF NOT list_contains(list(DISTINCT h), x)], ',') AS missing,
       array_to_string(list_sort([x FOR x IN list(DISTINCT h) IF x NOT IN (3, 15)]), ',') AS unexpected
FROM (SELECT CAST(o_orderdate AS DATE) AS day,
             CASE WHEN o_orderkey % 7 = 0 THEN 9 WHEN o_orderkey % 2 = 0 THEN 3 ELSE 15 END AS h FROM orders)
GROUP BY day"""


@register
def q_status_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRT-01, AGG-02, FLT-07: countable status rows per (agency, stream), ordered by
    agency, GTFS stem (default 'z' when the catalog has none) and stream."""
    f = countable_rows(feed_envelopes(spark, sf_dir, TZ))
    st = f.groupBy("agency", "stream").agg(F.count(F.lit(1)).cast("bigint").alias("rows"))
    cat = spark.createDataFrame([("view", "vehicle_positions"), ("purchase", "trip_updates")],
                                "stream string, stem string")
    st = gtfs_stem(st, cat).withColumn("stem", F.when(F.col("stem") == F.lower("stream"), F.lit("z"))
                                       .otherwise(F.col("stem")))
    return status_rank(st, ["agency", "stem", "stream"]).select("agency", "stream", "stem", "rows", "position")


ORACLE["q_status_order"] = with_feed("""
SELECT agency, stream, stem, rows, CAST(row_number() OVER (ORDER BY agency, stem, stream) AS INTEGER) AS position FROM (
  SELECT agency, stream, CASE stream WHEN 'view' THEN 'vehicle_positions' WHEN 'purchase' THEN 'trip_updates' ELSE 'z' END AS stem,
         count(*) AS rows FROM feed GROUP BY agency, stream)""")


@register
def q_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-05/06, SRC-10, PRJ-01, IDN-03/07 as one job (``jobs.capture_envelopes``):
    one captured BusTime answer per capture (a rejection page, an empty answer,
    non-JSON text, or a vehicle list of two items), classified, unwrapped, hashed
    and deduplicated per local day."""
    from feedlake.jobs import capture_envelopes
    ev = read_table(spark, sf_dir, "events", parallel=True)
    vehicles = F.concat(F.lit('{"bustime-response":{"vehicle":['), F.col("props"), F.lit(',{"vid":'),
                        F.col("user_id").cast("string"), F.lit("}]}}"))
    body = (F.when(F.col("event_type") == "signup", F.lit("<html><title>Request Rejected</title></html>"))
            .when(F.col("event_type") == "purchase",
                  F.lit('{"bustime-response":{"error":[{"msg":"No vehicles found"}]}}'))
            .when(F.col("event_type") == "click", F.lit("not json"))
            .otherwise(vehicles))
    caps = ev.select(F.format_string("A%d", F.col("user_id") % 5).alias("agency"),
                     F.col("event_type").alias("stream"), F.lit("getvehicles").alias("endpoint"),
                     F.col("ts").alias("poll_ts"), body.alias("body"))
    env = capture_envelopes(caps, uw.bustime(("vehicle",)), tz=TZ)
    return env.select("agency", "stream", "day", "hash_id", "data")


ORACLE["q_captures"] = f"""
SELECT DISTINCT agency, stream, day,
       sha256('{{"agency":"' || agency || '","data":' || data || ',"endpoint":"getvehicles","event":"update","metadata":null,"stream":"'
              || stream || '"}}') AS hash_id, data
FROM (
  SELECT 'A' || CAST(user_id % 5 AS VARCHAR) AS agency, event_type AS stream,
         CAST({local('ts')} AS DATE) AS day, CAST(json(props) AS VARCHAR) AS data FROM events
  WHERE event_type IN ('view', 'error')
  UNION ALL
  SELECT 'A' || CAST(user_id % 5 AS VARCHAR), event_type, CAST({local('ts')} AS DATE),
         '{{"vid":' || CAST(user_id AS VARCHAR) || '}}' FROM events WHERE event_type IN ('view', 'error'))"""
