"""Registered queries: archive content, detour changes, active sets, breaches, years and file audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions.identity import event_hash_struct
from feedlake.functions.scalars import from_local
from feedlake.operators import coverage as cov
from feedlake.operators import ids as id_ops
from feedlake.operators import monitor
from feedlake.operators.history import nonempty_tables
from feedlake.operators.lookups import changed_sets
from feedlake.plans.feeds import feed_envelopes
from feedlake.plans.oracle import local, with_feed
from feedlake.schema import DEFAULT_TZ
from feedlake.session import shared_dir
from feedlake.sinks.archive import compact_days, wal_append
from feedlake.sources.tables import read_table
from feedlake.sources.wal import read_archive, read_wal

TZ = DEFAULT_TZ
QUERIES: dict = {}
ORACLE: dict = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


@register
def q_archive_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-01/02/04, SRC-01/20, IDN-03: payloads of every kind (objects, text, repeated keys,
    nothing, lists, numbers), metadata, a null stream, agencies that look like numbers and
    lines that do not parse, landed, compacted in two sweeps and read back."""
    base = shared_dir(spark, "q_archive_content")
    f = feed_envelopes(spark, sf_dir, TZ)
    kind, k = F.col("event_id") % 6, (F.col("event_id") % 7).cast("string")
    data = (F.when(kind == 0, F.col("data")).when(kind == 1, F.concat(F.lit("text, no: JSON "), k))
            .when(kind == 2, F.concat(F.lit('{"a":1,"a":'), k, F.lit("}"))).when(kind == 3, F.lit(None).cast("string"))
            .when(kind == 4, F.concat(F.lit('[1,{"k":'), k, F.lit("}]"))).otherwise(k))
    env = f.select("ts", "event_id", F.concat(F.lit("00"), F.col("user_id") % 5).alias("agency"),
                   F.when(F.col("stream") != "error", F.col("stream")).alias("stream"), "endpoint", "event", "id",
                   data.alias("data"), "day",
                   F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('{"route":"'), k, F.lit('"}'))).alias("metadata"))
    env = env.withColumn("hash_id", event_hash_struct("agency", "stream", "event", "endpoint", "data", "metadata"))
    broken = env.filter(F.col("event_id") % 50 == 0).select(
        "agency", "stream", "day", F.concat(F.lit('{"broken '), F.col("event_id").cast("string")).alias("value"))
    as_of = from_local(F.lit("2024-01-20 12:00:00").cast("timestamp_ntz"), TZ)
    landing, archive = f"{base}/landing", f"{base}/archive"
    for part in (0, 1):
        wal_append(env.filter(F.col("event_id") % 2 == part), landing, TZ)
        if part == 0:
            broken.write.mode("append").partitionBy("agency", "stream", "day").text(landing)
        compact_days(spark, read_wal(spark, landing, TZ), archive, as_of, TZ, landing_root=landing,
                     log_root=f"{base}/log", remove_source=True)
    return read_archive(spark, archive).select("hash_id", "agency", "stream", "day", "endpoint", "data", "metadata")


ORACLE["q_archive_content"] = with_feed("""
SELECT DISTINCT sha256('{"agency":"' || ag || '","data":' || coalesce(CASE
           WHEN k6 IN (0, 4, 5) THEN CAST(json(d) AS VARCHAR) ELSE CAST(to_json(d) AS VARCHAR) END, 'null')
         || ',"endpoint":"' || endpoint || '","event":"update","metadata":' || coalesce(m, 'null') || ',"stream":'
         || coalesce('"' || st || '"', 'null') || '}') AS hash_id,
       ag AS agency, st AS stream, day, endpoint, CASE WHEN k6 IN (0, 4) THEN CAST(json(d) AS VARCHAR) ELSE d END AS data,
       m AS metadata
FROM (SELECT *, event_id % 6 AS k6, '00' || CAST(user_id % 5 AS VARCHAR) AS ag, nullif(stream, 'error') AS st,
        CASE WHEN event_id % 2 = 0 THEN '{"route":"' || CAST(event_id % 7 AS VARCHAR) || '"}' END AS m,
        CASE event_id % 6 WHEN 0 THEN data WHEN 1 THEN 'text, no: JSON ' || CAST(event_id % 7 AS VARCHAR)
             WHEN 2 THEN '{"a":1,"a":' || CAST(event_id % 7 AS VARCHAR) || '}' WHEN 3 THEN NULL
             WHEN 4 THEN '[1,{"k":' || CAST(event_id % 7 AS VARCHAR) || '}]' ELSE CAST(event_id % 7 AS VARCHAR) END AS d
      FROM feed WHERE day < DATE '2024-01-20')
UNION ALL
SELECT DISTINCT sha256(ag || '|error|' || strftime(day, '%Y-%m-%d') || ' 00:00:00|' || msg), ag, 'Errors', day, '',
       CAST(json_object('message', msg) AS VARCHAR), NULL
FROM (SELECT '00' || CAST(user_id % 5 AS VARCHAR) AS ag, day,
        'unparsable line in ' || coalesce(nullif(stream, 'error'), '?') || ': {"broken ' || CAST(event_id AS VARCHAR) AS msg
      FROM feed WHERE event_id % 50 = 0 AND day < DATE '2024-01-20')""")


def _detour_sets(spark: SparkSession, sf_dir: str, first: bool) -> DataFrame:
    f = feed_envelopes(spark, sf_dir, TZ)
    f = f.filter((F.col("day") < F.lit("2024-01-15").cast("date")) == F.lit(first))
    k = F.try_variant_get(F.try_parse_json("data"), "$.k", "int") % 4
    return id_ops.id_set(f.withColumn("k", k.cast("string")), ["id"], "k", "detours")


@register
def q_changed_detours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON-05: routes (entities) whose detour set after 2024-01-15 is new or differs from the stored one."""
    ch = changed_sets(_detour_sets(spark, sf_dir, False), _detour_sets(spark, sf_dir, True), "id", "detours")
    return ch.select("id", F.array_join("detours", ",").alias("detours"))


ORACLE["q_changed_detours"] = with_feed("""
SELECT n.id, n.detours FROM s n LEFT JOIN s o ON n.id = o.id AND o.first
WHERE NOT n.first AND n.detours IS DISTINCT FROM o.detours""",
    """s AS (SELECT id, day < DATE '2024-01-15' AS first,
            array_to_string(list_sort(list(DISTINCT CAST(CAST(json_extract_string(data, '$.k') AS INTEGER) % 4 AS VARCHAR))), ',') AS detours
          FROM feed GROUP BY ALL)""")


@register
def q_active_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-11: active routes per agency from two polls after stored sets: one with routes
    (an agency without any takes the empty set) and one whose sets are all empty, which
    leaves the sets as they are."""
    f = feed_envelopes(spark, sf_dir, TZ)
    stored = id_ops.id_set(f.filter(F.col("day") < F.lit("2024-01-10").cast("date")), ["agency"], "stream", "ids")
    route = F.when((F.col("agency") == "A2") | (F.col("stream") == "error"), F.lit(" \n")).otherwise(F.col("id"))
    buses = f.filter(F.col("day") >= F.lit("2024-01-25").cast("date")).select("agency", route.alias("route"))
    one = id_ops.active_sets(stored, buses, "agency", "route")
    two = id_ops.active_sets(one, buses.withColumn("route", F.lit("")), "agency", "route")
    return two.select("agency", F.array_join("ids", ",").alias("ids"))


ORACLE["q_active_sets"] = with_feed("""
SELECT coalesce(p.agency, s.agency) AS agency, coalesce(p.ids, s.ids) AS ids FROM
  (SELECT agency, array_to_string(list_sort(list(DISTINCT stream)), ',') AS ids FROM feed WHERE day < DATE '2024-01-10' GROUP BY agency) s
FULL JOIN
  (SELECT agency, coalesce(array_to_string(list_sort(list(DISTINCT id) FILTER (WHERE agency <> 'A2' AND stream <> 'error')), ','), '') AS ids
   FROM feed WHERE day >= DATE '2024-01-25' GROUP BY agency) p ON p.agency = s.agency""")

BREACH_LIMIT = 20


@register
def q_first_breach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-08: the call that first exceeds a quota of 20 calls per agency and local day."""
    f = feed_envelopes(spark, sf_dir, TZ).select("agency", "day", "ts", "event_id")
    b = monitor.first_breach(f, ["agency", "day"], ["ts", "event_id"], BREACH_LIMIT, bucket=F.date_trunc("hour", "ts"))
    return b.select("agency", "day", "event_id")


ORACLE["q_first_breach"] = with_feed("""
SELECT agency, day, event_id FROM (
  SELECT agency, day, event_id, row_number() OVER (PARTITION BY agency, day ORDER BY ts, event_id) AS n FROM feed) WHERE n = 21""")


@register
def q_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-17, SRT-04, SCL-15: years with data per stream group; the latest year is the default.
    Days of orders stand in for coverage days, order priorities for streams."""
    o = read_table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("agency"), F.col("o_orderpriority").alias("stream"),
                                                   F.to_date("o_orderdate").alias("day"))
    y = cov.streams_by_group(cov.coverage(o))
    return y.select("year", "stream", "group", "is_default")


ORACLE["q_years"] = """
SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority AS stream, 'custom' AS "group",
       year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders) AS is_default FROM orders"""


@register
def q_covered_agencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-11: real-time agencies (two of three, by number) with at least one covered day."""
    span = cov.agency_span(cov.agency_totals(cov.coverage(feed_envelopes(spark, sf_dir, TZ))))
    agencies = read_table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("A"), (F.col("s_suppkey") % 9).cast("string")).alias("agency"),
        (F.col("s_suppkey") % 9 % 3 != 1).alias("is_rt")).distinct()
    return cov.has_coverage(agencies, span).select("agency")


ORACLE["q_covered_agencies"] = with_feed("""
SELECT DISTINCT 'A' || CAST(s_suppkey % 9 AS VARCHAR) AS agency FROM supplier
WHERE s_suppkey % 9 % 3 <> 1 AND 'A' || CAST(s_suppkey % 9 AS VARCHAR) IN (SELECT agency FROM feed)""")


@register
def q_nonempty_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-13, AGG-19: rows of each table from its files; a table whose stored and new rows are
    both none is left out."""
    out = None
    for name, cut in (("orders", "o_orderkey < 0"), ("customer", "true"), ("part", "p_partkey >= 0"), ("supplier", "s_suppkey < 0")):
        rows = monitor.rows_per_file(read_table(spark, sf_dir, name).filter(cut))
        t = rows.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        out = t if out is None else out.unionByName(t)
    return nonempty_tables(out)


ORACLE["q_nonempty_tables"] = """
SELECT 'customer' AS table_name, CAST(count(*) AS BIGINT) AS rows FROM customer
UNION ALL SELECT 'part', CAST(count(*) AS BIGINT) FROM part"""


@register
def q_capture_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-04, FLT-05/06 (``jobs.capture_errors``): captures that failed — a rejection page behind
    line breaks, an unsupported call — as error envelopes; text, empty answers and data are none."""
    from feedlake.jobs import capture_errors
    ev = read_table(spark, sf_dir, "events")
    body = (F.when(F.col("event_type") == "signup", F.lit("\n\t<!DOCTYPE html><p>no</p>\n"))
            .when(F.col("event_type") == "purchase", F.lit('{"bustime-response":{"error":[{"msg":"Unsupported function"}]}}'))
            .when(F.col("event_type") == "click", F.lit("plain text")).when(F.col("event_type") == "error", F.lit(" \n"))
            .otherwise(F.col("props")))
    caps = ev.select("event_id", F.format_string("A%d", F.col("user_id") % 5).alias("agency"), F.col("event_type").alias("stream"),
                     F.concat(F.lit("get"), (F.col("event_id") % 3).cast("string")).alias("endpoint"), F.col("ts").alias("poll_ts"),
                     body.alias("body"))
    return capture_errors(caps, TZ).select("agency", "day", "stream", "hash_id", "data")


ORACLE["q_capture_errors"] = with_feed(f"""
SELECT agency, day, 'Errors' AS stream, sha256(agency || '|error|' || strftime({local('ts')}, '%Y-%m-%d %H:%M:%S') || '|' || msg) AS hash_id,
       CAST(json_object('message', msg) AS VARCHAR) AS data
FROM (SELECT *, CASE stream WHEN 'signup' THEN 'REJECTED signup get' || CAST(event_id % 3 AS VARCHAR) || ' <!DOCTYPE html><p>no</p>'
        ELSE 'UNSUPPORTED purchase get' || CAST(event_id % 3 AS VARCHAR)
             || ' {{"bustime-response":{{"error":[{{"msg":"Unsupported function"}}]}}}}' END AS msg
      FROM feed WHERE stream IN ('signup', 'purchase'))""")
