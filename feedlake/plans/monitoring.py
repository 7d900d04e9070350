"""Registered queries: windows, service clock, quotas, audits and id sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions.scalars import from_local, hms_of_ts, seconds_since_midnight, service_state, to_local
from feedlake.operators import ids as id_ops
from feedlake.operators import monitor
from feedlake.operators import windows as win
from feedlake.operators.dedupe import dedupe_events
from feedlake.operators.lookups import allow_list, latest, work_list
from feedlake.plans.feeds import feed_envelopes
from feedlake.plans.oracle import local, with_feed
from feedlake.schema import DEFAULT_TZ

TZ = DEFAULT_TZ
QUERIES: dict = {}
ORACLE: dict = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _k(props_col="data"):
    return F.try_variant_get(F.try_parse_json(F.col(props_col)), "$.k", "string")


@register
def q_changed_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON-05, WIN-09, AGG-12: per route (entity) and poll (local day) the sorted set
    of payload keys; rows where the set differs from the route's previous poll."""
    f = feed_envelopes(spark, sf_dir, TZ).withColumn("k", _k())
    sets = id_ops.id_set(f, ["agency", "id", "day"], "k", "detours")
    ch = win.changed_vs_previous(sets, ["agency", "id"], ["day"], "detours")
    return ch.filter("changed").select("agency", "id", "day", F.array_join("detours", ",").alias("detours"))


ORACLE["q_changed_sets"] = with_feed("""
SELECT agency, id, day, detours FROM (
  SELECT *, lag(detours) OVER (PARTITION BY agency, id ORDER BY day) AS prev FROM (
    SELECT agency, id, day, array_to_string(list_sort(list(DISTINCT json_extract_string(data, '$.k'))), ',') AS detours
    FROM feed GROUP BY agency, id, day)
) WHERE prev IS DISTINCT FROM detours""")


@register
def q_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-04: each agency's sorted entity ids cut into request batches of 25."""
    ids = feed_envelopes(spark, sf_dir, TZ).select("agency", "user_id").distinct()
    b = win.batches(ids, ["agency"], "user_id", 25, bucket=F.floor(F.col("user_id") / 1000))
    return b.select("agency", "batch_no", "ids", F.col("n").cast("bigint").alias("n"))


ORACLE["q_batches"] = with_feed("""
SELECT agency, CAST((rn - 1) // 25 AS INTEGER) AS batch_no, string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY user_id) AS ids,
       count(*) AS n
FROM (SELECT agency, user_id, row_number() OVER (PARTITION BY agency ORDER BY user_id) AS rn
      FROM (SELECT DISTINCT agency, user_id FROM feed))
GROUP BY agency, (rn - 1) // 25""")


@register
def q_occupancy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-06: occupancy label from a bus object's ``paxLoad`` (value / 100); error
    rows carry text, signup rows no load."""
    from feedlake.operators.projections import occupancy_payload
    f = feed_envelopes(spark, sf_dir, TZ)
    pax = (F.when(F.col("stream") == "error", F.lit("n/a"))
           .when(F.col("stream") == "signup", F.lit(None).cast("string"))
           .otherwise((F.col("value") / 100).cast("string")))
    bus = F.try_parse_json(F.to_json(F.struct(F.col("user_id").alias("busId"), pax.alias("paxLoad")),
                                     {"ignoreNullFields": "true"}))
    return f.select("event_id", F.coalesce(occupancy_payload(bus), F.lit("NO_DATA_AVAILABLE")).alias("occupancy"))


ORACLE["q_occupancy"] = """
SELECT event_id, CASE WHEN event_type IN ('error', 'signup') THEN 'NO_DATA_AVAILABLE'
  WHEN value / 100 = 0 THEN 'EMPTY' WHEN value / 100 < 0.3 THEN 'MANY_SEATS_AVAILABLE'
  WHEN value / 100 < 0.7 THEN 'FEW_SEATS_AVAILABLE' WHEN value / 100 < 0.9 THEN 'STANDING_ROOM_ONLY' ELSE 'FULL' END AS occupancy
FROM events"""


def _stop_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in ``stop_times``: arrival = local clock of the event (H:MM:SS),
    departure = arrival + floor(value) minutes (may pass 24:00:00); error rows have
    departure 'abc', signup rows a blank arrival."""
    f = feed_envelopes(spark, sf_dir, TZ)
    arr_s = seconds_since_midnight("ts", TZ)
    dep_s = arr_s + F.floor(F.col("value")).cast("int") * 60

    def fmt(s):
        return F.format_string("%d:%02d:%02d", (s / 3600).cast("int"), ((s % 3600) / 60).cast("int"),
                               (s % 60).cast("int"))
    arrival = F.when(F.col("stream") == "signup", F.lit("")).otherwise(fmt(arr_s))
    departure = F.when(F.col("stream") == "error", F.lit("abc")).otherwise(fmt(dep_s))
    return f.select("event_id", "agency", "ts", arrival.alias("arrival_time"), departure.alias("departure_time"))


STOP_TIMES_SQL = f"""
st AS (
  SELECT event_id, agency, ts,
         CASE WHEN stream = 'signup' THEN ''
              ELSE printf('%d:%02d:%02d', a // 3600, (a % 3600) // 60, a % 60) END AS arrival_time,
         CASE WHEN stream = 'error' THEN 'abc'
              ELSE printf('%d:%02d:%02d', (a + CAST(floor(value) AS BIGINT) * 60) // 3600,
                          ((a + CAST(floor(value) AS BIGINT) * 60) % 3600) // 60, (a + CAST(floor(value) AS BIGINT) * 60) % 60) END AS departure_time
  FROM (SELECT *, CAST(hour({local('ts')}) * 3600 + minute({local('ts')}) * 60 + second({local('ts')}) AS BIGINT) AS a FROM feed)
),
secs AS (
  SELECT *, CASE WHEN regexp_full_match(trim(arrival_time), '\\d+:\\d+:\\d+')
                 THEN CAST(split_part(trim(arrival_time), ':', 1) AS BIGINT) * 3600 + CAST(split_part(trim(arrival_time), ':', 2) AS BIGINT) * 60
                      + CAST(split_part(trim(arrival_time), ':', 3) AS BIGINT) END AS arr_s,
            CASE WHEN regexp_full_match(trim(departure_time), '\\d+:\\d+:\\d+')
                 THEN CAST(split_part(trim(departure_time), ':', 1) AS BIGINT) * 3600 + CAST(split_part(trim(departure_time), ':', 2) AS BIGINT) * 60
                      + CAST(split_part(trim(departure_time), ':', 3) AS BIGINT) END AS dep_s
  FROM st
),
win AS (
  SELECT agency, min(least(arr_s, dep_s)) AS tmin_s, max(greatest(arr_s, dep_s)) AS tmax_s FROM secs GROUP BY agency
)"""


def _hms_sql(x: str) -> str:
    return f"printf('%02d:%02d:%02d', ({x} % 86400) // 3600, (({x} % 86400) % 3600) // 60, ({x} % 86400) % 60)"


@register
def q_service_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-09, SCL-07/09: earliest/latest service second per agency over arrival and departure."""
    w = monitor.service_window(_stop_times(spark, sf_dir), ["agency"])
    return w.select("agency", F.col("tmin_s").cast("bigint").alias("tmin_s"),
                    F.col("tmax_s").cast("bigint").alias("tmax_s"), "tmin_hms", "tmax_hms")


ORACLE["q_service_window"] = with_feed(f"""
SELECT agency, tmin_s, tmax_s, {_hms_sql('tmin_s')} AS tmin_hms, {_hms_sql('tmax_s')} AS tmax_hms FROM win""",
                                       STOP_TIMES_SQL)


@register
def q_state_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-07, SCL-08/12: service state at each capture from the agency window;
    only rows where the state changes are kept."""
    st = _stop_times(spark, sf_dir)
    w = monitor.service_window(st, ["agency"])
    f = feed_envelopes(spark, sf_dir, TZ).select("event_id", "agency", "ts", "day")
    j = f.join(w.select("agency", "tmin_s", "tmax_s"), "agency", "left")
    j = j.withColumn("state", service_state(seconds_since_midnight("ts", TZ), F.col("tmin_s"), F.col("tmax_s")))
    j = j.withColumn("hour", F.date_trunc("hour", "ts"))  # an agency's day is cut into hours
    ch = win.state_transitions(j, ["agency"], ["ts", "event_id"], "state", split_by=["hour"])
    return ch.select("agency", "event_id", "state")


ORACLE["q_state_changes"] = with_feed(f"""
SELECT agency, event_id, state FROM (
  SELECT *, lag(state) OVER (PARTITION BY agency ORDER BY ts, event_id) AS prev FROM (
    SELECT f.agency, f.event_id, f.ts,
      CASE WHEN w.tmin_s IS NULL OR w.tmax_s IS NULL THEN 'STARTUP'
           WHEN n >= w.tmin_s - 3600 AND n < w.tmin_s THEN 'PRE_FLIGHT'
           WHEN n >= w.tmin_s AND n <= w.tmax_s THEN 'ACTIVE'
           WHEN n > w.tmax_s AND n <= w.tmax_s + 3600 THEN 'END_OF_SERVICE' ELSE 'OFF_HOURS' END AS state
    FROM (SELECT *, hour({local('ts')}) * 3600 + minute({local('ts')}) * 60 + second({local('ts')}) AS n FROM feed) f
    LEFT JOIN win w ON f.agency = w.agency)
) WHERE prev IS DISTINCT FROM state""", STOP_TIMES_SQL)


@register
def q_api_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-07/08, WIN-08: calls per agency and local day, previous active day,
    headroom under the 10,000/day quota and breach flag."""
    f = feed_envelopes(spark, sf_dir, TZ)
    c = monitor.quota_status(monitor.calls_per_day(f))
    c = win.day_over_day(c, ["agency"], "day", "calls")
    return c.select("agency", "day", F.col("calls").cast("bigint").alias("calls"),
                    F.col("prev_calls").cast("bigint").alias("prev_calls"), "headroom", "breached")


ORACLE["q_api_calls"] = with_feed("""
SELECT agency, day, calls, lag(calls) OVER (PARTITION BY agency ORDER BY day) AS prev_calls,
       CAST(greatest(0, 10000 - calls) AS BIGINT) AS headroom, calls > 10000 AS breached
FROM (SELECT agency, day, count(*) AS calls FROM feed GROUP BY agency, day)""")


@register
def q_today_yesterday(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-03, FLT-09: rows on 2024-01-20 and the day before, per agency and stream."""
    f = feed_envelopes(spark, sf_dir, TZ)
    t = monitor.today_vs_yesterday(f, F.lit("2024-01-20"))
    return t.select("agency", "stream", F.col("today").cast("bigint").alias("today"),
                    F.col("yesterday").cast("bigint").alias("yesterday"))


ORACLE["q_today_yesterday"] = with_feed("""
SELECT agency, stream, count(*) FILTER (WHERE day = DATE '2024-01-20') AS today,
       count(*) FILTER (WHERE day = DATE '2024-01-19') AS yesterday
FROM feed WHERE day IN (DATE '2024-01-20', DATE '2024-01-19') GROUP BY agency, stream""")


@register
def q_last_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRT-02: the 5 newest error rows per agency (top-k in two phases)."""
    f = feed_envelopes(spark, sf_dir, TZ).filter(F.col("stream") == "error")
    t = win.top_k(f, ["agency"], [F.col("ts").desc(), F.col("event_id").desc()], 5, split_by=["day"])
    return t.select("agency", "event_id", F.col("rank").cast("int").alias("rank"))


ORACLE["q_last_errors"] = with_feed("""
SELECT agency, event_id, rank FROM (
  SELECT agency, event_id, CAST(row_number() OVER (PARTITION BY agency ORDER BY ts DESC, event_id DESC) AS INTEGER) AS rank
  FROM feed WHERE stream = 'error') WHERE rank <= 5""")


@register
def q_recent_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-08: error rows in a look-back window before a fixed ``as_of``
    (2024-01-20 12:00 local, 6 hours; the dashboard uses 180 s before now)."""
    f = feed_envelopes(spark, sf_dir, TZ).filter(F.col("stream") == "error")
    as_of = from_local(F.lit("2024-01-20 12:00:00").cast("timestamp_ntz"), TZ)
    return monitor.recent(f, as_of, seconds=6 * 3600).select("agency", "event_id")


ORACLE["q_recent_errors"] = with_feed("""
SELECT agency, event_id FROM feed WHERE stream = 'error'
  AND ts > TIMESTAMP '2024-01-20 17:00:00' - INTERVAL 6 HOUR AND ts <= TIMESTAMP '2024-01-20 17:00:00'""")


def _near_clock_change(f: DataFrame) -> DataFrame:
    """The feed with signup rows moved to the days around the clock changes of 2024 (10 March,
    3 November), so that days of 23 and 25 hours are in the input."""
    shift = F.when(F.col("event_id") % 2 == 0, F.lit("2024-03-08")).otherwise(F.lit("2024-11-01")).cast("timestamp_ntz")
    moved = shift + F.make_interval(mins=F.pmod(F.col("event_id"), F.lit(5760)).cast("int"))
    return f.withColumn("ts", F.when(F.col("stream") == "signup", moved).otherwise(F.col("ts").cast("timestamp_ntz")))


@register
def q_hour_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-05: tumbling local hours with rows per (agency, stream, day) and hours missing."""
    f = _near_clock_change(feed_envelopes(spark, sf_dir, TZ))
    a = monitor.hourly_audit(f, tz=TZ)
    return a.select("agency", "stream", "day", F.col("hours_with_rows").cast("bigint").alias("hours_with_rows"),
                    "hours_missing", F.col("rows").cast("bigint").alias("rows"))


ORACLE["q_hour_audit"] = with_feed(f"""
SELECT agency, stream, day, hours_with_rows,
       CASE day WHEN DATE '2024-03-10' THEN 23 WHEN DATE '2024-11-03' THEN 25 ELSE 24 END - hours_with_rows AS hours_missing, rows
FROM (SELECT agency, stream, CAST({local('t')} AS DATE) AS day, count(DISTINCT date_trunc('hour', t)) AS hours_with_rows,
             count(*) AS rows
      FROM (SELECT agency, stream, CASE WHEN stream = 'signup'
              THEN (CASE WHEN event_id % 2 = 0 THEN TIMESTAMP '2024-03-08' ELSE TIMESTAMP '2024-11-01' END)
                   + to_minutes(CAST(event_id % 5760 AS INTEGER)) ELSE ts END AS t FROM feed)
      GROUP BY agency, stream, CAST({local('t')} AS DATE))""")

GRID_ZONES = ("America/New_York", "Asia/Kolkata")


def _with_empty_days(f: DataFrame) -> DataFrame:
    """The feed with every odd day of the month moved to the day before (so odd days are empty)
    and signup rows near the clock changes."""
    f = _near_clock_change(f)
    back = F.make_dt_interval(F.pmod(F.dayofmonth("ts") - 1, F.lit(2)))
    return f.withColumn("ts", F.when(F.col("stream") == "signup", F.col("ts")).otherwise(F.col("ts") - back))


_GRID_INPUT = """
moved AS (SELECT agency, stream, CASE WHEN stream = 'signup'
              THEN (CASE WHEN event_id % 2 = 0 THEN TIMESTAMP '2024-03-08' ELSE TIMESTAMP '2024-11-01' END)
                   + to_minutes(CAST(event_id % 5760 AS INTEGER))
              ELSE ts - to_days(CAST((day(ts) - 1) % 2 AS INTEGER)) END AS t FROM feed),
zoned AS (SELECT zone, agency, stream, t, CAST(timezone(zone, timezone('UTC', t)) AS DATE) AS day
          FROM moved, (SELECT unnest(['America/New_York', 'Asia/Kolkata']) AS zone)),
span AS (SELECT zone, agency, stream, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d
         FROM (SELECT zone, agency, stream, min(day) AS lo, max(day) AS hi FROM zoned GROUP BY zone, agency, stream)),
days AS (SELECT zone, agency, stream, CAST(d AS DATE) AS day, timezone('UTC', timezone(zone, d)) AS from_t,
                timezone('UTC', timezone(zone, d + INTERVAL 1 DAY)) AS to_t FROM span)"""


@register
def q_hour_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-05: every local hour of each stream's span with its rows, in a zone with clock
    changes and one half an hour off; days without any row are in the grid."""
    f = _with_empty_days(feed_envelopes(spark, sf_dir, TZ))
    out = None
    for zone in GRID_ZONES:
        part = monitor.hour_grid(f, tz=zone).select(F.lit(zone).alias("zone"), "agency", "stream", "day", "hour_start", "hour", "rows")
        out = part if out is None else out.unionByName(part)
    return out


ORACLE["q_hour_grid"] = with_feed("""
SELECT g.zone, g.agency, g.stream, g.day, g.hour_start, strftime(timezone(g.zone, timezone('UTC', g.hour_start)), '%H:%M') AS hour,
       count(z.t) AS rows
FROM (SELECT zone, agency, stream, day, unnest(generate_series(from_t, to_t - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS hour_start FROM days) g
LEFT JOIN zoned z ON z.zone = g.zone AND z.agency = g.agency AND z.stream = g.stream
     AND z.t >= g.hour_start AND z.t < g.hour_start + INTERVAL 1 HOUR
GROUP BY ALL""", _GRID_INPUT)


@register
def q_dense_hour_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-05: hours with and without rows of every local day of the span; an empty day misses
    all its 23, 24 or 25 hours."""
    f = _with_empty_days(feed_envelopes(spark, sf_dir, TZ))
    return monitor.hourly_audit(f, tz=TZ, dense=True).select("agency", "stream", "day", "hours_with_rows", "hours_missing", "rows")


ORACLE["q_dense_hour_audit"] = with_feed("""
SELECT d.agency, d.stream, d.day, count(DISTINCT date_trunc('hour', z.t)) AS hours_with_rows,
       CAST(epoch(d.to_t - d.from_t) / 3600 AS BIGINT) - count(DISTINCT date_trunc('hour', z.t)) AS hours_missing, count(z.t) AS rows
FROM days d LEFT JOIN zoned z ON z.zone = d.zone AND z.agency = d.agency AND z.stream = d.stream AND z.day = d.day
WHERE d.zone = 'America/New_York' GROUP BY d.agency, d.stream, d.day, d.from_t, d.to_t""", _GRID_INPUT)

# Expected poll interval (seconds) for feed classes; others hourly.
EXPECTED_INTERVAL_S = {"vehicles_enhanced": 7, "vehiclepositions": 10, "tripupdates": 15, "Predictions": 20,
                       "alerts": 30, "view": 300, "click": 600}


@register
def q_cadence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-07: gaps between consecutive captures per (agency, stream) versus the
    stream's expected interval from the catalog (default 3600 s)."""
    f = feed_envelopes(spark, sf_dir, TZ).select("agency", "stream", "ts", "event_id")
    g = monitor.cadence_gaps(f, ["agency", "stream"], ["ts", "event_id"])
    cat = spark.createDataFrame(list(EXPECTED_INTERVAL_S.items()), "stream string, expected_s int")
    g = g.join(cat, "stream", "left").withColumn("expected_s", F.coalesce("expected_s", F.lit(3600)))
    return g.groupBy("agency", "stream").agg(
        F.count("gap_s").cast("bigint").alias("gaps"), F.max("gap_s").cast("bigint").alias("max_gap_s"),
        F.count_if(F.col("gap_s") > F.col("expected_s")).cast("bigint").alias("late"))


ORACLE["q_cadence"] = with_feed("""
SELECT agency, stream, count(gap) AS gaps, max(gap) AS max_gap_s, count(*) FILTER (WHERE gap > expected) AS late FROM (
  SELECT agency, stream,
         CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) - lag(CAST(floor(epoch_us(ts) / 1000000) AS BIGINT))
           OVER (PARTITION BY agency, stream ORDER BY ts, event_id) AS gap,
         CASE stream WHEN 'view' THEN 300 WHEN 'click' THEN 600 ELSE 3600 END AS expected
  FROM feed) GROUP BY agency, stream""")


@register
def q_failure_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-06: consecutive error captures per entity, with cooldown and reconnect delay."""
    f = feed_envelopes(spark, sf_dir, TZ).select("event_id", "agency", "id", "ts", "stream", "day")
    s = win.failure_streaks(f, ["agency", "id"], ["ts", "event_id"], F.col("stream") == "error", split_by=["day"])
    return s.filter(F.col("streak").isNotNull()).select(
        "event_id", F.col("streak").cast("bigint").alias("streak"), "cooldown_s", "reconnect_s")


ORACLE["q_failure_streaks"] = with_feed("""
SELECT event_id, streak, CAST(least(30 * pow(2, streak - 1), 300) AS BIGINT) AS cooldown_s,
       CAST(least(5 * pow(2, streak - 1), 60) AS BIGINT) AS reconnect_s FROM (
  SELECT *, sum(CASE WHEN failed THEN 1 ELSE 0 END) OVER (PARTITION BY agency, id, island ORDER BY ts, event_id
                                                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS streak
  FROM (SELECT *, sum(CASE WHEN failed THEN 0 ELSE 1 END) OVER (PARTITION BY agency, id ORDER BY ts, event_id
                                                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island
        FROM (SELECT *, stream = 'error' AS failed FROM feed))
) WHERE failed""")


@register
def q_unavailable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-10: an entity's endpoint is unavailable for 12 h after an error mark;
    a mark outside such a period is reported."""
    f = feed_envelopes(spark, sf_dir, TZ).select("event_id", "agency", "id", "ts", "stream", "day")
    u = win.unavailable_marks(f, ["agency", "id"], "ts", ["ts", "event_id"], F.col("stream") == "error",
                              split_by=["day"])
    return u.select("event_id", "unavailable", "reported")


ORACLE["q_unavailable"] = with_feed("""
SELECT event_id, COALESCE(ts < last_mark + INTERVAL 12 HOUR, false) AS unavailable,
       stream = 'error' AND NOT COALESCE(ts < last_mark + INTERVAL 12 HOUR, false) AS reported FROM (
  SELECT *, max(CASE WHEN stream = 'error' THEN ts END) OVER (PARTITION BY agency, id ORDER BY ts, event_id
                                                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_mark
  FROM feed)""")


@register
def q_first_in_poll(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-02: first capture per (poll = local hour, entity)."""
    f = feed_envelopes(spark, sf_dir, TZ).withColumn("poll", F.date_format(to_local("ts", TZ), "yyyy-MM-dd HH"))
    d = dedupe_events(f.select("poll", "agency", "id", "ts", "event_id"), keys=["poll", "agency", "id"],
                      order=("ts", "event_id"))
    return d.select("poll", "agency", "id", "event_id")


ORACLE["q_first_in_poll"] = with_feed(f"""
SELECT poll, agency, id, arg_min(event_id, (ts, event_id)) AS event_id
FROM (SELECT *, strftime({local('ts')}, '%Y-%m-%d %H') AS poll FROM feed) GROUP BY poll, agency, id""")


@register
def q_latest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-04, JON-10, SCL-21: last capture per stream from stored history (before
    2024-01-20 local) combined with the live part, keeping the later."""
    f = feed_envelopes(spark, sf_dir, TZ)
    cut = F.lit("2024-01-20").cast("date")
    hist = monitor.last_sync(f.filter(F.col("day") < cut))
    live = monitor.last_sync(f.filter(F.col("day") >= cut))
    m = latest(hist, live, ["agency", "stream"], "last_ts")
    return m.select("agency", "stream", F.date_format(to_local("last_ts", TZ), "yyyy-MM-dd HH:mm:ss").alias("last_sync"),
                    hms_of_ts("last_ts", TZ).alias("hms"))


ORACLE["q_latest_status"] = with_feed(f"""
SELECT agency, stream, strftime({local('max(ts)')}, '%Y-%m-%d %H:%M:%S') AS last_sync,
       strftime({local('max(ts)')}, '%H:%M:%S') AS hms FROM feed GROUP BY agency, stream""")

# Request templates per discovered id kind.
REQUEST_TEMPLATES = (("vehicle", "getpredictions?vid={id}"), ("route", "getdirections?rt={id}"),
                     ("route", "getstops?rt={id}"))


@register
def q_work_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON-08: next requests from discovered ids (vehicles = entities, routes = streams)."""
    f = feed_envelopes(spark, sf_dir, TZ)
    ids = f.select("agency", F.lit("vehicle").alias("kind"), "id").union(
        f.select("agency", F.lit("route").alias("kind"), F.col("stream").alias("id"))).distinct()
    t = spark.createDataFrame(list(REQUEST_TEMPLATES), "kind string, template string")
    return work_list(ids, t).select("agency", "kind", "id", "request")


ORACLE["q_work_list"] = with_feed("""
SELECT agency, i.kind, id, replace(template, '{id}', id) AS request
FROM (SELECT DISTINCT agency, 'vehicle' AS kind, id FROM feed UNION SELECT DISTINCT agency, 'route', stream FROM feed) i
JOIN (VALUES ('vehicle', 'getpredictions?vid={id}'), ('route', 'getdirections?rt={id}'),
             ('route', 'getstops?rt={id}')) t(kind, template) ON i.kind = t.kind""")

ROUTE_TARGETS = ("A1", "A2", "A4")


@register
def q_route_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-04, FLT-02, SET-04: valid route ids (not blank, not integer 0) of the
    target agencies; error rows carry a blank id."""
    f = feed_envelopes(spark, sf_dir, TZ)
    rid = F.when(F.col("stream") == "error", F.lit(" \t\n")).otherwise(F.col("id"))
    r = f.select("agency", rid.alias("route_id")).filter(id_ops.valid_route_id("route_id"))
    return allow_list(r, "agency", list(ROUTE_TARGETS)).distinct()


ORACLE["q_route_ids"] = with_feed("""
SELECT DISTINCT agency, route_id FROM (
  SELECT agency, CASE WHEN stream = 'error' THEN ' ' ELSE id END AS route_id FROM feed)
WHERE trim(route_id) <> '' AND COALESCE(TRY_CAST(trim(route_id) AS BIGINT), 1) <> 0 AND agency IN ('A1', 'A2', 'A4')""")


def _id_batches(spark: SparkSession, sf_dir: str):
    f = feed_envelopes(spark, sf_dir, TZ)
    idc = F.when(F.col("value") < 1, F.lit("")).otherwise(F.col("id"))
    cut = F.lit("2024-01-15").cast("date")
    b1 = id_ops.observed_ids(f.filter(F.col("day") < cut), F.col("stream"), idc)
    # Agency A3 is not polled the second time: its stored ids stay.
    polled = (F.col("day") >= cut) & (F.col("stream") != "signup") & (F.col("agency") != "A3")
    b2 = id_ops.observed_ids(f.filter(polled), F.col("stream"), idc)
    return b1, b2


@register
def q_ids_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-05, AGG-10, SET-02, FLT-03: two discovery batches stored under the three modes."""
    b1, b2 = _id_batches(spark, sf_dir)
    out = None
    for mode in id_ops.MODES:
        r = id_ops.upsert_ids(b1, b2, mode).select(F.lit(mode).alias("mode"), "agency", "kind", "id",
                                                   F.date_format("first_seen", "yyyy-MM-dd HH:mm:ss").alias("first_seen"),
                                                   F.date_format("last_seen", "yyyy-MM-dd HH:mm:ss").alias("last_seen"))
        out = r if out is None else out.unionByName(r)
    return out


ORACLE["q_ids_upsert"] = with_feed("""
SELECT mode, agency, kind, id, strftime(first_seen, '%Y-%m-%d %H:%M:%S') AS first_seen,
       strftime(last_seen, '%Y-%m-%d %H:%M:%S') AS last_seen FROM (
  SELECT 'replace' AS mode, * FROM b2
  UNION ALL SELECT 'replace', * FROM b1 WHERE agency NOT IN (SELECT DISTINCT agency FROM b2)
  UNION ALL SELECT 'replace_nonempty', * FROM b2
  UNION ALL SELECT 'replace_nonempty', * FROM b1 WHERE (agency, kind) NOT IN (SELECT DISTINCT agency, kind FROM b2)
  UNION ALL SELECT 'accumulate', agency, kind, id, min(first_seen), max(last_seen)
            FROM (SELECT * FROM b1 UNION ALL SELECT * FROM b2) GROUP BY agency, kind, id)""",
    """ids AS (SELECT agency, stream AS kind, CASE WHEN value < 1 THEN '' ELSE id END AS id, ts, day, stream FROM feed)""",
    """b1 AS (SELECT agency, kind, id, min(ts) AS first_seen, max(ts) AS last_seen FROM ids
            WHERE day < DATE '2024-01-15' AND length(trim(id)) > 0 GROUP BY agency, kind, id)""",
    """b2 AS (SELECT agency, kind, id, min(ts) AS first_seen, max(ts) AS last_seen FROM ids
            WHERE day >= DATE '2024-01-15' AND stream <> 'signup' AND agency <> 'A3' AND length(trim(id)) > 0 GROUP BY agency, kind, id)""")
