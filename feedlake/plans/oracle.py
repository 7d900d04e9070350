"""DuckDB statements equal to the registered queries (views: the driver tables)."""

from __future__ import annotations

TZ = "America/New_York"

LOCAL = f"timezone('{TZ}', timezone('UTC', {{ts}}))"


def local(ts: str) -> str:
    return LOCAL.format(ts=ts)


# The stand-in feed: one envelope per events row.
FEED = f"""
feed AS (
  SELECT event_id, ts, user_id, value,
         'A' || CAST(user_id % 5 AS VARCHAR) AS agency,
         event_type AS stream, event_type AS endpoint, 'update' AS event,
         CAST(user_id AS VARCHAR) AS id, props AS data,
         CAST({local('ts')} AS DATE) AS day,
         sha256('{{"agency":"' || ('A' || CAST(user_id % 5 AS VARCHAR)) || '","data":' || CAST(json(props) AS VARCHAR)
                || ',"endpoint":"' || event_type || '","event":"update","metadata":null,"stream":"'
                || event_type || '"}}') AS hash_id
  FROM events
)"""


def with_feed(body: str, *more_ctes: str) -> str:
    ctes = ",\n".join([FEED, *more_ctes])
    return f"WITH {ctes}\n{body}"


SQL: dict[str, str] = {}

SQL["q_event_hash"] = with_feed("""
SELECT event_id,
       sha256(endpoint || '|' || event || '|' || id || '|' || replace(replace(CAST(json(data) AS VARCHAR), ':', ': '), ',', ', ')) AS hash_main,
       sha256(agency || '|' || endpoint || '|' || event || '|' || id || '|' || replace(replace(CAST(json(data) AS VARCHAR), ':', ': '), ',', ', ')) AS hash_agency,
       hash_id AS hash_struct,
       CAST(json(data) AS VARCHAR) AS data_json
FROM feed""")

SQL["q_dedupe_day"] = with_feed("""
SELECT event_id, agency, stream, day, hash_id FROM (
  SELECT *, row_number() OVER (PARTITION BY agency, stream, day, hash_id ORDER BY ts, event_id) AS rn FROM feed
) WHERE rn = 1""")

SQL["q_unique_rows"] = with_feed("""
SELECT agency, stream, day, count(*) AS rows, count(DISTINCT hash_id) AS unique_rows
FROM feed GROUP BY agency, stream, day""")

SQL["q_fetched_new"] = with_feed(f"""
SELECT agency, stream, poll, count(*) AS fetched, count(*) FILTER (WHERE rn = 1) AS new_rows FROM (
  SELECT agency, stream, strftime({local('ts')}, '%Y-%m-%d %H:00') AS poll,
         row_number() OVER (PARTITION BY agency, stream, day, hash_id ORDER BY ts, event_id) AS rn
  FROM feed
) GROUP BY agency, stream, poll""")

SQL["q_coverage"] = with_feed("""
SELECT agency, CASE WHEN grouping(stream) = 1 THEN '*all*' ELSE stream END AS stream, day, count(*) AS rows
FROM feed GROUP BY GROUPING SETS ((agency, day, stream), (agency, day))""")

SQL["q_coverage_calendar"] = with_feed("""
SELECT g.agency, g.year, g.day, g.week, g.weekday, g.in_year, g.month_label,
       COALESCE(c.rows, 0) AS rows,
       CAST(CASE WHEN COALESCE(c.rows, 0) = 0 THEN 0 WHEN c.rows < 500 THEN 1 WHEN c.rows < 2000 THEN 2
                 WHEN c.rows < 10000 THEN 3 ELSE 4 END AS INTEGER) AS level
FROM (
  SELECT agency, year, day, CAST((day - s) // 7 AS INTEGER) AS week, CAST(dayofweek(day) AS INTEGER) AS weekday,
         year(day) = year AS in_year,
         CASE WHEN dayofmonth(s + CAST((day - s) // 7 AS INTEGER) * 7 + 6) <= 7
               AND year(s + CAST((day - s) // 7 AS INTEGER) * 7 + 6) = year
              THEN strftime(s + CAST((day - s) // 7 AS INTEGER) * 7 + 6, '%b') END AS month_label
  FROM (
    SELECT agency, year, s, CAST(unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day
    FROM (
      SELECT agency, year,
             make_date(year, 1, 1) - CAST(dayofweek(make_date(year, 1, 1)) AS INTEGER) AS s,
             make_date(year, 12, 31) + (6 - CAST(dayofweek(make_date(year, 12, 31)) AS INTEGER)) AS e
      FROM (SELECT DISTINCT agency, CAST(year(day) AS INTEGER) AS year FROM feed)
    )
  )
) g LEFT JOIN cov c ON g.agency = c.agency AND g.day = c.day""",
    "cov AS (SELECT agency, day, count(*) AS rows FROM feed GROUP BY agency, day)")

SQL["q_missed_days"] = with_feed("""
SELECT s.agency, s.stream, s.id, CAST(d AS DATE) AS day
FROM (SELECT agency, stream, id, min(day) AS a, max(day) AS b FROM feed GROUP BY ALL) s,
     unnest(generate_series(CAST(s.a AS TIMESTAMP), CAST(s.b AS TIMESTAMP), INTERVAL 1 DAY)) AS t(d)
WHERE NOT EXISTS (SELECT 1 FROM feed f WHERE f.agency = s.agency AND f.stream = s.stream AND f.id = s.id
                  AND f.day = CAST(d AS DATE))""")

SQL["q_agency_span"] = with_feed("""
SELECT agency, min(day) AS first_day, max(day) AS last_day, count(DISTINCT day) AS days_covered
FROM feed WHERE year(day) = 2024 GROUP BY agency""")


def iso_local_sql(utc_ts: str) -> str:
    """``YYYY-MM-DDTHH:MM:SS±HHMM`` of a UTC instant in the local zone."""
    loc = local(utc_ts)
    d = f"CAST(round((epoch({loc}) - epoch({utc_ts})) / 60) AS INTEGER)"
    return (f"(strftime({loc}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN {d} < 0 THEN '-' ELSE '+' END"
            f" || lpad(CAST(abs({d}) // 60 AS VARCHAR), 2, '0') || lpad(CAST(abs({d}) % 60 AS VARCHAR), 2, '0'))")


def iso_seconds_sql(utc_ts: str) -> str:
    """``YYYY-MM-DDTHH:MM:SS±HH:MM`` of a UTC instant in the local zone."""
    loc = local(utc_ts)
    d = f"CAST(round((epoch({loc}) - epoch({utc_ts})) / 60) AS INTEGER)"
    return (f"(strftime({loc}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN {d} < 0 THEN '-' ELSE '+' END"
            f" || lpad(CAST(abs({d}) // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(abs({d}) % 60 AS VARCHAR), 2, '0'))")


ORDERS_HIST = """
o AS (SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
             o_orderpriority, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders),
h AS (SELECT *, sha256('{"row":' || CAST(json_object('o_custkey', o_custkey, 'o_orderdate', o_orderdate,
                  'o_orderkey', o_orderkey, 'o_orderpriority', o_orderpriority, 'o_orderstatus', o_orderstatus) AS VARCHAR)
                  || ',"table":"orders"}') AS hash_id FROM o),
u AS (SELECT *, TIMESTAMP '2024-01-01 08:00:00' AS t FROM h WHERE o_orderdate < '1998-01-01'
      UNION ALL SELECT *, TIMESTAMP '2024-02-01 08:00:00' AS t FROM h WHERE o_orderdate >= '1997-01-01'),
m AS (SELECT hash_id, any_value(o_orderkey) AS o_orderkey, any_value(o_custkey) AS o_custkey,
             any_value(o_orderstatus) AS o_orderstatus, any_value(o_orderpriority) AS o_orderpriority,
             any_value(o_orderdate) AS o_orderdate, min(t) AS first_t, max(t) AS last_t FROM u GROUP BY hash_id)"""

SQL["q_snapshot_merge"] = f"""WITH {ORDERS_HIST}
SELECT hash_id, o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_orderdate, CAST(NULL AS VARCHAR) AS o_note,
       {iso_local_sql('first_t')} AS first_logged, {iso_local_sql('last_t')} AS last_logged
FROM m"""

SQL["q_point_in_time"] = f"""WITH {ORDERS_HIST}
SELECT hash_id, o_orderkey FROM m
WHERE first_t <= TIMESTAMP '2024-01-15 17:00:00' AND last_t >= TIMESTAMP '2024-01-15 17:00:00'"""

SQL["q_gtfs_row_hash"] = """
SELECT 'nation' AS table_name, CAST(n_nationkey AS VARCHAR) AS row_key,
       sha256('{"row":' || CAST(json_object('n_name', n_name, 'n_nationkey', CAST(n_nationkey AS VARCHAR),
              'n_regionkey', CAST(n_regionkey AS VARCHAR)) AS VARCHAR) || ',"table":"nation"}') AS hash_id FROM nation
UNION ALL
SELECT 'region', CAST(r_regionkey AS VARCHAR),
       sha256('{"row":' || CAST(json_object('r_name', r_name, 'r_regionkey', CAST(r_regionkey AS VARCHAR)) AS VARCHAR)
              || ',"table":"region"}') FROM region
UNION ALL
SELECT 'supplier', CAST(s_suppkey AS VARCHAR),
       sha256('{"row":' || CAST(json_object('s_name', s_name, 's_nationkey', CAST(s_nationkey AS VARCHAR),
              's_suppkey', CAST(s_suppkey AS VARCHAR)) AS VARCHAR) || ',"table":"supplier"}') FROM supplier"""

SQL["q_align_schema"] = """
SELECT TRY_CAST(CAST(p_partkey AS VARCHAR) AS BIGINT) AS p_partkey, p_name,
       TRY_CAST(CAST(p_size AS VARCHAR) AS INTEGER) AS p_size, TRY_CAST(p_brand AS INTEGER) AS p_brand,
       CAST(NULL AS VARCHAR) AS p_container, TRY_CAST(CAST(p_retailprice AS VARCHAR) AS DOUBLE) AS p_retailprice
FROM part"""

SQL["q_agency_lookup"] = """
SELECT l_orderkey, l_linenumber, n_name AS agency,
       CASE l_returnflag WHEN 'R' THEN 'returned_items' WHEN 'A' THEN 'accepted_items'
            ELSE lower(coalesce(nullif(regexp_replace(regexp_replace(trim(l_returnflag), '[^\\w-]', '_', 'g'),
                                       '^_+|_+$', '', 'g'), ''), 'stream')) END AS stem
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey"""

SQL["q_fan_out"] = """
SELECT n_name AS agency, (SELECT strftime(max(o_orderdate), '%Y-%m-%d') FROM orders) AS feed_version FROM nation"""

SQL["q_fetched_per_agency"] = """
SELECT n_name AS agency, COALESCE(v, 0) AS vehicles, COALESCE(e, 0) AS enhanced
FROM nation LEFT JOIN (
  SELECT c_nationkey, count(*) FILTER (WHERE o_orderstatus = 'O') AS v, count(*) FILTER (WHERE o_orderstatus = 'F') AS e
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey
) c ON c.c_nationkey = n_nationkey"""

SQL["q_active_routes"] = """
WITH r AS (SELECT n_name AS agency, c_custkey AS route_id FROM customer JOIN nation ON c_nationkey = n_nationkey),
live AS (SELECT DISTINCT o_custkey FROM orders
         WHERE CAST(o_orderdate AS DATE) > (SELECT CAST(max(o_orderdate) AS DATE) - 30 FROM orders)),
act AS (SELECT * FROM r WHERE route_id IN (SELECT o_custkey FROM live))
SELECT * FROM act UNION ALL SELECT * FROM r WHERE agency NOT IN (SELECT agency FROM act)"""

SQL["q_missing_vehicles"] = with_feed("""
SELECT k.agency, k.day, k.id FROM (SELECT agency, id, day + 1 AS day FROM f) k
WHERE k.day IN (SELECT day FROM f)
  AND NOT EXISTS (SELECT 1 FROM f WHERE f.agency = k.agency AND f.id = k.id AND f.day = k.day)""",
    "f AS (SELECT DISTINCT agency, id, day FROM feed)")

LI_FEED = f"""
li AS (
  SELECT 'N' || CAST(l_suppkey % 25 AS VARCHAR) AS agency, l_returnflag || l_linestatus AS stream,
         CAST(l_orderkey AS VARCHAR) AS id,
         '{{"ln":' || CAST(l_linenumber AS VARCHAR) || ',"q":' || CAST(CAST(trunc(l_quantity) AS INTEGER) AS VARCHAR) || '}}' AS data,
         l_shipdate + to_hours(l_linenumber) AS ts
  FROM lineitem),
lif AS (
  SELECT *, CAST({local('ts')} AS DATE) AS day,
         sha256('{{"agency":"' || agency || '","data":' || data || ',"endpoint":"' || stream
                || '","event":"update","metadata":null,"stream":"' || stream || '"}}') AS hash_id
  FROM li)"""

SQL["q_li_dedupe"] = f"""WITH {LI_FEED}
SELECT agency, stream, day, hash_id, id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM (
  SELECT *, row_number() OVER (PARTITION BY agency, stream, day, hash_id ORDER BY ts, id) AS rn FROM lif)
WHERE rn = 1"""

SQL["q_li_coverage"] = f"""WITH {LI_FEED}
SELECT agency, CASE WHEN grouping(stream) = 1 THEN '*all*' ELSE stream END AS stream, day, count(*) AS rows
FROM lif GROUP BY GROUPING SETS ((agency, day, stream), (agency, day))"""

SQL["q_li_merge"] = f"""WITH l AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
         CAST(l_partkey AS VARCHAR) AS l_partkey, CAST(l_suppkey AS VARCHAR) AS l_suppkey, l_returnflag,
         strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate FROM lineitem),
h AS (SELECT *, sha256('{{"row":' || CAST(json_object('l_linenumber', l_linenumber, 'l_orderkey', l_orderkey,
          'l_partkey', l_partkey, 'l_returnflag', l_returnflag, 'l_shipdate', l_shipdate, 'l_suppkey', l_suppkey)
          AS VARCHAR) || ',"table":"lineitem"}}') AS hash_id FROM l),
u AS (SELECT *, TIMESTAMP '2024-01-01 08:00:00' AS t FROM h WHERE l_shipdate < '1997-01-01'
      UNION ALL SELECT *, TIMESTAMP '2024-02-01 08:00:00' AS t FROM h WHERE l_shipdate >= '1996-01-01')
SELECT hash_id, any_value(l_orderkey) AS l_orderkey, any_value(l_linenumber) AS l_linenumber,
       {iso_local_sql('min(t)')} AS first_logged, {iso_local_sql('max(t)')} AS last_logged
FROM u GROUP BY hash_id"""
