"""Registered queries that write and read back: landing, archive, schedule
packages, coverage documents and streams. Each run works in a fresh folder
under the cluster's shared checkpoint location."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions.scalars import from_local
from feedlake.operators.coverage import approx_distinct, coverage, distinct_sketches, merge_sketches
from feedlake.operators.history import prepare_snapshot
from feedlake.operators.ids import id_set
from feedlake.plans.feeds import envelopes_from_events, events_stream, feed_envelopes
from feedlake.plans.oracle import with_feed
from feedlake.schema import DEFAULT_TZ
from feedlake.session import shared_dir
from feedlake.sinks.archive import coverage_documents, compact_days, wal_append, write_gtfs_table
from feedlake.sources.gtfs import PANDAS_NULL_TOKENS, gtfs_package_tables, read_coverage, read_gtfs_table
from feedlake.sources.lines import read_lines
from feedlake.sources.sse import frame_records, sse_line_frames
from feedlake.sources.tables import read_table
from feedlake.sources.wal import read_archive, read_wal
from feedlake.streaming.changes import daily_calls, detour_changes, quota_breaches
from feedlake.streaming.ingest import start_ingest, stateful_dedupe

TZ = DEFAULT_TZ
QUERIES: dict = {}
ORACLE: dict = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


@register
def q_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-01/20, SNK-01/02, PRJ-02, FLT-01, STR-03/04/10: envelopes land as JSON
    Lines; days closed at 2024-01-20 12:00 local are compacted twice; a late
    re-delivery of 2024-01-10..12 lands and is compacted again; the archive keeps
    one row per (agency, stream, day, hash)."""
    base = shared_dir(spark, "q_compact")
    landing, archive = f"{base}/landing", f"{base}/archive"
    env = feed_envelopes(spark, sf_dir, TZ)
    wal_append(env, landing, TZ)
    as_of = from_local(F.lit("2024-01-20 12:00:00").cast("timestamp_ntz"), TZ)
    log = f"{base}/compaction_log"
    for _ in range(2):  # the second sweep finds nothing pending and writes nothing
        compact_days(spark, read_wal(spark, landing, TZ), archive, as_of, TZ, landing_root=landing, log_root=log)
    late = env.filter(F.col("day").between(F.lit("2024-01-10").cast("date"), F.lit("2024-01-12").cast("date")))
    wal_append(late, landing, TZ)  # a re-delivery lands in the same folders as new files
    compact_days(spark, read_wal(spark, landing, TZ), archive, as_of, TZ, landing_root=landing, log_root=log)
    a = read_archive(spark, archive)
    return a.groupBy("agency", "stream", "day").agg(F.count(F.lit(1)).cast("bigint").alias("rows"),
                                                    F.count_distinct("hash_id").cast("bigint").alias("unique_rows"))


ORACLE["q_compact"] = with_feed("""
SELECT agency, stream, day, count(DISTINCT hash_id) AS rows, count(DISTINCT hash_id) AS unique_rows
FROM feed WHERE day < DATE '2024-01-20' GROUP BY agency, stream, day""")


@register
def q_gtfs_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-05/06, SNK-03, IDN-08: ``nation`` and ``region`` written as a schedule
    package (header CSV, quoted commas, 'NA' cells), listed, read back all-string
    with pandas null tokens, hashed, and stored as cumulative tables."""
    base = shared_dir(spark, "q_gtfs_csv")
    pkg = f"{base}/package"
    n = read_table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("nation_id"), F.col("n_name").alias("nation_name"),
        F.when(F.col("n_nationkey") % 5 == 0, F.lit("NA"))
        .otherwise(F.concat(F.col("n_name"), F.lit(", region "), F.col("n_regionkey"))).alias("note"))
    r = read_table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("region_id"),
                                                   F.col("r_name").alias("region_name"))
    for name, df in (("nation", n), ("region", r)):
        df.write.mode("overwrite").option("header", True).csv(f"{pkg}/{name}.txt")
    logged = from_local(F.lit("2024-01-01 03:00:00").cast("timestamp_ntz"), TZ)
    out = None
    for table in gtfs_package_tables(spark, pkg):
        t = read_gtfs_table(spark, f"{pkg}/{table}.txt", table, null_tokens=PANDAS_NULL_TOKENS)
        snap = prepare_snapshot(t, table, logged).withColumn("agency", F.lit("A0")).withColumn("table", F.lit(table))
        key = t.columns[0]
        name = t.columns[1]
        note = F.col("note") if "note" in t.columns else F.lit(None).cast("string")
        part = snap.select("agency", "table", F.col(key).alias("row_key"), F.col(name).alias("name"),
                           note.alias("note"), "hash_id")
        out = part if out is None else out.unionByName(part)
    stored = write_gtfs_table(spark, out, f"{base}/gtfs", f"{base}/gtfs_staging")
    return stored.select("table", "row_key", "name", "note", "hash_id")


ORACLE["q_gtfs_csv"] = """
SELECT 'nation' AS "table", CAST(n_nationkey AS VARCHAR) AS row_key, n_name AS name,
       CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE n_name || ', region ' || CAST(n_regionkey AS VARCHAR) END AS note,
       sha256('{"row":' || CAST(json_object('nation_id', CAST(n_nationkey AS VARCHAR), 'nation_name', n_name,
              'note', CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE n_name || ', region ' || CAST(n_regionkey AS VARCHAR) END)
              AS VARCHAR) || ',"table":"nation"}') AS hash_id
FROM nation
UNION ALL
SELECT 'region', CAST(r_regionkey AS VARCHAR), r_name, NULL,
       sha256('{"row":' || CAST(json_object('region_id', CAST(r_regionkey AS VARCHAR), 'region_name', r_name) AS VARCHAR)
              || ',"table":"region"}')
FROM region"""


@register
def q_csv_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-05: every order as a CSV row whose note holds quotes, commas and line feeds, written
    in many files and read back by record starts; an empty note comes back as null."""
    base = shared_dir(spark, "q_csv_records")
    o = read_table(spark, sf_dir, "orders")
    note = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit('said "'), F.col("o_orderpriority"), F.lit('",\n\n then "x"\n')))\
        .when(F.col("o_orderkey") % 3 == 1, F.concat("o_orderstatus", F.lit(", plain"))).otherwise(F.lit(""))
    o.select(F.col("o_orderkey").alias("order_id"), note.alias("note"), F.to_date("o_orderdate").alias("day")) \
        .write.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(f"{base}/orders.txt")
    t = read_gtfs_table(spark, f"{base}/orders.txt", "orders")
    return t.select("order_id", "note", "day")


ORACLE["q_csv_records"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, strftime(o_orderdate, '%Y-%m-%d') AS day,
       CASE o_orderkey % 3 WHEN 0 THEN 'said "' || o_orderpriority || '",' || chr(10) || chr(10) || ' then "x"' || chr(10)
                           WHEN 1 THEN o_orderstatus || ', plain' END AS note
FROM orders"""


@register
def q_sse_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-02, WIN-03: the feed as event-stream text, one capture per agency, framed line by line
    (frames carry entity and day in their ``id:`` line); multi-line data and list payloads."""
    base = shared_dir(spark, "q_sse_lines")
    f = feed_envelopes(spark, sf_dir, TZ)
    name = F.when(F.col("stream") == "signup", F.lit("")).otherwise(F.concat(F.lit("event: "), F.col("stream"), F.lit("\n")))
    data = (F.when(F.col("stream") == "view", F.concat(F.lit("data: "), F.regexp_replace("data", ": ", ":\ndata: ")))
            .when(F.col("stream") == "purchase", F.concat(F.lit("data: ["), F.col("data"), F.lit(', {"id":'), F.col("user_id"), F.lit("}]")))
            .otherwise(F.concat(F.lit("data: "), F.col("data"))))
    bad = F.when(F.col("stream") == "click", F.lit("event: click\ndata: {oops\n\n")).otherwise(F.lit(""))
    text = F.concat(bad, F.lit(": comment\nid: "), F.concat_ws("/", "agency", "id", "day"), F.lit("\n"), name, data, F.lit("\n"))
    f.select("agency", text.alias("value")).write.partitionBy("agency").text(f"{base}/captures")
    rec = frame_records(sse_line_frames(read_lines(spark, f"{base}/captures")))
    key = F.split("last_id", "/")
    return rec.select(key[0].alias("agency"), key[1].alias("id"), key[2].cast("date").alias("day"), "event",
                      F.to_json("record").alias("record"))


ORACLE["q_sse_lines"] = with_feed("""
SELECT agency, id, day, CASE WHEN stream = 'signup' THEN 'message' ELSE stream END AS event,
       CAST(json(data) AS VARCHAR) AS record FROM feed
UNION ALL
SELECT agency, id, day, stream, '{"id":' || CAST(user_id AS VARCHAR) || '}' FROM feed WHERE stream = 'purchase'""")


@register
def q_distinct_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-05: distinct records per (agency, stream) over all days from stored daily sketches,
    held to the exact count: within three standard errors."""
    base = shared_dir(spark, "q_distinct_sketches")
    f = feed_envelopes(spark, sf_dir, TZ)
    distinct_sketches(f).write.parquet(f"{base}/sketches")
    merged = approx_distinct(merge_sketches(spark.read.parquet(f"{base}/sketches")))
    exact = f.groupBy("agency", "stream").agg(F.count_distinct("hash_id").alias("unique_rows"))
    return merged.join(exact, ["agency", "stream"]).select(
        "agency", "stream", F.col("rows").cast("bigint").alias("rows"), "unique_rows",
        (F.abs(F.col("approx_unique") - F.col("unique_rows")) <= 0.049 * F.col("unique_rows") + 1).alias("within"))


ORACLE["q_distinct_sketches"] = with_feed("""
SELECT agency, stream, count(*) AS rows, count(DISTINCT hash_id) AS unique_rows, true AS within FROM feed GROUP BY agency, stream""")


@register
def q_coverage_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-21, SNK-06: the coverage cube published as nested per-agency JSON and
    read back into long form."""
    base = shared_dir(spark, "q_coverage_json")
    cov = coverage(feed_envelopes(spark, sf_dir, TZ))
    agencies = cov.select("agency").distinct().select(
        "agency", F.concat(F.lit("Agency "), F.col("agency")).alias("name"), F.lit(True).alias("is_rt"),
        F.lit(None).cast("string").alias("url"))
    coverage_documents(cov, agencies).write.mode("overwrite").text(f"{base}/coverage")
    return read_coverage(spark.read.text(f"{base}/coverage"))


ORACLE["q_coverage_json"] = with_feed("""
SELECT agency, stream, day, count(*) AS rows FROM feed GROUP BY agency, stream, day""")


@register
def q_stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-01/02: the events file as a stream, envelopes, watermark dedupe on
    (agency, stream, day, hash), appended with a checkpoint (availableNow), read back."""
    base = shared_dir(spark, "q_stream_dedupe")
    s = envelopes_from_events(events_stream(spark, sf_dir), TZ).select("agency", "stream", "day", "hash_id", "ts")
    q = start_ingest(stateful_dedupe(s), f"{base}/out", f"{base}/checkpoint")
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out").select("agency", "stream", "day", "hash_id")


ORACLE["q_stream_dedupe"] = with_feed("""
SELECT DISTINCT agency, stream, day, hash_id FROM feed""")


@register
def q_stream_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-02: half of the feed lands and its closed days are archived; a stream with a new
    checkpoint then delivers the whole feed. What the archive or the landing held is not
    admitted again, so landing and archive together hold every record once."""
    from feedlake.jobs import ingest_stream
    base = shared_dir(spark, "q_stream_history")
    landing, archive = f"{base}/landing", f"{base}/archive"
    wal_append(feed_envelopes(spark, sf_dir, TZ).where(F.col("event_id") % 2 == 0), landing, TZ)
    as_of = from_local(F.lit("2024-01-20 12:00:00").cast("timestamp_ntz"), TZ)
    compact_days(spark, read_wal(spark, landing, TZ), archive, as_of, TZ, landing_root=landing,
                 log_root=f"{archive}/_compaction_log", remove_source=True)
    ingest_stream(envelopes_from_events(events_stream(spark, sf_dir), TZ), landing, f"{base}/checkpoint",
                  available_now=True, tz=TZ, archive_root=archive).awaitTermination()
    keys = ["agency", "stream", "day"]
    stored = read_archive(spark, archive).select(*keys, "hash_id", F.lit(1).alias("old"))
    landed = read_wal(spark, landing, TZ).select(*keys, "hash_id", F.lit(0).alias("old"))
    return stored.unionByName(landed).groupBy(*keys).agg(
        F.sum("old").cast("bigint").alias("archived"), F.sum(1 - F.col("old")).cast("bigint").alias("landed"),
        (F.count(F.lit(1)) - F.count_distinct("hash_id")).cast("bigint").alias("repeats"))


ORACLE["q_stream_history"] = with_feed("""
SELECT agency, stream, day, count(DISTINCT hash_id) FILTER (WHERE day < DATE '2024-01-20' AND event_id % 2 = 0) AS archived,
       CASE WHEN day < DATE '2024-01-20'
            THEN count(DISTINCT hash_id) - count(DISTINCT hash_id) FILTER (WHERE event_id % 2 = 0)
            ELSE count(DISTINCT hash_id) + count(*) FILTER (WHERE event_id % 2 = 0)
                 - count(DISTINCT hash_id) FILTER (WHERE event_id % 2 = 0) END AS landed,
       CASE WHEN day < DATE '2024-01-20' THEN 0
            ELSE count(*) FILTER (WHERE event_id % 2 = 0) - count(DISTINCT hash_id) FILTER (WHERE event_id % 2 = 0) END AS repeats
FROM feed GROUP BY agency, stream, day""")


@register
def q_stream_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-08: per-route poll sets (entity x local day) landed as files, streamed
    through stateful change detection (transformWithStateInPandas), read back."""
    base = shared_dir(spark, "q_stream_changes")
    f = feed_envelopes(spark, sf_dir, TZ).withColumn(
        "k", F.try_variant_get(F.try_parse_json("data"), "$.k", "string"))
    polls = id_set(f, ["agency", "id", "day"], "k", "s").select("agency", "id", "day",
                                                                 F.array_join("s", ",").alias("detours"))
    polls.write.mode("overwrite").parquet(f"{base}/polls")
    src = spark.readStream.schema(polls.schema).parquet(f"{base}/polls")
    q = (detour_changes(src).writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint")
         .outputMode("append").trigger(availableNow=True).start(f"{base}/out"))
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out").select("agency", "id", "day", "detours")


ORACLE["q_stream_changes"] = with_feed("""
SELECT agency, id, day, detours FROM (
  SELECT *, lag(detours) OVER (PARTITION BY agency, id ORDER BY day) AS prev FROM (
    SELECT agency, id, day, array_to_string(list_sort(list(DISTINCT json_extract_string(data, '$.k'))), ',') AS detours
    FROM feed GROUP BY agency, id, day)
) WHERE prev IS DISTINCT FROM detours""")


@register
def q_stream_detours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-08 with a memory of one day: a route that was not polled the day before is forgotten,
    and its next poll counts as changed. The polls arrive in two runs of one checkpoint."""
    base = shared_dir(spark, "q_stream_detours")
    f = feed_envelopes(spark, sf_dir, TZ).withColumn(
        "k", (F.try_variant_get(F.try_parse_json("data"), "$.k", "int") % 2).cast("string"))
    polls = id_set(f, ["agency", "id", "day"], "k", "s").select("agency", "id", "day", F.array_join("s", ",").alias("detours"))
    half = F.coalesce(F.col("day") < F.lit("2024-01-15").cast("date"), F.lit(False))  # no day: second run
    for i, part in enumerate((half, ~half)):
        polls.where(part).write.parquet(f"{base}/polls/run={i}")
        src = spark.readStream.schema(polls.schema).option("recursiveFileLookup", True).parquet(f"{base}/polls")
        detour_changes(src, forget_after_days=1).writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint") \
            .outputMode("append").trigger(availableNow=True).start(f"{base}/out").awaitTermination()
    return spark.read.parquet(f"{base}/out").select("agency", "id", "day", "detours", "late")


ORACLE["q_stream_detours"] = with_feed("""
SELECT agency, id, day, detours, false AS late FROM (
  SELECT *, lag(detours) OVER w AS prev, lag(day) OVER w AS prev_day FROM (
    SELECT agency, id, day, array_to_string(list_sort(list(DISTINCT CAST(CAST(json_extract_string(data, '$.k') AS INTEGER) % 2 AS VARCHAR))), ',') AS detours
    FROM feed GROUP BY agency, id, day) WINDOW w AS (PARTITION BY agency, id ORDER BY day)
) WHERE prev IS DISTINCT FROM detours OR day - prev_day > 1""")

BREACH_LIMIT = 20


@register
def q_stream_breach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-09: the feed arrives in three parts cut in the middle of days, each streamed by a
    query restarted from one checkpoint; every agency-day over 20 calls is told once, with the
    call that first exceeded them."""
    base = shared_dir(spark, "q_stream_breach")
    events = read_table(spark, sf_dir, "events")
    cuts = [F.lit(t).cast("timestamp_ntz") for t in ("2024-01-10 15:00:00", "2024-01-20 18:30:00")]
    ts = F.col("ts").cast("timestamp_ntz")
    for i, part in enumerate((ts < cuts[0], (ts >= cuts[0]) & (ts < cuts[1]), (ts >= cuts[1]) | ts.isNull())):
        events.where(part).write.parquet(f"{base}/events/run={i}")
        s = spark.readStream.schema(events.schema).option("recursiveFileLookup", True).parquet(f"{base}/events")
        quota_breaches(envelopes_from_events(s, TZ), F.col("event_id"), BREACH_LIMIT, tz=TZ).writeStream.format("parquet") \
            .option("checkpointLocation", f"{base}/checkpoint").outputMode("append").trigger(availableNow=True) \
            .start(f"{base}/out").awaitTermination()
    return spark.read.parquet(f"{base}/out").select("agency", "day", F.col("call_id").alias("event_id"))


ORACLE["q_stream_breach"] = with_feed("""
SELECT agency, day, event_id FROM (
  SELECT agency, day, event_id, row_number() OVER (PARTITION BY agency, day ORDER BY ts, event_id) AS n FROM feed) WHERE n = 21""")


@register
def q_stream_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-09: running calls per (agency, local day) on the events stream; each
    micro-batch's complete result replaces the published table."""
    base = shared_dir(spark, "q_stream_quota")
    s = envelopes_from_events(events_stream(spark, sf_dir), TZ)
    out = f"{base}/out"

    def publish(batch: DataFrame, _epoch: int) -> None:
        batch.withColumn("breached", F.col("calls") > 10_000).write.mode("overwrite").parquet(out)

    q = (daily_calls(s).writeStream.outputMode("complete").foreachBatch(publish)
         .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out).select("agency", "day", F.col("calls").cast("bigint").alias("calls"), "breached")


ORACLE["q_stream_quota"] = with_feed("""
SELECT agency, day, count(*) AS calls, count(*) > 10000 AS breached FROM feed GROUP BY agency, day""")


@register
def q_schedule_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-05/06, IDN-08..10, SNK-03 as one job (``jobs.update_schedule``): two
    pulls of a package — ``nation`` at 2024-01-01, then ``nation`` with every fourth
    name changed plus a new ``region`` table at 2024-02-01 — folded into stored
    cumulative tables; unchanged rows span both pulls, changed rows split in two."""
    from feedlake.functions.scalars import iso_local
    from feedlake.jobs import update_schedule
    from feedlake.sources.gtfs import gtfs_package_tables as list_tables
    base = shared_dir(spark, "q_schedule_update")
    nat = read_table(spark, sf_dir, "nation")
    reg = read_table(spark, sf_dir, "region")
    pull1 = {"nation": nat.select(F.col("n_nationkey").alias("nation_id"), F.col("n_name").alias("nation_name"),
                                  F.col("n_regionkey").alias("region_id"))}
    pull2 = {"nation": nat.select(F.col("n_nationkey").alias("nation_id"),
                                  F.when(F.col("n_nationkey") % 4 == 0, F.concat("n_name", F.lit("_v2")))
                                  .otherwise(F.col("n_name")).alias("nation_name"),
                                  F.col("n_regionkey").alias("region_id")),
             "region": reg.select(F.col("r_regionkey").alias("region_id"), F.col("r_name").alias("region_name"))}
    for i, (pull, local_time) in enumerate(((pull1, "2024-01-01 03:00:00"), (pull2, "2024-02-01 03:00:00"))):
        pkg = f"{base}/package{i}"
        for name, df in pull.items():
            df.write.mode("overwrite").option("header", True).csv(f"{pkg}/{name}.txt")
        update_schedule(spark, pkg, f"{base}/store", f"{base}/work{i}", "A0",
                        from_local(F.lit(local_time).cast("timestamp_ntz"), TZ))
    out = None
    for table in list_tables(spark, f"{base}/package1"):
        t = spark.read.parquet(f"{base}/store/{table}")
        key, name = (("nation_id", "nation_name") if table == "nation" else ("region_id", "region_name"))
        part = t.select(F.lit(table).alias("table_name"), F.col(key).alias("row_key"), F.col(name).alias("name"),
                        "hash_id", iso_local("first_logged", TZ).alias("first_logged"),
                        iso_local("last_logged", TZ).alias("last_logged"))
        out = part if out is None else out.unionByName(part)
    return out


def _nation_hash(name_expr: str) -> str:
    return ("sha256('{\"row\":' || CAST(json_object('nation_id', CAST(n_nationkey AS VARCHAR), 'nation_name', "
            + name_expr + ", 'region_id', CAST(n_regionkey AS VARCHAR)) AS VARCHAR) || ',\"table\":\"nation\"}')")


ORACLE["q_schedule_update"] = f"""
WITH p AS (
  SELECT 'nation' AS table_name, CAST(n_nationkey AS VARCHAR) AS row_key, n_name AS name, {_nation_hash('n_name')} AS hash_id,
         1 AS pull FROM nation
  UNION ALL
  SELECT 'nation', CAST(n_nationkey AS VARCHAR), CASE WHEN n_nationkey % 4 = 0 THEN n_name || '_v2' ELSE n_name END,
         {_nation_hash("CASE WHEN n_nationkey % 4 = 0 THEN n_name || '_v2' ELSE n_name END")}, 2 FROM nation
  UNION ALL
  SELECT 'region', CAST(r_regionkey AS VARCHAR), r_name,
         sha256('{{"row":' || CAST(json_object('region_id', CAST(r_regionkey AS VARCHAR), 'region_name', r_name) AS VARCHAR)
                || ',"table":"region"}}'), 2 FROM region)
SELECT table_name, row_key, name, hash_id,
       CASE WHEN min(pull) = 1 THEN '2024-01-01T03:00:00-0500' ELSE '2024-02-01T03:00:00-0500' END AS first_logged,
       CASE WHEN max(pull) = 2 THEN '2024-02-01T03:00:00-0500' ELSE '2024-01-01T03:00:00-0500' END AS last_logged
FROM p GROUP BY table_name, row_key, name, hash_id"""
