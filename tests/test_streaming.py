"""Streaming: availableNow equals batch; a restart from the checkpoint neither
loses nor repeats rows."""

from pyspark.sql import functions as F

from feedlake.plans.feeds import envelopes_from_events
from feedlake.session import shared_dir
from feedlake.sources.tables import read_table
from feedlake.streaming.ingest import start_ingest, stateful_dedupe

SF = "/root/testdata/sf0.001"


def test_restart_from_checkpoint(spark):
    base = shared_dir(spark, "test_restart")
    ev = read_table(spark, SF, "events")
    first, second = ev.filter(F.col("event_id") % 2 == 0), ev.filter(F.col("event_id") % 2 == 1)
    first.write.parquet(f"{base}/in/part=0")
    schema = ev.schema

    def run():
        src = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{base}/in")
        s = envelopes_from_events(src).select("agency", "stream", "day", "hash_id", "ts")
        q = start_ingest(stateful_dedupe(s), f"{base}/out", f"{base}/ckpt")
        q.awaitTermination()

    run()
    second.write.parquet(f"{base}/in/part=1")
    run()
    run()  # nothing new: must not repeat rows
    got = spark.read.parquet(f"{base}/out").select("agency", "stream", "day", "hash_id")
    want = envelopes_from_events(ev).select("agency", "stream", "day", "hash_id").distinct()
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_live_path_stream_landing_to_archive(spark):
    """STR-01/02/04: events stream -> JSON-lines landing -> incremental sweep -> archive."""
    from feedlake.functions.scalars import from_local
    from feedlake.jobs import archive_sweep, ingest_stream
    from feedlake.plans.feeds import events_stream
    from feedlake.sources.wal import read_archive
    base = shared_dir(spark, "test_live_path")
    env = envelopes_from_events(events_stream(spark, SF))
    q = ingest_stream(env, f"{base}/landing", f"{base}/ckpt", available_now=True)
    q.awaitTermination()
    as_of = from_local(F.lit("2024-01-20 12:00:00").cast("timestamp_ntz"))
    assert archive_sweep(spark, f"{base}/landing", f"{base}/archive", as_of) > 0
    assert archive_sweep(spark, f"{base}/landing", f"{base}/archive", as_of) == 0
    got = read_archive(spark, f"{base}/archive").select("agency", "stream", "day", "hash_id")
    want = envelopes_from_events(read_table(spark, SF, "events")) \
        .filter(F.col("day") < F.lit("2024-01-20").cast("date")).select("agency", "stream", "day", "hash_id").distinct()
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_stateless_quota_monitor_matches_exact(spark):
    """STR-09/10: counts appended by batch give the exact counts, with late days and replays."""
    from feedlake.plans.feeds import events_stream
    from feedlake.streaming.changes import append_call_counts, current_calls
    base = shared_dir(spark, "test_quota")
    s = envelopes_from_events(events_stream(spark, SF))
    q = (s.writeStream.foreachBatch(append_call_counts(f"{base}/log"))
         .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    spark.read.parquet(f"{base}/log").write.mode("append").parquet(f"{base}/log")  # a replay of every batch
    got = current_calls(spark.read.parquet(f"{base}/log"))
    want = envelopes_from_events(read_table(spark, SF, "events")).groupBy("agency", "day").count() \
        .withColumnRenamed("count", "calls")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select("agency", "day", "calls").collect()))


def test_new_checkpoint_takes_its_history_from_archive_and_landing(spark):
    """STR-02: a stream that starts anew, whole feed delivered again, admits nothing twice: closed
    days are known from the archive, open ones from the landing; a null stream is matched too."""
    from feedlake.functions.scalars import from_local
    from feedlake.jobs import archive_sweep, ingest_stream
    from feedlake.plans.feeds import events_stream
    from feedlake.sources.wal import read_archive, read_wal
    base = shared_dir(spark, "test_history")
    env = envelopes_from_events(events_stream(spark, SF)).withColumn("stream", F.expr("nullif(stream, 'error')"))
    as_of = from_local(F.lit("2024-01-20 12:00:00").cast("timestamp_ntz"))

    def run(checkpoint):
        ingest_stream(env, f"{base}/landing", f"{base}/{checkpoint}", available_now=True, archive_root=f"{base}/archive").awaitTermination()
        return read_wal(spark, f"{base}/landing").count()

    first = run("one")  # neither archive nor landing yet
    assert archive_sweep(spark, f"{base}/landing", f"{base}/archive", as_of) > 0
    held = read_archive(spark, f"{base}/archive").count()
    assert run("two") + held == first and run("two") + held == first and run("three") + held == first


def _run(spark, df, base):
    df.writeStream.format("parquet").option("checkpointLocation", f"{base}/ckpt").outputMode("append") \
        .trigger(availableNow=True).start(f"{base}/out").awaitTermination()


def test_detour_memory_late_polls_gaps_and_expiry(spark):
    """STR-08: late polls are told apart, a gap makes a route new, and a route that is not polled
    for the retirement time loses its state."""
    from feedlake.streaming.changes import detour_changes
    base = shared_dir(spark, "test_detours")
    schema = "agency string, id string, day date, detours string"
    batches = [[("A", "1", "2024-01-01", "x"), ("A", "2", "2024-01-01", "y"), ("A", "1", "2024-01-02", "x")],
               [("A", "1", "2024-01-05", "x"), ("A", "1", "2024-01-03", "z"), ("A", None, "2024-01-05", None)],
               [("A", "1", "2024-02-20", "x"), ("A", "1", "2024-01-04", "w")], [("A", "1", "2024-02-21", "x"), ("A", "2", "2024-02-21", "y")]]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, "agency string, id string, d string, detours string") \
            .selectExpr("agency", "id", "cast(d as date) day", "detours").write.parquet(f"{base}/in/n={i}")
        src = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(f"{base}/in")
        _run(spark, detour_changes(src, retire_days=20), base)
    got = sorted((r.id or "", str(r.day), r.detours, r.late) for r in spark.read.parquet(f"{base}/out").collect())
    # Route 2 had lost its state, so its old set is new; route 1 was polled in time.
    assert got == [("", "2024-01-05", None, False), ("1", "2024-01-01", "x", False), ("1", "2024-01-03", "z", False),
                   ("1", "2024-01-04", "w", True), ("1", "2024-01-05", "x", False), ("2", "2024-01-01", "y", False),
                   ("2", "2024-02-21", "y", False)]


def test_breach_is_told_once_over_restarts(spark):
    """STR-09: the call that first exceeds the quota, one event per agency-day over micro-batches
    and restarts; calls of a day that the watermark has closed are left out."""
    from feedlake.streaming.changes import quota_breaches
    base = shared_dir(spark, "test_breach")
    calls = [[(i, "A", f"2024-01-05 10:00:{i:02d}") for i in range(4)] + [(50, "B", "2024-01-05 23:00:00")],
             [(i, "A", f"2024-01-05 11:00:{i:02d}") for i in range(10, 14)], [(i, "A", f"2024-01-05 12:00:{i:02d}") for i in range(20, 30)],
             [(60 + i, "B", f"2024-01-06 08:00:{i:02d}") for i in range(7)], [(70, "C", "2024-01-20 08:00:00")],
             [(80 + i, "A", f"2024-01-05 13:00:{i:02d}") for i in range(9)]]
    for i, rows in enumerate(calls):
        spark.createDataFrame(rows, "call bigint, agency string, t string") \
            .selectExpr("call", "agency", "cast(t as timestamp) ts").write.parquet(f"{base}/in/n={i}")
        s = spark.readStream.schema("call bigint, agency string, ts timestamp").option("recursiveFileLookup", True).parquet(f"{base}/in")
        _run(spark, quota_breaches(s.withColumn("day", F.to_date("ts")), F.col("call"), limit=5, tz="UTC"), base)
    got = sorted((r.agency, str(r.day), r.call_id, r.quota) for r in spark.read.parquet(f"{base}/out").collect())
    assert got == [("A", "2024-01-05", 11, 5), ("B", "2024-01-06", 65, 5)]


def test_keyed_state_in_a_session_with_the_default_state_store(spark):
    """STR-08/09: a session without RocksDB as its state store (Spark's default) runs both monitors;
    polls without a day and calls without a time are told too."""
    from feedlake.session import STATE_STORE, STATE_STORES
    from feedlake.streaming.changes import detour_changes, quota_breaches
    s = spark.newSession()
    s.conf.set("spark.sql.session.timeZone", "UTC")
    s.conf.set("spark.sql.shuffle.partitions", "2")
    s.conf.set(STATE_STORE, f"{STATE_STORES}HDFSBackedStateStoreProvider")
    base = shared_dir(spark, "test_default_store")
    polls = [("A", "1", "2024-01-01", "x"), ("A", "1", "2024-01-02", "x"), ("A", "1", None, "y"), ("B", "2", None, "z")]
    s.createDataFrame(polls, "agency string, id string, d string, detours string") \
        .selectExpr("agency", "id", "cast(d as date) day", "detours").write.parquet(f"{base}/polls")
    src = s.readStream.schema("agency string, id string, day date, detours string").parquet(f"{base}/polls")
    _run(s, detour_changes(src), f"{base}/detours")
    got = sorted((r.id, str(r.day), r.detours, r.late) for r in s.read.parquet(f"{base}/detours/out").collect())
    assert got == [("1", "2024-01-01", "x", False), ("1", "None", "y", False), ("2", "None", "z", False)]
    s.conf.set(STATE_STORE, f"{STATE_STORES}HDFSBackedStateStoreProvider")
    calls = [(i, "A", f"2024-01-05 10:00:{i:02d}") for i in range(4)] + [(i, "B", None) for i in range(5, 9)]
    s.createDataFrame(calls, "call bigint, agency string, t string") \
        .selectExpr("call", "agency", "cast(t as timestamp) ts").write.parquet(f"{base}/calls")
    src = s.readStream.schema("call bigint, agency string, ts timestamp").parquet(f"{base}/calls")
    _run(s, quota_breaches(src.withColumn("day", F.to_date("ts")), F.col("call"), limit=2, tz="UTC"), f"{base}/breach")
    got = sorted((r.agency, str(r.day), r.call_id) for r in s.read.parquet(f"{base}/breach/out").collect())
    assert got == [("A", "2024-01-05", 2), ("B", "None", 7)]
