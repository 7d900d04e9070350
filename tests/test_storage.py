import datetime as dt

from pyspark.sql import functions as F

from feedlake.functions.scalars import from_local
from feedlake.operators.monitor import countable_rows, first_breach, rows_per_file
from feedlake.plans.feeds import feed_envelopes
from feedlake.session import shared_dir
from feedlake.sinks.archive import compact_days, error_rows, wal_append
from feedlake.sources import passio
from feedlake.sources.gtfs import PANDAS_NULL_TOKENS, read_gtfs_table
from feedlake.sources.wal import read_archive, read_wal, read_wal_files

SF = "/root/testdata/sf0.001"


def _as_of():
    return from_local(F.lit("2024-01-20 12:00:00").cast("timestamp_ntz"))


def test_compaction_idempotent_and_late_rows(spark):
    base = shared_dir(spark, "test_compact")
    env = feed_envelopes(spark, SF)
    wal_append(env, f"{base}/landing")
    kw = dict(landing_root=f"{base}/landing", log_root=f"{base}/log")
    n1 = compact_days(spark, read_wal(spark, f"{base}/landing"), f"{base}/archive", _as_of(), **kw)
    first = sorted(map(tuple, read_archive(spark, f"{base}/archive").select("hash_id", "day", "agency", "stream").collect()))
    n2 = compact_days(spark, read_wal(spark, f"{base}/landing"), f"{base}/archive", _as_of(), **kw)
    again = sorted(map(tuple, read_archive(spark, f"{base}/archive").select("hash_id", "day", "agency", "stream").collect()))
    assert n1 > 0 and n2 == 0 and first == again
    want = env.filter(F.col("day") < F.lit("2024-01-20").cast("date")).select("hash_id", "day", "agency", "stream").distinct()
    assert len(first) == want.count()
    # a late re-delivery of already archived days changes nothing
    wal_append(env.filter(F.col("day") == F.lit("2024-01-05").cast("date")), f"{base}/landing")
    n3 = compact_days(spark, read_wal(spark, f"{base}/landing"), f"{base}/archive", _as_of(), **kw)
    late = sorted(map(tuple, read_archive(spark, f"{base}/archive").select("hash_id", "day", "agency", "stream").collect()))
    assert n3 > 0 and late == first
    # coverage totals equal archive counts
    cov = read_archive(spark, f"{base}/archive").groupBy("agency", "day").count().agg(F.sum("count")).first()[0]
    assert cov == len(first)


def test_read_wal_files_from_names(spark, tmp_path):
    d = tmp_path / "events"
    d.mkdir()
    (d / "MBTA_vehicles_enhanced_01312024.jsonl").write_text(
        '{"hash_id":"h1","ts":"2024-01-31T10:00:00.123456-05:00","event":"update","id":"0123","data":{"a":1}}\n'
        'not json\n')
    (d / "MBTA_Errors_01312024.jsonl").write_text(
        '{"hash_id":"h2","ts":"2024-01-31 10:00:00","event":"error","data":{"message":"x"}}\n')
    rows = read_wal_files(spark, str(d)).orderBy("hash_id").collect()
    ok = [r for r in rows if r.hash_id]
    assert [(r.agency, r.stream, r.day) for r in ok] == [("MBTA", "vehicles_enhanced", dt.date(2024, 1, 31)),
                                                         ("MBTA", "Errors", dt.date(2024, 1, 31))]
    assert ok[0].id == "0123" and ok[0].data == '{"a":1}'
    assert ok[0].ts == dt.datetime(2024, 1, 31, 15, 0, 0, 123456) and ok[1].ts == dt.datetime(2024, 1, 31, 15, 0)
    assert sum(1 for r in rows if r._corrupt) == 1


def test_gtfs_csv_edges(spark, tmp_path):
    p = tmp_path / "stops.txt"
    p.write_text('﻿stop_id,stop_name,zone,empty\n0123,"Main St, North",NA,\n0123,"Main St, North",NA,\n',
                 encoding="utf-8")
    df = read_gtfs_table(spark, str(p), "stops", null_tokens=PANDAS_NULL_TOKENS)
    assert df.columns == ["stop_id", "stop_name", "zone", "empty"]
    r = df.collect()
    assert len(r) == 2 and r[0].stop_id == "0123" and r[0].stop_name == "Main St, North" and r[0].zone is None
    plain = read_gtfs_table(spark, str(p), "stops")
    assert plain.first().zone == "NA"


def test_monitor_helpers(spark):
    df = spark.createDataFrame([("A", "x"), ("A", "Errors"), (None, "x"), ("B", "y")], "agency string, stream string")
    assert countable_rows(df).count() == 2 and countable_rows(df, ["y"]).count() == 1
    calls = spark.createDataFrame([("A", d, i) for d in (1, 2) for i in range(5)], "agency string, day int, i int")
    fb = first_breach(calls, ["agency", "day"], ["i"], limit=3).collect()
    assert sorted((r.day, r.i) for r in fb) == [(1, 3), (2, 3)]
    ev = spark.read.parquet(f"{SF}/events.parquet")
    assert rows_per_file(ev).agg(F.sum("rows")).first()[0] == ev.count()


def test_error_rows(spark):
    df = spark.createDataFrame([(1, "A", "boom", dt.datetime(2024, 1, 1, 15, 0))], "k int, a string, m string, ts timestamp_ntz")
    r = error_rows(df, F.col("a"), F.col("m"), F.col("ts"), keep=["k"]).first()
    assert (r.k, r.stream, r.event, r.ts_raw, r.data, r.day) == (1, "Errors", "error", "2024-01-01 10:00:00",
                                                                '{"message":"boom"}', dt.date(2024, 1, 1))


def test_passio_shapes(spark):
    docs = spark.createDataFrame([
        ('{"7":{"routes":{"r1":{"myid":"5","name":"a"},"r2":{"routeId":"9"},"r3":"x"}}}',),
        ('{"routes":[{"id":"1"}]}',), ("{}",)], "b string")
    out = [[F_ for F_ in r[0]] for r in docs.select(
        F.transform(passio.passio_items(F.try_parse_json("b"), "routes"), lambda x: F.to_json(x))).collect()]
    assert out[0] == ['{"_PASSIOGO_dict_key":"r1","myid":"5","name":"a"}', '{"routeId":"9"}', '{"_key":"r3","value":"x"}']
    assert out[1] == ['{"id":"1"}'] and out[2] == []
    b = spark.createDataFrame([('{"buses":{"a":[{"busId":1},5],"b":"x","c":[{"busId":2}]}}',)], "b string")
    assert b.select(F.size(passio.bus_map(F.try_parse_json("b")))).first()[0] == 2
    e = spark.createDataFrame([('{"ETAs":{"s1":[{"eta":3,"error":"e"},7],"s2":"none"}}',)], "b string")
    etas = e.select(F.transform(passio.eta_map(F.try_parse_json("b")), lambda x: F.to_json(x))).first()[0]
    assert list(etas) == ['{"_parent_stop_id":"s1","eta":3}']


def test_zip_package_landing(spark, tmp_path):
    import zipfile
    from feedlake.sources.gtfs import land_zip_packages, landed_tables
    z = tmp_path / "MBTA_gtfs.zip"
    with zipfile.ZipFile(z, "w") as zf:
        zf.writestr("stops.txt", "stop_id,stop_name\n0123,\"Main St, North\"\n7,Elm\n")
        zf.writestr("feed/routes.txt", "route_id\nR1\n")
        zf.writestr("readme.md", "x")
    out = str(tmp_path / "landed")
    land_zip_packages(spark, str(z), out)
    assert landed_tables(spark, out, "MBTA_gtfs") == ["routes", "stops"]
    stops = read_gtfs_table(spark, f"{out}/package=MBTA_gtfs/table=stops", "stops").collect()
    assert [(r.stop_id, r.stop_name) for r in stops] == [("0123", "Main St, North"), ("7", "Elm")]


def test_hot_folder_is_written_by_several_tasks(spark):
    """One stream-day of many rows lands and is archived by several tasks (SNK-01/02)."""
    base = shared_dir(spark, "test_hot")
    env = spark.range(40_000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("hash_id"), F.lit("2024-01-02 10:00:00").cast("timestamp_ntz").alias("ts"),
        F.lit("A").alias("agency"), F.lit("s").alias("stream"), F.lit("").alias("endpoint"), F.lit("update").alias("event"),
        F.col("id").cast("string").alias("id"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 4).alias("data"),
        F.lit(None).cast("string").alias("metadata"), F.lit("2024-01-02").cast("date").alias("day"))
    wal_append(env, f"{base}/landing", rows_per_writer=10_000)
    compact_days(spark, read_wal(spark, f"{base}/landing"), f"{base}/archive", _as_of(), landing_root=f"{base}/landing",
                 log_root=f"{base}/log", bytes_per_writer=1 << 20)
    for fmt, path in (("text", "landing"), ("parquet", "archive")):
        files = spark.read.format(fmt).load(f"{base}/{path}").select(F.input_file_name().alias("f")).distinct().count()
        assert files > 1
    assert read_archive(spark, f"{base}/archive").count() == 40_000


def test_content_survives_and_old_archives_merge(spark):
    """Text payloads, repeated keys, metadata, broken lines, a null stream and a numeric agency
    reach the archive; rows of an archive without ``ts_raw`` stay; an unreadable one stops the job."""
    import pytest
    base = shared_dir(spark, "test_content")
    texts = ["plain, text", '{"a":1,"a":2}', '{"b":[1,2]}', "123", '"quoted"', None, "line\nbreak"]
    env = spark.createDataFrame(
        [(f"h{i}", dt.datetime(2024, 1, 2, 15, i), "007", None if i == 2 else "s", "ep", "update", str(i), t,
          '{"route":"1"}' if i % 2 else None, dt.date(2024, 1, 2)) for i, t in enumerate(texts)],
        "hash_id string, ts timestamp_ntz, agency string, stream string, endpoint string, event string, id string, "
        "data string, metadata string, day date")
    old = env.limit(1).drop("ts_raw", "endpoint", "metadata").withColumn("hash_id", F.lit("old1"))
    old.write.partitionBy("agency", "stream", "day").parquet(f"{base}/archive")
    wal_append(env, f"{base}/landing")
    spark.createDataFrame([("not json at all", "007", "s", dt.date(2024, 1, 2)), ('{"cut', "007", "s", dt.date(2024, 1, 2))],
                          "value string, agency string, stream string, day date") \
        .write.mode("append").partitionBy("agency", "stream", "day").text(f"{base}/landing")
    kw = dict(landing_root=f"{base}/landing", log_root=f"{base}/log", remove_source=True)
    for _ in range(2):
        compact_days(spark, read_wal(spark, f"{base}/landing"), f"{base}/archive", _as_of(), **kw)
        got = {r.hash_id: r for r in read_archive(spark, f"{base}/archive").collect() if r.stream != "Errors"}
        assert {h: (r.agency, r.stream, r.data, r.metadata, r.endpoint, r.id) for h, r in got.items() if h != "old1"} == {
            f"h{i}": ("007", None if i == 2 else "s", t, '{"route":"1"}' if i % 2 else None, "ep", str(i))
            for i, t in enumerate(texts)}
        assert got["old1"].data == texts[0]
        errors = read_archive(spark, f"{base}/archive").filter("stream = 'Errors'").collect()
        assert sorted(r.data for r in errors) == ['{"message":"unparsable line in s: not json at all"}',
                                                  '{"message":"unparsable line in s: {\\"cut"}']
    assert spark.read.parquet(f"{base}/log").agg(F.max("folder_rows")).first()[0] == 7
    wal_append(env.limit(1).withColumn("hash_id", F.lit("h9")), f"{base}/landing")
    (open(next(iter(spark.read.parquet(f"{base}/archive").filter("stream = 's'").select(F.input_file_name()).first()))
          .removeprefix("file://").replace("file:", ""), "wb")).write(b"broken")
    with pytest.raises(Exception):  # noqa: B017 - whatever the reader says, the job must stop
        compact_days(spark, read_wal(spark, f"{base}/landing"), f"{base}/archive", _as_of(), **kw)


def test_same_clock_tick_is_not_lost(spark):
    """A file with the time of one already compacted is still picked up (STR-04)."""
    base = shared_dir(spark, "test_tick")
    env = feed_envelopes(spark, SF).filter(F.col("day") == F.lit("2024-01-05").cast("date"))
    kw = dict(landing_root=f"{base}/landing", log_root=f"{base}/log")
    halves = [env.filter(F.col("event_id") % 2 == k) for k in range(2)]
    wal_append(halves[0], f"{base}/landing")
    compact_days(spark, read_wal(spark, f"{base}/landing"), f"{base}/archive", _as_of(), **kw)
    wal_append(halves[1], f"{base}/landing")
    spark.read.parquet(f"{base}/log").withColumn("landed_at", F.current_timestamp()).write.parquet(f"{base}/log2")
    kw["log_root"] = f"{base}/log2"  # every logged time is later than the new files'
    compact_days(spark, read_wal(spark, f"{base}/landing"), f"{base}/archive", _as_of(), **kw)
    assert read_archive(spark, f"{base}/archive").select("hash_id").distinct().count() == env.select("hash_id").distinct().count()


def test_header_only_table_is_skipped(spark, tmp_path):
    from feedlake.jobs import update_schedule
    for name, text in (("agency", "agency_id,agency_name\n"), ("stops", "stop_id,stop_name\n1,Elm\n")):
        (tmp_path / f"{name}.txt").write_text(text)
    done = update_schedule(spark, str(tmp_path), f"{tmp_path}/store", f"{tmp_path}/work", "A",
                           from_local(F.lit("2024-01-01 03:00:00").cast("timestamp_ntz")))
    assert done == ["stops"] and spark.read.parquet(f"{tmp_path}/store/stops").count() == 1


def test_a_cluster_session_needs_a_shared_folder(spark, monkeypatch):
    import pytest
    from feedlake import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session(), "x")
