import datetime as dt

from pyspark.sql import functions as F

from feedlake.operators import history as H
from feedlake.operators import ids as ID
from feedlake.operators import windows as W
from feedlake.operators.dedupe import dedupe_events
from feedlake.operators.filters import reject_html
from feedlake.operators.lookups import active_only, changed_sets, parse_catalog
from feedlake.operators.monitor import classify_bustime, service_window
from feedlake.operators.projections import align_schema, derive_occupancy

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


def env(spark, rows):
    return spark.createDataFrame(rows, "agency string, stream string, day date, hash_id string, ts timestamp_ntz, v int")


def test_dedupe_keeps_first_and_is_idempotent(spark):
    d = dt.date(2024, 1, 1)
    df = env(spark, [("A", "s", d, "h1", T0 + dt.timedelta(seconds=5), 2), ("A", "s", d, "h1", T0, 1),
                     ("A", "s", d, "h2", T0, 3), ("A", "s", dt.date(2024, 1, 2), "h1", T0 + dt.timedelta(days=1), 4)])
    once = dedupe_events(df, order=("ts",))
    assert sorted(r.v for r in once.collect()) == [1, 3, 4]
    twice = dedupe_events(once, order=("ts",))
    assert sorted(r.v for r in twice.collect()) == [1, 3, 4]
    assert sorted(r.v for r in dedupe_events(df, scope="all", order=("ts",)).collect()) == [1, 3]


def test_merge_snapshots_twice_is_stable(spark):
    t1, t2 = F.lit("2024-01-01 08:00:00").cast("timestamp_ntz"), F.lit("2024-02-01 08:00:00").cast("timestamp_ntz")
    a = spark.createDataFrame([("1", "x"), ("2", "y")], "id string, name string")
    b = spark.createDataFrame([("2", "y", None), ("3", "z", None)], "id string, name string, extra string")
    old = H.prepare_snapshot(a, "t", t1, ignore_null_columns=True)
    m1 = H.merge_snapshots(old, H.prepare_snapshot(b, "t", t2, ignore_null_columns=True), "t", t2, True)
    rows = {r.id: (r.first_logged, r.last_logged) for r in m1.collect()}
    assert rows["2"] == (dt.datetime(2024, 1, 1, 8), dt.datetime(2024, 2, 1, 8))
    assert rows["1"][1] == dt.datetime(2024, 1, 1, 8) and rows["3"][0] == dt.datetime(2024, 2, 1, 8)
    m2 = H.merge_snapshots(m1, H.prepare_snapshot(b, "t", t2, ignore_null_columns=True), "t", t2, True)
    assert sorted(map(tuple, m2.select("hash_id", "first_logged", "last_logged").collect())) == \
        sorted(map(tuple, m1.select("hash_id", "first_logged", "last_logged").collect()))


def test_merge_backfills_missing_hash_and_text_dates(spark):
    t = F.lit("2024-03-01 05:00:00").cast("timestamp_ntz")
    stored = spark.createDataFrame([("1", "x", "01312024", None)], "id string, name string, first_logged string, "
                                   "last_logged string")
    new = H.prepare_snapshot(spark.createDataFrame([("1", "x")], "id string, name string"), "t", t)
    m = H.merge_snapshots(stored, new, "t", t).collect()
    assert len(m) == 1
    assert m[0].first_logged == dt.datetime(2024, 1, 31, 5) and m[0].last_logged == dt.datetime(2024, 3, 1, 5)


def test_point_in_time(spark):
    h = spark.createDataFrame([("a", T0, T0 + dt.timedelta(days=2)), ("b", T0 + dt.timedelta(days=3), T0 + dt.timedelta(days=4))],
                              "hash_id string, first_logged timestamp_ntz, last_logged timestamp_ntz")
    assert [r.hash_id for r in H.point_in_time(h, F.lit(T0 + dt.timedelta(days=1))).collect()] == ["a"]


def test_upsert_modes(spark):
    s = "agency string, kind string, id string, first_seen timestamp_ntz, last_seen timestamp_ntz"
    old = spark.createDataFrame([("A", "route", "1", T0, T0), ("A", "stop", "9", T0, T0)], s)
    t1 = T0 + dt.timedelta(days=1)
    new = spark.createDataFrame([("A", "route", "1", t1, t1), ("A", "route", "2", t1, t1), ("A", "route", " ", t1, t1)], s)
    rep = {(r.kind, r.id) for r in ID.upsert_ids(old, new, "replace").collect()}
    assert rep == {("route", "1"), ("route", "2")}
    rne = {(r.kind, r.id) for r in ID.upsert_ids(old, new, "replace_nonempty").collect()}
    assert rne == {("route", "1"), ("route", "2"), ("stop", "9")}
    acc = {(r.kind, r.id): (r.first_seen, r.last_seen) for r in ID.upsert_ids(old, new, "accumulate").collect()}
    assert acc[("route", "1")] == (T0, t1) and ("stop", "9") in acc


def test_detour_routes_shapes(spark):
    df = spark.createDataFrame([('"7"',), ('["7","8"]',), ('[{"rt":"9"}]',), ("null",)], "j string")
    out = [r[0] for r in df.select(ID.detour_routes(F.try_parse_json("j"))).collect()]
    assert out == [["7"], ["7", "8"], ["9"], []]


def test_valid_route_id(spark):
    df = spark.createDataFrame([("0",), ("00",), ("",), (" ",), ("12",), ("A0",)], "r string")
    assert [r.r for r in df.filter(ID.valid_route_id("r")).collect()] == ["12", "A0"]


def test_failure_streaks_reset_by_success(spark):
    rows = [(i, ok) for i, ok in enumerate([True, False, False, False, True, False, False, False, False, False])]
    df = spark.createDataFrame(rows, "i int, ok boolean").withColumn("k", F.lit(1))
    s = W.failure_streaks(df, ["k"], ["i"], ~F.col("ok")).orderBy("i").collect()
    assert [r.streak for r in s] == [None, 1, 2, 3, None, 1, 2, 3, 4, 5]
    assert [r.cooldown_s for r in s if r.streak] == [30, 60, 120, 30, 60, 120, 240, 300]
    assert [r.reconnect_s for r in s if r.streak][-1] == 60


def test_batches_and_top_k(spark):
    ids = spark.createDataFrame([("A", i) for i in range(1, 8)], "g string, id int")
    b = W.batches(ids, ["g"], "id", 3).orderBy("batch_no").collect()
    assert [r.ids for r in b] == ["1,2,3", "4,5,6", "7"]
    df = spark.createDataFrame([("A", d % 3, d) for d in range(20)], "g string, day int, v int")
    top = W.top_k(df, ["g"], [F.col("v").desc()], 4, split_by=["day"]).orderBy("rank").collect()
    assert [r.v for r in top] == [19, 18, 17, 16]


def test_state_transitions_and_unavailable(spark):
    df = spark.createDataFrame([(1, "A"), (2, "A"), (3, "B"), (4, "B"), (5, "A")], "t int, s string") \
        .withColumn("k", F.lit(1))
    assert [r.t for r in W.state_transitions(df, ["k"], ["t"], "s").orderBy("t").collect()] == [1, 3, 5]
    ev = spark.createDataFrame([(T0, True), (T0 + dt.timedelta(hours=1), True), (T0 + dt.timedelta(hours=13), True)],
                               "ts timestamp_ntz, err boolean").withColumn("k", F.lit(1))
    u = W.unavailable_marks(ev, ["k"], "ts", ["ts"], F.col("err")).orderBy("ts").collect()
    assert [(r.unavailable, r.reported) for r in u] == [(False, True), (True, False), (False, True)]


def test_reject_html_and_classify(spark):
    bodies = spark.createDataFrame([("<!DOCTYPE html><p>",), ("x<title>Request Rejected</title>",), ('{"a":1}',),
                                    ("plain",), ("  ",)], "body string")
    out = [(r.outcome, r.payload) for r in reject_html(bodies).collect()]
    assert out == [("rejected", None), ("rejected", None), ("json", '{"a":1}'), ("text", '{"data":"plain"}'),
                   ("empty", None)]
    docs = spark.createDataFrame([
        ('{"bustime-response":{"error":[{"msg":"Function does not support"}]}}',),
        ('{"bustime-response":{"error":{"msg":"No RTPI Data Feed parameter provided"}}}',),
        ('{"bustime-response":{"error":[{"msg":"No arrival times"}]}}',),
        ('{"bustime-response":{"error":[{"msg":"Key invalid"}]}}',),
        ('{"bustime-response":{"vehicle":[]}}',)], "b string")
    assert [r[0] for r in docs.select(classify_bustime(F.try_parse_json("b"))).collect()] == \
        ["UNSUPPORTED", "NEEDS_PARAM", "EMPTY", "ERROR", "OK"]


def test_occupancy_align_service_window(spark):
    df = spark.createDataFrame([("0",), ("0.1",), ("0.5",), ("0.8",), ("0.95",), ("x",), (None,), ("-1",)], "p string")
    assert [r[0] for r in df.select(derive_occupancy("p")).collect()] == [
        "EMPTY", "MANY_SEATS_AVAILABLE", "FEW_SEATS_AVAILABLE", "STANDING_ROOM_ONLY", "FULL", "NO_DATA_AVAILABLE",
        "NO_DATA_AVAILABLE", "MANY_SEATS_AVAILABLE"]
    from pyspark.sql import types as T
    raw = spark.createDataFrame([("1", "abc", "zzz")], "a string, b string, extra string")
    tgt = T.StructType([T.StructField("b", T.IntegerType()), T.StructField("a", T.LongType()),
                        T.StructField("c", T.StringType())])
    assert align_schema(raw, tgt).first().asDict() == {"b": None, "a": 1, "c": None}
    st = spark.createDataFrame([("A", "5:00:00", "25:30:00"), ("A", "", "abc"), ("B", "", "")],
                               "g string, arrival_time string, departure_time string")
    w = {r.g: (r.tmin_s, r.tmax_s, r.tmax_hms) for r in service_window(st, ["g"]).collect()}
    assert w["A"] == (18000, 91800, "01:30:00") and w["B"] == (None, None, None)


def test_lookups(spark):
    routes = spark.createDataFrame([("A", 1), ("A", 2), ("B", 3)], "g string, r int")
    active = spark.createDataFrame([("A", 2)], "g string, r int")
    assert sorted(tuple(x) for x in active_only(routes, active, "g", "r").collect()) == [("A", 2), ("B", 3)]
    new = spark.createDataFrame([("r1", ["b", "a"]), ("r2", ["x"]), ("r3", ["y"])], "k string, s array<string>")
    old = spark.createDataFrame([("r1", ["a", "b"]), ("r2", ["z"]), ("r4", ["q"])], "k string, s array<string>")
    assert sorted(r.k for r in changed_sets(new, old, "k", "s").collect()) == ["r2", "r3"]
    cat = spark.createDataFrame([("1: AB , 2:CD,, 3:, :E",)], "t string").select(F.explode(parse_catalog(F.col("t"))))
    assert [(r.col.key, r.col.value) for r in cat.collect()] == [("1", "AB"), ("2", "CD")]
    dup = spark.createDataFrame([("1:ab, 2:cd, 1:ef",)], "t string").select(F.explode(parse_catalog(F.col("t"))))
    assert sorted((r.col.key, r.col.value) for r in dup.collect()) == [("1", "EF"), ("2", "CD")]
    from feedlake.operators.projections import occupancy_payload
    buses = spark.createDataFrame([('{"paxLoad":0.5}',), ('{"paxLoad":0.5,"gtfsOccupancyStatus":null}',),
                                   ('{"gtfsOccupancyStatus":"FULL"}',), ('{"x":1}',)], "b string")
    assert [r[0] for r in buses.select(occupancy_payload(F.try_parse_json("b"))).collect()] == [
        "FEW_SEATS_AVAILABLE", None, "FULL", None]


def test_split_windows_equal_unsplit(spark):
    import random
    rnd = random.Random(7)
    rows = []
    for k in range(3):
        t = T0
        for i in range(300):
            t = t + dt.timedelta(minutes=rnd.choice([5, 30, 200, 700]))
            rows.append((k, i, t, t.date(), rnd.random() < 0.45, rnd.choice(["A", "B"])))
    df = spark.createDataFrame(rows, "k int, i int, ts timestamp_ntz, day date, bad boolean, s string")

    def norm(x, cols):
        return sorted(tuple(r) for r in x.select(*cols).collect())

    a = W.failure_streaks(df, ["k"], ["ts", "i"], F.col("bad"))
    b = W.failure_streaks(df, ["k"], ["ts", "i"], F.col("bad"), split_by=["day"])
    assert norm(a, ["k", "i", "streak", "cooldown_s"]) == norm(b, ["k", "i", "streak", "cooldown_s"])
    a = W.state_transitions(df, ["k"], ["ts", "i"], "s")
    b = W.state_transitions(df, ["k"], ["ts", "i"], "s", split_by=["day"])
    assert norm(a, ["k", "i", "prev_s"]) == norm(b, ["k", "i", "prev_s"])
    a = W.unavailable_marks(df, ["k"], "ts", ["ts", "i"], F.col("bad"))
    b = W.unavailable_marks(df, ["k"], "ts", ["ts", "i"], F.col("bad"), split_by=["day"])
    assert norm(a, ["k", "i", "unavailable", "reported"]) == norm(b, ["k", "i", "unavailable", "reported"])


def test_payload_helpers(spark):
    from feedlake.functions.scalars import parse_envelope_ts
    from feedlake.operators.projections import attach_key, stringify_payload, to_envelope
    df = spark.createDataFrame([('{"b":1,"a":2}',), ("[1,2]",), ("plain text",), (None,), ('"q"',)], "p string")
    assert [r[0] for r in df.select(stringify_payload("p")).collect()] == ['{"a":2,"b":1}', "[1,2]", "plain text",
                                                                             None, '"q"']
    items = spark.createDataFrame([('{"x":1}',), ("7",), ('{"_routeId":"keep"}',)], "j string")
    out = [r[0] for r in items.select(attach_key(F.try_parse_json("j"), "_routeId", F.lit("R1"))).collect()]
    assert out == ['{"_routeId":"R1","x":1}', '{"_routeId":"R1","raw":7}', '{"_routeId":"keep"}']
    ts = spark.createDataFrame([("2024-01-31T10:00:00-05:00",), ("2024-07-01 10:00:00",), ("bad",)], "t string")
    assert [r[0] for r in ts.select(parse_envelope_ts("t")).collect()] == [
        dt.datetime(2024, 1, 31, 15), dt.datetime(2024, 7, 1, 14), None]
    e = spark.createDataFrame([("A", "s", '{"k":1}', dt.datetime(2024, 1, 1, 3))],
                              "a string, s string, d string, ts timestamp_ntz")
    env = to_envelope(e, F.col("a"), F.col("s"), F.lit("update"), F.col("d"), ts=F.col("ts"), tz="America/New_York")
    r = env.first()
    assert r.day == dt.date(2023, 12, 31) and r.data == '{"k":1}' and r.metadata is None and len(r.hash_id) == 64


def test_merge_order_does_not_change_first_last(spark):
    t1, t2 = F.lit("2024-01-01 08:00:00").cast("timestamp_ntz"), F.lit("2024-02-01 08:00:00").cast("timestamp_ntz")
    a = H.prepare_snapshot(spark.createDataFrame([("1", "x"), ("2", "y")], "id string, name string"), "t", t1)
    b = H.prepare_snapshot(spark.createDataFrame([("2", "y"), ("3", "z")], "id string, name string"), "t", t2)
    ab = H.merge_snapshots(a, b, "t", t2).select("hash_id", "first_logged", "last_logged").collect()
    ba = H.merge_snapshots(b, a, "t", t2).select("hash_id", "first_logged", "last_logged").collect()
    assert sorted(map(tuple, ab)) == sorted(map(tuple, ba))


def test_id_extraction(spark):
    items = spark.createDataFrame([('{"vehicleId":"","id":"7"}',), ('"42"',), ("13",), ("1.5",), ('{"x":1}',),
                                   ('{"dtrid":"D9","rt":[{"rt":"5"},"",6]}',)], "j string")
    got = [r[0] for r in items.select(ID.id_from_keys(F.try_parse_json("j"), ["vehicleId", "id"])).collect()]
    assert got == ["7", "42", "13", None, None, None]
    r = items.select(ID.detour_id(F.try_parse_json("j")).alias("d"),
                     ID.detour_routes(F.try_variant_get(F.try_parse_json("j"), "$.rt", "variant")).alias("r")).collect()
    assert (r[-1].d, list(r[-1].r)) == ("D9", ["5", "6"])


def test_hour_grid_has_empty_days_and_hours_of_the_zone(spark):
    from feedlake.operators.monitor import hour_grid, hourly_audit
    rows = [("a", "2024-03-09 12:00:00"), ("a", "2024-03-09 12:59:59"), ("a", "2024-03-12 03:30:00"), ("b", "2024-11-03 05:30:00"),
            ("b", "2024-11-03 06:30:00"), (None, "2024-03-09 00:10:00")]
    df = spark.createDataFrame(rows, "s string, t string").selectExpr("s", "cast(t as timestamp_ntz) ts")
    per = {(r.s, str(r.day)): (r.hours_with_rows, r.hours_missing, r.rows)
           for r in hourly_audit(df, keys=("s",), tz="America/New_York", dense=True).collect()}
    assert per == {("a", "2024-03-09"): (1, 23, 2), ("a", "2024-03-10"): (0, 23, 0), ("a", "2024-03-11"): (1, 23, 1),
                   ("b", "2024-11-03"): (2, 23, 2), (None, "2024-03-08"): (1, 23, 1)}
    grid = hour_grid(df, keys=("s",), tz="America/New_York").collect()
    fall = [r for r in grid if r.s == "b"]
    assert len(fall) == 25 and [r.hour for r in fall if r.rows] == ["01:00", "01:00"]
    india = hour_grid(df.where("s = 'a'"), keys=("s",), tz="Asia/Kolkata").collect()
    assert len(india) == 4 * 24 and {(str(r.hour_start), r.hour, r.rows) for r in india if r.rows} == {
        ("2024-03-09 11:30:00", "17:00", 1), ("2024-03-09 12:30:00", "18:00", 1), ("2024-03-12 03:30:00", "09:00", 1)}
    wide = hour_grid(df, keys=("s",), tz="UTC", first_day=F.lit("2024-01-01"), last_day=F.lit("2024-01-02")).collect()
    assert len(wide) == 3 * 48 and not sum(r.rows for r in wide)
    assert hour_grid(df.limit(0), keys=("s",)).count() == 0


def test_distinct_sketches_merge_within_their_error(spark):
    from feedlake.operators.coverage import approx_distinct, distinct_sketches, merge_sketches
    df = spark.range(40_000).selectExpr("concat('A', id % 2) agency", "'s' stream", "date_add(date'2024-01-01', cast(id % 10 as int)) day",
                                        "sha2(cast(id % 15000 as string), 256) hash_id")
    daily = distinct_sketches(df)
    merged = {r.agency: r.approx_unique for r in approx_distinct(merge_sketches(daily)).collect()}
    exact = {r.agency: r[1] for r in df.groupBy("agency").agg(F.count_distinct("hash_id")).collect()}
    assert merged.keys() == exact.keys() and all(abs(merged[a] - exact[a]) <= 0.049 * exact[a] for a in exact)
    assert daily.count() == 10 and approx_distinct(distinct_sketches(df.limit(0))).count() == 0
