"""Odd cases of single rules: white space, Python truth, empty lists, resets, late polls, split windows."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from feedlake.functions.scalars import first_truthy_field, stream_class, strip
from feedlake.operators import ids as id_ops
from feedlake.operators import monitor
from feedlake.operators import windows as win
from feedlake.operators.filters import reject_html
from feedlake.operators.projections import canonical_route, first_per_id
from feedlake.sources import unwrap as uw
from feedlake.sources.gtfs import land_zip_packages, read_gtfs_table
from feedlake.sources.sse import sse_records


def one(spark, text):
    return spark.createDataFrame([(text,)], "b string")


def test_strip_takes_all_white_space(spark):
    texts = ["\n a b\t\r\n", " x ", "", " y\x85", "  \t ", "in  ner", "\x1cz\x1f", " " * 5000 + "q" + "\n" * 5000]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(strip("t")).collect()] == [t.strip() for t in texts]


def test_html_behind_line_breaks_is_rejected_and_text_is_stripped(spark):
    rows = ["\n<!DOCTYPE html>x", "\t<HTML>", "\n plain \n", " \r\n", '{"a": 1}']
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, body string")
    got = reject_html(df).orderBy("i").select("outcome", "payload").collect()
    assert [r.outcome for r in got] == ["rejected", "rejected", "text", "empty", "json"]
    assert got[2].payload == '{"data":"plain"}'


@pytest.mark.parametrize("doc,want", [
    ('{"id":0,"myid":"7"}', "7"), ('{"id":"","myid":" 8 "}', "8"), ('{"id":"  ","myid":"9"}', None), ('{"id":5}', "5"),
    ('{"id":"0"}', "0"), ('{"id":false,"myid":3}', "3"), ('{"id":0.0}', None), ('{"id":[],"myid":"m"}', "m"), ("{}", None)])
def test_route_id_follows_python_truth(spark, doc, want):
    assert one(spark, doc).select(canonical_route(F.try_parse_json("b"))).first()[0] == want


def test_first_truthy_field(spark):
    df = one(spark, '{"a":0,"b":null,"c":{},"d":"x"}')
    assert df.select(first_truthy_field(F.try_parse_json("b"), "$.a", "$.b", "$.c", "$.d")).first()[0] == "x"


@pytest.mark.parametrize("doc,n", [('{"routes":[]}', 0), ('{"routes":[],"stops":[{"a":1}]}', 0), ('{"routes":5,"stops":[1,2]}', 2),
                                   ('{"x":1}', 1), ('{"data":{"y":1}}', 1)])
def test_massport_empty_list_decides(spark, doc, n):
    items = uw.unwrap_items(F.try_parse_json("b"), uw.massport(("routes", "stops")))
    assert one(spark, doc).select(F.size(items)).first()[0] == n


def test_transloc_skips_empty_lists(spark):
    items = uw.unwrap_items(F.try_parse_json("b"), uw.transloc("arrivals"))
    assert one(spark, '{"d":[],"arrivals":[1]}').select(F.size(items)).first()[0] == 1


def test_sse_wraps_plain_elements_and_keeps_resets(spark):
    body = 'event: reset\ndata: []\n\nevent: add\ndata: [5,{"id":1}]\n\ndata: "x"\n\n'
    plain = [(r.event, r.r) for r in sse_records(one(spark, body), "b").select("event", F.to_json("record").alias("r")).collect()]
    assert plain == [("add", '{"value":5}'), ("add", '{"id":1}'), ("message", '{"value":"x"}')]
    kept = sse_records(one(spark, body), "b", keep_empty_reset=True).select("event", F.to_json("record").alias("r")).collect()
    assert [(r.event, r.r) for r in kept] == [("reset", None), *plain]


def test_quoted_newline_in_a_large_table(spark, tmp_path):
    text = 'trip_id,stop_headsign\n1,"Main\nStreet"\n2,plain\n'
    for table in ("trips", "stop_times"):
        (tmp_path / f"{table}.txt").write_text(text)
        rows = read_gtfs_table(spark, str(tmp_path / f"{table}.txt"), table).collect()
        assert sorted(tuple(r) for r in rows) == [("1", "Main\nStreet"), ("2", "plain")]


def test_zip_members_keep_odd_line_breaks(spark, tmp_path):
    import zipfile
    with zipfile.ZipFile(tmp_path / "A.zip", "w") as z:
        z.writestr("stops.txt", "stop_id,stop_name\r\n1,a b\x0cc\r\n2,d\u0085e\n")
    land_zip_packages(spark, str(tmp_path / "A.zip"), str(tmp_path / "out"))
    rows = read_gtfs_table(spark, str(tmp_path / "out/package=A/table=stops"), "stops").collect()
    assert [r.stop_name for r in rows] == ["a b\x0cc", "d\u0085e"]


def test_stream_classes_by_name(spark):
    df = spark.createDataFrame([("Routes",), ("Agencies",), ("Predictions",), ("Trips",), ("x",)], "s string")
    got = [tuple(r) for r in df.select(*[stream_class("s", p) for p in ("bustime", "passiogo", "routematch", "massport")]).collect()]
    assert got[0] == ("Hourly", "Hourly", "Streamed", "Hourly") and got[1][0] == "Bi-Weekly"
    assert got[2][3] == "Live" and got[3][3] == "Hourly" and got[4] == ("Streamed",) * 4


def test_first_per_id_in_an_answer(spark):
    arr = F.try_variant_get(F.try_parse_json("b"), "$", "array<variant>")
    out = one(spark, '[{"v":1,"n":"a"},{"v":2},{"v":1,"n":"b"},{"x":1},{"x":2}]').select(
        F.transform(first_per_id(arr, "$.v"), lambda x: F.to_json(x))).first()[0]
    assert list(out) == ['{"n":"a","v":1}', '{"v":2}', '{"x":1}']


def events(spark, n=400, seed=1):
    rng = random.Random(seed)
    base = dt.datetime(2024, 3, 9, 20)
    rows = [(rng.choice("AB"), base + dt.timedelta(seconds=rng.randint(0, 200_000)), i, rng.choice("xyz")) for i in range(n)]
    return spark.createDataFrame(rows, "k string, ts timestamp_ntz, i int, s string")


def test_split_windows_equal_unsplit_ones(spark):
    df = events(spark)
    w = Window.partitionBy("k").orderBy("ts", "i")
    secs = F.unix_seconds(F.col("ts").cast("timestamp"))
    want = df.select("i", (secs - F.lag(secs).over(w)).alias("g"))
    got = monitor.cadence_gaps(df, ["k"], ["ts", "i"], split_seconds=900).select("i", "gap_s")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    hours = df.withColumn("h", F.date_trunc("hour", "ts"))
    split = win.state_transitions(hours, ["k"], ["ts", "i"], "s", split_by=["h"]).select("i", "s")
    whole = win.state_transitions(df, ["k"], ["ts", "i"], "s").select("i", "s")
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, whole.collect()))
    a = win.batches(df, ["k"], "i", 7, bucket=F.floor(F.col("i") / 13)).orderBy("k", "batch_no").collect()
    assert a == win.batches(df, ["k"], "i", 7).orderBy("k", "batch_no").collect()
    for limit in (3, 150):
        b = monitor.first_breach(df, ["k"], ["ts", "i"], limit, bucket=F.date_trunc("hour", "ts")).select("k", "i").collect()
        assert sorted(b) == sorted(monitor.first_breach(df, ["k"], ["ts", "i"], limit).select("k", "i").collect())


def test_hours_of_clock_changes(spark):
    df = spark.createDataFrame([(d,) for d in (dt.date(2024, 3, 10), dt.date(2024, 11, 3), dt.date(2024, 5, 1))], "d date")
    assert [r[0] for r in df.select(monitor.hours_of_day("d")).collect()] == [23, 25, 24]


def test_replace_keeps_agencies_that_were_not_polled(spark):
    cols = "agency string, kind string, id string, first_seen timestamp_ntz, last_seen timestamp_ntz"
    t = dt.datetime(2024, 1, 1)
    stored = spark.createDataFrame([("A", "r", "1", t, t), ("B", "r", "2", t, t), ("C", "r", "3", t, t)], cols)
    batch = spark.createDataFrame([("A", "r", "9", t, t)], cols)
    polled = spark.createDataFrame([("A",), ("C",)], "agency string")
    assert sorted(r.id for r in id_ops.upsert_ids(stored, batch, "replace").collect()) == ["2", "3", "9"]
    assert sorted(r.id for r in id_ops.upsert_ids(stored, batch, "replace", polled=polled).collect()) == ["2", "9"]


def test_active_sets_keep_old_ones_when_all_are_empty(spark):
    stored = spark.createDataFrame([("A", ["1"]), ("B", ["2"])], "agency string, ids array<string>")
    buses = spark.createDataFrame([("A", " 5 "), ("A", ""), ("B", None)], "agency string, route string")
    got = {r.agency: list(r.ids) for r in id_ops.active_sets(stored, buses, "agency", "route").collect()}
    assert got == {"A": ["5"], "B": []}
    blank = buses.withColumn("route", F.lit(" \n"))
    assert {r.agency: list(r.ids) for r in id_ops.active_sets(stored, blank, "agency", "route").collect()} == {"A": ["1"], "B": ["2"]}


def test_late_polls_come_out_marked():
    import pandas as pd
    from feedlake.streaming.changes import DetourMemory

    class Last:
        value = (dt.date(2024, 1, 5), "a", 5)

        def exists(self):
            return True

        def get(self):
            return self.value

        def update(self, value):
            self.value = value
    memory = DetourMemory(None)
    memory.last = Last()
    polls = pd.DataFrame({"day": [dt.date(2024, 1, 3), dt.date(2024, 1, 4), dt.date(2024, 1, 6)], "detours": ["b", "a", "c"], "at_ms": [3, 4, 6]})
    out = pd.concat(memory.handleInputRows(("A", "1"), iter([polls]), None))
    assert out[["detours", "late"]].values.tolist() == [["b", True], ["c", False]] and memory.last.value == (dt.date(2024, 1, 6), "c", 6)


def test_capture_errors_and_text(spark):
    from feedlake.jobs import capture_envelopes, capture_errors, classify_captures
    rows = [("\n<html>no", "REJECTED"), (" plain ", "TEXT"), ("", "BLANK"), ('{"data":[{"a":1}]}', "OK"),
            ('{"bustime-response":{"error":[{"msg":"Unsupported function"}]}}', "UNSUPPORTED")]
    df = spark.createDataFrame([("A", "S", "ep", dt.datetime(2024, 1, 1, 12), b) for b, _ in rows],
                               "agency string, stream string, endpoint string, poll_ts timestamp_ntz, body string")
    assert [r.status for r in classify_captures(df).select("status").collect()] == [s for _, s in rows]
    assert sorted(r.data for r in capture_envelopes(df, uw.ROUTEMATCH, tz="UTC").collect()) == ['"plain"', '{"a":1}']
    assert sorted(r.data for r in capture_errors(df, "UTC").collect())[0] == '{"message":"REJECTED S ep <html>no"}'


def test_capture_errors_keep_long_bodies(spark):
    import json

    from feedlake.jobs import capture_errors
    bodies = ["<html>" + "no " * 400 + end for end in ("one", "two")]
    df = spark.createDataFrame([("A", "S", "ep", dt.datetime(2024, 1, 1, 12), b) for b in bodies],
                               "agency string, stream string, endpoint string, poll_ts timestamp_ntz, body string")
    rows = capture_errors(df, "UTC").collect()
    assert sorted(json.loads(r.data)["message"] for r in rows) == [f"REJECTED S ep {b}" for b in bodies]
    assert len({r.hash_id for r in rows}) == 2
