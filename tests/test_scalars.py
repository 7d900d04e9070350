import datetime as dt

from pyspark.sql import functions as F

from feedlake.functions import scalars as S


def one(spark, expr, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"x {dtype}").select(expr(F.col("x")).alias("y")).first()["y"]


def test_safe_prefix_styles(spark):
    assert one(spark, S.safe_prefix, "  MBTA  transit!! ") == "MBTA_transit"
    assert one(spark, lambda c: S.safe_prefix(c, "unicode"), "Zürich  bus") == "Zürich__bus"
    assert one(spark, S.safe_prefix, "###") == "agency"
    assert one(spark, lambda c: S.safe_prefix(c, "main", "stream"), "") == "stream"


def test_file_date_key_and_day(spark):
    assert one(spark, S.file_date_key, "MBTA_vehicles_enhanced_01312024.jsonl") == "01312024"
    assert one(spark, S.file_day, "A_x_01312024.parquet") == dt.date(2024, 1, 31)
    assert one(spark, S.file_day, "A_x_junk.parquet") is None


def test_time_to_seconds_edges(spark):
    assert one(spark, S.time_to_seconds, "25:10:00") == 25 * 3600 + 600
    assert one(spark, S.time_to_seconds, " 7:05:00") == 7 * 3600 + 300
    assert one(spark, S.time_to_seconds, "+1: 02 :03") == 3723
    assert one(spark, S.time_to_seconds, "1:02:03:99") == 3723
    for bad in ("", "abc", "7:05", "7:x:00", None):
        assert one(spark, S.time_to_seconds, bad) is None


def test_seconds_to_hms_wraps(spark):
    assert one(spark, S.seconds_to_hms, 90000, "bigint") == "01:00:00"
    assert one(spark, S.seconds_to_hms, 59, "bigint") == "00:00:59"


def test_service_state(spark):
    df = spark.createDataFrame([(t,) for t in (100, 3600 * 4 + 1, 3600 * 5, 3600 * 21, 3600 * 21 + 1800, 86399)],
                               "n int")
    st = df.select(S.service_state(F.col("n"), F.lit(3600 * 5), F.lit(3600 * 21)).alias("s")).collect()
    assert [r.s for r in st] == ["OFF_HOURS", "PRE_FLIGHT", "ACTIVE", "ACTIVE", "END_OF_SERVICE", "OFF_HOURS"]
    unknown = df.select(S.service_state(F.col("n"), F.lit(None).cast("int"), F.lit(None).cast("int"))).first()[0]
    assert unknown == "STARTUP"
    wrapped = spark.createDataFrame([(1800,)], "n int").select(
        S.service_state(F.col("n"), F.lit(3600 * 5), F.lit(3600 * 25), wrap=True)).first()[0]
    assert wrapped == "ACTIVE"


def test_levels_groups_classes(spark):
    rows = spark.createDataFrame([(0,), (1,), (499,), (500,), (1999,), (2000,), (9999,), (10000,)], "r bigint")
    assert [r[0] for r in rows.select(S.coverage_level("r")).collect()] == [0, 1, 1, 2, 2, 3, 3, 4]
    assert one(spark, S.stream_group, "VehiclePositions_Enhanced") == "enhanced"
    assert one(spark, S.stream_group, "predictions") == "main"
    assert one(spark, S.stream_group, "Predictions") == "custom"
    assert one(spark, lambda c: S.stream_class(c, "transloc"), "StopArrivalTimes") == "prediction"
    assert one(spark, lambda c: S.stream_class(c, "swiv"), "SystemConfig") == "config"


def test_dotnet_date(spark):
    assert one(spark, S.parse_dotnet_date, "/Date(1704067200999-0500)/") == "2023-12-31T19:00:00-05:00"
    assert one(spark, S.parse_dotnet_date, "/Date(1719835200000)/") == "2024-07-01T08:00:00-04:00"
    assert one(spark, S.parse_dotnet_date, "") is None
    assert one(spark, S.parse_dotnet_date, "soon") == "soon"
    anchored = lambda c: S.parse_dotnet_date(c, anchored=True)
    assert one(spark, anchored, "x/Date(1)/") == "x/Date(1)/"
    assert one(spark, anchored, "/Date(1704067200000-0500)/") == "/Date(1704067200000-0500)/"
    assert one(spark, anchored, "/Date(1704067200000)/") == "2023-12-31T19:00:00-05:00"


def test_parse_logged_and_iso_local(spark):
    f = lambda c: S.iso_local(S.parse_logged(c))
    assert one(spark, f, "01312024") == "2024-01-31T00:00:00-0500"
    assert one(spark, f, "2024-07-04") == "2024-07-04T00:00:00-0400"
    assert one(spark, f, "2024-07-04T12:00:00+00:00") == "2024-07-04T08:00:00-0400"
    assert one(spark, S.parse_logged, "junk") is None


def test_local_day_across_midnight_and_dst(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 4, 30),), (dt.datetime(2024, 3, 10, 5, 30),)],
                               "ts timestamp_ntz")
    days = [r[0] for r in df.select(S.local_day("ts")).collect()]
    assert days == [dt.date(2024, 3, 9), dt.date(2024, 3, 10)]


def test_lists_and_truthy(spark):
    assert one(spark, S.split_list, " a, ,b ,") == ["a", "b"]
    df = spark.createDataFrame([("", "x"), (None, "y"), ("z", "w")], "a string, b string")
    assert [r[0] for r in df.select(S.first_truthy("a", "b")).collect()] == ["x", "y", "z"]


def test_sunday_saturday(spark):
    assert one(spark, S.sunday_of, dt.date(2024, 1, 1), "date") == dt.date(2023, 12, 31)
    assert one(spark, S.saturday_of, dt.date(2024, 12, 31), "date") == dt.date(2025, 1, 4)
