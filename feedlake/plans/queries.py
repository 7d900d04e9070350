"""Registered queries over the driver tables: one per operator group of the survey.

Each function takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose
column names and types match the DuckDB statement of the same name in
``feedlake.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql import types as T

from feedlake.functions.identity import canonical_json, event_hash_pipe, event_hash_struct, row_hash
from feedlake.functions.scalars import from_local, iso_local, to_local
from feedlake.operators import coverage as cov_ops
from feedlake.operators.dedupe import dedupe_events, flag_first_occurrence
from feedlake.operators.history import merge_snapshots, point_in_time, prepare_snapshot
from feedlake.operators.lookups import active_only, agency_of, fan_out, gtfs_stem, missing_ids
from feedlake.operators.monitor import counts_with_zeros
from feedlake.operators.projections import align_schema
from feedlake.plans.feeds import feed_envelopes, lineitem_envelopes
from feedlake.schema import DEFAULT_TZ
from feedlake.sources.tables import read_table

TZ = DEFAULT_TZ


def q_event_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IDN-01/02/03/06, PRJ-01/12: the three envelope identities and canonical payload."""
    f = feed_envelopes(spark, sf_dir, TZ)
    return f.select(
        "event_id",
        event_hash_pipe("endpoint", "event", "id", "data").alias("hash_main"),
        event_hash_pipe("endpoint", "event", "id", "data", agency="agency").alias("hash_agency"),
        event_hash_struct("agency", "stream", "event", "endpoint", "data").alias("hash_struct"),
        canonical_json("data").alias("data_json"),
    )


def q_dedupe_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IDN-07, WIN-01, SCL-03: first row per (agency, stream, local day, hash)."""
    f = feed_envelopes(spark, sf_dir, TZ).select("event_id", "ts", "agency", "stream", "day", "hash_id")
    d = dedupe_events(f, scope="day", order=("ts", "event_id"))
    return d.select("event_id", "agency", "stream", "day", "hash_id")


def q_unique_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-02/05: rows and distinct records per (agency, stream, local day). Flagship."""
    f = feed_envelopes(spark, sf_dir, TZ)
    c = cov_ops.coverage(f, distinct_col="hash_id")
    return c.select("agency", "stream", "day", F.col("rows").cast("bigint").alias("rows"),
                    F.col("unique_rows").cast("bigint").alias("unique_rows"))


def q_fetched_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-06: per poll (local hour) rows fetched and rows new for the day."""
    f = feed_envelopes(spark, sf_dir, TZ)
    f = flag_first_occurrence(f, scope="day", order=("ts", "event_id"))
    f = f.withColumn("poll", F.date_format(to_local("ts", TZ), "yyyy-MM-dd HH:00"))
    return f.groupBy("agency", "stream", "poll").agg(
        F.count(F.lit(1)).cast("bigint").alias("fetched"),
        F.count_if(F.col("is_new")).cast("bigint").alias("new_rows"))


def q_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-13/14: rows per (agency, stream, day) plus the all-stream total per (agency, day)."""
    return cov_ops.coverage_with_totals(feed_envelopes(spark, sf_dir, TZ))


def q_coverage_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CAL-01/02, SCL-16/22, JON-11: year grid per agency with rows and level."""
    c = cov_ops.coverage(feed_envelopes(spark, sf_dir, TZ))
    cal = cov_ops.coverage_calendar(c)
    return cal.select("agency", "year", "day", "week", "weekday", "in_year", "month_label", "rows", "level")


def q_missed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-20: days without rows inside each entity's first..last range."""
    f = feed_envelopes(spark, sf_dir, TZ)
    c = f.groupBy("agency", "stream", "id", "day").agg(F.count(F.lit(1)).alias("rows"))
    return cov_ops.missed_days(c, keys=("agency", "stream", "id")).select("agency", "stream", "id", "day")


def q_agency_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-15/16, FLT-11/12: first/last day and days covered per agency in 2024."""
    c = cov_ops.coverage(feed_envelopes(spark, sf_dir, TZ))
    s = cov_ops.agency_span(c, year=2024)
    return s.select("agency", "first_day", "last_day", F.col("days_covered").cast("bigint").alias("days_covered"))


# ---------------------------------------------------------------- schedule history

def _orders_snapshots(spark: SparkSession, sf_dir: str):
    """Two pulls of ``orders`` as schedule snapshots: orders before 1998 pulled at
    2024-01-01 03:00 local, orders from 1997 on pulled at 2024-02-01 03:00 local with
    one added all-empty column. 1997 orders appear in both."""
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"))
    t1 = from_local(F.lit("2024-01-01 03:00:00").cast("timestamp_ntz"), TZ)
    t2 = from_local(F.lit("2024-02-01 03:00:00").cast("timestamp_ntz"), TZ)
    old = prepare_snapshot(o.filter(F.col("o_orderdate") < "1998-01-01"), "orders", t1, ignore_null_columns=True)
    new = o.filter(F.col("o_orderdate") >= "1997-01-01").withColumn("o_note", F.lit(None).cast("string"))
    return old, new, t2


def _merged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new, t2 = _orders_snapshots(spark, sf_dir)
    new = prepare_snapshot(new, "orders", t2, ignore_null_columns=True)
    return merge_snapshots(old, new, "orders", t2, ignore_null_columns=True, tz=TZ)


def q_snapshot_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IDN-08/09/10, AGG-01, SET-01, SRT-05, FLT-13: cumulative table with first/last seen."""
    m = _merged_orders(spark, sf_dir)
    return m.select("hash_id", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate",
                    "o_note", iso_local("first_logged", TZ).alias("first_logged"),
                    iso_local("last_logged", TZ).alias("last_logged"))


def q_point_in_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IDN-11: rows of the cumulative table valid at 2024-01-15 12:00 local."""
    m = _merged_orders(spark, sf_dir)
    at = from_local(F.lit("2024-01-15 12:00:00").cast("timestamp_ntz"), TZ)
    return point_in_time(m, at).select("hash_id", "o_orderkey")


def q_gtfs_row_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IDN-05: row identity of all-string tables (nation, region, supplier names)."""
    parts = []
    for table, cols, key in (("nation", ["n_nationkey", "n_name", "n_regionkey"], "n_nationkey"),
                             ("region", ["r_regionkey", "r_name"], "r_regionkey"),
                             ("supplier", ["s_suppkey", "s_name", "s_nationkey"], "s_suppkey")):
        t = read_table(spark, sf_dir, table).select(*[F.col(c).cast("string").alias(c) for c in cols])
        parts.append(t.select(F.lit(table).alias("table_name"), F.col(key).alias("row_key"),
                              row_hash(cols, table).alias("hash_id")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_align_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-03, SET-01: all-string ``part`` aligned to a typed target schema."""
    raw = read_table(spark, sf_dir, "part")
    raw = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    target = T.StructType([
        T.StructField("p_partkey", T.LongType()), T.StructField("p_name", T.StringType()),
        T.StructField("p_size", T.IntegerType()), T.StructField("p_brand", T.IntegerType()),
        T.StructField("p_container", T.StringType()), T.StructField("p_retailprice", T.DoubleType()),
    ])
    return align_schema(raw, target)


# ---------------------------------------------------------------- lookups and joins

def q_agency_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON-01/02: vehicle rows (lineitem) -> owning agency through the supplier
    catalog (inner), stream (return flag) -> file stem through a stream catalog (left)."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey",
                                                      F.col("l_returnflag").alias("stream"))
    sup = read_table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"),
                                                       F.col("s_nationkey").alias("n_nationkey"))
    nat = read_table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("agency"))
    catalog = agency_of(sup, nat, "n_nationkey").select("l_suppkey", "agency")
    v = agency_of(li, catalog, "l_suppkey")
    stems = spark.createDataFrame([("R", "returned_items"), ("A", "accepted_items")], "stream string, stem string")
    return gtfs_stem(v, stems).select("l_orderkey", "l_linenumber", "agency", "stem")


def q_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON-07: one feed-info snapshot (latest order date) copied to every agency."""
    nat = read_table(spark, sf_dir, "nation").select(F.col("n_name").alias("agency"))
    info = read_table(spark, sf_dir, "orders").agg(F.date_format(F.max("o_orderdate"), "yyyy-MM-dd"))
    return fan_out(nat, info, "feed_version")


def q_fetched_per_agency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-18/19: open (vehicles) and finished (enhanced) orders per agency, zeros kept."""
    nat = read_table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("agency"))
    cust = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"),
                                                        F.col("c_nationkey").alias("n_nationkey"))
    o = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus")
    counts = agency_of(o, cust, "o_custkey").groupBy("n_nationkey").agg(
        F.count_if(F.col("o_orderstatus") == "O").alias("vehicles"),
        F.count_if(F.col("o_orderstatus") == "F").alias("enhanced"))
    return counts_with_zeros(nat, counts, "n_nationkey", ["vehicles", "enhanced"]).drop("n_nationkey")


def q_active_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON-03, AGG-11: routes (customers) with an order in the last 30 days of data,
    per agency (nation); an agency with none keeps all its routes."""
    nat = read_table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("agency"))
    routes = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("route_id"),
                                                          F.col("c_nationkey").alias("n_nationkey"))
    routes = agency_of(routes, nat, "n_nationkey").select("agency", "route_id")
    o = read_table(spark, sf_dir, "orders")
    cutoff = o.agg(F.date_sub(F.max("o_orderdate").cast("date"), 30)).scalar()
    live = o.filter(F.col("o_orderdate").cast("date") > cutoff).select(F.col("o_custkey").alias("route_id"))
    active = routes.join(live.distinct(), "route_id", "left_semi")
    return active_only(routes, active, "agency", "route_id")


def q_missing_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON-04, SET-03: entities live on the previous local day but not on this one."""
    f = feed_envelopes(spark, sf_dir, TZ).select("agency", "id", "day").distinct()
    known = f.select("agency", "id", F.date_add("day", 1).alias("day"))
    days = f.select("day").distinct()
    known = known.join(days, "day", "left_semi")
    return missing_ids(known, f, ["agency", "id", "day"]).select("agency", "day", "id")


REGISTRY = {
    "q_event_hash": q_event_hash,
    "q_dedupe_day": q_dedupe_day,
    "q_unique_rows": q_unique_rows,
    "q_fetched_new": q_fetched_new,
    "q_coverage": q_coverage,
    "q_coverage_calendar": q_coverage_calendar,
    "q_missed_days": q_missed_days,
    "q_agency_span": q_agency_span,
    "q_snapshot_merge": q_snapshot_merge,
    "q_point_in_time": q_point_in_time,
    "q_gtfs_row_hash": q_gtfs_row_hash,
    "q_align_schema": q_align_schema,
    "q_agency_lookup": q_agency_lookup,
    "q_fan_out": q_fan_out,
    "q_fetched_per_agency": q_fetched_per_agency,
    "q_active_routes": q_active_routes,
    "q_missing_vehicles": q_missing_vehicles,
}


# ---------------------------------------------------------------- the 600 K-row products (lineitem feed)

def q_li_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IDN-07 over the lineitem feed: first row per (agency, stream, local day, hash)."""
    f = lineitem_envelopes(spark, sf_dir, TZ).select("agency", "stream", "day", "hash_id", "ts", "id")
    d = dedupe_events(f, scope="day", order=("ts", "id"))
    return d.select("agency", "stream", "day", "hash_id", "id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))


def q_li_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-13/14 over the lineitem feed: rows per stream-day and all-stream totals."""
    return cov_ops.coverage_with_totals(lineitem_envelopes(spark, sf_dir, TZ))


def q_li_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IDN-09 over lineitem as a schedule table: lines shipped before 1997 pulled at
    2024-01-01, lines shipped from 1996 on pulled at 2024-02-01, folded by row hash."""
    li = read_table(spark, sf_dir, "lineitem", parallel=True).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate"))
    t1 = from_local(F.lit("2024-01-01 03:00:00").cast("timestamp_ntz"), TZ)
    t2 = from_local(F.lit("2024-02-01 03:00:00").cast("timestamp_ntz"), TZ)
    old = prepare_snapshot(li.filter(F.col("l_shipdate") < "1997-01-01"), "lineitem", t1)
    new = prepare_snapshot(li.filter(F.col("l_shipdate") >= "1996-01-01"), "lineitem", t2)
    m = merge_snapshots(old, new, "lineitem", t2, tz=TZ)
    return m.select("hash_id", "l_orderkey", "l_linenumber", iso_local("first_logged", TZ).alias("first_logged"),
                    iso_local("last_logged", TZ).alias("last_logged"))


REGISTRY.update({"q_li_dedupe": q_li_dedupe, "q_li_coverage": q_li_coverage, "q_li_merge": q_li_merge})
