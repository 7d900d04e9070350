"""Operational metrics over envelopes (AGG-02..09, FLT-07..10, STR-05..07 in batch).

Every clock-dependent rule takes an explicit ``as_of`` so results repeat.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.functions.scalars import seconds_to_hms, strip, time_to_seconds, to_local
from feedlake.schema import DEFAULT_TZ

# Daily call quota of the BusTime platform.
DAILY_CALL_QUOTA = 10_000
ERRORS_STREAM = "Errors"


def countable_rows(df: DataFrame, known_streams: Sequence[str] | None = None) -> DataFrame:
    """Rows with agency and stream, not error rows, optionally only known streams (FLT-07)."""
    out = df.filter(F.col("agency").isNotNull() & F.col("stream").isNotNull() & (F.col("stream") != ERRORS_STREAM))
    return out if not known_streams else out.filter(F.col("stream").isin(*known_streams))


def rows_per_stream(df: DataFrame) -> DataFrame:
    """Rows per (agency, stream) (AGG-02)."""
    return df.groupBy("agency", "stream").agg(F.count(F.lit(1)).alias("rows"))


def today_vs_yesterday(df: DataFrame, as_of_day: Column, keys=("agency", "stream")) -> DataFrame:
    """Two conditional counts; only two day partitions are read (AGG-03, FLT-09)."""
    d = F.to_date(as_of_day)
    two = df.filter(F.col("day").isin(d, F.date_sub(d, 1)))
    return two.groupBy(*keys).agg(F.count_if(F.col("day") == d).alias("today"),
                                  F.count_if(F.col("day") == F.date_sub(d, 1)).alias("yesterday"))


def last_sync(df: DataFrame, keys=("agency", "stream"), ts: str = "ts") -> DataFrame:
    """Latest capture instant per stream (AGG-04)."""
    return df.groupBy(*keys).agg(F.max(ts).alias("last_ts"))


def calls_per_day(df: DataFrame, keys=("agency", "day")) -> DataFrame:
    """API calls per day (AGG-07)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("calls"))


def quota_status(calls: DataFrame, limit: int = DAILY_CALL_QUOTA) -> DataFrame:
    """Headroom floored at 0 and breach flag per (agency, day) (AGG-08)."""
    return calls.withColumn("headroom", F.greatest(F.lit(0), F.lit(limit) - F.col("calls")).cast("bigint")) \
        .withColumn("breached", F.col("calls") > limit)


def first_breach(df: DataFrame, keys: Sequence[str], order: Sequence[str], limit: int = DAILY_CALL_QUOTA,
                 bucket: Column | None = None) -> DataFrame:
    """The call that first exceeds the daily limit (AGG-08): the (limit+1)-th call of the day.

    Calls are counted per key and ``bucket`` (a Column that rises with ``order``, such as
    the hour) first; running counts tell the one bucket that holds the breach, and only
    that bucket is ranked, so neither an ordinary nor a breached day is sorted whole.
    """
    rows = df.withColumn("_b", bucket if bucket is not None else F.lit(0))
    w = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = rows.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_c")).withColumn("_to", F.sum("_c").over(w))
    spot = counts.filter((F.col("_to") > limit) & (F.col("_to") - F.col("_c") <= limit)) \
        .select(*keys, "_b", (F.col("_to") - F.col("_c")).alias("_before"))
    rank = F.row_number().over(Window.partitionBy(*keys, "_b").orderBy(*order))
    return rows.join(spot, [*keys, "_b"]).withColumn("_n", rank + F.col("_before")) \
        .filter(F.col("_n") == limit + 1).drop("_n", "_b", "_before")


def service_window(stop_times: DataFrame, group: Sequence[str],
                   time_cols: Sequence[str] = ("arrival_time", "departure_time")) -> DataFrame:
    """Earliest and latest GTFS second over the given time columns (AGG-09).

    Malformed or blank times are skipped. The window is null when no minimum
    exists or the maximum is 0.
    """
    secs = [time_to_seconds(c) for c in time_cols]
    lo = F.least(*secs) if len(secs) > 1 else secs[0]
    hi = F.greatest(*secs) if len(secs) > 1 else secs[0]
    w = stop_times.groupBy(*group).agg(F.min(lo).alias("tmin_s"), F.max(hi).alias("tmax_s"))
    valid = F.col("tmin_s").isNotNull() & (F.coalesce(F.col("tmax_s"), F.lit(0)) != 0)
    w = w.withColumn("tmin_s", F.when(valid, F.col("tmin_s"))).withColumn("tmax_s", F.when(valid, F.col("tmax_s")))
    return w.withColumn("tmin_hms", seconds_to_hms("tmin_s")).withColumn("tmax_hms", seconds_to_hms("tmax_s"))


def recent(df: DataFrame, as_of: Column, seconds: int = 180, ts: str = "ts") -> DataFrame:
    """Rows in the last ``seconds`` before ``as_of`` (FLT-08)."""
    t = as_of.cast("timestamp_ntz")
    return df.filter((F.col(ts) > t - F.expr(f"INTERVAL {seconds} SECONDS")) & (F.col(ts) <= t))


def _midnight(day: Column, tz: str) -> Column:
    """Unix second of the start of a local day."""
    return F.unix_seconds(F.convert_timezone(F.lit(tz), F.lit("UTC"), day.cast("timestamp_ntz")).cast("timestamp"))


def hours_of_day(day, tz: str = DEFAULT_TZ) -> Column:
    """Hours of a local day, begun ones included: 24, or 23 and 25 on the days of a clock change."""
    d = F.col(day) if isinstance(day, str) else day
    return F.ceil((_midnight(F.date_add(d, 1), tz) - _midnight(d, tz)) / 3600).cast("bigint")


def _hourly(df: DataFrame, keys: Sequence[str], ts: str, tz: str) -> DataFrame:
    """Rows per key, local day and hour of that day. Hours are counted by instants from the
    day's own midnight: the hour that comes twice when clocks go back is two hours, the one
    that is skipped is none, and zones that are half an hour off have hours of their own."""
    day = to_local(ts, tz).cast("date")
    slot = F.floor((F.unix_seconds(F.col(ts).cast("timestamp")) - _midnight(day, tz)) / 3600)
    return df.groupBy(*keys, day.alias("day"), slot.cast("int").alias("_slot")).agg(F.count(F.lit(1)).alias("rows"))


def _days(hourly: DataFrame, keys: Sequence[str], first_day: Column | None, last_day: Column | None) -> DataFrame:
    """Every local day of each key's span: its first to its last day with rows, or the days given."""
    span = hourly.groupBy(*keys).agg(F.min("day").alias("_lo"), F.max("day").alias("_hi"))
    lo, hi = (F.col(c) if given is None else given.cast("date") for c, given in (("_lo", first_day), ("_hi", last_day)))
    return span.select(*keys, F.explode(F.when(lo <= hi, F.sequence(lo, hi))).alias("day"))


def _joined(grid: DataFrame, counts: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join, null keys matching."""
    right = counts.select(*[F.col(c).alias(f"_r_{c}") for c in on], *[c for c in counts.columns if c not in on])
    same = F.lit(True)
    for c in on:
        same = same & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return grid.join(right, same, "left").drop(*[f"_r_{c}" for c in on])


def hour_grid(df: DataFrame, keys=("agency", "stream"), ts: str = "ts", tz: str = DEFAULT_TZ,
              first_day: Column | None = None, last_day: Column | None = None) -> DataFrame:
    """Every hour of every local day of each key's span with its rows, 0 for the empty ones (STR-05).

    ``hour_start`` is the hour's first instant (UTC), ``hour`` its local clock. Rows are
    counted per hour first, so the grid meets counts and a stream that holds most rows
    weighs no more than another; the span (or ``first_day`` to ``last_day``) bounds the grid.
    """
    hourly = _hourly(df, keys, ts, tz)
    grid = _days(hourly, keys, first_day, last_day) \
        .select("*", F.explode(F.sequence(F.lit(0), (hours_of_day("day", tz) - 1).cast("int"))).alias("_slot"))
    start = F.timestamp_seconds(_midnight(F.col("day"), tz) + F.col("_slot") * 3600).cast("timestamp_ntz")
    return _joined(grid, hourly, [*keys, "day", "_slot"]).withColumn("hour_start", start) \
        .select(*keys, "day", "hour_start", F.date_format(to_local("hour_start", tz), "HH:mm").alias("hour"),
                F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"))


def hourly_audit(df: DataFrame, keys=("agency", "stream"), ts: str = "ts", tz: str = DEFAULT_TZ, dense: bool = False,
                 first_day: Column | None = None, last_day: Column | None = None) -> DataFrame:
    """Hours with and without data per local day (STR-05): of the days with rows, or (``dense``)
    of every day of each key's span, those without any row included."""
    hourly = _hourly(df, keys, ts, tz)
    per = hourly.groupBy(*keys, "day").agg(F.count(F.lit(1)).alias("hours_with_rows"), F.sum("rows").alias("rows"))
    if dense:
        per = _joined(_days(hourly, keys, first_day, last_day), per, [*keys, "day"]) \
            .select(*keys, "day", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("hours_with_rows", "rows")])
    return per.withColumn("hours_missing", hours_of_day("day", tz) - F.col("hours_with_rows"))


def cadence_gaps(df: DataFrame, keys: Sequence[str], order: Sequence[str], ts: str = "ts",
                 split_seconds: int = 3600) -> DataFrame:
    """Seconds since the previous row of the key (STR-07); ``order`` begins with ``ts``.

    Rows are ordered per key and time bucket; the first row of a bucket compares with
    the newest of the key's bucket before, from a per-bucket summary, so a stream that
    holds most rows is spread over as many tasks as it has buckets.
    """
    secs = F.unix_seconds(F.col(ts).cast("timestamp"))
    d = df.withColumn("_s", secs).withColumn("_b", F.floor(F.col("_s") / split_seconds))
    last = d.groupBy(*keys, "_b").agg(F.max("_s").alias("_last"))
    carry = last.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_b").alias("_cb"),
                        F.lag("_last").over(Window.partitionBy(*keys).orderBy("_b")).alias("_carry"))
    same = F.col("_b").eqNullSafe(F.col("_cb"))
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    prev = F.coalesce(F.lag("_s").over(Window.partitionBy(*keys, "_b").orderBy(*order)), F.col("_carry"))
    return d.join(carry, same, "left").withColumn("gap_s", F.col("_s") - prev).select(*df.columns, "gap_s")


def classify_bustime(body_variant: Column) -> Column:
    """Status of a BusTime answer (FLT-06): UNSUPPORTED, NEEDS_PARAM, EMPTY, ERROR, OK.

    The first error is used when ``error`` is a list; a missing ``msg`` reads as
    'Unknown API error'.
    """
    v = body_variant
    resp = F.try_variant_get(v, '$["bustime-response"]', "variant")
    err_list = F.try_variant_get(resp, "$.error", "array<variant>")
    err = F.coalesce(F.get(err_list, 0), F.try_variant_get(resp, "$.error", "variant"))
    has_err = err.isNotNull()
    has_msg = F.try_variant_get(err, "$.msg", "variant").isNotNull()
    msg = strip(F.when(has_msg, F.try_variant_get(err, "$.msg", "string")).otherwise(F.lit("Unknown API error")))
    empty = None
    for frag in EMPTY_FRAGMENTS:
        c = msg.contains(frag)
        empty = c if empty is None else (empty | c)
    status = (F.when(msg.contains("Unsupported") | msg.contains("does not support"), F.lit("UNSUPPORTED"))
              .when(msg.isin(*NEEDS_PARAM_TEXTS), F.lit("NEEDS_PARAM"))
              .when(empty, F.lit("EMPTY"))
              .otherwise(F.lit("ERROR")))
    return F.when(has_err, status).otherwise(F.lit("OK"))


# BusTime error texts.
NEEDS_PARAM_TEXTS = ("No parameter provided", "No RTPI Data Feed parameter provided")
EMPTY_FRAGMENTS = ("No data found", "No vehicles found", "No service", "No arrival times", "No agencies")


def rows_per_file(df: DataFrame) -> DataFrame:
    """Rows per source file of a file-based DataFrame (AGG-19), from the hidden
    ``_metadata`` column (no extra listing)."""
    return df.select(F.col("_metadata.file_path").alias("file_path")).groupBy("file_path") \
        .agg(F.count(F.lit(1)).alias("rows"))


def counts_with_zeros(targets: DataFrame, counts: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Per-target counts with missing targets as 0 (AGG-18)."""
    j = targets.join(counts, key, "left")
    return j.select(*targets.columns, *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in cols])


def status_rank(df: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """Position of each status row in display order (SRT-01). Only for status
    tables (one row per agency and stream): the window is global."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("int"))


def pull_audit(pulls: DataFrame, ts: str, expected_hours: Sequence[int], tz: str) -> DataFrame:
    """Schedule pulls per local day against the expected local hours (STR-06):
    slots seen, expected slots missing, unexpected slots."""
    from feedlake.functions.scalars import local_day, to_local
    p = pulls.select(local_day(ts, tz).alias("day"), F.hour(to_local(ts, tz)).alias("hour"))
    per = p.groupBy("day").agg(F.array_sort(F.collect_set("hour")).alias("hours"))
    expected = F.array(*[F.lit(h) for h in expected_hours])
    return per.select("day", F.size("hours").cast("bigint").alias("n_slots"),
                      F.array_join(F.array_except(expected, "hours"), ",").alias("missing"),
                      F.array_join(F.array_except("hours", expected), ",").alias("unexpected"))
