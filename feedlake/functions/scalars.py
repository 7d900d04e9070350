"""Scalar Column functions (names, dates, clocks, levels, groups).

All functions return Spark Columns built from built-in expressions, so rows stay in the
JVM; those that bind a value with a lambda (``_let``) run outside generated code. Instants are TIMESTAMP/TIMESTAMP_NTZ read as UTC.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlake.schema import DEFAULT_TZ


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _let(value: Column, body) -> Column:
    """Bind ``value`` once for ``body`` (a lambda binding), so it is not recomputed."""
    return F.element_at(F.transform(F.array(value), body), 1)


# ---------------------------------------------------------------- names (SCL-01/02, PRJ-14)

def safe_prefix(col, style: str = "main", default: str = "agency") -> Column:
    """File-safe label (SCL-01).

    ``main``: every run of characters outside ``[A-Za-z0-9_-]`` becomes one ``_``.
    ``unicode``: every single character that is not a letter, digit, ``_`` or
    ``-`` becomes ``_`` (Unicode letters are kept). Leading/trailing ``_`` are
    stripped; an empty result falls back to ``default``.
    """
    s = F.regexp_replace(_c(col), r"^\s+|\s+$", "")
    if style == "main":
        cleaned = F.regexp_replace(s, r"[^A-Za-z0-9_-]+", "_")
    else:
        cleaned = F.regexp_replace(s, r"[^\p{L}\p{N}_-]", "_")
    stripped = F.regexp_replace(cleaned, r"^_+|_+$", "")
    return F.coalesce(F.nullif(stripped, F.lit("")), F.lit(default))


def file_date_key(col) -> Column:
    """Text after the last ``_`` up to the first ``.`` (SCL-02): ``A_x_01312024.jsonl`` -> ``01312024``."""
    last = F.substring_index(_c(col), "_", -1)
    return F.substring_index(last, ".", 1)


def file_day(col) -> Column:
    k = file_date_key(col)
    return F.when(k.rlike(r"^\d{8}$"), F.try_to_timestamp(k, F.lit("MMddyyyy")).cast("date"))


def archive_name(prefix, stem, day, extension: str) -> Column:
    """``<PREFIX>_<stem>_<MMDDYYYY>.<ext>`` for a DATE ``day`` (PRJ-14)."""
    return F.format_string(f"%s_%s_%s.{extension}", _c(prefix), _c(stem), F.date_format(_c(day), "MMddyyyy"))


def gtfs_table_name(prefix, table) -> Column:
    return F.format_string("%s_gtfs_%s.parquet", _c(prefix), _c(table))


def strip(col) -> Column:
    """Text without leading and trailing white space of any kind (``str.strip``): line breaks,
    tabs, Unicode spaces. Spark's ``trim`` takes spaces only."""
    return F.regexp_replace(_c(col), r"(?U)^[\s\x1c-\x1f]++|(?<![\s\x1c-\x1f])[\s\x1c-\x1f]++$", "")


def split_list(col) -> Column:
    """Comma list -> array of stripped, non-blank items (SCL-18)."""
    return F.filter(F.transform(F.split(_c(col), ","), lambda x: strip(x)), lambda x: x != F.lit(""))


def first_truthy(*cols) -> Column:
    """Python ``a or b or …`` over strings: '' and null count as missing (SCL-19)."""
    return F.coalesce(*[F.nullif(_c(c).cast("string"), F.lit("")) for c in cols])


def truthy_text(v, path: str) -> Column:
    """Text of a VARIANT field, or null where Python calls the value false: missing, null,
    '', a zero number, false, an empty list or object (SCL-19)."""
    value = F.try_variant_get(_c(v), path, "variant")
    text = F.try_variant_get(_c(v), path, "string")
    kind = F.schema_of_variant(value)
    zero = kind.rlike(r"^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL|DOUBLE|FLOAT)") & (F.try_variant_get(value, "$", "double") == 0)
    empty = text.isin("", "[]", "{}") | ((kind == "BOOLEAN") & (text == "false"))
    return F.when(F.coalesce(zero | empty, F.lit(False)), F.lit(None).cast("string")).otherwise(text)


def first_truthy_field(v, *paths: str) -> Column:
    """Python ``a or b or …`` over fields of a VARIANT (SCL-19)."""
    return F.coalesce(*[truthy_text(v, p) for p in paths])


# ---------------------------------------------------------------- local clock (SCL-03/05/08/21)

def to_local(ts, tz: str = DEFAULT_TZ) -> Column:
    """UTC instant -> local wall clock (TIMESTAMP_NTZ)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), _c(ts).cast("timestamp_ntz"))


def from_local(local_ts, tz: str = DEFAULT_TZ) -> Column:
    """Local wall clock -> UTC instant as TIMESTAMP_NTZ."""
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), _c(local_ts).cast("timestamp_ntz"))


def local_day(ts, tz: str = DEFAULT_TZ) -> Column:
    """Local calendar day of a UTC instant (SCL-03)."""
    return to_local(ts, tz).cast("date")


def mmddyyyy(ts, tz: str = DEFAULT_TZ) -> Column:
    return F.date_format(to_local(ts, tz), "MMddyyyy")


def seconds_since_midnight(ts, tz: str = DEFAULT_TZ) -> Column:
    """Seconds since local midnight (SCL-08)."""
    lt = to_local(ts, tz)
    return (F.hour(lt) * 3600 + F.minute(lt) * 60 + F.second(lt)).cast("int")


def hms_of_ts(ts, tz: str = DEFAULT_TZ) -> Column:
    """Local ``HH:MM:SS`` of an instant (SCL-21)."""
    return F.date_format(to_local(ts, tz), "HH:mm:ss")


def utc_offset(ts, tz: str = DEFAULT_TZ) -> Column:
    """``±HHMM`` offset of ``tz`` at the instant ``ts``."""
    secs = (F.unix_seconds(to_local(ts, tz).cast("timestamp"))
            - F.unix_seconds(_c(ts).cast("timestamp_ntz").cast("timestamp")))
    sign = F.when(secs < 0, F.lit("-")).otherwise(F.lit("+"))
    a = F.abs(secs)
    return F.format_string("%s%02d%02d", sign, (a / 3600).cast("int"), ((a % 3600) / 60).cast("int"))


def iso_local(ts, tz: str = DEFAULT_TZ) -> Column:
    """``YYYY-MM-DDTHH:MM:SS±HHMM`` in ``tz`` (the text form of first/last logged)."""
    return F.concat(F.date_format(to_local(ts, tz), "yyyy-MM-dd'T'HH:mm:ss"), utc_offset(ts, tz))


def parse_envelope_ts(col, tz: str = DEFAULT_TZ) -> Column:
    """ISO-8601 text with an offset, or naive ``YYYY-MM-DD HH:MM:SS`` local text -> UTC instant (NTZ).

    SCL-05: naive text (error rows) is read as local wall clock in ``tz``.
    """
    s = F.trim(_c(col))
    has_offset = s.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    with_offset = F.try_to_timestamp(s)  # ISO with zone -> instant rendered in session zone (UTC)
    naive = F.try_to_timestamp(F.regexp_replace(s, "T", " "), F.lit("yyyy-MM-dd HH:mm:ss"))
    return F.when(has_offset, with_offset.cast("timestamp_ntz")).otherwise(from_local(naive, tz))


def parse_logged(col, tz: str = DEFAULT_TZ) -> Column:
    """Free-form logged date -> UTC instant (NTZ) (SCL-04).

    Order: ISO text with offset; ISO date or date-time without offset (local);
    ``MMDDYYYY`` (local midnight); anything else -> null.
    """
    s = F.trim(_c(col).cast("string"))
    has_offset = s.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})$")
    iso_zoned = F.try_to_timestamp(s).cast("timestamp_ntz")
    naive_dt = F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?)?$"),
                      F.try_to_timestamp(F.regexp_replace(s, "T", " ")).cast("timestamp_ntz"))
    mdy = F.when(s.rlike(r"^\d{8}$"), F.try_to_timestamp(s, F.lit("MMddyyyy")).cast("timestamp_ntz"))
    return F.when(has_offset, iso_zoned).otherwise(from_local(F.coalesce(naive_dt, mdy), tz))


def iso_seconds(ts, tz: str = DEFAULT_TZ) -> Column:
    """``YYYY-MM-DDTHH:MM:SS±HH:MM`` of an instant in ``tz`` (fraction truncated)."""
    def body(pair):
        local, utc = pair["l"], pair["u"]
        secs = F.unix_seconds(local.cast("timestamp")) - F.unix_seconds(utc.cast("timestamp"))
        a = F.abs(secs)
        off = F.format_string("%s%02d:%02d", F.when(secs < 0, F.lit("-")).otherwise(F.lit("+")),
                              (a / 3600).cast("int"), ((a % 3600) / 60).cast("int"))
        return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), off)
    t = _c(ts).cast("timestamp_ntz")
    return _let(F.struct(to_local(t, tz).alias("l"), t.alias("u")), body)


def parse_dotnet_date(col, anchored: bool = False, keep_unmatched: bool = True, tz: str = DEFAULT_TZ) -> Column:
    """``/Date(ms±hhmm)/`` -> instant, the offset ignored (SCL-06).

    Empty text gives null. With ``keep_unmatched`` the result is a STRING: the
    instant as local ISO text with offset at second precision, or the input text
    when it does not match; otherwise a TIMESTAMP_NTZ (UTC) that is null on no
    match. ``anchored`` is the TransLoc form: ``/Date(ms)/`` at the start, no offset.
    """
    pat = r"^/Date\((\d+)\)/" if anchored else r"/Date\((\d+)([+-]\d{4})?\)/"

    def parse(s):
        digits = F.regexp_extract(s, pat, 1)
        return F.when(digits != "", F.timestamp_millis(digits.try_cast("bigint")).cast("timestamp_ntz"))

    def body(s):
        ts = parse(s)
        if not keep_unmatched:
            return F.when(F.trim(s) != "", ts)
        return (F.when(s.isNull() | (s == ""), F.lit(None).cast("string"))
                .otherwise(F.coalesce(_let(ts, lambda t: F.when(t.isNotNull(), iso_seconds(t, tz))), s)))
    return _let(_c(col).cast("string"), body)


# ---------------------------------------------------------------- GTFS clock (SCL-07/09/12)

def time_to_seconds(col) -> Column:
    """``H:M:S`` (hours may exceed 24) -> seconds; malformed or blank -> null (SCL-07)."""
    parts = F.split(F.regexp_replace(_c(col).cast("string"), r"^\s+|\s+$", ""), ":")
    num = r"^\s*[+-]?\d+\s*$"
    ok = (F.size(parts) >= 3) & F.get(parts, 0).rlike(num) & F.get(parts, 1).rlike(num) & F.get(parts, 2).rlike(num)

    def part(i):
        return F.trim(F.get(parts, i)).try_cast("bigint")
    return F.when(ok, part(0) * 3600 + part(1) * 60 + part(2))


def seconds_to_hms(col) -> Column:
    """Seconds -> ``HH:MM:SS`` modulo one day (SCL-09)."""
    t = F.pmod(_c(col).cast("bigint"), F.lit(86400))
    return F.when(t.isNotNull(), F.format_string("%02d:%02d:%02d", (t / 3600).cast("int"),
                                                 ((t % 3600) / 60).cast("int"), (t % 60).cast("int")))


def service_state(now_seconds, tmin, tmax, wrap: bool = False) -> Column:
    """Service state from the clock and the service window (SCL-12).

    PRE_FLIGHT in [tmin-3600, tmin), ACTIVE in [tmin, tmax], END_OF_SERVICE in
    (tmax, tmax+3600], else OFF_HOURS; STARTUP while the window is unknown.
    With ``wrap`` a clock before ``tmin`` is also tried one day later, so windows
    ending past midnight (tmax > 86400) are reachable.
    """
    n, lo, hi = _c(now_seconds), _c(tmin), _c(tmax)

    def classify(x):
        return (F.when((x >= lo - 3600) & (x < lo), F.lit("PRE_FLIGHT"))
                .when((x >= lo) & (x <= hi), F.lit("ACTIVE"))
                .when((x > hi) & (x <= hi + 3600), F.lit("END_OF_SERVICE")))

    base = classify(n)
    if wrap:
        base = F.coalesce(base, F.when(n < lo, classify(n + 86400)))
    return F.when(lo.isNull() | hi.isNull(), F.lit("STARTUP")).otherwise(F.coalesce(base, F.lit("OFF_HOURS")))


# ---------------------------------------------------------------- stream labels (SCL-14/15/16)

# Stream-type keyword rules per platform, first match wins.
STREAM_CLASS_RULES = {
    "gtfsrt": [(("vehicle",), "vehicle"), (("trip",), "trip"), (("alert",), "alert")],
    "transloc": [(("vehicle",), "vehicle"), (("arrival", "stop"), "prediction"), (("route",), "config"),
                 (("capacit",), "occupancy")],
    "swiv": [(("vehicle",), "vehicle"), (("alert",), "alert"), (("config", "version"), "config"),
             (("topo",), "topo")],
}

# Exact stream names per platform and their type; any other stream is ``Streamed``.
STREAM_CLASS_NAMES = {
    "bustime": {"Bi-Weekly": ("Agencies", "Locales", "RealTimeDataFeeds"),
                "Hourly": ("Routes", "Directions", "Stops", "Patterns", "ServiceBulletins", "BusBridges")},
    "passiogo": {"Hourly": ("FeedInfo", "Routes", "Stops")},
    "routematch": {"Hourly": ("Version", "Timezone", "MasterRoute", "MasterRouteNames", "StopKeywords")},
    "massport": {"Hourly": ("Routes", "Stops", "Trips", "Collections"), "Live": ("Predictions",)},
}

# Streams the coverage page counts as the main group.
MAIN_STREAMS = (
    "vehicles", "alerts", "predictions", "stop_events",
    "schedules", "services", "shapes", "trips", "lines",
    "routes", "route_patterns", "facilities", "stops", "live_facilities",
    "VehiclePositions", "Alerts", "TripUpdates",
)

# Coverage level upper bounds (exclusive) for levels 1, 2, 3; 4 above.
COVERAGE_LEVEL_BOUNDS = (500, 2000, 10000)


def stream_class(col, platform: str = "gtfsrt",
                 rules: Sequence[tuple[Iterable[str], str]] | None = None, default: str = "general") -> Column:
    """Stream type by ordered keyword rules, or by exact names, per platform (SCL-14)."""
    if rules is None and platform in STREAM_CLASS_NAMES:
        expr = F.lit("Streamed")
        for label, names in STREAM_CLASS_NAMES[platform].items():
            expr = F.when(_c(col).isin(*names), F.lit(label)).otherwise(expr)
        return expr
    low = F.lower(_c(col))
    expr = None
    for words, label in (rules or STREAM_CLASS_RULES[platform]):
        cond = None
        for w in words:
            c = low.contains(w)
            cond = c if cond is None else (cond | c)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


def stream_group(col) -> Column:
    """enhanced / main / custom group of a stream name (SCL-15)."""
    s = _c(col)
    return (F.when(F.lower(s).contains("enhanced"), F.lit("enhanced"))
            .when(s.isin(*MAIN_STREAMS), F.lit("main"))
            .otherwise(F.lit("custom")))


def coverage_level(rows) -> Column:
    """Calendar colour level 0..4 of a day's row count (SCL-16)."""
    r = _c(rows)
    b1, b2, b3 = COVERAGE_LEVEL_BOUNDS
    return (F.when(r.isNull() | (r == 0), F.lit(0))
            .when(r < b1, F.lit(1)).when(r < b2, F.lit(2)).when(r < b3, F.lit(3))
            .otherwise(F.lit(4))).cast("int")


def sunday_of(day) -> Column:
    """Sunday on or before ``day`` (SCL-22)."""
    d = _c(day).cast("date")
    return F.date_sub(d, F.dayofweek(d) - 1)


def saturday_of(day) -> Column:
    d = _c(day).cast("date")
    return F.date_add(d, 7 - F.dayofweek(d))
