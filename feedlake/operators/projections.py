"""Projections and reshapes (PRJ-01..14).

All projections are ``select`` lists of built-in expressions over VARIANT or
typed columns; nothing leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.functions.identity import as_variant, event_hash_struct
from feedlake.functions.scalars import first_truthy_field, local_day, parse_dotnet_date, strip


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def to_envelope(df: DataFrame, agency, stream, event, data, endpoint=None, id_=None, ts=None,
                metadata=None, tz: str | None = None) -> DataFrame:
    """Build the event envelope with its content hash and local day (PRJ-01); ``metadata``
    such as ``{route_id, direction}`` rides beside the payload and is hashed with it (PRJ-13)."""
    cols = {
        "ts": _c(ts) if ts is not None else F.current_timestamp().cast("timestamp_ntz"),
        "agency": _c(agency), "stream": _c(stream), "event": _c(event),
        "endpoint": F.coalesce(_c(endpoint), F.lit("")) if endpoint is not None else F.lit(""),
        "id": _c(id_).cast("string") if id_ is not None else F.lit(None).cast("string"),
        "data": stringify_payload(data),
        "metadata": stringify_payload(metadata) if metadata is not None else F.lit(None).cast("string"),
    }
    out = df.select(*[v.alias(k) for k, v in cols.items()])
    out = out.withColumn("hash_id", event_hash_struct("agency", "stream", "event", "endpoint", "data", "metadata"))
    if tz:
        out = out.withColumn("day", local_day("ts", tz))
    return out


def is_container(v) -> Column:
    """VARIANT holds an object or an array."""
    return (F.try_variant_get(v, "$", "map<string,variant>").isNotNull()
            | F.try_variant_get(v, "$", "array<variant>").isNotNull())


def stringify_payload(col, is_variant: bool = False) -> Column:
    """Object/list payload -> JSON text; null stays null; a scalar -> its text (PRJ-02, PRJ-12).

    STRING input is read as JSON when it parses; text that is not JSON is kept.
    """
    c = _c(col)
    v = c if is_variant else as_variant(c)
    scalar = F.try_variant_get(v, "$", "string") if is_variant else c.cast("string")
    return F.when(c.isNull(), F.lit(None).cast("string")).when(is_container(v), F.to_json(v)).otherwise(scalar)


def to_variant_value(col) -> Column:
    """Any typed column as a VARIANT value."""
    return F.try_variant_get(F.to_variant_object(F.struct(_c(col).alias("v"))), "$.v", "variant")


def align_schema(df: DataFrame, target: T.StructType) -> DataFrame:
    """Order to ``target``, cast each field (null on failure), add missing fields
    as null, drop extras (PRJ-03)."""
    out = []
    for f in target.fields:
        if f.name in df.columns:
            out.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
        else:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*out)


# Occupancy labels by paxLoad fraction, checked in this order.
OCCUPANCY_STEPS = ((0.3, "MANY_SEATS_AVAILABLE"), (0.7, "FEW_SEATS_AVAILABLE"), (0.9, "STANDING_ROOM_ONLY"))


def derive_occupancy(pax_load, existing=None) -> Column:
    """GTFS occupancy label from a load fraction (PRJ-06).

    Existing label wins; 0 -> EMPTY; < 0.3 / 0.7 / 0.9 -> steps; else FULL (NaN
    lands in FULL); null or non-numeric -> NO_DATA_AVAILABLE.
    """
    x = _c(pax_load).cast("string").try_cast("double")
    label = F.when(x.isNull(), F.lit("NO_DATA_AVAILABLE")).when(x == 0, F.lit("EMPTY"))
    for bound, name in OCCUPANCY_STEPS:
        label = label.when(x < bound, F.lit(name))
    label = label.otherwise(F.lit("FULL"))
    return label if existing is None else F.coalesce(_c(existing), label)


def vget(v, path: str, dtype: str = "string") -> Column:
    return F.try_variant_get(_c(v), path, dtype)


# InfoPoint vehicle fields -> output names (PRJ-04).
INFOPOINT_VEHICLE_FIELDS = (
    ("VehicleId", "vehicle_id"), ("Name", "vehicle_name"), ("VehicleFareboxId", "vehicle_farebox_id"),
    ("RunId", "run_id"), ("TripId", "trip_id"), ("BlockFareboxId", "block_farebox_id"),
    ("Latitude", "latitude"), ("Longitude", "longitude"), ("Heading", "heading"), ("Speed", "speed"),
    ("Direction", "direction"), ("DirectionLong", "direction_long"), ("Destination", "destination"),
    ("LastStop", "last_stop"), ("StopId", "stop_id"), ("OnBoard", "on_board"),
    ("OccupancyStatus", "occupancy_status"), ("OccupancyStatusReportLabel", "occupancy_label"),
    ("Deviation", "deviation"), ("OpStatus", "op_status"), ("DisplayStatus", "display_status"),
    ("CommStatus", "comm_status"), ("GPSStatus", "gps_status"), ("SeatingCapacity", "seating_capacity"),
    ("TotalCapacity", "total_capacity"), ("PropertyName", "property_name"),
)


def infopoint_vehicle(route, vehicle) -> list[Column]:
    """30-column projection of an InfoPoint vehicle with its route context (SRC-08, PRJ-04)."""
    r, v = _c(route), _c(vehicle)
    cols = [vget(r, "$.RouteId").alias("route_id"),
            first_truthy_field(r, "$.RouteAbbreviation", "$.ShortName").alias("route_abbr"),
            first_truthy_field(r, "$.LongName", "$.GoogleDescription").alias("route_name")]
    cols += [vget(v, f"$.{src}").alias(dst) for src, dst in INFOPOINT_VEHICLE_FIELDS]
    cols.append(parse_dotnet_date(vget(v, "$.LastUpdated")).alias("last_updated"))
    return cols


# InfoPoint alert fields -> output names (PRJ-05).
INFOPOINT_ALERT_FIELDS = (
    ("MessageId", "message_id"), ("Header", "header"), ("Message", "message"), ("Priority", "priority"),
    ("CauseReportLabel", "cause"), ("EffectReportLabel", "effect"), ("DaysOfWeek", "days_of_week"),
    ("URL", "url"), ("Published", "published"), ("IsPrimaryRecord", "is_primary_record"),
)


def infopoint_alert(alert) -> list[Column]:
    """13-column projection of an InfoPoint alert (SRC-09, PRJ-05); ``Routes`` defaults to []."""
    a = _c(alert)
    cols = [vget(a, f"$.{src}").alias(dst) for src, dst in INFOPOINT_ALERT_FIELDS]
    routes = F.coalesce(F.to_json(vget(a, "$.Routes", "variant")), F.lit("[]"))
    cols += [routes.alias("routes"),
             parse_dotnet_date(vget(a, "$.FromDate")).alias("from_date"),
             parse_dotnet_date(vget(a, "$.ToDate")).alias("to_date")]
    return cols


def canonical_route(item) -> Column:
    """Route id = ``id`` or, when that is missing, '' or 0, ``myid``; stripped, and null when
    nothing is left (PRJ-09)."""
    return F.nullif(strip(first_truthy_field(item, "$.id", "$.myid")), F.lit(""))


def first_per_id(items, path: str) -> Column:
    """Items of an array of VARIANT, the first of each id kept (WIN-02 inside one answer: no
    shuffle); items without the id are kept once."""
    def body(t):
        ids = F.transform(t, lambda x: F.coalesce(F.try_variant_get(x, path, "string"), F.lit("\x00")))
        first = F.array_distinct(ids)
        return F.when(F.size(first) == F.size(ids), t).otherwise(
            F.transform(first, lambda k: F.element_at(t, F.array_position(ids, k).cast("int"))))
    return F.element_at(F.transform(F.array(_c(items)), body), 1)


def attach_key(item, name: str, value) -> Column:
    """Object payload with ``name`` set when absent; non-objects wrapped as
    ``{"raw": …}`` first (PRJ-07, PRJ-08, PRJ-10). Returns JSON text."""
    v = _c(item)
    obj = F.try_variant_get(v, "$", "map<string,variant>")
    base = F.when(obj.isNotNull(), obj).otherwise(F.create_map(F.lit("raw"), v))
    has = F.array_contains(F.map_keys(base), F.lit(name))
    merged = F.when(has, base).otherwise(F.map_concat(base, F.create_map(F.lit(name), to_variant_value(value))))
    return F.to_json(F.to_variant_object(merged))


def occupancy_payload(bus) -> Column:
    """Label for a bus object: its own ``gtfsOccupancyStatus`` when the key exists
    (even if null), else one derived from ``paxLoad`` when that key exists."""
    v = _c(bus)
    keys = F.map_keys(F.try_variant_get(v, "$", "map<string,variant>"))
    has_status = F.coalesce(F.array_contains(keys, F.lit("gtfsOccupancyStatus")), F.lit(False))
    has_pax = F.coalesce(F.array_contains(keys, F.lit("paxLoad")), F.lit(False))
    return F.when(has_status, vget(v, "$.gtfsOccupancyStatus")).when(has_pax, derive_occupancy(vget(v, "$.paxLoad")))
