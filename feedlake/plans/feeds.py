"""How the driver's tables stand in for feed data.

``events(event_id, ts, user_id, event_type, value, props)`` plays the captured
feed: stream and endpoint = ``event_type``, entity id = ``user_id``, payload =
``props`` (JSON text), capture instant = ``ts`` (UTC), agency = one of five
operators chosen by ``user_id % 5``. Every derived frame reads the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions.identity import event_hash_struct
from feedlake.functions.scalars import local_day
from feedlake.schema import DEFAULT_TZ
from feedlake.sources.tables import read_table

# Fixed values of the stand-in mapping.
AGENCIES = 5
EVENT_NAME = "update"
STREAM_FILES_PER_TRIGGER = 1000  # bounds a micro-batch (and so one folder's writer per batch)


def agency_of_user(col="user_id"):
    return F.format_string("A%d", F.col(col) % AGENCIES)


def feed_envelopes(spark: SparkSession, sf_dir: str, tz: str = DEFAULT_TZ) -> DataFrame:
    """Envelope rows with ``hash_id`` (IDN-03) and local ``day``."""
    # Hashing and JSON parsing are per-row CPU work: spread a single-split scan.
    return envelopes_from_events(read_table(spark, sf_dir, "events", parallel=True), tz)


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream (only ``events.parquet`` of the folder)."""
    schema = read_table(spark, sf_dir, "events").schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
            .option("maxFilesPerTrigger", STREAM_FILES_PER_TRIGGER).parquet(sf_dir))


def envelopes_from_events(ev: DataFrame, tz: str = DEFAULT_TZ) -> DataFrame:
    """Batch or streaming ``events`` -> envelopes."""
    env = ev.select(
        "event_id", "ts", "user_id", "value",
        agency_of_user().alias("agency"),
        F.col("event_type").alias("stream"),
        F.col("event_type").alias("endpoint"),
        F.lit(EVENT_NAME).alias("event"),
        F.col("user_id").cast("string").alias("id"),
        F.col("props").alias("data"),
    )
    return env.withColumn("day", local_day("ts", tz)).withColumn(
        "hash_id", event_hash_struct("agency", "stream", "event", "endpoint", "data"))


def lineitem_envelopes(spark: SparkSession, sf_dir: str, tz: str = DEFAULT_TZ) -> DataFrame:
    """A second, larger stand-in feed over ``lineitem``: agency = one of 25 supplier
    groups, stream = return flag + line status, entity = order, payload = line
    number and whole quantity, capture instant = ship date + line number hours."""
    li = read_table(spark, sf_dir, "lineitem", parallel=True)
    data = F.to_json(F.struct(F.col("l_linenumber").alias("ln"), F.col("l_quantity").cast("int").alias("q")))
    env = li.select(
        F.format_string("N%d", F.col("l_suppkey") % 25).alias("agency"),
        F.concat("l_returnflag", "l_linestatus").alias("stream"),
        F.concat("l_returnflag", "l_linestatus").alias("endpoint"),
        F.lit(EVENT_NAME).alias("event"),
        F.col("l_orderkey").cast("string").alias("id"),
        data.alias("data"),
        (F.col("l_shipdate") + F.make_interval(hours=F.col("l_linenumber"))).alias("ts"),
    )
    return env.withColumn("day", local_day("ts", tz)).withColumn(
        "hash_id", event_hash_struct("agency", "stream", "event", "endpoint", "data"))
