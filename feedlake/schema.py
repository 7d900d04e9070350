"""Envelope and table schemas. Explicit StructTypes everywhere: no inference."""

from pyspark.sql import types as T

# Default local zone of the feeds (ISO offsets -04:00/-05:00 in captured files).
DEFAULT_TZ = "America/New_York"

# Raw WAL line as landed (JSON Lines). ``data``/``metadata`` stay raw JSON text
# here and become VARIANT after ``parse_json``.
WAL_SCHEMA = T.StructType([
    T.StructField("hash_id", T.StringType()),
    T.StructField("ts", T.StringType()),
    T.StructField("agency", T.StringType()),
    T.StructField("stream", T.StringType()),
    T.StructField("endpoint", T.StringType()),
    T.StructField("event", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("data", T.StringType()),
    T.StructField("metadata", T.StringType()),
    T.StructField("_corrupt", T.StringType()),
])

# Archived envelope (Parquet, partitioned by agency, stream, day).
ARCHIVE_SCHEMA = T.StructType([
    T.StructField("hash_id", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("ts_raw", T.StringType()),
    T.StructField("event", T.StringType()),
    T.StructField("endpoint", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("data", T.StringType()),
    T.StructField("metadata", T.StringType()),
    T.StructField("agency", T.StringType()),
    T.StructField("stream", T.StringType()),
    T.StructField("day", T.DateType()),
])

ENVELOPE_COLUMNS = ["hash_id", "ts", "agency", "stream", "endpoint", "event", "id", "data", "metadata"]

# The log of landing files that a finished compaction has read.
COMPACTION_LOG_SCHEMA = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("agency", T.StringType()),
    T.StructField("stream", T.StringType()),
    T.StructField("day", T.DateType()),
    T.StructField("landed_at", T.TimestampType()),
    T.StructField("bytes", T.LongType()),
    T.StructField("folder_rows", T.LongType()),
    T.StructField("compacted_at", T.TimestampType()),
])

# Captured poll response: the landing form for request/response sources.
CAPTURE_SCHEMA = T.StructType([
    T.StructField("agency", T.StringType()),
    T.StructField("stream", T.StringType()),
    T.StructField("endpoint", T.StringType()),
    T.StructField("poll_id", T.StringType()),
    T.StructField("poll_ts", T.TimestampNTZType()),
    T.StructField("http_status", T.IntegerType()),
    T.StructField("body", T.StringType()),
])

ENTITY_IDS_SCHEMA = T.StructType([
    T.StructField("agency", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("first_seen", T.TimestampNTZType()),
    T.StructField("last_seen", T.TimestampNTZType()),
])

COVERAGE_SCHEMA = T.StructType([
    T.StructField("agency", T.StringType()),
    T.StructField("stream", T.StringType()),
    T.StructField("day", T.DateType()),
    T.StructField("rows", T.LongType()),
])
