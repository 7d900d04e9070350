"""Write-ahead-log (JSON Lines) landing and the Parquet archive (SRC-01, SRC-20).

Landing layout is ``<root>/agency=…/stream=…/day=…/part-*.txt`` with one JSON
envelope per line, ``data`` embedded as a JSON value. Lines that do not parse
land in ``_corrupt`` instead of failing the read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.functions.identity import json_string
from feedlake.functions.scalars import file_day, local_day, parse_envelope_ts
from feedlake.schema import ARCHIVE_SCHEMA, DEFAULT_TZ, ENVELOPE_COLUMNS, WAL_SCHEMA

PARTITIONS = ("agency", "stream", "day")

LINE_SCHEMA = T.StructType([f for f in WAL_SCHEMA.fields if f.name not in PARTITIONS])


def json_or_text(col: str) -> Column:
    """An object or array as its JSON value, any other text as a JSON string: reading the
    line back gives the same text, whatever it was."""
    v = F.try_parse_json(F.col(col))
    box = F.try_variant_get(v, "$", "map<string,variant>").isNotNull() | F.try_variant_get(v, "$", "array<variant>").isNotNull()
    return F.when(box, v).otherwise(F.try_parse_json(json_string(F.col(col))))


def wal_line(ts_text: Column, columns=ENVELOPE_COLUMNS) -> Column:
    """One JSON line of an envelope with the envelope fields that ``columns`` has; payload
    and metadata embedded as JSON values. Agency and stream are in it and in the folder name."""
    have = set(columns)
    fields = []
    for name in ENVELOPE_COLUMNS:
        if name == "ts":
            fields.append(ts_text.alias("ts"))
        elif name in have:
            fields.append((json_or_text(name) if name in ("data", "metadata") else F.col(name)).alias(name))
    return F.to_json(F.struct(*fields))


def iso_ts_text(ts: str = "ts", tz: str = DEFAULT_TZ) -> Column:
    """ISO-8601 local text with offset and microseconds, as the capture writes it."""
    from feedlake.functions.scalars import to_local, utc_offset
    off = utc_offset(ts, tz)
    return F.concat(F.date_format(to_local(ts, tz), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
                    F.substr(off, F.lit(1), F.lit(3)), F.lit(":"), F.substr(off, F.lit(4), F.lit(2)))


def read_wal(spark: SparkSession, root: str, tz: str = DEFAULT_TZ) -> DataFrame:
    """Partitioned landing -> envelopes with ``ts`` (UTC instant), ``ts_raw`` and ``data`` text (SRC-01).

    The partition columns ``agency``, ``stream``, ``day`` come from the folder
    names, so filters on them prune folders before any file is opened.
    """
    schema = T.StructType(list(LINE_SCHEMA.fields) + [
        T.StructField("agency", T.StringType()), T.StructField("stream", T.StringType()),
        T.StructField("day", T.DateType())])
    # ``_file`` (the file's name) tells a sweep which files it has read.
    raw = (spark.read.schema(schema).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", "_corrupt").json(root))
    raw = raw.select("*", F.col("_metadata.file_name").alias("_file"))
    return raw.withColumn("ts_raw", F.col("ts")).withColumn("ts", parse_envelope_ts("ts_raw", tz))


def read_wal_files(spark: SparkSession, path: str, tz: str = DEFAULT_TZ) -> DataFrame:
    """SRC-01 for flat files named ``<AGENCY>_<stream>_<MMDDYYYY>.jsonl``: agency, stream and day
    from the file name (the first ``_`` part, the middle, the last)."""
    raw = (spark.read.schema(WAL_SCHEMA).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", "_corrupt").json(path))
    name = F.col("_metadata.file_name")
    stem = F.regexp_extract(name, r"^(.*)\.[^.]*$", 1)
    out = raw.withColumn("_file", name) \
        .withColumn("agency", F.coalesce(F.col("agency"), F.regexp_extract(stem, r"^([^_]+)_", 1))) \
        .withColumn("stream", F.coalesce(F.col("stream"), F.regexp_extract(stem, r"^[^_]+_(.*)_[^_]+$", 1))) \
        .withColumn("day", file_day(name))
    out = out.withColumn("ts_raw", F.col("ts")).withColumn("ts", parse_envelope_ts("ts_raw", tz))
    return out.withColumn("day", F.coalesce(F.col("day"), local_day("ts", tz)))


def read_archive(spark: SparkSession, root: str) -> DataFrame:
    """The compacted archive (Parquet partitioned by agency, stream, day) (SRC-20), with its
    schema: agency ``007`` stays text, and files of an older layout read as nulls."""
    return spark.read.schema(ARCHIVE_SCHEMA).parquet(root)
