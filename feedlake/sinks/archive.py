"""Sinks: WAL landing, day compaction, schedule tables, coverage (SNK-01..06).

Compaction is idempotent and lossless: the landing's new files of closed days are
unioned with what the archive holds in the same folders, deduplicated by content
hash and written once with dynamic partition overwrite (only the touched
``agency/stream/day`` folders are replaced, each by one rename when the whole write
is done). An archive that cannot be read stops the job. Lines that do not parse go to
the ``Errors`` stream with their text. Rows are dealt to writers by folder, and a folder
that holds a third of all rows to as many writers as its size asks for (by row hash).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.functions.identity import error_hash
from feedlake.functions.scalars import from_local, local_day, to_local
from feedlake.operators.dedupe import dedupe_events
from feedlake.operators.filters import closed_days
from feedlake.schema import ARCHIVE_SCHEMA, COMPACTION_LOG_SCHEMA, DEFAULT_TZ
from feedlake.sources.wal import PARTITIONS, iso_ts_text, read_archive, wal_line

ZSTD_LEVEL = 10              # Fixed value: archive codec level.
ROWS_PER_WRITER = 1_000_000
BYTES_PER_WRITER = 256 << 20  # of landing lines


def read_if_exists(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """A Parquet table, or None when the path does not exist; any other failure is raised."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    try:
        return reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def same_folder(a: str, b: str) -> Column:
    """Null-safe match of the folder keys of two aliased frames."""
    out = F.lit(True)
    for c in PARTITIONS:
        out = out & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return out


def folder_writers(rows: DataFrame, keys: Sequence[str] = PARTITIONS, rows_per_writer: int = ROWS_PER_WRITER) -> DataFrame:
    """How many tasks write each folder: one for every ``rows_per_writer`` rows (folder keys only are read)."""
    return rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / rows_per_writer).cast("int").alias("_w"))


def spread(df: DataFrame, writers: DataFrame, keys: Sequence[str] = PARTITIONS) -> DataFrame:
    """Deal rows to writers: ``writers`` has the folder keys and the number ``_w`` of tasks
    that write the folder; rows of a folder not in it go to one. Small folders are spread
    over all tasks of the shuffle, since each file costs the same whatever its size."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    many = writers.where("_w > 1").select(*[F.col(c).alias(f"_w_{c}") for c in keys], "_w")
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"_w_{c}"))
    row = F.xxhash64("hash_id") if "hash_id" in df.columns else F.xxhash64(*df.columns)
    salted = df.join(many, same, "left").withColumn("_salt", F.pmod(row, F.coalesce("_w", F.lit(1))))
    return salted.repartition(n, *[F.col(c) for c in keys], F.col("_salt")).select(*df.columns)


def wal_append(envelopes: DataFrame, root: str, tz: str = DEFAULT_TZ, rows_per_writer: int = ROWS_PER_WRITER) -> None:
    """Append envelopes as JSON Lines under ``agency=/stream=/day=`` (SNK-01).

    Rows are counted per folder first (folder keys only); a folder is written by one task
    for every ``rows_per_writer`` rows, so a hot stream-day is cut into many.
    """
    writers = folder_writers(envelopes, rows_per_writer=rows_per_writer)
    lines = envelopes.select(*PARTITIONS, "hash_id", wal_line(iso_ts_text("ts", tz), envelopes.columns).alias("value"))
    spread(lines, writers).select(*PARTITIONS, "value").write.mode("append").partitionBy(*PARTITIONS).text(root)


def _write_parquet(df: DataFrame, path: str, mode: str, partition_by: Sequence[str]) -> None:
    """Parquet zstd; an overwrite of a partitioned table replaces only the folders
    present in ``df`` (dynamic partition overwrite, set per write so it does not
    depend on the session's default)."""
    (df.write.mode(mode).option("compression", "zstd")
     .option("parquet.compression.codec.zstd.level", str(ZSTD_LEVEL))
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def landing_files(spark: SparkSession, landing_root: str) -> DataFrame:
    """Landing files with their folder, name and time, from file metadata only
    (``binaryFile`` without its ``content`` column reads no data)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(landing_root)

    def folder(name: str) -> Column:  # read from the path as text: ``agency=007`` stays ``007``
        raw = F.regexp_extract("path", f"/{name}=([^/]*)/", 1)
        text = F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))
        return F.when(raw != "__HIVE_DEFAULT_PARTITION__", text).alias(name)

    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("file"), folder("agency"), folder("stream"),
                        folder("day").cast("date").alias("day"), F.col("modificationTime").alias("landed_at"),
                        F.col("length").alias("bytes"))


def pending_files(spark: SparkSession, landing_root: str, log_root: str) -> DataFrame:
    """Landing files that no finished compaction has read (STR-04 sweep), told by folder
    and file name: a file that lands in the same clock tick as another is still new."""
    files = landing_files(spark, landing_root)
    log = read_if_exists(spark, log_root, COMPACTION_LOG_SCHEMA)
    if log is None:
        return files
    return files.alias("f").join(log.alias("l"), (F.col("f.file") == F.col("l.file")) & same_folder("f", "l"), "left_anti")


def remove_files(spark: SparkSession, paths: DataFrame) -> int:
    """Delete the files named by the first column; returns how many went."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    for row in paths.toLocalIterator():
        path = jvm.org.apache.hadoop.fs.Path(row[0])
        n += bool(path.getFileSystem(conf).delete(path, False))
    return n


def archive_rows(landing: DataFrame, tz: str = DEFAULT_TZ) -> DataFrame:
    """Landing rows in the archive's columns. A line that does not parse becomes an error
    envelope with the raw line in its message and the folder's agency and day (SNK-04)."""
    have = set(landing.columns)
    row = {f.name: (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType) for f in ARCHIVE_SCHEMA}
    if "_corrupt" not in have:
        return landing.select(*[c.alias(n) for n, c in row.items()])
    message = F.concat(F.lit("unparsable line in "), F.coalesce("stream", F.lit("?")), F.lit(": "), F.col("_corrupt"))
    error = error_fields(F.col("agency"), message, from_local(F.col("day").cast("timestamp_ntz"), tz), tz)
    error = {f.name: error.get(f.name, F.lit(None)).cast(f.dataType) for f in ARCHIVE_SCHEMA}
    bad = F.col("_corrupt").isNotNull()
    return landing.select(*[F.when(bad, error[n]).otherwise(row[n]).alias(n) for n in ARCHIVE_SCHEMA.names])


def compact_days(spark: SparkSession, landing: DataFrame, archive_root: str, as_of: Column, tz: str = DEFAULT_TZ,
                 scope: str = "day", landing_root: str | None = None, log_root: str | None = None,
                 remove_source: bool = False, rows_per_writer: int = ROWS_PER_WRITER,
                 bytes_per_writer: int = BYTES_PER_WRITER) -> int:
    """Move closed local days of the landing into the archive (SNK-02, FLT-01, STR-04, STR-10).

    Rows of days before the local date of ``as_of`` are merged with the archive's
    rows for the same folders, deduplicated (IDN-07) and swapped in. With
    ``landing_root`` and ``log_root`` the sweep is incremental: a metadata-only
    listing less the log gives the files to read, the sweep stops before reading any
    data when there are none, and after the swap the files are logged with their
    folder's row count (and deleted, with ``remove_source``). Returns the number of
    folders written (0 when nothing was pending).
    """
    closed = closed_days(landing, as_of, tz)
    pending = None
    if landing_root and log_root:
        # Frozen as a small written table: files that land during this sweep stay
        # pending for the next one, so the log records exactly what this sweep read.
        frozen = f"{log_root.rstrip('/')}_pending"
        closed_days(pending_files(spark, landing_root, log_root), as_of, tz).write.mode("overwrite").parquet(frozen)
        pending = spark.read.parquet(frozen)
        if pending.isEmpty():
            return 0
        closed = closed.alias("c").join(pending.alias("p"), (F.col("c._file") == F.col("p.file")) & same_folder("c", "p"),
                                        "left_semi")
    rows = archive_rows(closed, tz)
    folders = (pending if pending is not None else closed).select(*PARTITIONS)
    # An unparsable line goes to its agency's Errors folder of the day: that is touched too.
    folders = folders.unionByName(folders.withColumn("stream", F.lit("Errors"))).distinct()
    existing = read_if_exists(spark, archive_root, ARCHIVE_SCHEMA)
    if existing is not None:
        rows = rows.unionByName(existing.alias("a").join(folders.alias("t"), same_folder("a", "t"), "left_semi")
                                .select(*ARCHIVE_SCHEMA.names))
    out = dedupe_events(rows, scope=scope, order=("ts", "ts_raw"))
    # Sorted by capture time inside each folder's files: row-group min/max on ``ts``
    # let time-range reads skip data (the writer sorts by folder keys anyway).
    if pending is not None:  # sizes from the listing and the log: no data is read for them
        writers = pending.groupBy(*PARTITIONS).agg(F.ceil(F.sum("bytes") / bytes_per_writer).cast("int").alias("_w"))
        log = read_if_exists(spark, log_root, COMPACTION_LOG_SCHEMA)
        if log is not None:
            held = log.groupBy(*PARTITIONS).agg(F.ceil(F.max("folder_rows") / rows_per_writer).cast("int").alias("_w"))
            writers = writers.unionByName(held).groupBy(*PARTITIONS).agg(F.sum("_w").cast("int").alias("_w"))
    else:
        writers = folder_writers(closed, rows_per_writer=rows_per_writer)
    out = spread(out, writers).sortWithinPartitions(*PARTITIONS, "ts")
    _write_parquet(out, archive_root, "overwrite", PARTITIONS)
    done = read_archive(spark, archive_root).alias("a").join(folders.alias("t"), same_folder("a", "t"), "left_semi") \
        .groupBy(*PARTITIONS).agg(F.count(F.lit(1)).alias("folder_rows"))
    if pending is None:
        return done.count()
    logged = pending.alias("p").join(done.alias("d"), same_folder("p", "d"), "left") \
        .select("p.*", "folder_rows", F.current_timestamp().alias("compacted_at")).select(*COMPACTION_LOG_SCHEMA.names)
    logged.write.mode("append").parquet(log_root)
    if remove_source:
        remove_files(spark, pending.select("path"))
    return done.count()


def write_gtfs_table(spark: SparkSession, df: DataFrame, root: str, staging_root: str,
                     partition_by: Sequence[str] = ("agency", "table")) -> DataFrame:
    """Rewrite cumulative schedule tables through a staging folder (SNK-03).

    The staged copy is read back (the check that it is readable) and swapped into
    ``root`` with dynamic partition overwrite of the touched (agency, table). Both are
    read with the known schema, so an empty table (a header alone) passes through.
    """
    last = [f for f in df.schema if f.name in partition_by]
    schema = T.StructType([f for f in df.schema if f.name not in partition_by] + last)
    _write_parquet(df, staging_root, "overwrite", partition_by)
    staged = spark.read.schema(schema).parquet(staging_root)
    _write_parquet(staged, root, "overwrite", partition_by)
    return spark.read.schema(schema).parquet(root)


def error_fields(agency: Column, message: Column, ts: Column, tz: str = DEFAULT_TZ) -> dict[str, Column]:
    """The fields of an error envelope: stream ``Errors``, event ``error``, ``data =
    {"message": …}``, ``ts_raw`` the naive local time text, hash IDN-04 over it (SNK-04)."""
    ts_text = F.date_format(to_local(ts, tz), "yyyy-MM-dd HH:mm:ss")
    return {"hash_id": error_hash(agency, ts_text, message), "ts": ts, "ts_raw": ts_text, "agency": agency,
            "stream": F.lit("Errors"), "event": F.lit("error"), "endpoint": F.lit(""), "id": F.lit(None).cast("string"),
            "data": F.to_json(F.struct(message.alias("message"))), "day": local_day(ts, tz)}


def error_rows(df: DataFrame, agency: Column, message: Column, ts: Column, tz: str = DEFAULT_TZ,
               keep: Sequence[str] = ()) -> DataFrame:
    """Dead letters as error envelopes (SNK-04). ``keep`` passes input columns through."""
    return df.select(*keep, *[c.alias(n) for n, c in error_fields(agency, message, ts, tz).items()])


def coverage_documents(cov: DataFrame, agencies: DataFrame | None = None) -> DataFrame:
    """Nested coverage JSON per agency: ``{agency, …, streams: {stream: {day: rows}}}`` (SNK-06).

    The cube has one row per (agency, stream, day); nesting collects at most
    (streams x days) entries per agency.
    """
    per_stream = cov.groupBy("agency", "stream").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.date_format("day", "yyyy-MM-dd"), "rows"))))
        .alias("days"))
    by_stream = F.array_sort(F.collect_list(F.struct("stream", "days")),
                             lambda a, b: F.when(a["stream"] < b["stream"], -1)
                             .when(a["stream"] > b["stream"], 1).otherwise(0))
    per_agency = per_stream.groupBy("agency").agg(F.map_from_entries(by_stream).alias("streams"))
    if agencies is not None:
        per_agency = agencies.join(per_agency, "agency", "left")
    return per_agency.select(F.to_json(F.struct(*per_agency.columns)).alias("value"))
