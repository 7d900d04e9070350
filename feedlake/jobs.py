"""User-level jobs: the reference's three entry points as Spark jobs.

* ``ingest_stream`` + ``archive_sweep`` — live events -> landing -> archive
  (SURVEY §3 A; STR-01/02/04, SNK-01/02).
* ``update_schedule`` — a static schedule package folded into cumulative tables
  that know when each row was first and last seen (§3 B; SRC-05/06, IDN-08..10,
  SNK-03).
* ``capture_envelopes`` — captured poll responses -> classified, unwrapped,
  hashed, deduplicated envelopes (§3 C; FLT-05/06, SRC-10, PRJ-01, IDN-07).

Loops in this module run over table names of one package (a folder listing),
never over rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions.scalars import strip
from feedlake.operators.dedupe import dedupe_events
from feedlake.operators.filters import is_rejection_page
from feedlake.operators.history import merge_snapshots, prepare_snapshot
from feedlake.operators.monitor import classify_bustime
from feedlake.operators.projections import to_envelope
from feedlake.schema import DEFAULT_TZ
from feedlake.sinks.archive import compact_days, error_rows, read_if_exists, wal_append, write_gtfs_table
from feedlake.sources import unwrap as uw
from feedlake.sources.gtfs import gtfs_package_tables, read_gtfs_table
from feedlake.sources.wal import read_wal
from feedlake.streaming.ingest import seed_history, stateful_dedupe, stored_history, unseen


def ingest_stream(envelopes: DataFrame, landing_root: str, checkpoint: str, available_now: bool = False,
                  tz: str = DEFAULT_TZ, archive_root: str | None = None):
    """Start the continuous ingest of a streaming envelope DataFrame (STR-01/02/03).

    Repeats are dropped in-stream (arrival-time watermark, never a late-row drop) and, with
    ``archive_root``, against what the archive and, for a new checkpoint, the landing hold
    already. Each micro-batch is appended like a batch (``wal_append``: hot folders split by
    size) under ``agency=/stream=/day=``, which ``archive_sweep`` compacts. A micro-batch
    that is replayed after a crash may land twice; compaction dedupes exactly. The landing
    keeps no sink log of its own, so a sweep may remove the files it has compacted.
    """
    seed = seed_history(envelopes.sparkSession, landing_root, checkpoint) if archive_root else None

    def land(batch: DataFrame, _epoch: int) -> None:
        known = stored_history(batch.sparkSession, archive_root, seed) if archive_root else None
        rows = unseen(batch, known)
        rows.persist()  # counted and written: the stateful dedupe runs once
        try:
            wal_append(rows, landing_root, tz)
        finally:
            rows.unpersist()

    writer = stateful_dedupe(envelopes).writeStream.option("checkpointLocation", checkpoint).foreachBatch(land)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")).start()


def archive_sweep(spark: SparkSession, landing_root: str, archive_root: str, as_of: Column, tz: str = DEFAULT_TZ,
                  remove_source: bool = True) -> int:
    """One incremental compaction sweep (STR-04): closed local days with new files
    are merged into the archive; returns the number of folders written.

    The compaction log lives with the archive (``<archive>/_compaction_log``; names
    starting with ``_`` are hidden from readers of the archive). Landing files are
    removed once the archive holds their rows, so the next listing is short.
    """
    return compact_days(spark, read_wal(spark, landing_root, tz), archive_root, as_of, tz, landing_root=landing_root,
                        log_root=f"{archive_root.rstrip('/')}/_compaction_log", remove_source=remove_source)


def update_schedule(spark: SparkSession, package_dir: str, store_root: str, work_root: str, agency: str,
                    logged_at: Column, tz: str = DEFAULT_TZ, null_tokens=("",),
                    ignore_null_columns: bool = False) -> list[str]:
    """Fold every table of an unpacked schedule package into ``<store_root>/<table>``
    (partitioned by agency): rows are hashed, merged with the stored rows of this
    agency by ``hash_id`` (min first_logged, max last_logged), staged and swapped in.
    Returns the table names processed."""
    done = []
    for table in gtfs_package_tables(spark, package_dir):
        new = read_gtfs_table(spark, f"{package_dir}/{table}.txt", table, null_tokens=null_tokens)
        snap = prepare_snapshot(new, table, logged_at, ignore_null_columns)
        root = f"{store_root}/{table}"
        stored = read_if_exists(spark, root)
        if stored is not None:
            stored = stored.filter(F.col("agency") == agency).drop("agency")
        elif new.isEmpty():
            continue  # a header alone, and nothing stored: no table yet (FLT-13)
        merged = merge_snapshots(stored, snap, table, logged_at, ignore_null_columns, tz)
        write_gtfs_table(spark, merged.withColumn("agency", F.lit(agency)), root, f"{work_root}/{table}",
                         partition_by=("agency",))
        done.append(table)
    return done


def capture_envelopes(captures: DataFrame, cfg: uw.UnwrapConfig, event: str = "update",
                      tz: str = DEFAULT_TZ, scope: str = "day") -> DataFrame:
    """Captured responses ``(agency, stream, endpoint, poll_ts, body)`` -> new envelopes.

    Rejection pages and non-OK BusTime answers are left out (FLT-05/06; ``capture_errors``
    has them), the rest unwrapped by ``cfg`` (SRC-10), text that is not JSON as ``{"data":
    text}``; one envelope per item with its content hash (PRJ-01, IDN-03), deduplicated
    within ``scope`` (IDN-07).
    """
    c = classify_captures(captures).filter(F.col("status").isin("OK", "TEXT"))
    items = c.select("agency", "stream", "endpoint", "poll_ts",
                     F.explode(uw.unwrap_items(uw.bustime_body(F.col("_v")), cfg)).alias("item"))
    env = to_envelope(items, F.col("agency"), F.col("stream"), F.lit(event), F.to_json("item"),
                      endpoint=F.col("endpoint"), ts=F.col("poll_ts"), tz=tz)
    return dedupe_events(env, scope=scope, order=("ts",))


def classify_captures(captures: DataFrame) -> DataFrame:
    """Each capture with ``status``: BLANK, REJECTED (HTML page), TEXT (not JSON), or the
    BusTime class (UNSUPPORTED, NEEDS_PARAM, EMPTY, ERROR, OK); ``_v`` the parsed body,
    ``{"data": text}`` for text."""
    v = F.try_parse_json("body")
    text = F.try_parse_json(F.to_json(F.struct(strip("body").alias("data"))))
    blank = F.col("body").isNull() | (strip("body") == "")
    status = (F.when(blank, F.lit("BLANK"))
              .when(is_rejection_page(F.col("body")), F.lit("REJECTED"))
              .when(v.isNull(), F.lit("TEXT"))
              .otherwise(classify_bustime(v)))
    return captures.withColumn("_v", F.coalesce(v, text)).withColumn("status", status)


def capture_errors(captures: DataFrame, tz: str = DEFAULT_TZ) -> DataFrame:
    """Error envelopes of the captures that failed (SNK-04): rejected pages and BusTime answers
    of class ERROR or UNSUPPORTED, with the endpoint and the whole body."""
    bad = classify_captures(captures).filter(F.col("status").isin("REJECTED", "ERROR", "UNSUPPORTED"))
    message = F.concat_ws(" ", F.col("status"), F.col("stream"), F.col("endpoint"), strip("body"))
    return error_rows(bad, F.col("agency"), message, F.col("poll_ts"), tz)


def land_envelopes(envelopes: DataFrame, landing_root: str, tz: str = DEFAULT_TZ) -> None:
    """Batch append of envelopes to the landing (SNK-01)."""
    wal_append(envelopes, landing_root, tz)
