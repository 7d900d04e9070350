"""Continuous ingest and stateful dedupe (STR-01, STR-02, STR-03, STR-10).

The same envelope transforms as batch, on a file (or Kafka) stream. Repeats are dropped
in two places. Those that arrive within ``delay`` of each other meet in the stream's own
state: ``dropDuplicatesWithinWatermark`` on (agency, stream, day, hash_id) with the
watermark on *arrival* time (the micro-batch clock), not on the record's own ``ts``: a
watermark on ``ts`` would silently drop late records (a re-delivered old day), while
arrival time never runs backwards, so no row is ever dropped as late. Repeats of what the
archive holds, however long ago it came and whichever checkpoint took it, are dropped by
an anti join of each micro-batch with the archive's hashes, of the batch's days only
(``unseen``). A new checkpoint also takes the hashes of the landing's open days, written
once as its seed (``seed_history``). So a job that starts anew, with or without its
checkpoint, admits nothing twice.

Every micro-batch is written by as many tasks a folder as its rows ask for (``spread``).
``start_ingest`` writes it under a folder named by query and batch, which a replay
overwrites, so the sink holds every row once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.schema import ARCHIVE_SCHEMA
from feedlake.sinks.archive import ROWS_PER_WRITER, folder_writers, read_if_exists, spread
from feedlake.sources.wal import PARTITIONS, read_wal

DEDUPE_KEYS = ("agency", "stream", "day", "hash_id")


def stateful_dedupe(stream: DataFrame, keys: Sequence[str] = DEDUPE_KEYS, delay: str = "2 days") -> DataFrame:
    """Drop repeats within scope on a stream, never dropping a late row (STR-02)."""
    s = stream.withColumn("_arrival", F.current_timestamp())
    return s.withWatermark("_arrival", delay).dropDuplicatesWithinWatermark(list(keys)).drop("_arrival")


def unseen(batch: DataFrame, history: DataFrame | None, keys: Sequence[str] = DEDUPE_KEYS) -> DataFrame:
    """Rows of a micro-batch whose keys ``history`` does not hold (STR-02).

    With ``day`` among the keys only the batch's own days are read: they are listed first
    (a few, whatever the batch's size) and prune the history's folders. Keys match null-safe.
    """
    if history is None:
        return batch
    held = history.select(*keys)
    if "day" in keys:
        days = [r["day"] for r in batch.select("day").distinct().collect()]
        known = [d for d in days if d is not None]
        pick = F.col("day").isin(known) if known else F.lit(False)
        held = held.where(pick | F.col("day").isNull() if None in days else pick)
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"b.{k}").eqNullSafe(F.col(f"h.{k}"))
    return batch.alias("b").join(held.alias("h"), same, "left_anti")


def seed_history(spark: SparkSession, landing_root: str, checkpoint: str, keys: Sequence[str] = DEDUPE_KEYS) -> str | None:
    """What the landing held when a checkpoint was new, written once beside it; its folder.

    Later rows are in the stream's own state, and days that close are in the archive, so the
    seed stays as it is. A checkpoint that exists already keeps the seed it has.
    """
    root = f"{checkpoint.rstrip('/')}_seed"
    if read_if_exists(spark, root) is None:
        try:
            landing = read_wal(spark, landing_root)
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        # One folder a day: a day prunes to its own files, as in the archive.
        landing.where(F.col("hash_id").isNotNull()).select(*keys).distinct() \
            .write.partitionBy(*[k for k in ("day",) if k in keys]).parquet(root)
    return root


def stored_history(spark: SparkSession, archive_root: str, seed_root: str | None = None,
                   keys: Sequence[str] = DEDUPE_KEYS) -> DataFrame | None:
    """Keys that the archive holds now, and those of the seed; None when there are neither."""
    types = {f.name: f.dataType for f in ARCHIVE_SCHEMA}
    sides = [read_if_exists(spark, root, ARCHIVE_SCHEMA if root == archive_root else None)
             for root in (archive_root, seed_root) if root]
    out = None
    for side in sides:
        if side is not None:
            side = side.select(*[F.col(k).cast(types[k]).alias(k) for k in keys])
            out = side if out is None else out.unionByName(side)
    return out


def start_ingest(stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = PARTITIONS,
                 fmt: str = "parquet", available_now: bool = True, rows_per_writer: int = ROWS_PER_WRITER,
                 history: Callable[[SparkSession], DataFrame | None] | None = None):
    """Append a stream to a partitioned sink with a checkpoint (STR-01, STR-03).

    ``day`` is a partition column, so files rotate at local midnight and late rows
    land in their own day (STR-10). ``history`` gives the keys stored so far, read anew for
    each micro-batch; rows that it holds are left out.
    """
    def append(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        run = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        rows = unseen(batch, history(spark)) if history else batch
        rows.persist()  # counted and written: the stream's own work runs once
        try:
            spread(rows, folder_writers(rows, partition_by, rows_per_writer), partition_by) \
                .write.mode("overwrite").partitionBy(*partition_by).format(fmt).save(f"{path}/batch={run}-{epoch:09d}")
        finally:
            rows.unpersist()

    w = stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
