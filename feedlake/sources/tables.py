"""Readers for Parquet tables in a folder (the driver tables and archives)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin a scan that yields fewer splits than the session's parallelism.

    A Parquet row group is the unit of a scan split, so a small table written as
    one row group is read by one task and every narrow stage after it (JSON
    parsing, hashing, framing) runs single-threaded. A larger file is cut into byte
    ranges, but the range with the middle of a row group reads all of it and the others
    nothing, so splits beyond one a file are not counted on. On a cluster reading many
    files the scan already has more splits than cores and this is a no-op.
    Filters and column pruning still reach the scan below the repartition.
    """
    try:
        want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
        have = min(splits, len(df.inputFiles()) or splits)
    except Exception:  # noqa: BLE001 - no RDD view (e.g. a remote session): leave the scan as is
        return df
    return df.repartition(max(want, splits)) if have < want else df


def read_table(spark: SparkSession, folder: str, name: str, parallel: bool = False) -> DataFrame:
    """``<folder>/<name>.parquet``; column pruning and filters reach the scan."""
    df = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
    return spread(df) if parallel else df
