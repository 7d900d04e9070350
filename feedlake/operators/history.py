"""Cumulative schedule tables with first/last seen (IDN-08..11, AGG-01, SET-01, SRT-05).

A snapshot is every source column as STRING plus ``hash_id``, ``first_logged``
and ``last_logged``. Merging unions the stored table with a new snapshot and
folds rows by ``hash_id`` in one aggregate (partial aggregation map-side, one
shuffle on ``hash_id``). Nothing is sorted globally; output is
ordered by hash within each partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.functions.identity import row_hash
from feedlake.functions.scalars import parse_logged
from feedlake.schema import DEFAULT_TZ

META = ("hash_id", "first_logged", "last_logged")


def data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in META and not c.startswith("_")]


def prepare_snapshot(df: DataFrame, table: str, logged_at: Column, ignore_null_columns: bool = False) -> DataFrame:
    """All columns to STRING, add the row hash and ``first = last = logged_at`` (IDN-08)."""
    cols = data_columns(df)
    s = df.select(*[F.col(c).cast("string").alias(c) for c in cols])
    return s.withColumns({"hash_id": row_hash(cols, table, ignore_null_columns),
                          "first_logged": logged_at.cast("timestamp_ntz"),
                          "last_logged": logged_at.cast("timestamp_ntz")})


def backfill_history(df: DataFrame, table: str, logged_at: Column, ignore_null_columns: bool = False,
                     tz: str = DEFAULT_TZ) -> DataFrame:
    """Derive missing ``hash_id``/``first_logged``/``last_logged`` on one side (IDN-10, D9, D11).

    Text dates are parsed with SCL-04; values that do not parse fall back to
    the ``logged_at`` instant.
    """
    cols = data_columns(df)
    out = df
    if "hash_id" not in df.columns:
        out = out.withColumn("hash_id", row_hash(cols, table, ignore_null_columns))
    if "first_logged" not in df.columns:
        out = out.withColumn("first_logged", logged_at.cast("timestamp_ntz"))
    if "last_logged" not in df.columns:
        out = out.withColumn("last_logged", F.col("first_logged"))
    for c in ("first_logged", "last_logged"):
        dtype = dict(out.dtypes)[c]
        parsed = parse_logged(F.col(c), tz) if dtype == "string" else F.col(c).cast("timestamp_ntz")
        out = out.withColumn(c, F.coalesce(parsed, logged_at.cast("timestamp_ntz")))
    return out


def merge_snapshots(existing: DataFrame | None, new: DataFrame, table: str, logged_at: Column,
                    ignore_null_columns: bool = False, tz: str = DEFAULT_TZ) -> DataFrame:
    """Fold a new snapshot into the cumulative table (IDN-09, AGG-01, SET-01, SRT-05).

    Per ``hash_id``: ``min(first_logged)``, ``max(last_logged)``, and for every
    other column the first non-null value, the stored side before the new one.
    Columns present on one side only are kept (null on the other).
    """
    sides = []
    for order, side in enumerate([existing, new]):
        if side is None:
            continue
        sides.append(backfill_history(side, table, logged_at, ignore_null_columns, tz)
                     .withColumn("_src", F.lit(order)))
    u = sides[0]
    for s in sides[1:]:
        u = u.unionByName(s, allowMissingColumns=True)
    cols = data_columns(u)
    aggs = [F.min("first_logged").alias("first_logged"), F.max("last_logged").alias("last_logged")]
    aggs += [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_src"))).alias(c) for c in cols]
    merged = u.groupBy("hash_id").agg(*aggs)
    return merged.select("hash_id", *cols, "first_logged", "last_logged").sortWithinPartitions("hash_id")


def point_in_time(history: DataFrame, at: Column) -> DataFrame:
    """Rows valid at an instant: ``first_logged <= at <= last_logged`` (IDN-11)."""
    t = at.cast("timestamp_ntz")
    return history.filter((F.col("first_logged") <= t) & (F.col("last_logged") >= t))


def nonempty_tables(union_counts: DataFrame) -> DataFrame:
    """Tables whose union of stored and new rows is not empty (FLT-13)."""
    return union_counts.filter(F.col("rows") > 0)
