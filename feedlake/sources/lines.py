"""Text files line by line with positions, and running totals along a file.

A file is read in splits by many tasks. Every line knows its file, its split's first byte
and its place among the lines of the split, so rules that run along a file (quotes that are
open, frames that are not closed) work split by split: each split sums up on its own, the
few sums a file are added in order, and each split starts from the sum before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

POSITION = ("file", "block", "seq")
STRETCH_BITS = 14  # lines of a split that one window takes, as a power of two


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``block`` (first byte of the split), ``seq`` (rises within the split) and ``value``,
    one row per line; lines end at line feeds, a carriage return before one is taken off."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                        F.monotonically_increasing_id().alias("seq"), F.regexp_replace("value", "\r$", "").alias("value"))


def running_total(lines: DataFrame, amount: Column, name: str, first: str | None = None) -> DataFrame:
    """Adds ``name``: the sum of ``amount`` over the lines of the file before this one; and ``first``,
    if named: whether the line is the first of its file.

    One window per stretch of lines of a split and one over the stretches' sums; a file of any
    size, and a split of any size, is dealt to as many tasks as there are, evenly. Both sides of
    the join read one shuffle of the lines, and the file once: the hash below keeps every column
    on the side of the sums, so that the shuffles are equal.
    """
    part = Window.partitionBy("file", "block", "_stretch")
    within = part.orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = lines.withColumn("_stretch", F.shiftright("seq", STRETCH_BITS)).withColumn("_amount", amount.cast("bigint")) \
        .withColumn("_here", F.sum("_amount").over(within)).withColumn("_place", F.row_number().over(part.orderBy("seq")))
    before = Window.partitionBy("_file").orderBy("_block", "_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(F.col("file").alias("_file"), F.col("block").alias("_block"), F.col("_stretch").alias("_part")) \
        .agg(F.max("_here").alias("_sum"), F.max(F.xxhash64(*lines.columns)).alias("_any")) \
        .withColumn("_past", F.coalesce(F.sum("_sum").over(before), F.lit(0))) \
        .withColumn("_begins", F.count(F.lit(1)).over(before) == 0).where(F.col("_any").isNotNull()).drop("_any", "_sum")
    joined = rows.join(sums, (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block")) & (F.col("_stretch") == F.col("_part")))
    total = (F.col("_here") - F.col("_amount") + F.col("_past")).alias(name)
    begins = [] if first is None else [(F.col("_begins") & (F.col("_place") == 1)).alias(first)]
    return joined.select(*lines.columns, total, *begins)


def quoted_records(lines: DataFrame, quote: str = '"') -> DataFrame:
    """Records of a quoted text (CSV): ``file``, ``first`` (the record begins the file) and
    ``record``, with the line feeds that quoted cells hold.

    A line starts a record when an even number of quotes stands before it. Lines that are a
    record of their own pass through; only those of records that span lines are put together.
    """
    count = F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))
    rows = running_total(lines.withColumn("_quotes", count), F.col("_quotes"), "_open", first="first")
    starts = F.col("_open") % 2 == 0
    whole = starts & (F.col("_quotes") % 2 == 0)
    single = rows.where(whole).select("file", "first", F.col("value").alias("record"))
    parts = running_total(rows.where(~whole).select(*lines.columns, "first", starts.cast("int").alias("_start")), F.col("_start"), "_before")
    joined = parts.groupBy("file", (F.col("_before") + F.col("_start")).alias("_number")) \
        .agg(F.max("first").alias("first"), F.sort_array(F.collect_list(F.struct("block", "seq", "value"))).alias("_lines")) \
        .select("file", "first", F.array_join(F.transform("_lines", lambda x: x["value"]), "\n").alias("record"))
    return single.unionByName(joined)
