"""Window-style operators (WIN-02/04/06/07/08/09, SRT-02).

Windows partition by entity keys (agency, endpoint, route, …), never globally.
Top-k runs in two phases — per (group, day) first, then per group over at most
k rows per day — so a group holding a third of all rows is split across tasks
before the final ranking.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def batches(df: DataFrame, group: Sequence[str], id_col: str, size: int, order: Sequence = None,
            sep: str = ",", bucket: Column | None = None) -> DataFrame:
    """Cut each group's sorted id list into batches of ``size`` joined with ``sep`` (WIN-04).

    ``bucket`` (a Column that rises with the order, such as the id's thousands or first
    letters) splits a group over tasks: ids are numbered per bucket, and the number of ids
    in the buckets before is added from a small summary.
    Output: group columns, ``batch_no`` (0-based), ``ids`` text, ``n`` ids.
    """
    order_cols = _cols(order or [id_col])
    d = df.withColumn("_b", bucket if bucket is not None else F.lit(0))
    before = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = d.groupBy(*group, "_b").agg(F.count(F.lit(1)).alias("_c")) \
        .select(*group, "_b", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))
    numbered = d.withColumn("_rn", F.row_number().over(Window.partitionBy(*group, "_b").orderBy(*order_cols)))
    numbered = numbered.join(offsets, [*group, "_b"]).withColumn("_rn", F.col("_rn") + F.col("_off")) \
        .withColumn("batch_no", F.floor((F.col("_rn") - 1) / size).cast("int"))
    agg = numbered.groupBy(*group, "batch_no").agg(
        F.array_sort(F.collect_list(F.struct("_rn", F.col(id_col).cast("string").alias("v")))).alias("_l"))
    return agg.select(*group, "batch_no", F.array_join(F.transform("_l", lambda e: e["v"]), sep).alias("ids"),
                      F.size("_l").alias("n"))


def _carry_join(df: DataFrame, carry: DataFrame, on: Sequence[str]) -> DataFrame:
    """Attach a per-(key, split) carry table (one row per key and split value).

    A plain equi-join on (key, split): the row side is already hash-partitioned
    on exactly those columns by its window, so only the carry side moves."""
    return df.join(carry, list(on), "left")


def failure_streaks(df: DataFrame, keys: Sequence[str], order: Sequence[str], failed: Column,
                    split_by: Sequence[str] | None = None) -> DataFrame:
    """Consecutive failures per key with the cooldown each implies (WIN-06).

    Gaps and islands: a success starts a new island; ``streak`` counts failures
    inside it. ``cooldown_s = min(30 * 2^(streak-1), 300)``; ``reconnect_s`` is the
    reconnect delay ``min(5 * 2^(streak-1), 60)``. Successes get nulls.

    With ``split_by`` (e.g. ``["day"]``, ordered consistently with ``order``) the
    row windows run per (key, split) and the streak open at the end of the previous
    split is carried in from a per-split summary, so one hot key is spread over
    many tasks.
    """
    split = list(split_by or [])
    part = [*keys, *split]
    w = Window.partitionBy(*part).orderBy(*_cols(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = df.withColumn("_failed", failed).withColumn(
        "_island", F.sum(F.when(~F.col("_failed"), 1).otherwise(0)).over(w))
    wi = Window.partitionBy(*part, "_island").orderBy(*_cols(order)) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    streak = F.sum(F.col("_failed").cast("int")).over(wi)
    if split:
        # Per split: failures after its last success ("trailing"), or all its failures
        # when it has no success; the open streak at the end of a split is the running
        # sum of these within runs that start at a split with a success.
        d = d.withColumn("_max_island", F.max("_island").over(Window.partitionBy(*part)))
        summ = d.groupBy(*part).agg(
            (F.max("_max_island") > 0).alias("_has_ok"),
            F.sum(F.col("_failed").cast("int")).alias("_nfail"),
            F.count_if(F.col("_failed") & (F.col("_island") == F.col("_max_island"))).alias("_trail"))
        contrib = F.when(F.col("_has_ok"), F.col("_trail")).otherwise(F.col("_nfail"))
        wk = Window.partitionBy(*keys).orderBy(*split)
        summ = summ.withColumn("_run", F.sum(F.col("_has_ok").cast("int")).over(
            wk.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        summ = summ.withColumn("_open", F.sum(contrib).over(
            Window.partitionBy(*keys, "_run").orderBy(*split).rowsBetween(Window.unboundedPreceding,
                                                                          Window.currentRow)))
        carry = summ.select(*part, F.coalesce(F.lag("_open").over(wk), F.lit(0)).alias("_carry"))
        d = _carry_join(d, carry, part)
        streak = streak + F.when(F.col("_island") == 0, F.col("_carry")).otherwise(F.lit(0))
    d = d.withColumn("streak", F.when(F.col("_failed"), streak))
    d = d.withColumn("cooldown_s", F.least(F.lit(30) * F.pow(F.lit(2), F.col("streak") - 1), F.lit(300))
                     .cast("bigint")) \
        .withColumn("reconnect_s", F.least(F.lit(5) * F.pow(F.lit(2), F.col("streak") - 1), F.lit(60))
                    .cast("bigint"))
    return d.drop("_failed", "_island", "_carry", "_max_island")


def state_transitions(df: DataFrame, keys: Sequence[str], order: Sequence[str], state: str,
                      split_by: Sequence[str] | None = None) -> DataFrame:
    """Rows where the state differs from the previous row of the key (WIN-07).

    With ``split_by`` the lag runs per (key, split); the first row of a split
    compares with the last state of the key's previous split, taken from a
    per-split summary.
    """
    split = list(split_by or [])
    part = [*keys, *split]
    w = Window.partitionBy(*part).orderBy(*_cols(order))
    d = df.withColumn("_prev", F.lag(state).over(w))
    if split:
        d = d.withColumn("_first", F.row_number().over(w) == 1)
        last = df.groupBy(*part).agg(F.max_by(F.col(state), F.struct(*_cols(order))).alias("_last"))
        carry = last.select(*part, F.lag("_last").over(Window.partitionBy(*keys).orderBy(*split)).alias("_carry"))
        d = _carry_join(d, carry, part)
        d = d.withColumn("_prev", F.when(F.col("_first"), F.col("_carry")).otherwise(F.col("_prev"))) \
            .drop("_first", "_carry")
    return d.filter(~F.col(state).eqNullSafe(F.col("_prev"))).withColumnRenamed("_prev", f"prev_{state}")


def day_over_day(df: DataFrame, keys: Sequence[str], day: str, value: str) -> DataFrame:
    """Value on the previous active day of the key (WIN-08)."""
    w = Window.partitionBy(*keys).orderBy(day)
    return df.withColumn(f"prev_{value}", F.lag(value).over(w))


def changed_vs_previous(df: DataFrame, keys: Sequence[str], order: Sequence[str], set_col: str) -> DataFrame:
    """Flag ``changed`` when the sorted set differs from the key's previous poll;
    the first poll of a key counts as changed (WIN-09)."""
    w = Window.partitionBy(*keys).orderBy(*_cols(order))
    s = F.array_sort(F.col(set_col))
    return df.withColumn("changed", ~s.eqNullSafe(F.lag(s).over(w)))


def top_k(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int,
          split_by: Sequence[str] | None = None, rank_col: str = "rank") -> DataFrame:
    """The first ``k`` rows per group by ``order`` (SRT-02), in two phases.

    ``split_by`` (e.g. the day) cuts each group into sub-groups ranked first, so
    the final window sees at most k rows per sub-group.
    """
    pre = df
    if split_by:
        w1 = Window.partitionBy(*group, *split_by).orderBy(*order)
        pre = df.withColumn("_r1", F.row_number().over(w1)).filter(F.col("_r1") <= k).drop("_r1")
    w2 = Window.partitionBy(*group).orderBy(*order)
    return pre.withColumn(rank_col, F.row_number().over(w2)).filter(F.col(rank_col) <= k)


def unavailable_marks(df: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str], is_mark: Column,
                      hours: int = 12, split_by: Sequence[str] | None = None) -> DataFrame:
    """Endpoint availability after UNSUPPORTED marks (FLT-10).

    ``unavailable``: a mark happened in the previous ``hours`` before this row.
    ``reported``: a mark that starts a new unavailable period. With ``split_by``
    the latest mark of earlier splits is carried in from a per-split summary.
    """
    split = list(split_by or [])
    part = [*keys, *split]
    w = Window.partitionBy(*part).orderBy(*_cols(order)).rowsBetween(Window.unboundedPreceding, -1)
    d = df.withColumn("_mark", is_mark).withColumn(
        "_last_mark", F.max(F.when(F.col("_mark"), F.col(ts))).over(w))
    if split:
        per = d.groupBy(*part).agg(F.max(F.when(F.col("_mark"), F.col(ts))).alias("_m"))
        wk = Window.partitionBy(*keys).orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)
        carry = per.select(*part, F.max("_m").over(wk).alias("_carry"))
        d = _carry_join(d, carry, part).withColumn("_last_mark", F.greatest("_last_mark", "_carry")).drop("_carry")
    unav = F.col("_last_mark").isNotNull() & (F.col(ts) < F.col("_last_mark") + F.expr(f"INTERVAL {hours} HOURS"))
    return d.withColumn("unavailable", unav).withColumn("reported", F.col("_mark") & ~unav) \
        .drop("_mark", "_last_mark")
