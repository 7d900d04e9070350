"""Discovered id sets (AGG-10..12, SNK-05 modes, SET-02, FLT-03/04).

Id sets are tables ``(agency, kind, id, first_seen, last_seen)``; accumulating
is a union plus one aggregate, never a driver-side set.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.functions.scalars import first_truthy_field, strip

MODES = ("replace", "replace_nonempty", "accumulate")


def nonempty_id(col) -> Column:
    """Not null and not blank (FLT-03)."""
    c = F.col(col) if isinstance(col, str) else col
    return c.isNotNull() & (F.length(strip(c.cast("string"))) > 0)


def valid_route_id(col) -> Column:
    """Not blank and not an integer equal to 0 (FLT-04)."""
    c = (F.col(col) if isinstance(col, str) else col).cast("string")
    return nonempty_id(c) & (F.coalesce(strip(c).try_cast("bigint"), F.lit(1)) != 0)


def id_from_keys(item: Column, keys: Sequence[str]) -> Column:
    """Id of a VARIANT item (AGG-10): for an object, the first candidate key whose
    value is not null or empty; a bare string or integer item is its own id."""
    is_obj = F.try_variant_get(item, "$", "map<string,variant>").isNotNull()
    scalar_id = F.when(F.schema_of_variant(item).rlike(r"^(STRING|BIGINT|INT|SMALLINT|TINYINT|DECIMAL\(\d+,0\))$"),
                       F.try_variant_get(item, "$", "string"))
    return F.when(is_obj, first_truthy_field(item, *[f"$.{k}" for k in keys])) \
        .otherwise(scalar_id)


def observed_ids(df: DataFrame, kind: Column, id_col: Column, ts: str = "ts",
                 group: Sequence[str] = ("agency",)) -> DataFrame:
    """Distinct ids per group and kind with first/last seen (AGG-10)."""
    d = df.select(*group, kind.alias("kind"), id_col.cast("string").alias("id"), F.col(ts).alias("_ts"))
    d = d.filter(nonempty_id("id"))
    return d.groupBy(*group, "kind", "id").agg(F.min("_ts").alias("first_seen"), F.max("_ts").alias("last_seen"))


def upsert_ids(existing: DataFrame, batch: DataFrame, mode: str = "accumulate",
               group: Sequence[str] = ("agency", "kind"), polled: DataFrame | None = None) -> DataFrame:
    """Persist discovered ids (SNK-05).

    ``replace``: agencies that were polled get the batch as their set, an empty one
    included; ``polled`` names them (default: those in the batch), and an agency that
    was not polled keeps its stored ids. ``replace_nonempty``: groups present in the
    batch are replaced, others keep their stored ids. ``accumulate``: union with min
    ``first_seen`` and max ``last_seen`` per id (SET-02).
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    b = batch.filter(nonempty_id("id"))
    if mode == "replace":
        done = (batch if polled is None else polled).select(group[0]).distinct()
        return b.unionByName(existing.join(done, group[0], "left_anti").select(*b.columns))
    if mode == "replace_nonempty":
        kept = existing.join(b.select(*group).distinct(), list(group), "left_anti")
        return b.unionByName(kept)
    u = existing.unionByName(b)
    return u.groupBy(*group, "id").agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))


def id_set(df: DataFrame, group: Sequence[str], id_col: str, name: str = "ids") -> DataFrame:
    """Sorted distinct set per group (AGG-11, AGG-12, SRT-03). Groups are bounded id
    dimensions (routes, detours), not event streams."""
    return df.groupBy(*group).agg(F.array_sort(F.collect_set(F.col(id_col))).alias(name))


def active_sets(stored: DataFrame, buses: DataFrame, group: str, id_col: str) -> DataFrame:
    """Active ids per group from one poll (AGG-11): every group of the poll takes its new
    set, the empty one too; a poll whose sets are all empty leaves the stored sets as they
    are. ``stored`` has (group, ids); ``buses`` one row per bus, ids null or blank to skip."""
    good = nonempty_id(id_col)
    new = buses.groupBy(group).agg(F.array_sort(F.collect_set(F.when(good, strip(F.col(id_col).cast("string"))))).alias("ids"))
    parsed = buses.agg(F.coalesce(F.max(good), F.lit(False)).alias("any")).scalar()
    both = stored.select(group, F.col("ids").alias("_old")).join(new, group, "full_outer").withColumn("_parsed", parsed)
    return both.select(group, F.when(F.col("_parsed") & F.col("ids").isNotNull(), F.col("ids")).otherwise(
        F.coalesce("_old", F.array().cast("array<string>"))).alias("ids"))


def detour_routes(rt: Column) -> Column:
    """``rt`` as array of route ids: a string, a list of strings, or a list of ``{rt}``
    objects; empty ids are skipped (AGG-12)."""
    arr = F.try_variant_get(rt, "$", "array<variant>")
    from_list = F.transform(arr, lambda e: F.coalesce(F.try_variant_get(e, "$.rt", "string"),
                                                      F.try_variant_get(e, "$", "string")))
    single = F.array(F.try_variant_get(rt, "$", "string"))
    out = F.when(arr.isNotNull(), from_list).when(F.try_variant_get(rt, "$", "string").isNotNull(), single)
    return F.filter(F.coalesce(out, F.array().cast("array<string>")), lambda x: x.isNotNull() & (x != ""))


def detour_id(item: Column) -> Column:
    """Detour id: ``id``, else ``dtrid``, else '' (AGG-12)."""
    return F.coalesce(F.try_variant_get(item, "$.id", "string"), F.try_variant_get(item, "$.dtrid", "string"),
                      F.lit(""))
