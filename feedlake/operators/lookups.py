"""Joins and lookups (JON-01..11, SET-01..04, FLT-02).

Dimension lookups are plain equi-joins: adaptive execution knows the sides' real
sizes after their stages and broadcasts a side only under the session's threshold.
No hint forces a broadcast, and no job runs while a plan is built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.functions.scalars import safe_prefix, split_list, strip

def agency_of(vehicles: DataFrame, catalog: DataFrame, key: str) -> DataFrame:
    """Inner lookup of the owning agency; unmatched rows are dropped (JON-01)."""
    return vehicles.join(catalog, key, "inner")


def gtfs_stem(df: DataFrame, catalog: DataFrame, stream_col: str = "stream", lower: bool = True) -> DataFrame:
    """Left lookup stream -> GTFS file stem; default is the safe stream name (JON-02)."""
    fallback = safe_prefix(F.col(stream_col), style="unicode", default="stream")
    cat = catalog.select(F.col("stream").alias("_cat_stream"), F.col("stem").alias("_cat_stem"))
    j = df.join(cat, df[stream_col] == cat["_cat_stream"], "left")
    stem = F.coalesce(F.col("_cat_stem"), fallback)
    return j.withColumn("stem", F.lower(stem) if lower else stem).drop("_cat_stream", "_cat_stem")


def fan_out(targets: DataFrame, snapshot: DataFrame, name: str) -> DataFrame:
    """Copy one single-row snapshot to every target row (JON-07).

    The snapshot is a scalar subquery (at most one row, checked by Spark), not a
    cross join.
    """
    return targets.withColumn(name, snapshot.scalar())


def active_only(routes: DataFrame, active: DataFrame, group: str, key: str) -> DataFrame:
    """Routes with an active vehicle; a group with no active route keeps all (JON-03)."""
    act = active.select(group, key).distinct()
    keep = routes.join(act, [group, key], "left_semi")
    idle_groups = routes.select(group).distinct().join(act.select(group).distinct(), group, "left_anti")
    rest = routes.join(idle_groups, group, "left_semi")
    return keep.unionByName(rest)


def missing_ids(known: DataFrame, live: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Known ids minus live ids (JON-04, SET-03)."""
    return known.join(live, list(keys), "left_anti")


def changed_sets(new: DataFrame, old: DataFrame, key: str, set_col: str) -> DataFrame:
    """Keys whose set is new or different; vanished keys are not reported (JON-05)."""
    o = old.select(F.col(key), F.array_sort(F.col(set_col)).alias("_old"))
    j = new.join(o, key, "left")
    return j.filter(~F.array_sort(F.col(set_col)).eqNullSafe(F.col("_old"))).drop("_old")


def version_text(doc) -> Column:
    """Version of a document: its ``version`` field, or the document when it is a bare string (PRJ-11)."""
    v = F.try_parse_json(F.col(doc) if isinstance(doc, str) else doc)
    return F.coalesce(F.try_variant_get(v, "$.version", "string"), F.try_variant_get(v, "$", "string"))


def full_pair(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Two documents per key, either may be missing (JON-06, PRJ-11)."""
    return left.join(right, key, "full_outer")


def latest(history: DataFrame, live: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """Combine a stored value with a live one, keeping the later (JON-10)."""
    h = history.select(*keys, F.col(col).alias("_h"))
    lv = live.select(*keys, F.col(col).alias("_l"))
    return h.join(lv, list(keys), "full_outer").select(*keys, F.greatest("_h", "_l").alias(col))


def allow_list(df: DataFrame, col: str, targets: Sequence[str]) -> DataFrame:
    """Keep rows whose ``col`` is in ``targets``; an empty list keeps all (FLT-02, SET-04)."""
    return df if not targets else df.filter(F.col(col).isin(*targets))


def parse_catalog(text: Column) -> Column:
    """``id:ABBR, id2:ABBR2`` -> array of (key, value) (JON-09): both sides trimmed,
    the abbreviation upper-cased, pairs without a key or value dropped, a repeated
    id keeps its last value; explode it to get one row per entry."""
    pairs = F.filter(split_list(text), lambda p: p.contains(":"))
    kv = F.transform(pairs, lambda p: F.struct(strip(F.substring_index(p, ":", 1)).alias("key"),
                                               F.upper(strip(F.regexp_extract(p, r"(?s)^[^:]*:(.*)$", 1)))
                                               .alias("value")))
    kv = F.filter(kv, lambda e: (e["key"] != "") & (e["value"] != ""))
    return F.filter(kv, lambda e, i: ~F.exists(F.slice(kv, i + 2, F.size(kv)), lambda x: x["key"] == e["key"]))


def catalog_with_fallback(catalog: DataFrame, targets: DataFrame, group: str, key: str) -> DataFrame:
    """Catalog entries intersected with targets; a group with no overlap keeps all (JON-09)."""
    hit = catalog.join(targets, [group, key], "left_semi")
    groups_hit = hit.select(group).distinct()
    rest = catalog.join(groups_hit, group, "left_anti")
    return hit.unionByName(rest)


def work_list(ids: DataFrame, templates: DataFrame) -> DataFrame:
    """Requests derived from discovered ids: equi-join on ``kind`` with endpoint
    templates, ``{id}`` replaced (JON-08)."""
    j = ids.join(templates, "kind", "inner")
    return j.withColumn("request", F.replace(F.col("template"), F.lit("{id}"), F.col("id"))).drop("template")
