"""PassioGO collection shapes (SRC-11..13, PRJ-07/08/09).

Dict-keyed collections (``{"ID1": {...}, "ID2": {...}}``) become rows with the key
kept; all reshaping is VARIANT/map expressions in the JVM (lambdas run outside generated code).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlake.operators.projections import to_variant_value

DICT_KEY = "_PASSIOGO_dict_key"


def _obj(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>")


def _arr(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def _let(value: Column, body) -> Column:
    """Bind ``value`` once for ``body`` (a lambda binding)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _is_empty(v: Column) -> Column:
    """An answer with nothing in it: null, JSON null, {}, [] or ""."""
    s = F.try_variant_get(v, "$", "string")
    return (v.isNull() | F.is_variant_null(v) | (F.size(_obj(v)) == 0) | (F.size(_arr(v)) == 0)
            | (_obj(v).isNull() & _arr(v).isNull() & (s == "")))


def _with_key(item: Column, key: Column) -> Column:
    """A dict member as an item: objects get ``_PASSIOGO_dict_key`` unless they have
    an ``id`` key or any key containing ``Id``; other values become ``{_key, value}``."""
    def body(m):
        keys = F.map_keys(m)
        has_id = F.array_contains(keys, F.lit("id")) | F.exists(keys, lambda k: k.contains("Id"))
        injected = F.to_variant_object(F.map_concat(m, F.create_map(F.lit(DICT_KEY), to_variant_value(key))))
        wrapped = F.to_variant_object(F.create_map(F.lit("_key"), to_variant_value(key), F.lit("value"), item))
        return F.when(m.isNull(), wrapped).when(has_id, item).otherwise(injected)
    return _let(_obj(item), body)


def passio_items(v: Column, preferred_key: str, text: Column | None = None) -> Column:
    """Items of a PassioGO answer (SRC-11): ``preferred_key`` at the top, or inside the
    first member when that is an object holding it; a dict becomes one item per
    member (key injected), a list is its items, anything else a single item.

    VARIANT keeps keys sorted; ``text``, the answer as it came, tells which member is
    the first of the document."""
    def pick(top):
        value = F.element_at(F.map_values(top), 1)
        if text is not None:
            key = F.get(F.map_keys(F.from_json(text, "map<string,string>")), 0)
            value = F.coalesce(F.try_element_at(top, key), value)
        first = _let(_obj(value), lambda fm: F.when(
            F.array_contains(F.map_keys(fm), F.lit(preferred_key)), F.element_at(fm, F.lit(preferred_key))))
        return F.when(F.array_contains(F.map_keys(top), F.lit(preferred_key)),
                      F.element_at(top, F.lit(preferred_key))).otherwise(first)

    def shape(t):
        from_dict = F.transform(F.map_entries(t["o"]), lambda e: _with_key(e["value"], e["key"]))
        return (F.when(t["o"].isNotNull(), from_dict).when(t["a"].isNotNull(), t["a"])
                .otherwise(F.array(t["v"])))

    target = F.coalesce(_let(_obj(v), pick), v)
    items = _let(F.struct(target.alias("v"), _obj(target).alias("o"), _arr(target).alias("a")), shape)
    return F.when(_is_empty(v), F.array().cast("array<variant>")).otherwise(items)


def bus_map(v: Column) -> Column:
    """``{"buses": {bucket: [bus, …]}}`` -> bus objects; non-list buckets and
    non-object elements are ignored (SRC-12)."""
    buses = _obj(F.try_variant_get(v, "$.buses", "variant"))
    lists = F.filter(F.transform(F.map_values(buses), lambda x: _arr(x)), lambda a: a.isNotNull())
    flat = F.flatten(F.coalesce(lists, F.array().cast("array<array<variant>>")))
    return F.filter(flat, lambda b: _obj(b).isNotNull())


def eta_map(v: Column) -> Column:
    """``{"ETAs": {stop_id: [eta, …]}}`` -> ETA objects without ``error`` and with
    ``_parent_stop_id`` (SRC-13, PRJ-08). Returns array<variant>."""
    etas = _obj(F.try_variant_get(v, "$.ETAs", "variant"))
    per_stop = F.transform(
        F.map_entries(etas),
        lambda e: F.transform(F.filter(F.coalesce(_arr(e["value"]), F.array().cast("array<variant>")),
                                       lambda x: _obj(x).isNotNull()),
                              lambda x: F.to_variant_object(F.map_concat(
                                  F.map_filter(_obj(x), lambda k, _: (k != F.lit("error")) & (k != F.lit("_parent_stop_id"))),
                                  F.create_map(F.lit("_parent_stop_id"), to_variant_value(e["key"]))))))
    return F.flatten(F.coalesce(per_stop, F.array().cast("array<array<variant>>")))


def drop_keys(item: Column, *names: str) -> Column:
    """Object without the given keys (VARIANT)."""
    return F.to_variant_object(F.map_filter(_obj(item), lambda k, _: ~k.isin(*names)))
