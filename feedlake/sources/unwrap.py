"""Config-driven payload unwrapping (SRC-03..18).

Every vendor answer is reduced to a list of items with one expression over a
VARIANT, then exploded. The platforms differ only in configuration: which keys
may hold the list, whether a one-key wrapper object is opened, and what happens
to scalars and single objects.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class UnwrapConfig:
    keys: tuple[str, ...] = ()       # the first key present holds the items
    list_keys: tuple[str, ...] = ()  # then: the first of these whose value is a non-empty list
    empty_lists: bool = False        # an empty list under a list key decides too: no items
    inner_one_key: bool = False      # a located one-key object is opened: {"routes": {"route": [...]}}
    doc_one_key: bool = False        # without a key, a one-key document is opened (RouteMatch)
    value_scalar: str = "wrap"       # located scalar: 'wrap' -> [x], 'drop' -> []
    value_object: str = "wrap"       # located object: 'wrap' -> [obj], 'drop' -> []
    doc_scalar: str = "wrap"         # document scalar: 'wrap', 'drop', or 'data' -> [{"data": "x"}]
    doc_object: str = "wrap"         # document object without a key: 'wrap' -> [doc], 'drop' -> []
    doc_list: bool = True            # a list document yields its items


# Per-platform unwrap rules.
BULK = UnwrapConfig(keys=("entity",))                                       # SRC-03 / SRC-07
JSONAPI = UnwrapConfig(keys=("data",))                                      # SRC-04
ROUTEMATCH = UnwrapConfig(keys=("data",), doc_one_key=True, doc_scalar="data")   # SRC-15
PASSIO_ALERTS = UnwrapConfig(list_keys=("msgs",), doc_object="drop", doc_scalar="drop", doc_list=False)  # SRC-14


def passio_alerts() -> UnwrapConfig:
    """SRC-14: one item per ``msgs`` element; anything but a list gives nothing."""
    return PASSIO_ALERTS


def routematch() -> UnwrapConfig:
    """SRC-15: a scalar becomes ``{"data": text}``; the ``data`` key, else the single
    value of a one-key object, as a list or wrapped."""
    return ROUTEMATCH


def bustime(keys: tuple[str, ...]) -> UnwrapConfig:
    """SRC-10: the first key present — a list, a one-key wrapper around a list or an
    object, or a wrapped value; a document without the key, or text, gives nothing."""
    return UnwrapConfig(keys=keys, inner_one_key=True, doc_object="drop", doc_scalar="drop")


def swiv(key: str) -> UnwrapConfig:
    """SRC-16: the named key if present, else the document; list or wrap."""
    return UnwrapConfig(keys=(key,))


def transloc(key: str) -> UnwrapConfig:
    """SRC-17: a list document, or the first non-empty list among ``d`` and the
    named key; anything else gives nothing."""
    return UnwrapConfig(list_keys=("d", key), doc_object="drop", doc_scalar="drop")


def massport(collection_keys: tuple[str, ...]) -> UnwrapConfig:
    """SRC-18: ``data`` (list or wrapped), else the first collection key holding a
    list (an empty one gives nothing), else the object itself."""
    return UnwrapConfig(keys=("data",), list_keys=collection_keys, empty_lists=True)


def _arr(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def _obj(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>")


def _key_value(v: Column, key: str) -> tuple[Column, Column]:
    """(present, value) of a top-level key; present even when the value is JSON null."""
    m = _obj(v)
    return F.coalesce(F.array_contains(F.map_keys(m), F.lit(key)), F.lit(False)), F.element_at(m, F.lit(key))


def _empty() -> Column:
    return F.array().cast("array<variant>")


def _let(value: Column, body) -> Column:
    """Bind ``value`` once for ``body`` (a lambda binding)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _shapes(v: Column) -> Column:
    """The document with its object and list views, converted once."""
    return F.struct(v.alias("v"), _obj(v).alias("o"), _arr(v).alias("a"),
                    F.try_variant_get(v, "$", "string").alias("s"))


def _value_items(x: Column, cfg: UnwrapConfig) -> Column:
    """Items of a located value: a list is its items; objects and scalars per config."""
    def body(t):
        obj, arr, single = t["o"], t["a"], F.array(t["v"])
        if cfg.inner_one_key:
            inner = F.element_at(F.map_values(obj), 1)
            one = F.size(obj) == 1
            obj_items = _let(F.struct(_obj(inner).alias("o"), _arr(inner).alias("a"), inner.alias("v")),
                             lambda i: F.coalesce(F.when(one & i["a"].isNotNull(), i["a"])
                                                  .when(one & i["o"].isNotNull(), F.array(i["v"])), single))
        else:
            obj_items = single if cfg.value_object == "wrap" else _empty()
        scalar = single if cfg.value_scalar == "wrap" else _empty()
        return (F.when(t["v"].isNull() | F.is_variant_null(t["v"]), _empty()).when(arr.isNotNull(), arr)
                .when(obj.isNotNull(), obj_items).otherwise(scalar))
    return _let(_shapes(x), body)


def _doc_items(t: Column, cfg: UnwrapConfig) -> Column:
    """Items of a document (bound shapes ``t``) in which no configured key matched."""
    v, obj, arr = t["v"], t["o"], t["a"]
    if cfg.doc_scalar == "data":
        scalar = F.array(F.to_variant_object(F.create_map(
            F.lit("data"), F.try_variant_get(F.to_variant_object(F.struct(t["s"].alias("v"))), "$.v", "variant"))))
    elif cfg.doc_scalar == "wrap":
        scalar = F.array(v)
    else:
        scalar = _empty()
    obj_items = F.array(v) if cfg.doc_object == "wrap" else _empty()
    if cfg.doc_one_key:
        obj_items = F.when(F.size(obj) == 1, _value_items(F.element_at(F.map_values(obj), 1), cfg)) \
            .otherwise(obj_items)
    lst = arr if cfg.doc_list else _empty()
    return F.when(arr.isNotNull(), lst).when(obj.isNotNull(), obj_items).otherwise(scalar)


def unwrap_items(v: Column, cfg: UnwrapConfig) -> Column:
    """array<variant> of items in a VARIANT document under ``cfg`` (SRC-03/04/07/10/14..18).

    An empty answer gives nothing; then the first configured key present decides,
    then the first ``list_keys`` entry holding a non-empty list, then the document
    itself. The document's object/list views are computed once per row.
    """
    def body(t):
        m, arr = t["o"], t["a"]
        falsy = (t["v"].isNull() | F.is_variant_null(t["v"]) | (F.size(m) == 0) | (F.size(arr) == 0)
                 | (m.isNull() & arr.isNull() & (t["s"] == "")))
        out = _doc_items(t, cfg)
        names = F.coalesce(F.map_keys(m), F.array().cast("array<string>"))
        if cfg.list_keys:
            lists = F.filter(F.transform(F.array(*[F.lit(k) for k in cfg.list_keys]),
                                         lambda k: _arr(F.element_at(m, k))),
                             lambda a: a.isNotNull() & (F.size(a) > F.lit(-1 if cfg.empty_lists else 0)))
            out = F.when(F.size(lists) > 0, F.element_at(lists, 1)).otherwise(out)
        if cfg.keys:
            hit = F.filter(F.array(*[F.lit(k) for k in cfg.keys]), lambda k: F.array_contains(names, k))
            value = F.element_at(m, F.try_element_at(hit, F.lit(1)))
            out = F.when(F.size(hit) > 0, _value_items(value, cfg)).otherwise(out)
        return F.when(falsy, _empty()).otherwise(out)
    return _let(_shapes(v), body)


def unwrap(df: DataFrame, payload: str | Column, cfg: UnwrapConfig, pos: str = "item_no",
           item: str = "item") -> DataFrame:
    """Explode a JSON/VARIANT payload column into one row per item."""
    p = F.col(payload) if isinstance(payload, str) else payload
    v = p if _is_variant(df, payload) else F.try_parse_json(p)
    keep = [c for c in df.columns if not (isinstance(payload, str) and c == payload)]
    return df.select(*keep, F.posexplode(unwrap_items(v, cfg)).alias(pos, item))


def _is_variant(df: DataFrame, payload) -> bool:
    return isinstance(payload, str) and dict(df.dtypes).get(payload) == "variant"


def bustime_body(v: Column) -> Column:
    """The ``bustime-response`` envelope when present, else the document."""
    present, value = _key_value(v, "bustime-response")
    return F.when(present, value).otherwise(v)
