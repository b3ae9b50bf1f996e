"""JSON documents held as strings: shallow merge, removal and append of keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_KIND = "map<string,variant>"


def _entries(doc: Column) -> Column:
    return F.from_json(F.coalesce(doc, F.lit("{}")), _KIND)


def remove_key(doc: Column, key: str) -> Column:
    return F.to_json(F.map_filter(_entries(doc), lambda k, _: k != key))


def merge(left: Column, right: Column) -> Column:
    """Shallow and right-biased: keys of the right win."""
    new = _entries(right)
    return F.to_json(F.map_concat(F.map_filter(_entries(left), lambda k, _: ~F.map_contains_key(new, k)), new))


def append_event(doc: Column, key: str, event: Column) -> Column:
    """``event`` (a JSON string) at the end of the array under ``key``, which may be absent."""
    array = F.coalesce(F.from_json(F.get_json_object(F.coalesce(doc, F.lit("{}")), f"$.{key}"), "array<variant>"), F.array().cast("array<variant>"))
    longer = F.to_json(F.concat(array, F.array(F.parse_json(event))))
    return merge(doc, F.concat(F.lit(f'{{"{key}":'), longer, F.lit("}")))


def has_key(doc: Column, key: str) -> Column:
    """Also true where the key's value is null."""
    return F.coalesce(F.array_contains(F.json_object_keys(doc), key), F.lit(False))


def elements(rows: DataFrame, doc: str, path: str = "$") -> DataFrame:
    """The columns of ``rows`` but ``doc``, and (pos, key, value) of each element of the array or object at ``path`` of the JSON document ``doc``.

    By the table function ``variant_explode`` in a lateral join: elements keep all their fields as VARIANT, whatever their
    shape, for ``field`` to look into.  A malformed or null document, and one without the path, has no elements.
    """
    others = [c for c in rows.columns if c != doc]
    inner = "v"
    while inner in others:
        inner += "_"
    opened = rows.select(*(F.col(f"`{c}`") for c in others), F.try_variant_get(F.try_parse_json(F.col(f"`{doc}`")), path, "variant").alias(inner))
    return opened.lateralJoin(rows.sparkSession.tvf.variant_explode(F.col(inner).outer())).drop(inner)


def field(value: Column, name: str, kind: str) -> Column:
    """A field of a VARIANT as a SQL type; null where it is absent or of another kind."""
    return F.try_variant_get(value, f"$.{name}", kind)
