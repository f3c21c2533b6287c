"""JSON objects kept as text: shallow merge, nested merge, typed reads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MAP = "map<string,variant>"


def _object(text: Column) -> Column:
    return F.try_parse_json(F.coalesce(text, F.lit("{}"))).cast(_MAP)


def merge(old: Column, patch: Column) -> Column:
    """Top-level union: the patch wins, nested values are replaced whole, explicit nulls stay."""
    a, b = _object(old), _object(patch)
    return F.to_json(F.map_concat(F.map_filter(a, lambda k, v: ~F.map_contains_key(b, k)), b))


def merge_at(text: Column, key: str, patch: Column) -> Column:
    """merge() of the object under one key, which is made if it is absent."""
    inner = merge(F.get_json_object(text, f"$.{key}"), patch)
    return merge(text, F.concat(F.lit(f'{{"{key}":'), inner, F.lit("}")))


def fold(patches: Column) -> Column:
    """All patches of an ordered array, one after the other."""
    return F.aggregate(patches, F.lit("{}"), lambda acc, x: merge(acc, x))


def has_key(text: Column, key: str) -> Column:
    return F.coalesce(F.array_contains(F.json_object_keys(text), key), F.lit(False))


def typed(text: Column, path: str, kind: str) -> Column:
    """The value at $.path, or null where it is missing or of another kind."""
    return F.get_json_object(text, f"$.{path}").try_cast(kind)


def contains(text: Column, path: str, schema: str, test) -> Column:
    """Whether any element of the array at $.path passes the test."""
    return F.coalesce(F.exists(F.from_json(F.get_json_object(text, f"$.{path}"), schema), test), F.lit(False))


def patch_of(**values: Column) -> Column:
    """A JSON object of columns; those that are null are left out."""
    return F.to_json(F.struct(*(c.alias(k) for k, c in values.items())))


def as_objects(text: Column, schema: str) -> Column:
    """An array of objects; empty where the text is no such array."""
    return F.coalesce(F.from_json(text, schema), F.from_json(F.lit("[]"), schema))
