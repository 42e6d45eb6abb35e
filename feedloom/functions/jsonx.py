"""JSON helpers on top of Spark's variant type.

A payload is parsed once with ``try_parse_json`` (bad text -> null); fields
are read with ``try_variant_get`` so a wrong type gives null, not an error.
``vget_default`` keeps the difference between a *missing* key (default
applies) and an explicit JSON ``null`` (stays null).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_variant(body: Column) -> Column:
    return F.try_parse_json(body)


def as_json_array(body: Column) -> Column:
    """A JSON text that is an object becomes a one-element array."""
    t = F.ltrim(body)
    return F.when(t.startswith("["), body).otherwise(F.concat(F.lit("["), body, F.lit("]")))


def variant_items(v: Column) -> Column:
    """array<variant> of a variant that is an array, or of a single object."""
    kind = F.schema_of_variant(v)
    return (F.when(kind.startswith("ARRAY"), v.try_cast("array<variant>"))
            .when(kind.startswith("OBJECT"), F.array(v)))


def vget(v: Column, path: str, dtype: str = "string") -> Column:
    return F.try_variant_get(v, path, dtype)


def vget_default(v: Column, path: str, dtype: str, default) -> Column:
    present = F.try_variant_get(v, path, "variant").isNotNull()
    return F.when(present, F.try_variant_get(v, path, dtype)).otherwise(F.lit(default).cast(dtype))
