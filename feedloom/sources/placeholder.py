"""Demo blog feed normaliser: posts, users, todos, comments, albums, photos.

Bodies are a JSON list of items, or a single object (``/posts/{id}``), which
counts as a one-item list.  Each endpoint maps item fields to a fixed typed
schema; a field with a default gets it only when the key is *missing* (an
explicit JSON null stays null), like ``dict.get(key, default)``.  Nested
users fields (address, geo, company) default to ``""`` when any level of the
path is missing.  An unknown endpoint falls back to posts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.jsonx import variant_items, vget, vget_default

# The output schema of each endpoint as
# (column, JSON path, type, default when missing; None = no default).
ENDPOINTS: dict[str, list[tuple[str, str, str, object]]] = {
    "posts": [
        ("userId", "$.userId", "int", None),
        ("id", "$.id", "int", None),
        ("title", "$.title", "string", ""),
        ("body", "$.body", "string", ""),
    ],
    "users": [
        ("id", "$.id", "int", None),
        ("name", "$.name", "string", ""),
        ("username", "$.username", "string", ""),
        ("email", "$.email", "string", ""),
        ("phone", "$.phone", "string", ""),
        ("website", "$.website", "string", ""),
        ("address_street", "$.address.street", "string", ""),
        ("address_suite", "$.address.suite", "string", ""),
        ("address_city", "$.address.city", "string", ""),
        ("address_zipcode", "$.address.zipcode", "string", ""),
        ("address_geo_lat", "$.address.geo.lat", "string", ""),
        ("address_geo_lng", "$.address.geo.lng", "string", ""),
        ("company_name", "$.company.name", "string", ""),
        ("company_catchPhrase", "$.company.catchPhrase", "string", ""),
        ("company_bs", "$.company.bs", "string", ""),
    ],
    "todos": [
        ("userId", "$.userId", "int", None),
        ("id", "$.id", "int", None),
        ("title", "$.title", "string", ""),
        ("completed", "$.completed", "boolean", False),
    ],
    "comments": [
        ("postId", "$.postId", "int", None),
        ("id", "$.id", "int", None),
        ("name", "$.name", "string", ""),
        ("email", "$.email", "string", ""),
        ("body", "$.body", "string", ""),
    ],
    "albums": [
        ("userId", "$.userId", "int", None),
        ("id", "$.id", "int", None),
        ("title", "$.title", "string", ""),
    ],
    "photos": [
        ("albumId", "$.albumId", "int", None),
        ("id", "$.id", "int", None),
        ("title", "$.title", "string", ""),
        ("url", "$.url", "string", ""),
        ("thumbnailUrl", "$.thumbnailUrl", "string", ""),
    ],
}


def endpoint_spec(endpoint: str | None) -> list[tuple[str, str, str, object]]:
    return ENDPOINTS.get(endpoint or "posts", ENDPOINTS["posts"])


def item_columns(item: Column, endpoint: str | None) -> list[Column]:
    cols = []
    for name, path, dtype, default in endpoint_spec(endpoint):
        c = vget(item, path, dtype) if default is None else vget_default(item, path, dtype, default)
        cols.append(c.alias(name))
    return cols


def normalise(captures: DataFrame, endpoint: str = "posts", body_col: str = "body",
              keep: list[str] | None = None) -> DataFrame:
    """Capture rows -> typed rows of ``endpoint`` (one per list item)."""
    keep = keep or []
    parsed = captures.select(*keep, F.try_parse_json(body_col).alias("_p"))
    items = parsed.select(*keep, F.explode(variant_items(F.col("_p"))).alias("_item"))
    return items.select(*keep, *item_columns(F.col("_item"), endpoint))


def item_url(base: str, endpoint: str, id_value: int | None = None) -> str:
    """``/posts`` or ``/posts/{id}``."""
    ep = endpoint if endpoint in ENDPOINTS else "posts"
    return f"{base.rstrip('/')}/{ep}" + (f"/{id_value}" if id_value is not None else "")


def select_items(df: DataFrame, item_id: int | None = None, limit: int | None = None) -> DataFrame:
    """``id`` picks one item; ``limit`` applies only when no ``id`` is given."""
    if item_id is not None:
        return df.where(F.col("id") == F.lit(int(item_id)))
    if limit is not None:
        return first_n(df, int(limit))
    return df


def first_n(df: DataFrame, n: int) -> DataFrame:
    """``_limit``: the first ``n`` items in id order (a top-k, not a sample)."""
    if n < 0:
        raise ValueError("limit must be >= 0")
    return df.orderBy("id").limit(n)
