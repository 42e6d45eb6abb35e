"""Pull-request feed normaliser.

Body: JSON list of ``{number, title, user: {login}, created_at, updated_at}``.
A ``user`` that is null or missing gives a null author (the row is kept).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions.jsonx import variant_items, vget

# The output schema.
SCHEMA = "id int, title string, author string, created_at string, updated_at string"


def pulls_url(repo: str | None, page: int | None = None) -> str:
    if not repo:
        raise ValueError("repo (owner/name) is required")
    url = f"https://api.github.com/repos/{repo}/pulls"
    return url if page is None else f"{url}?page={page}"


def normalise(captures: DataFrame, body_col: str = "body", keep: list[str] | None = None) -> DataFrame:
    keep = keep or []
    parsed = captures.select(*keep, F.try_parse_json(body_col).alias("_p"))
    items = parsed.select(*keep, F.explode(variant_items(F.col("_p"))).alias("_pr"))
    pr = F.col("_pr")
    return items.select(
        *keep,
        vget(pr, "$.number", "int").alias("id"),
        vget(pr, "$.title").alias("title"),
        vget(pr, "$.user.login").alias("author"),
        vget(pr, "$.created_at").alias("created_at"),
        vget(pr, "$.updated_at").alias("updated_at"),
    )
