"""Weather timelines per location, and incremental reads with per-key marks.

Payload: ``{"timelines": {"minutely" | "hourly" | "daily": [{"time": iso,
"values": {...}}]}}``.  Rows are ``latitude, longitude, weather, timestamp``
where ``weather`` is the entry's ``values`` object as compact JSON text and
``timestamp`` the ISO time text (ISO texts of one format compare correctly
as strings).

Incremental reading keeps one mark per location: entries strictly after the
mark are new; the next mark is the larger of the old mark and the newest
entry seen (an empty timeline leaves the mark unchanged).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Output schema, timeline names, and the first mark of a location.
SCHEMA = "latitude double, longitude double, weather string, timestamp string"
FREQUENCIES = ("minutely", "hourly", "daily")
INITIAL_MARK = "2024-09-01T00:00:00Z"

_ENTRIES = "struct<timelines: map<string, array<struct<time: string, values: string>>>>"


def check_frequency(frequency: str) -> str:
    if frequency not in FREQUENCIES:
        raise ValueError(f"unknown frequency {frequency!r}; known: {', '.join(FREQUENCIES)}")
    return frequency


def parse_locations(text: Column) -> Column:
    """``"[(lat, lon), ...]"`` -> array<array<double>>."""
    t = F.translate(text, "()", "[]")
    return F.from_json(t, "array<array<double>>")


def option_locations(spark, text: str | None) -> list[tuple[float, float]]:
    """The (latitude, longitude) pairs of an option value."""
    found = spark.range(1).select(parse_locations(F.lit(text or "[]")).alias("l")).first()["l"]
    if not found or any(x is None or len(x) != 2 or None in x for x in found):
        raise ValueError("locations is required: a list of pairs, e.g. '[(52.5, 13.4)]'")
    return [(a, b) for a, b in found]


def normalise(captures: DataFrame, frequency: str = "minutely", body_col: str = "body",
              lat_col: str = "latitude", lon_col: str = "longitude") -> DataFrame:
    check_frequency(frequency)
    parsed = F.from_json(F.col(body_col), _ENTRIES)
    entries = F.try_element_at(parsed["timelines"], F.lit(frequency))
    rows = captures.select(F.col(lat_col).cast("double").alias("latitude"),
                           F.col(lon_col).cast("double").alias("longitude"),
                           F.explode(entries).alias("_e"))
    return rows.select("latitude", "longitude", F.col("_e.values").alias("weather"),
                       F.col("_e.time").alias("timestamp"))


def initial_marks(locations: DataFrame, mark: str = INITIAL_MARK) -> DataFrame:
    return locations.select("latitude", "longitude", F.lit(mark).alias("mark"))


def _same_place():
    return F.col("latitude").eqNullSafe(F.col("_lat")) & F.col("longitude").eqNullSafe(F.col("_lon"))


def increment(rows: DataFrame, marks: DataFrame, initial_mark: str = INITIAL_MARK) -> DataFrame:
    """New rows: ``timestamp > mark`` of their location (exclusive start).

    Locations without a mark use ``initial_mark``.  The marks table has one
    row per location; a null coordinate is a location of its own.
    """
    m = marks.select(F.col("latitude").alias("_lat"), F.col("longitude").alias("_lon"), "mark")
    j = rows.join(m, _same_place(), "left").drop("_lat", "_lon")
    start = F.coalesce(F.col("mark"), F.lit(initial_mark))
    return j.where(F.col("timestamp") > start).drop("mark")


def advance_marks(rows: DataFrame, marks: DataFrame, initial_mark: str = INITIAL_MARK) -> DataFrame:
    """Next marks: ``greatest(old, max(timestamp))`` per location.

    ``max`` is partial-aggregated, so a location with many entries costs
    one row per task before the shuffle.
    """
    newest = rows.groupBy("latitude", "longitude").agg(F.max("timestamp").alias("_newest"))
    newest = newest.select(F.col("latitude").alias("_lat"), F.col("longitude").alias("_lon"), "_newest",
                           F.lit(True).alias("_new"))
    j = marks.join(newest, _same_place(), "full")
    new = F.col("_new") & F.col("mark").isNull()
    return j.select(F.when(new, F.col("_lat")).otherwise(F.col("latitude")).alias("latitude"),
                    F.when(new, F.col("_lon")).otherwise(F.col("longitude")).alias("longitude"),
                    F.greatest(F.coalesce("mark", F.lit(initial_mark)),
                               F.coalesce("_newest", F.lit(""))).alias("mark"))
