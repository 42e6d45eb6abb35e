"""Flight position snapshots: ``{time, states: [[17+ mixed values], ...]}``.

Each state vector becomes one typed row.  Rules kept from the feed:

* only vectors with at least 17 elements and a non-null icao24, longitude
  and latitude are kept;
* numbers are read leniently (a number or numeric text; anything else is
  null); ``category`` follows Python ``int()``: JSON ``1.5`` -> 1, text
  ``"1.5"`` -> null;
* ``on_ground`` / ``spi`` follow Python truthiness: ``false``, ``0`` and
  ``""`` are false, the text ``"false"`` is true;
* a null position or contact time gives a null timestamp (the row stays).

Element 7 is read as the geometric altitude and element 13 as the
barometric one, the same mapping as the feed this replaces.

Mixed-type arrays are read through the variant type so the JSON type of
every element is still known (``schema_of_variant``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.operators.fetch import join_on_key

from feedloom.functions.safe import truthy

# Named bounding boxes as (lat min, lat max, lon min, lon max).
REGIONS = {
    "EUROPE": (35.0, 72.0, -25.0, 45.0),
    "NORTH_AMERICA": (7.0, 72.0, -168.0, -60.0),
    "SOUTH_AMERICA": (-56.0, 15.0, -90.0, -30.0),
    "ASIA": (-10.0, 82.0, 45.0, 180.0),
    "AUSTRALIA": (-50.0, -10.0, 110.0, 180.0),
    "AFRICA": (-35.0, 37.0, -20.0, 52.0),
    "GLOBAL": (-90.0, 90.0, -180.0, 180.0),
}
DEFAULT_REGION = "NORTH_AMERICA"

# The output columns, in state-vector order (time_ingest first).
COLUMNS = ("time_ingest", "icao24", "callsign", "origin_country", "time_position",
           "last_contact", "longitude", "latitude", "geo_altitude", "on_ground", "velocity",
           "true_track", "vertical_rate", "sensors", "baro_altitude", "squawk", "spi",
           "category")


def check_region(region: str | None) -> str:
    r = (region or DEFAULT_REGION).upper()
    if r not in REGIONS:
        raise ValueError(f"unknown region {region!r}; known: {', '.join(REGIONS)}")
    return r


def _el(arr: Column, i: int) -> Column:
    return F.get(arr, i)


def _num(v: Column, t: Column) -> Column:
    """A number, or numeric text read like Python's ``float()``; true and
    false are 1 and 0.  ``t`` is the value as text: only what is no number
    is asked for its kind."""
    from feedloom.functions.safe import safe_double

    flag = t.isin("true", "false") & (F.schema_of_variant(v) == "BOOLEAN")
    return F.coalesce(safe_double(t), F.when(flag, (t == "true").cast("double")))


def _int(v: Column) -> Column:
    kind = F.schema_of_variant(v)
    text = F.try_variant_get(v, "$", "string")
    from feedloom.functions.safe import safe_int

    return (F.when(kind == "STRING", safe_int(text))
            .when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("int"))
            .otherwise(F.try_variant_get(v, "$", "int")))


def _text(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


# Places of the numbers in a state vector.
NUMBERS = (3, 4, 5, 6, 7, 9, 10, 11, 13)


def state_columns(time_ingest: Column) -> list[Column]:
    """Columns of a vector ``_s`` whose numbers stand as text in ``_n<i>``."""
    e = lambda i: _el(F.col("_s"), i)
    num = lambda i: _num(e(i), F.col(f"_n{i}"))
    return [
        time_ingest.alias("time_ingest"),
        _text(e(0)).alias("icao24"),
        _text(e(1)).alias("callsign"),
        _text(e(2)).alias("origin_country"),
        F.timestamp_seconds(num(3)).alias("time_position"),
        F.timestamp_seconds(num(4)).alias("last_contact"),
        num(5).alias("longitude"),
        num(6).alias("latitude"),
        num(7).alias("geo_altitude"),
        truthy(e(8)).alias("on_ground"),
        num(9).alias("velocity"),
        num(10).alias("true_track"),
        num(11).alias("vertical_rate"),
        F.try_variant_get(e(12), "$", "array<int>").alias("sensors"),
        num(13).alias("baro_altitude"),
        _text(e(14)).alias("squawk"),
        truthy(e(15)).alias("spi"),
        _int(e(16)).alias("category"),
    ]


def normalise(snapshots: DataFrame, body_col: str = "body", keep: list[str] | None = None) -> DataFrame:
    """Snapshot payloads -> one row per valid state vector."""
    keep = keep or []
    # parse each body once; time and states are both read from the variant
    parsed = snapshots.select(*keep, F.try_parse_json(body_col).alias("_p"))
    v = F.col("_p")
    rows = parsed.select(
        *keep,
        F.timestamp_seconds(F.try_variant_get(v, "$.time", "double")).alias("_t"),
        F.explode(F.try_variant_get(v, "$.states", "array<variant>")).alias("_v"))
    rows = rows.select(*keep, "_t", F.try_variant_get("_v", "$", "array<variant>").alias("_s"))
    s = F.col("_s")
    valid = ((F.size(s) >= 17)
             & _text(_el(s, 0)).isNotNull()
             & ~F.is_variant_null(_el(s, 5)) & ~F.is_variant_null(_el(s, 6)))
    # each number is taken out as text once, then read
    texts = [_text(_el(s, i)).alias(f"_n{i}") for i in NUMBERS]
    return rows.where(valid).select(*keep, "_t", "_s", *texts).select(*keep, *state_columns(F.col("_t")))


def in_region(region: str) -> Column:
    """Bounding-box predicate of one named region (inclusive)."""
    lamin, lamax, lomin, lomax = REGIONS[check_region(region)]
    return (F.col("latitude").between(lamin, lamax) & F.col("longitude").between(lomin, lomax))


def tag_regions(states: DataFrame) -> DataFrame:
    """Every (state, region) pair whose box holds the position.

    The seven boxes are fixed literals: each row tests them (seven range
    predicates) and is exploded once per match.  No join and no shuffle;
    the tests run inside whole-stage codegen.
    """
    lat, lon = F.col("latitude"), F.col("longitude")
    names = [F.when(lat.between(a, b) & lon.between(c, e), F.lit(k))
             for k, (a, b, c, e) in REGIONS.items()]
    return (states.withColumn("region", F.explode(F.array(*names)))
            .where(F.col("region").isNotNull()))


# Sides of the grids' cells: 180 degrees, halved this many times.
LEVELS = 13


def _cell(degrees: Column, level: Column) -> Column:
    """Number of the cell that holds a coordinate; it never falls as the
    coordinate rises, whatever the coordinate."""
    held = F.least(F.greatest(degrees, F.lit(-720.0)), F.lit(720.0))
    return F.floor(held * F.pow(F.lit(2.0), level) / 180).cast("long")


def tag_boxes(states: DataFrame, boxes: DataFrame, name: str = "region") -> DataFrame:
    """Every (state, box) pair whose box holds the position, for any number of
    boxes (``name``, lamin, lamax, lomin, lomax; bounds inclusive).

    Each box is covered by cells of the grid whose cells are just larger than
    it, at most four; a position has one cell in each grid that some box uses
    (13 at most).  Position and box meet by an equi-join on the cell, whose hot
    cells Spark may split, and the exact test follows.  Boxes without a bound
    or with bounds in the wrong order hold nothing.
    """
    lamin, lamax, lomin, lomax = (F.col(c).cast("double") for c in ("lamin", "lamax", "lomin", "lomax"))
    whole = boxes.where((lamin <= lamax) & (lomin <= lomax)).select(
        F.col(name).alias("_name"), lamin.alias("_a"), lamax.alias("_b"), lomin.alias("_c"), lomax.alias("_d"))
    extent = F.greatest(F.col("_b") - F.col("_a"), F.col("_d") - F.col("_c"), F.lit(1e-9))
    level = F.least(F.greatest(F.floor(F.log2(F.lit(180.0) / extent)), F.lit(0)), F.lit(LEVELS - 1)).cast("int")
    cells = whole.withColumn("_level", level)
    for lo, hi, cell in (("_a", "_b", "_y"), ("_c", "_d", "_x")):
        cells = cells.withColumn(cell, F.explode(F.sequence(_cell(F.col(lo), F.col("_level")), _cell(F.col(hi), F.col("_level")))))
    used = sorted(r[0] for r in cells.select("_level").distinct().collect())  # at most LEVELS numbers
    grids = F.array(*[F.lit(n) for n in used]) if used else F.array().cast("array<int>")
    lat, lon = F.col("latitude"), F.col("longitude")
    placed = states.where(lat.isNotNull() & lon.isNotNull()).withColumn("_at_level", F.explode(grids))
    placed = placed.withColumns({"_at_y": _cell(lat, F.col("_at_level")), "_at_x": _cell(lon, F.col("_at_level"))})
    met = join_on_key(placed, cells, ["_at_level", "_at_y", "_at_x"], ["_level", "_y", "_x"], "inner")
    inside = lat.between(F.col("_a"), F.col("_b")) & lon.between(F.col("_c"), F.col("_d"))
    return met.where(inside).select(*states.columns, F.col("_name").alias(name))


def high_flights(states: DataFrame, altitude: float = 10000.0) -> DataFrame:
    """Airborne filter of the feed's example: callsign set, above ``altitude``."""
    return states.where(F.col("callsign").isNotNull() & (F.col("geo_altitude") > altitude))


def read_snapshots(spark, path: str, whole_files: bool = False) -> DataFrame:
    """Landed snapshots as a batch table of states.

    ``whole_files``: one snapshot per file (``wholetext``); otherwise one
    snapshot per line, which lets Spark split large files.
    """
    text = spark.read.text(path, wholetext=bool(whole_files))
    return normalise(text.select(F.col("value").alias("body")))
