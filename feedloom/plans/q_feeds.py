"""Queries for the JSON feed normalisers (demo blog data, pull requests,
quotes, price series, flight positions, weather)."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.plans import captures as C
from feedloom.plans.registry import query
from feedloom.plans.tables import load
from feedloom.sources import flights, github, placeholder, quotes, stock, weather

# ------------------------------------------------------------ demo blog data

_USERS_SQL = """
SELECT CAST(c_custkey AS INTEGER) AS id, c_name AS name,
       lower(replace(c_name, '#', '')) AS username,
       lower(replace(c_name, '#', '.')) || '@example.com' AS email,
       '+' || c_nationkey || '-' || c_custkey AS phone,
       'www.' || lower(n_name) || '.example' AS website,
       CASE WHEN c_acctbal < 0 THEN '' ELSE c_custkey || ' Main St' END AS address_street,
       CASE WHEN c_acctbal < 0 THEN '' ELSE 'Apt ' || c_nationkey END AS address_suite,
       CASE WHEN c_acctbal < 0 THEN '' ELSE n_name END AS address_city,
       CASE WHEN c_acctbal < 0 THEN '' ELSE lpad(CAST(c_custkey AS VARCHAR), 5, '0') END AS address_zipcode,
       CASE WHEN c_acctbal < 0 OR c_mktsegment = 'AUTOMOBILE' THEN '' ELSE CAST(c_nationkey AS VARCHAR) END AS address_geo_lat,
       CASE WHEN c_acctbal < 0 OR c_mktsegment = 'AUTOMOBILE' THEN '' ELSE CAST(n_regionkey AS VARCHAR) END AS address_geo_lng,
       CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '' ELSE c_mktsegment END AS company_name,
       CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '' ELSE r_name END AS company_catchPhrase,
       CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '' ELSE lower(c_mktsegment) END AS company_bs
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""

_POSTS_SQL = """
SELECT CAST(o_custkey AS INTEGER) AS userId, CAST(o_orderkey AS INTEGER) AS id,
       CASE WHEN o_orderstatus = 'P' THEN '' WHEN o_orderpriority = '5-LOW' THEN NULL
            ELSE o_orderpriority END AS title,
       o_orderstatus AS body
FROM orders
"""


def _users(spark, d):
    caps = C.blog_users(load(spark, d, "customer"), load(spark, d, "nation"), load(spark, d, "region"))
    return placeholder.normalise(caps, "users")


def _posts(spark, d):
    return placeholder.normalise(C.blog_posts(load(spark, d, "orders")), "posts")


def _albums(spark, d):
    return placeholder.normalise(C.blog_albums(load(spark, d, "orders")), "albums")


def _comments(spark, d):
    return placeholder.normalise(C.blog_comments(load(spark, d, "lineitem")), "comments")


def _photos(spark, d):
    return placeholder.normalise(C.blog_photos(load(spark, d, "lineitem")), "photos")


def _join(left, right, key):
    """Join of items taken out of payloads.  Spark knows the number of the
    payloads, not of their items, and would broadcast millions of them for a
    few: such sides are always sorted and merged."""
    return left.join(right.hint("merge"), key)


query("jp_users", _USERS_SQL)(_users)
query("jp_posts", _POSTS_SQL)(_posts)
query("jp_albums", """
SELECT CAST(o_custkey AS INTEGER) AS userId, CAST(o_orderkey AS INTEGER) AS id,
       'album ' || o_orderkey AS title FROM orders
""")(_albums)
query("jp_comments", """
SELECT CAST(l_orderkey AS INTEGER) AS postId, CAST(l_orderkey * 8 + l_linenumber AS INTEGER) AS id,
       're ' || l_returnflag || l_linestatus AS name,
       CASE WHEN l_returnflag = 'R' THEN '' ELSE 'u' || l_suppkey || '@example.com' END AS email,
       'qty ' || CAST(l_quantity AS INTEGER) AS body
FROM lineitem
""")(_comments)
query("jp_photos", """
SELECT CAST(l_orderkey AS INTEGER) AS albumId, CAST(l_orderkey * 8 + l_linenumber AS INTEGER) AS id,
       'photo ' || l_linenumber AS title, 'https://img.example.com/' || l_partkey AS url,
       CASE WHEN l_linestatus = 'F' THEN '' ELSE 'https://img.example.com/t/' || l_partkey END AS thumbnailUrl
FROM lineitem
""")(_photos)


@query("jp_todos", """
SELECT CAST(user_id AS INTEGER) AS userId, CAST(event_id AS INTEGER) AS id, event_type AS title,
       CASE WHEN event_type = 'purchase' THEN true WHEN event_type = 'error' THEN NULL
            ELSE false END AS completed
FROM events
""")
def jp_todos(spark, d):
    return placeholder.normalise(C.blog_todos(load(spark, d, "events")), "todos")


@query("jp_by_id", _POSTS_SQL)
def jp_by_id(spark, d):
    """``/posts/{id}``: a single object body counts as a one-item list."""
    return placeholder.normalise(C.blog_post_objects(load(spark, d, "orders")), "posts")


@query("jp_fallback", _POSTS_SQL)
def jp_fallback(spark, d):
    """An unknown endpoint name falls back to posts."""
    return placeholder.normalise(C.blog_posts(load(spark, d, "orders")), "no-such-endpoint")


@query("jp_limit", f"SELECT * FROM ({_POSTS_SQL}) ORDER BY id LIMIT 100")
def jp_limit(spark, d):
    """``_limit``: the first 100 posts in id order (a top-k)."""
    return placeholder.first_n(_posts(spark, d), 100)


@query("jp_posts_users", """
SELECT CAST(o_orderkey AS INTEGER) AS post_id, o_orderstatus AS body, c_name AS author
FROM orders JOIN customer ON o_custkey = c_custkey
""")
def jp_posts_users(spark, d):
    """Posts joined with their users (``userId = id``)."""
    posts = _posts(spark, d).select(F.col("id").alias("post_id"), "userId", "body")
    users = _users(spark, d).select(F.col("id").alias("userId"), F.col("name").alias("author"))
    return _join(posts, users, "userId").drop("userId")


@query("jp_posts_comments", """
SELECT CAST(o_orderkey AS INTEGER) AS post_id, count(*) AS n_comments
FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey
""")
def jp_posts_comments(spark, d):
    """Posts joined with comments, counted per post (aggregate first)."""
    per_post = _comments(spark, d).groupBy(F.col("postId").alias("post_id")) \
        .agg(F.count(F.lit(1)).alias("n_comments"))
    posts = _posts(spark, d).select(F.col("id").alias("post_id"))
    return _join(posts, per_post, "post_id")


@query("jp_user_photos", """
SELECT CAST(c_custkey AS INTEGER) AS user_id, c_name AS name, count(*) AS n_photos
FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey
GROUP BY c_custkey, c_name
""")
def jp_user_photos(spark, d):
    """Users -> albums -> photos; photos counted per album before the joins."""
    per_album = _photos(spark, d).groupBy("albumId").agg(F.count(F.lit(1)).alias("n"))
    albums = _albums(spark, d).select(F.col("id").alias("albumId"), F.col("userId").alias("user_id"))
    per_user = _join(albums, per_album, "albumId").groupBy("user_id").agg(F.sum("n").alias("n_photos"))
    users = _users(spark, d).select(F.col("id").alias("user_id"), "name")
    return _join(users, per_user, "user_id")


# ------------------------------------------------------------- pull requests
@query("github_pulls", """
SELECT CAST(doc_id AS INTEGER) AS id, text AS title,
       CASE WHEN doc_id % 7 IN (0, 3) THEN NULL ELSE source END AS author,
       strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id * 3600), '%Y-%m-%dT%H:%M:%SZ') AS created_at,
       strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds((doc_id + 24) * 3600), '%Y-%m-%dT%H:%M:%SZ') AS updated_at
FROM documents
""")
def github_pulls(spark, d):
    """Pull-request lists -> (id, title, author, created_at, updated_at); whole texts."""
    return github.normalise(C.pull_requests(load(spark, d, "documents")))


# -------------------------------------------------------------------- quotes
@query("quotes", """
SELECT 'U' || user_id || '-USD' AS symbol,
       CASE WHEN event_type IN ('error', 'view', 'signup') THEN 0.0 ELSE value END AS price,
       value * 0.99 AS bid_price, value + 1 AS ask_price,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS updated_at
FROM events
-- the fixture answers every 10th user's call with an error payload; a failed
-- symbol yields no rows (the Spark side still reads and parses every payload)
WHERE user_id % 10 <> 0
""")
def quotes_query(spark, d):
    """Quote payloads -> typed rows; bad numbers 0.0; failed symbols no rows."""
    return quotes.normalise(C.quote_payloads(load(spark, d, "events")))


@query("quote_errors", """
SELECT DISTINCT 'U' || user_id || '-USD' AS symbol, 'Not found' AS error FROM events WHERE user_id % 10 = 0
""")
def quote_errors(spark, d):
    """Symbols whose call gave no quote, with the service's message."""
    return quotes.errors(C.quote_payloads(load(spark, d, "events"))).distinct()


@query("quote_symbols", """
SELECT event_id, 'U' || user_id || '-USD' AS symbol FROM events
UNION ALL
SELECT event_id, upper(event_type) || '-USD' FROM events
""")
def quote_symbols(spark, d):
    """Symbol lists: split, trim, upper, ``-USD`` when no pair, blanks dropped."""
    ev = load(spark, d, "events").select(
        "event_id", F.concat(F.lit(" u"), F.col("user_id"), F.lit(" , "),
                             F.lower("event_type"), F.lit("-usd ,,")).alias("symbols"))
    return quotes.explode_symbols(ev, "symbols").select("event_id", "symbol")


# ------------------------------------------------------------- price series
_DAILY_SQL = """
WITH x AS (
  SELECT p_brand AS symbol, CAST(l_shipdate AS DATE) AS day, l_extendedprice AS p,
         l_quantity AS q, l_orderkey * 8 + l_linenumber AS k
  FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT strftime(day, '%Y-%m-%d') AS date, arg_min(p, k) AS open, max(p) AS high, min(p) AS low,
       arg_max(p, k) AS close, CAST(trunc(sum(q)) AS BIGINT) AS volume, symbol, day
FROM x GROUP BY symbol, day
"""


def _daily(spark, d):
    caps = C.price_series(load(spark, d, "lineitem"), load(spark, d, "part"))
    return stock.normalise(caps)


@query("stock_daily", f"SELECT date, open, high, low, close, volume, symbol FROM ({_DAILY_SQL})")
def stock_daily(spark, d):
    """Daily series payloads -> typed rows (error / empty payloads give none)."""
    return _daily(spark, d)


def _resampled_sql(unit: str) -> str:
    return f"""
SELECT strftime(max(day), '%Y-%m-%d') AS date, arg_min(open, day) AS open, max(high) AS high,
       min(low) AS low, arg_max(close, day) AS close, CAST(sum(volume) AS BIGINT) AS volume, symbol
FROM ({_DAILY_SQL}) GROUP BY symbol, date_trunc('{unit}', day)
"""


@query("stock_weekly", _resampled_sql("week"))
def stock_weekly(spark, d):
    """Weekly series resampled from the daily rows on Spark."""
    return stock.resample(_daily(spark, d), "week")


@query("stock_monthly", _resampled_sql("month"))
def stock_monthly(spark, d):
    """Monthly series resampled from the daily rows on Spark."""
    return stock.resample(_daily(spark, d), "month")


@query("stock_errors", """
SELECT DISTINCT p_brand AS symbol, '{"Note":"Thank you for using the API; call frequency is 5 per minute."}' AS error
FROM part
UNION ALL
SELECT DISTINCT p_brand, '{"Meta Data":{"2. Symbol":"' || p_brand || '"}}'
FROM part
""")
def stock_errors(spark, d):
    """Payloads without a series are reported, not fatal."""
    caps = C.price_series(load(spark, d, "lineitem"), load(spark, d, "part"))
    return stock.errors(caps)


# ------------------------------------------------------------------- flights
_EPOCH = "CAST(floor(epoch(ts)) AS BIGINT)"
_STATES_SQL = f"""
WITH e AS (
  SELECT *, {_EPOCH} AS ep FROM events
  -- vectors the normaliser must drop: no longitude (the fixture blanks every
  -- 11th) and fewer than 17 elements (short vectors for some errors)
  WHERE event_id % 11 <> 0 AND NOT (event_type = 'error' AND event_id % 5 = 0)),
r AS (SELECT * FROM e UNION ALL SELECT * FROM e WHERE event_id % 13 = 0)
SELECT make_timestamp((ep - ep % 3600) * 1000000) AS time_ingest,
       'ev' || event_id AS icao24,
       CASE WHEN event_type = 'view' THEN NULL ELSE 'CS' || user_id END AS callsign,
       event_type AS origin_country,
       CASE WHEN event_type = 'signup' THEN NULL ELSE make_timestamp(ep * 1000000) END AS time_position,
       make_timestamp((ep + 5) * 1000000) AS last_contact,
       CAST((event_id * 37) % 360 - 180 AS DOUBLE) AS longitude,
       CAST((event_id * 53) % 180 - 90 AS DOUBLE) AS latitude,
       value * 1000 AS geo_altitude,
       CASE WHEN event_type IN ('purchase', 'view') THEN false ELSE true END AS on_ground,
       value AS velocity, CAST(user_id AS DOUBLE) AS true_track, value AS vertical_rate,
       CASE WHEN event_type = 'error' THEN NULL ELSE [CAST(user_id AS INTEGER), 1] END AS sensors,
       value * 900 AS baro_altitude, lpad(CAST(user_id AS VARCHAR), 4, '0') AS squawk,
       event_type = 'purchase' AS spi,
       CASE WHEN event_type = 'click' THEN 1 WHEN event_type = 'view' THEN NULL
            WHEN event_type = 'purchase' THEN 3 ELSE CAST(user_id % 5 AS INTEGER) END AS category
FROM r
"""


def _states(spark, d):
    return flights.normalise(C.flight_snapshots(load(spark, d, "events")))


query("flight_states", _STATES_SQL)(_states)


@query("flight_region", f"""
SELECT icao24, time_position, longitude, latitude FROM ({_STATES_SQL})
WHERE latitude BETWEEN 7.0 AND 72.0 AND longitude BETWEEN -168.0 AND -60.0
""")
def flight_region(spark, d):
    """States inside the default region's bounding box."""
    s = _states(spark, d)
    return s.where(flights.in_region(flights.DEFAULT_REGION)).select(
        "icao24", "time_position", "longitude", "latitude")


_REGIONS_SQL = ", ".join(
    f"('{k}', {a}, {b}, {c}, {e})" for k, (a, b, c, e) in flights.REGIONS.items())


@query("flight_all_regions", f"""
SELECT s.icao24, r.region, s.longitude, s.latitude
FROM ({_STATES_SQL}) s JOIN (VALUES {_REGIONS_SQL}) r(region, lamin, lamax, lomin, lomax)
  ON s.latitude BETWEEN r.lamin AND r.lamax AND s.longitude BETWEEN r.lomin AND r.lomax
""")
def flight_all_regions(spark, d):
    """Every state tagged with each named region holding it (broadcast range join)."""
    return flights.tag_regions(_states(spark, d)).select("icao24", "region", "longitude", "latitude")


_BOXES_SQL = """
SELECT 'box ' || s_suppkey AS region, ((s_suppkey * 7) % 170 - 88)::DOUBLE AS lamin,
       ((s_suppkey * 7) % 170 - 88 + s_suppkey % 9)::DOUBLE AS lamax, ((s_suppkey * 11) % 350 - 180)::DOUBLE AS lomin,
       ((s_suppkey * 11) % 350 - 180 + s_suppkey % 13)::DOUBLE AS lomax FROM supplier
UNION ALL SELECT 'nation ' || n_nationkey, -90, 90, n_nationkey * 10 - 180, n_nationkey * 10 - 179.5 FROM nation
UNION ALL SELECT r_name, -1000, 1000, -1000, r_regionkey * 100 FROM region
"""


@query("flight_custom_regions", f"""
SELECT s.icao24, r.region, s.longitude, s.latitude FROM ({_STATES_SQL}) s JOIN ({_BOXES_SQL}) r
  ON s.latitude BETWEEN r.lamin AND r.lamax AND s.longitude BETWEEN r.lomin AND r.lomax
""")
def flight_custom_regions(spark, d):
    """States tagged with boxes from a table, small ones and some as large as the world."""
    key = F.col("s_suppkey")
    box = ["region", "lamin", "lamax", "lomin", "lomax"]
    supplier = load(spark, d, "supplier").select(
        F.concat(F.lit("box "), key), key * 7 % 170 - 88, key * 7 % 170 - 88 + key % 9,
        key * 11 % 350 - 180, key * 11 % 350 - 180 + key % 13).toDF(*box)
    nation = load(spark, d, "nation").selectExpr("concat('nation ', n_nationkey)", "-90", "90", "n_nationkey * 10 - 180",
                                                 "n_nationkey * 10 - 179.5").toDF(*box)
    region = load(spark, d, "region").selectExpr("r_name", "-1000", "1000", "-1000", "r_regionkey * 100").toDF(*box)
    boxes = None
    for part in (supplier, nation, region):
        part = part.select("region", *[F.col(c).cast("double").alias(c) for c in box[1:]])
        boxes = part if boxes is None else boxes.unionByName(part)
    return flights.tag_boxes(_states(spark, d), boxes).select("icao24", "region", "longitude", "latitude")


@query("flight_snapshot_files", f"SELECT icao24, time_ingest, longitude, latitude, geo_altitude FROM ({_STATES_SQL})")
def flight_snapshot_files(spark, d):
    """Landed snapshots read as a batch, a snapshot a line and a snapshot a file."""
    from feedloom.session import fresh_dir

    root = fresh_dir(spark, "snapshots")
    bodies = C.flight_snapshots(load(spark, d, "events")).select("body")
    one = F.pmod(F.xxhash64("body"), F.lit(50)) == 0
    bodies.where(~one).write.text(f"{root}/lines")
    files = bodies.where(one)
    files.repartition(max(1, files.count()), "body").write.option("maxRecordsPerFile", 1).text(f"{root}/files")
    cols = ["icao24", "time_ingest", "longitude", "latitude", "geo_altitude"]
    return (flights.read_snapshots(spark, f"{root}/lines").select(*cols)
            .unionByName(flights.read_snapshots(spark, f"{root}/files", whole_files=True).select(*cols)))


@query("weather_locations", """
SELECT n_nationkey, CAST(n_nationkey AS DOUBLE) / 4 AS latitude, CAST(n_regionkey AS DOUBLE) - 2.5 AS longitude FROM nation
""")
def weather_locations(spark, d):
    """The location list of the options, from one text a nation and from one of all."""
    nation = load(spark, d, "nation")
    text = F.concat(F.lit("[("), F.col("n_nationkey").cast("double") / 4, F.lit(", "), F.col("n_regionkey").cast("double") - 2.5, F.lit(")]"))
    found = nation.select("n_nationkey", weather.parse_locations(text).alias("l"))
    return found.select("n_nationkey", F.explode("l").alias("p")).select(
        "n_nationkey", F.col("p")[0].alias("latitude"), F.col("p")[1].alias("longitude"))


@query("flight_high", f"""
SELECT icao24, callsign, geo_altitude FROM ({_STATES_SQL})
WHERE callsign IS NOT NULL AND geo_altitude > 10000
""")
def flight_high(spark, d):
    """Airborne filter: callsign set and above 10,000."""
    return flights.high_flights(_states(spark, d)).select("icao24", "callsign", "geo_altitude")


# ------------------------------------------------------------------- weather
_WEATHER_SQL = """
SELECT CAST(user_id AS DOUBLE) / 4 AS latitude, CAST(user_id AS DOUBLE) / 2 - 90 AS longitude,
       '{"type":"' || event_type || '","k":' || CAST(json_extract(props, '$.k') AS BIGINT)
       || ',"cents":' || CAST(round(value * 100) AS BIGINT) || '}' AS weather,
       strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS timestamp
FROM events
"""
_MARK = "2024-01-15T00:00:00Z"


def _weather_rows(spark, d, frequency="hourly"):
    return weather.normalise(C.weather_timelines(load(spark, d, "events")), frequency)


@query("weather_rows", _WEATHER_SQL)
def weather_rows(spark, d):
    """Hourly timeline entries per location; values kept as JSON text."""
    return _weather_rows(spark, d)


@query("weather_minutely", f"SELECT * FROM ({_WEATHER_SQL}) WHERE weather LIKE '%\"click\"%'")
def weather_minutely(spark, d):
    """The minutely timeline (the feed's default frequency)."""
    return _weather_rows(spark, d, "minutely")


def _marks(spark, d):
    locs = C.weather_locations(load(spark, d, "events")).distinct()
    return weather.initial_marks(locs, _MARK)


@query("weather_increment", f"SELECT * FROM ({_WEATHER_SQL}) WHERE timestamp > '{_MARK}'")
def weather_increment(spark, d):
    """Entries strictly after each location's mark."""
    return weather.increment(_weather_rows(spark, d), _marks(spark, d))


@query("weather_marks", f"""
SELECT latitude, longitude, greatest('{_MARK}', max(timestamp)) AS mark
FROM ({_WEATHER_SQL}) GROUP BY latitude, longitude
""")
def weather_marks(spark, d):
    """Next mark per location: the larger of the old mark and the newest entry."""
    return weather.advance_marks(_weather_rows(spark, d), _marks(spark, d))
