"""Packing the driver's tables into captured payloads (fixture side).

These functions play the remote service: they turn table rows into the
bodies an API would have answered, keyed by the request that would have
asked for them.  They are deliberately written apart from the operators
(no shared helpers), so a query that packs with this module and unpacks
with an operator checks the operator against an independent SQL oracle.

Scale rules kept here too: a payload list never holds an unbounded group.
Lists are cut by a bounded chunk of a unique id (``id div n``), so one hot
key spreads over many bodies, each of at most ``n`` items.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

API = "https://api.example.com"


def _capture(df: DataFrame, feed: str, key: Column, body: Column,
             error: Column | None = None, status: Column | None = None) -> DataFrame:
    err = error if error is not None else F.lit(None).cast("string")
    st = status if status is not None else F.when(err.isNull(), F.lit(200)).otherwise(F.lit(500))
    return df.select(
        F.lit(feed).alias("feed"),
        key.cast("string").alias("key"),
        st.cast("int").alias("status"),
        body.cast("string").alias("body"),
        err.alias("error"),
        F.lit("2024-02-01 00:00:00").cast("timestamp").alias("fetched_at"),
    )


def user_lookup(customer: DataFrame) -> DataFrame:
    """One JSON object per customer at ``/users/{c_custkey}``."""
    body = F.to_json(F.struct(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
        (F.col("c_acctbal") > 0).alias("is_valid")))
    return _capture(customer, "users", F.concat(F.lit(API + "/users/"), F.col("c_custkey")), body)


def web_pages(pages: DataFrame) -> DataFrame:
    """key = url, body = html."""
    return _capture(pages, "web", F.col("url"), F.col("html"))


def scores(labels: DataFrame) -> DataFrame:
    """key = doc_id, body ``{quality, toxic}``."""
    return _capture(labels, "scores", F.col("doc_id"),
                    F.to_json(F.struct("quality", "toxic")))


def _div(name: str, n: int) -> Column:
    """``name div n``: exact integer division for any long id."""
    return F.expr(f"`{name}` div {int(n)}")


def chunked_lists(df: DataFrame, group_cols: list[str], id_col: str, item: Column,
                  chunk: int = 64) -> DataFrame:
    """JSON array text per (group, id div chunk): bounded lists."""
    g = df.select(*group_cols, _div(id_col, chunk).alias("_chunk"),
                  F.col(id_col).alias("_id"), item.alias("_item"))
    return (g.groupBy(*group_cols, "_chunk")
            .agg(F.array_sort(F.collect_list(F.struct("_id", "_item"))).alias("_items"))
            .select(*group_cols, "_chunk",
                    F.concat(F.lit("["),
                             F.array_join(F.transform("_items", lambda s: s["_item"]), ","),
                             F.lit("]")).alias("body")))


# ---------------------------------------------------------------- JSON text
def jstr(c: Column) -> Column:
    """JSON string literal of a column (``null`` for null)."""
    return F.regexp_extract(F.to_json(F.array(c.cast("string"))), r"^\[(.*)\]$", 1)


def kv(name: str, value_json: Column, missing: Column | None = None) -> Column:
    """``"name":value``; null (so left out by ``obj``) when ``missing``."""
    p = F.concat(F.lit(f'"{name}":'), value_json)
    return p if missing is None else F.when(~missing, p)


def obj(*parts: Column) -> Column:
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def _lists(df: DataFrame, feed: str, id_col: str, item: Column, chunk: int = 64,
           group_cols: list[str] | None = None, key_fmt: str | None = None) -> DataFrame:
    group_cols = group_cols or []
    lists = chunked_lists(df, group_cols, id_col, item, chunk)
    key = F.concat_ws("/", F.lit(f"{API}/{feed}"), *[F.col(c).cast("string") for c in group_cols],
                      F.col("_chunk").cast("string"))
    return lists.select(*group_cols,
                        F.lit(feed).alias("feed"), key.alias("key"), F.lit(200).alias("status"),
                        "body", F.lit(None).cast("string").alias("error"),
                        F.lit("2024-02-01 00:00:00").cast("timestamp").alias("fetched_at"))


# ------------------------------------------------------------ demo blog data
def _struct_lists(df: DataFrame, feed: str, id_col: str, item: Column, chunk: int = 64) -> DataFrame:
    """JSON array per ``id div chunk`` of ``to_json``-ed structs; null fields
    are left out of the objects (a *missing* key)."""
    g = (df.groupBy(_div(id_col, chunk).alias("_chunk"))
         .agg(F.to_json(F.collect_list(item)).alias("body")))
    return g.select(F.lit(feed).alias("feed"),
                    F.concat_ws("/", F.lit(f"{API}/{feed}"), F.col("_chunk").cast("string")).alias("key"),
                    F.lit(200).alias("status"), "body", F.lit(None).cast("string").alias("error"),
                    F.lit("2024-02-01 00:00:00").cast("timestamp").alias("fetched_at"))


def blog_users(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    c = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")) \
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    geo = F.when(F.col("c_mktsegment") != "AUTOMOBILE",
                 F.struct(F.col("c_nationkey").cast("string").alias("lat"),
                          F.col("n_regionkey").cast("string").alias("lng")))
    address = F.when(F.col("c_acctbal") >= 0, F.struct(
        F.concat(F.col("c_custkey"), F.lit(" Main St")).alias("street"),
        F.concat(F.lit("Apt "), F.col("c_nationkey")).alias("suite"),
        F.col("n_name").alias("city"),
        F.lpad(F.col("c_custkey").cast("string"), 5, "0").alias("zipcode"),
        geo.alias("geo")))
    company = F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.struct(
        F.col("c_mktsegment").alias("name"), F.col("r_name").alias("catchPhrase"),
        F.lower("c_mktsegment").alias("bs")))
    item = F.struct(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.lower(F.regexp_replace("c_name", "#", "")).alias("username"),
        F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("+"), F.col("c_nationkey"), F.lit("-"), F.col("c_custkey")).alias("phone"),
        F.concat(F.lit("www."), F.lower("n_name"), F.lit(".example")).alias("website"),
        address.alias("address"), company.alias("company"))
    return _struct_lists(c, "users", "c_custkey", item)


def blog_posts(orders: DataFrame) -> DataFrame:
    title = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("null")).otherwise(jstr(F.col("o_orderpriority")))
    item = obj(kv("userId", F.col("o_custkey").cast("string")),
               kv("id", F.col("o_orderkey").cast("string")),
               kv("title", title, F.col("o_orderstatus") == "P"),
               kv("body", jstr(F.col("o_orderstatus"))))
    return _lists(orders, "posts", "o_orderkey", item)


def blog_post_objects(orders: DataFrame) -> DataFrame:
    """``/posts/{id}`` answered with a single object."""
    title = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("null")).otherwise(jstr(F.col("o_orderpriority")))
    item = obj(kv("userId", F.col("o_custkey").cast("string")),
               kv("id", F.col("o_orderkey").cast("string")),
               kv("title", title, F.col("o_orderstatus") == "P"),
               kv("body", jstr(F.col("o_orderstatus"))))
    return _capture(orders, "posts", F.concat(F.lit(API + "/posts/"), F.col("o_orderkey")), item)


def blog_albums(orders: DataFrame) -> DataFrame:
    item = F.struct(F.col("o_custkey").alias("userId"), F.col("o_orderkey").alias("id"),
                    F.concat(F.lit("album "), F.col("o_orderkey")).alias("title"))
    return _struct_lists(orders, "albums", "o_orderkey", item)


def _line_id(li: DataFrame) -> DataFrame:
    return li.withColumn("_lid", F.col("l_orderkey") * 8 + F.col("l_linenumber"))


def blog_comments(lineitem: DataFrame) -> DataFrame:
    li = _line_id(lineitem)
    item = F.struct(
        F.col("l_orderkey").alias("postId"), F.col("_lid").alias("id"),
        F.concat(F.lit("re "), F.col("l_returnflag"), F.col("l_linestatus")).alias("name"),
        F.when(F.col("l_returnflag") != "R",
               F.concat(F.lit("u"), F.col("l_suppkey"), F.lit("@example.com"))).alias("email"),
        F.concat(F.lit("qty "), F.col("l_quantity").cast("int")).alias("body"))
    return _struct_lists(li, "comments", "_lid", item)


def blog_photos(lineitem: DataFrame) -> DataFrame:
    li = _line_id(lineitem)
    item = F.struct(
        F.col("l_orderkey").alias("albumId"), F.col("_lid").alias("id"),
        F.concat(F.lit("photo "), F.col("l_linenumber")).alias("title"),
        F.concat(F.lit("https://img.example.com/"), F.col("l_partkey")).alias("url"),
        F.when(F.col("l_linestatus") != "F",
               F.concat(F.lit("https://img.example.com/t/"), F.col("l_partkey"))).alias("thumbnailUrl"))
    return _struct_lists(li, "photos", "_lid", item)


def blog_todos(events: DataFrame) -> DataFrame:
    et = F.col("event_type")
    completed = F.when(et == "purchase", F.lit("true")).when(et == "error", F.lit("null")) \
        .otherwise(F.lit("false"))
    item = obj(kv("userId", F.col("user_id").cast("string")),
               kv("id", F.col("event_id").cast("string")),
               kv("title", jstr(et)),
               kv("completed", completed, et == "view"))
    return _lists(events, "todos", "event_id", item)


# ------------------------------------------------------------- pull requests
def _iso_from_hours(hours: Column) -> Column:
    ts = F.timestamp_add("SECOND", hours * 3600, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def pull_requests(documents: DataFrame) -> DataFrame:
    """Lists per (source, doc_id div 64); every 7th user null, some missing."""
    r = F.pmod(F.col("doc_id"), F.lit(7))
    user = F.when(r == 0, F.lit("null")).otherwise(obj(kv("login", jstr(F.col("source")))))
    item = obj(kv("number", F.col("doc_id").cast("string")),
               kv("title", jstr(F.col("text"))),
               kv("user", user, r == 3),
               kv("created_at", jstr(_iso_from_hours(F.col("doc_id")))),
               kv("updated_at", jstr(_iso_from_hours(F.col("doc_id") + 24))))
    return _lists(documents, "pulls", "doc_id", item, group_cols=["source"])


# -------------------------------------------------------------------- quotes
def quote_payloads(events: DataFrame) -> DataFrame:
    et = F.col("event_type")
    v = F.col("value")
    price = (F.when(et == "error", F.lit('"abc"')).when(et == "view", F.lit('""'))
             .when(et == "click", jstr(F.concat(F.lit(" "), v.cast("string"), F.lit(" "))))
             .otherwise(jstr(v.cast("string"))))
    stamp = F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    item = obj(kv("price", price, et == "signup"),
               kv("bid_inclusive_of_sell_spread", jstr((v * 0.99).cast("string"))),
               kv("ask_inclusive_of_buy_spread", (v + 1).cast("string")),
               kv("timestamp", jstr(stamp)))
    lists = chunked_lists(events, ["user_id"], "event_id", item)
    symbol = F.concat(F.lit("U"), F.col("user_id"), F.lit("-USD"))
    body = F.when(F.pmod(F.col("user_id"), F.lit(10)) == 0, F.lit('{"detail":"Not found"}')) \
        .otherwise(F.concat(F.lit('{"results":'), F.col("body"), F.lit("}")))
    return lists.select(symbol.alias("symbol"), F.lit("quotes").alias("feed"),
                        F.concat(F.lit(API + "/quotes/"), symbol, F.lit("/"), F.col("_chunk")).alias("key"),
                        body.alias("body"))


# ------------------------------------------------------------- price series
def daily_prices(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Per (brand, ship day): first / max / min / last price and quantity."""
    j = lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"))
    k = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    return (j.groupBy(F.col("p_brand").alias("symbol"), F.to_date("l_shipdate").alias("day"))
            .agg(F.min_by("l_extendedprice", k).alias("o"), F.max("l_extendedprice").alias("h"),
                 F.min("l_extendedprice").alias("l"), F.max_by("l_extendedprice", k).alias("c"),
                 F.sum("l_quantity").alias("v")))


def price_series(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Series bodies per (brand, year), plus an error and an empty payload per brand."""
    d = daily_prices(lineitem, part)
    vals = F.struct(F.col("o").cast("string").alias("1. open"), F.col("h").cast("string").alias("2. high"),
                    F.col("l").cast("string").alias("3. low"), F.col("c").cast("string").alias("4. close"),
                    F.col("v").cast("string").alias("5. volume"))
    per_year = (d.groupBy("symbol", F.year("day").alias("year"))
                .agg(F.map_from_entries(F.collect_list(F.struct(F.date_format("day", "yyyy-MM-dd"), vals)))
                     .alias("series")))
    body = F.to_json(F.struct(
        F.struct(F.lit("Daily Prices").alias("1. Information"), F.col("symbol").alias("2. Symbol"))
        .alias("Meta Data"),
        F.col("series").alias("Time Series (Daily)")))
    good = per_year.select("symbol", "year", body.alias("body"))
    brands = part.select(F.col("p_brand").alias("symbol")).distinct()
    note = brands.select("symbol", F.lit(1900).alias("year"),
                         F.lit('{"Note":"Thank you for using the API; call frequency is 5 per minute."}').alias("body"))
    meta_only = brands.select("symbol", F.lit(1901).alias("year"),
                              F.to_json(F.struct(F.struct(F.col("symbol").alias("2. Symbol")).alias("Meta Data")))
                              .alias("body"))
    return good.unionByName(note).unionByName(meta_only)


# ------------------------------------------------------------------- flights
def _epoch(ts: Column) -> Column:
    """Epoch seconds of a zone-less timestamp read as UTC (no session zone)."""
    return (F.unix_date(F.to_date(ts)).cast("bigint") * 86400 + F.hour(ts) * 3600
            + F.minute(ts) * 60 + F.floor(F.second(ts)).cast("bigint"))


def flight_snapshots(events: DataFrame) -> DataFrame:
    et = F.col("event_type")
    eid = F.col("event_id")
    v = F.col("value")
    uid = F.col("user_id")
    epoch = _epoch(F.col("ts"))
    els = [
        jstr(F.concat(F.lit("ev"), eid)),
        F.when(et == "view", F.lit("null")).otherwise(jstr(F.concat(F.lit("CS"), uid))),
        jstr(et),
        F.when(et == "signup", F.lit("null")).otherwise(epoch.cast("string")),
        (epoch + 5).cast("string"),
        F.when(F.pmod(eid, F.lit(11)) == 0, F.lit("null"))
        .otherwise((F.pmod(eid * 37, F.lit(360)) - 180).cast("string")),
        (F.pmod(eid * 53, F.lit(180)) - 90).cast("string"),
        (v * 1000).cast("string"),
        F.when(et == "click", F.lit('"false"')).when(et == "purchase", F.lit("false"))
        .when(et == "view", F.lit("0")).otherwise(F.lit("true")),
        v.cast("string"),
        uid.cast("string"),
        F.when(et == "view", jstr(v.cast("string"))).otherwise(v.cast("string")),
        F.when(et == "error", F.lit("null")).otherwise(F.concat(F.lit("["), uid, F.lit(",1]"))),
        (v * 900).cast("string"),
        jstr(F.lpad(uid.cast("string"), 4, "0")),
        F.when(et == "purchase", F.lit("1")).otherwise(F.lit("false")),
    ]
    category = (F.when(et == "click", F.lit("1.5")).when(et == "view", F.lit('"1.5"'))
                .when(et == "purchase", F.lit('"3"')).otherwise(F.pmod(uid, F.lit(5)).cast("string")))
    short = (et == "error") & (F.pmod(eid, F.lit(5)) == 0)
    state = F.concat(F.lit("["), F.concat_ws(",", *els),
                     F.when(short, F.lit("")).otherwise(F.concat(F.lit(","), category)), F.lit("]"))
    # every 13th state vector is sent twice
    reps = F.when(F.pmod(eid, F.lit(13)) == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    st = events.select(eid.alias("event_id"), (epoch - F.pmod(epoch, F.lit(3600))).alias("hour"),
                       F.explode(reps).alias("rep"), state.alias("state"))
    g = (st.groupBy("hour", _div("event_id", 256).alias("_chunk"))
         .agg(F.array_join(F.collect_list("state"), ",").alias("states")))
    return g.select(F.lit("flights").alias("feed"),
                    F.concat(F.lit(API + "/states/all?time="), F.col("hour"), F.lit("&c="), F.col("_chunk")).alias("key"),
                    F.concat(F.lit('{"time":'), F.col("hour"), F.lit(',"states":['), F.col("states"),
                             F.lit("]}")).alias("body"))


# ------------------------------------------------------------------- weather
def weather_locations(events: DataFrame) -> DataFrame:
    return events.select((F.col("user_id").cast("double") / 4).alias("latitude"),
                         (F.col("user_id").cast("double") / 2 - 90).alias("longitude"))


def weather_timelines(events: DataFrame) -> DataFrame:
    """Per (location, day): minutely = clicks, hourly = all events, daily = none."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    entry = F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("time"),
                     F.struct(F.col("event_type").alias("type"), k.alias("k"),
                              F.round(F.col("value") * 100).cast("bigint").alias("cents")).alias("values"))
    # bounded bodies: (location, day, event_id div 256)
    g = (events.groupBy("user_id", F.to_date("ts").alias("day"),
                        _div("event_id", 256).alias("_chunk"))
         .agg(F.collect_list(entry).alias("entries")))
    tl = F.struct(F.filter("entries", lambda e: e["values"]["type"] == "click").alias("minutely"),
                  F.col("entries").alias("hourly"),
                  F.filter("entries", lambda e: F.lit(False)).alias("daily"))
    return g.select((F.col("user_id").cast("double") / 4).alias("latitude"),
                    (F.col("user_id").cast("double") / 2 - 90).alias("longitude"),
                    F.lit("weather").alias("feed"),
                    F.to_json(F.struct(tl.alias("timelines"))).alias("body"))


# -------------------------------------------------------------------- sheets
def sheet_lines(df: DataFrame, header: str | None, cols: list[Column], n: Column) -> DataFrame:
    """A sheet as landed lines: (line, n); the header (if any) is line 0."""
    rows = df.select(F.concat_ws(",", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
                     .alias("line"), n.cast("long").alias("n"))
    if header is None:
        return rows
    head = df.limit(1).select(F.lit(header).alias("line"), F.lit(0).cast("long").alias("n"))
    return head.unionByName(rows)


def sheet_urls(pages: DataFrame) -> DataFrame:
    """Per page: a spreadsheet url (with / without gid) and the page url itself."""
    r = F.pmod(F.col("page_id"), F.lit(3))
    tail = (F.when(r == 0, F.lit("")).when(r == 1, F.concat(F.lit("?gid="), F.col("page_id")))
            .otherwise(F.concat(F.lit("?usp=sharing&gid="), F.col("page_id"), F.lit("#gid=9"))))
    sheet = F.concat(F.lit("https://docs.google.com/spreadsheets/d/"), F.md5("url"), F.lit("/edit"), tail)
    return pages.select(sheet.alias("url")).unionByName(pages.select("url"))
