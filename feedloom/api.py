"""Options-style entry points: ``read(spark, feed, **options)`` and
``write(df, sink, **options)``.

The option names follow the connectors this library replaces (``numRows``,
``function``, ``region``, ``frequency``, ``locations``, ``has_header``, ...),
so a job that configured a connector with options can pass the same
options here.  A feed read is always the same plan:

    options -> request DataFrame -> responses -> normaliser -> typed DataFrame

Responses come from ``captures`` (a landed capture table, replayed by
join) or from ``transport`` (the live call stage); with ``land_to`` the
live responses are written to the shared folder and read back before they
are parsed, so nothing is fetched twice.  Option values are driver-side by
nature (a symbol list, a location list); everything that grows with data is
a DataFrame.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.operators import fetch as fx
from feedloom.operators.requests import build_requests
from feedloom.operators.transports import http_transport
from feedloom.session import fresh_dir
from feedloom.sources import (
    arrow, datasets, fake, flights, github, hub, placeholder, quotes, sheets, stock, weather,
)

# Service base urls of the feeds.
BLOG_BASE = "https://jsonplaceholder.typicode.com"
QUOTES_BASE = "https://trading.robinhood.com"
FLIGHTS_URL = "https://opensky-network.org/api/states/all"
WEATHER_URL = "https://api.tomorrow.io/v4/weather/forecast"


def _opt(options: dict, *names, default=None):
    for n in names:
        if n in options and options[n] is not None:
            return options[n]
    return default


def _bool(v, default: bool) -> bool:
    if v is None:
        return default
    if isinstance(v, bool):
        return v
    return str(v).strip().lower() in ("true", "1", "y", "yes")


def _known(options: dict, *names: str) -> None:
    """An option nobody reads is an error, not silence."""
    unknown = sorted(set(options) - set(names))
    if unknown:
        raise ValueError(f"unknown options: {', '.join(unknown)}; known: {', '.join(sorted(names))}")


def _responses(req: DataFrame, feed: str, transport=None, captures: DataFrame | None = None,
               land_to: str | None = None, on=None, partitions: int | None = None,
               concurrency: int = 1) -> DataFrame:
    if captures is not None:
        return fx.replay(req, captures, on=on)
    if transport is None:
        raise ValueError("give either captures (landed responses) or a transport")
    got = fx.fetch(req, transport, partitions=partitions, concurrency=concurrency)
    if land_to is None:
        return got
    # This read's replies, each with the row it answers: nothing is joined back,
    # so neither equal requests nor requests that differ in headers share any.
    # ``as_capture`` makes captures of them.
    return fx.land(got, f"{land_to.rstrip('/')}/{feed}/{uuid.uuid4().hex}", partition_by=None)


def _list_df(spark, name: str, values: list) -> DataFrame:
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def _as_capture_cols(df: DataFrame) -> DataFrame:
    return df.withColumn("body", F.col("response"))


# --------------------------------------------------------------------- readers
def read(spark, feed: str, transport=None, captures: DataFrame | None = None,
         land_to: str | None = None, **options) -> DataFrame:
    feed = feed.lower()
    if feed not in READERS:
        raise ValueError(f"unknown feed {feed!r}; known: {', '.join(sorted(READERS))}")
    return READERS[feed](spark, options, transport, captures, land_to)


def _read_rest(spark, o, transport, captures, land_to):
    _known(o, "input", "url", "method", "queryType", "postInputFormat", "headers", "authType", "oauthToken",
           "userId", "userPassword", "cookie", "partitions", "concurrency", "failOnError", "schema",
           "schemaSamplePcnt", "includeInputsInOutput", "callStrictlyOnce", "connectionTimeout", "readTimeout")
    params = _opt(o, "input")
    if isinstance(params, str):  # a temp view / table name, as the option was
        params = spark.table(params)
    if transport is None and captures is None:
        # milliseconds; the standard library has one time-out for connecting and reading
        limits = [float(_opt(o, n, default=ms)) for n, ms in (("connectionTimeout", 1000), ("readTimeout", 5000))]
        transport = http_transport(timeout=max(limits) / 1000)
    parts = _opt(o, "partitions")

    def call(rows: DataFrame) -> DataFrame:
        req = build_requests(
            rows, _opt(o, "url"), method=_opt(o, "method", default="POST"),
            query_type=_opt(o, "queryType", default="querystring"),
            post_input_format=_opt(o, "postInputFormat", default="json"),
            headers=_opt(o, "headers"), auth_type=_opt(o, "authType"),
            token=_opt(o, "oauthToken"), user=_opt(o, "userId"), password=_opt(o, "userPassword"),
            cookie=_opt(o, "cookie"))
        return _responses(req, "rest", transport, captures, land_to,
                          partitions=int(parts) if parts is not None else None,
                          concurrency=int(_opt(o, "concurrency", default=1)))

    if params is not None and _bool(_opt(o, "callStrictlyOnce"), False):
        got = fx.call_once(params, list(params.columns), call, ["status", "response", "_corrupt_record"])
    else:
        got = call(params)
    got = fx.fail_on_error(got, _bool(_opt(o, "failOnError"), False))
    schema, sample = _opt(o, "schema"), _opt(o, "schemaSamplePcnt")
    if schema is None and sample is not None:
        if land_to is None and captures is None:
            raise ValueError("schemaSamplePcnt reads the responses twice: give land_to or captures")
        schema = fx.infer_schema(got, fraction=float(sample) / 100.0)
    out = fx.parse_output(got, schema)
    include = _bool(_opt(o, "includeInputsInOutput"), True)
    return fx.select_output(out, include_inputs=include, inputs=list(params.columns))


def _read_arrow(spark, o, *_):
    _known(o, "path", "columns")
    return arrow.read_arrow(spark, _opt(o, "path"), _opt(o, "columns"))


def _read_fake(spark, o, *_):
    _known(o, "numRows", "numPartitions", "schema")
    n = int(_opt(o, "numRows", default=3))
    parts = _opt(o, "numPartitions")
    return fake.fake(spark, n, _opt(o, "schema", default=fake.DEFAULT_SCHEMA),
                     int(parts) if parts else None)


def _read_pulls(spark, o, transport, captures, land_to):
    """Every page of a repository's pull requests, up to the first empty one."""
    _known(o, "path", "repo", "token")
    repo = _opt(o, "path", "repo")
    token = _opt(o, "token")

    def call(pages: DataFrame) -> DataFrame:
        url = F.concat(F.lit(github.pulls_url(repo)), F.when(F.col("page") > 1, F.concat(F.lit("?page="), F.col("page")))
                       .otherwise(F.lit("")))
        req = build_requests(pages, url, method="GET", param_columns=[],
                             headers='{"Accept": "application/vnd.github+json"}',
                             auth_type="Bearer" if token else None, token=token)
        return _responses(req, "pull_requests", transport, captures)

    items = F.size(F.try_variant_get(F.try_parse_json("response"), "$", "array<variant>"))
    got = fx.pages_until_empty(_list_df(spark, "repo", [repo]), call, items, land_to or fresh_dir(spark, "pulls"))
    return github.normalise(_as_capture_cols(got))


def _sheet_of(spark, o) -> tuple[str, str | None]:
    """(spreadsheet id, sheet id) that the options name."""
    if _opt(o, "url") is None:
        if _opt(o, "path") is None:
            raise ValueError("name the sheet: its url, or its spreadsheet id as path")
        return _opt(o, "path"), _opt(o, "sheet_id")
    found = spark.range(1).select(sheets.locate(F.lit(_opt(o, "url"))).alias("l")).first()["l"]
    if found["error"] is not None:
        raise ValueError(found["error"])
    return found["spreadsheet_id"], found["sheet_id"]


def _read_sheets(spark, o, transport, captures, land_to):
    _known(o, "url", "path", "sheet_id", "has_header", "schema")
    has_header = _bool(_opt(o, "has_header"), True)
    schema = _opt(o, "schema")
    if schema is None and not has_header:
        raise ValueError("a sheet without a header row needs a schema")
    where = spark.createDataFrame([_sheet_of(spark, o)], "sid string, gid string")
    req = build_requests(where.select(sheets.export_url(F.col("sid"), F.col("gid")).alias("url")), F.col("url"),
                         method="GET", param_columns=[])
    got = _responses(req, "sheets", transport, captures, land_to)
    lines = got.select(F.posexplode(sheets.record_lines(F.col("response"))).alias("n", "line")).where(F.col("line") != "")
    return sheets.sheet_from_lines(lines, has_header=has_header, schema=schema)


def _read_hub(spark, o, *_):
    return hub.read_split(spark, _opt(o, "root"), _opt(o, "path", "dataset"),
                          _opt(o, "split", default="train"), _opt(o, "config", default="default"),
                          columns=_opt(o, "schema", "columns"))


def _read_datasets(spark, o, *_):
    extra = {k: v for k, v in o.items()
             if k not in ("root", "handle", "path", "username", "key", "schema")}
    return datasets.read_file(spark, _opt(o, "root"), _opt(o, "handle"), _opt(o, "path"),
                              _opt(o, "username"), _opt(o, "key"), _opt(o, "schema"), **extra)


def _read_blog(spark, o, transport, captures, land_to):
    _known(o, "endpoint", "id", "limit")
    endpoint = _opt(o, "endpoint", default="posts")
    if endpoint not in placeholder.ENDPOINTS:
        endpoint = "posts"
    item_id = _opt(o, "id")
    limit = _opt(o, "limit")
    url = placeholder.item_url(BLOG_BASE, endpoint, item_id)
    if item_id is None and limit is not None:
        url += f"?_limit={int(limit)}"
    req = build_requests(_list_df(spark, "endpoint", [endpoint]), url, method="GET", param_columns=[])
    rows = placeholder.normalise(_as_capture_cols(_responses(req, "blog_demo", transport, captures,
                                                             land_to)), endpoint)
    return placeholder.select_items(rows, item_id, None if item_id is not None else limit)


def _read_quotes(spark, o, transport, captures, land_to):
    _known(o, "path", "symbols")
    syms = quotes.option_symbols(spark, _opt(o, "path", "symbols"))
    req = _list_df(spark, "symbol", syms)
    req = build_requests(req, F.concat(F.lit(QUOTES_BASE), quotes.quote_path(F.col("symbol"))),
                         method="GET", param_columns=[])
    got = _as_capture_cols(_responses(req, "quotes", transport, captures, land_to))
    return quotes.normalise(got)


def _read_prices(spark, o, transport, captures, land_to):
    _known(o, "api_key", "function", "path", "symbols")
    key = _opt(o, "api_key")
    if not key:
        raise ValueError("api_key is required")
    function = stock.check_function(_opt(o, "function", default="TIME_SERIES_DAILY"))
    names = [s.strip() for s in str(_opt(o, "path", "symbols", default="")).split(",") if s.strip()]
    if not names:
        raise ValueError("Give at least one symbol")
    req = _list_df(spark, "symbol", names)
    # weekly / monthly series are resampled from the daily one on Spark
    req = build_requests(req, stock.series_url(F.col("symbol"), "TIME_SERIES_DAILY", key),
                         method="GET", param_columns=[])
    daily = stock.normalise(_as_capture_cols(_responses(req, "price_series", transport, captures, land_to)))
    unit = stock.FUNCTIONS[function]
    return daily if unit is None else stock.resample(daily, unit)


def _read_flights(spark, o, transport, captures, land_to):
    _known(o, "client_id", "client_secret", "region")
    if _opt(o, "client_id") and not _opt(o, "client_secret"):
        raise ValueError("client_id needs a client_secret")
    region = flights.check_region(_opt(o, "region"))
    lamin, lamax, lomin, lomax = flights.REGIONS[region]
    url = f"{FLIGHTS_URL}?lamin={lamin}&lamax={lamax}&lomin={lomin}&lomax={lomax}"
    req = build_requests(_list_df(spark, "region", [region]), url, method="GET", param_columns=[])
    return flights.normalise(_as_capture_cols(_responses(req, "flights", transport, captures, land_to)))


def _read_weather(spark, o, transport, captures, land_to):
    _known(o, "frequency", "locations", "apikey", "marks")
    freq = weather.check_frequency(_opt(o, "frequency", default="minutely"))
    locs = weather.option_locations(spark, _opt(o, "locations"))
    key = _opt(o, "apikey", default="")
    df = spark.createDataFrame(locs, "latitude double, longitude double")
    url = F.concat(F.lit(WEATHER_URL + "?location="), F.col("latitude").cast("string"), F.lit(","),
                   F.col("longitude").cast("string"), F.lit(f"&apikey={key}"))
    req = build_requests(df, url, method="GET", param_columns=[])
    got = _as_capture_cols(_responses(req, "weather", transport, captures, land_to))
    rows = weather.normalise(got, freq)
    marks = _opt(o, "marks")
    return rows if marks is None else weather.increment(rows, marks)


READERS = {
    "rest": _read_rest, "arrow": _read_arrow, "fake": _read_fake, "pull_requests": _read_pulls,
    "sheets": _read_sheets, "hub": _read_hub, "datasets": _read_datasets, "blog_demo": _read_blog,
    "quotes": _read_quotes, "price_series": _read_prices, "flights": _read_flights,
    "weather": _read_weather,
}


# --------------------------------------------------------------------- writers
def write(df: DataFrame, sink: str, **options):
    sink = sink.lower()
    if sink == "json_array":
        from feedloom.sinks import json_array

        path = _opt(options, "path")
        if not path:
            raise ValueError("path (the output folder) is required")
        return json_array.write_json_array(df, path, _opt(options, "mode", default="append"))
    if sink == "arrow_dataset":
        path = _opt(options, "path")
        if not path:
            raise ValueError("path is required")
        if _opt(options, "mode", default="append") != "append":
            raise ValueError("arrow_dataset supports append only")
        return arrow.append_arrow(df, path)
    if sink == "crm":
        from feedloom.sinks import crm

        crm.check_options(_opt(options, "username"), _opt(options, "password"),
                          _opt(options, "security_token"))
        obj = _opt(options, "salesforce_object", "object", default=crm.DEFAULT_OBJECT)
        size = int(_opt(options, "batch_size", default=crm.BATCH_SIZE))
        recs = crm.records(df, key=_opt(options, "key"), schema=_opt(options, "schema"))
        payloads = crm.batches(recs, size, obj)
        transport = _opt(options, "transport")
        land_to = _opt(options, "land_to")
        if land_to:
            return crm.deliver_landed(payloads, transport, land_to, obj)
        return crm.deliver(payloads, transport, obj)
    raise ValueError(f"unknown sink {sink!r}")


# --------------------------------------------------------------------- streams
def read_stream(spark, feed: str, **options) -> DataFrame:
    """Streaming reads over replayable inputs.

    ``fake``: ``numRows`` generated rows per micro-batch (rate source).
    ``flights``: landed snapshot files at ``path`` (one snapshot per line),
    repeats dropped (``watermark``: forget keys older than that, and drop
    snapshots that arrive later), optional region.
    ``weather``: landed ``{latitude, longitude, body}`` JSON lines at ``path``;
    entries after each location's mark (keyed state, ``initial_mark``).
    ``files``: new files at ``path`` as (name, path, content).
    """
    from feedloom.streaming import flights as flight_stream
    from feedloom.streaming import sources as ss
    from feedloom.streaming import weather as weather_stream

    feed = feed.lower()
    max_files = _opt(options, "maxFilesPerTrigger")
    max_files = int(max_files) if max_files else None
    if feed == "fake":
        return ss.fake_stream(spark, int(_opt(options, "numRows", default=3)),
                              _opt(options, "schema", default=fake.DEFAULT_SCHEMA))
    path = _opt(options, "path")
    if not path:
        raise ValueError("path (landed files) is required")
    if feed == "flights":
        states = flight_stream.flight_stream(spark, path, _opt(options, "watermark"), max_files)
        region = _opt(options, "region")
        return states if region is None else states.where(flights.in_region(region))
    if feed == "weather":
        freq = weather.check_frequency(_opt(options, "frequency", default="minutely"))
        rows = weather.normalise(
            ss.json_lines(spark, path, "latitude double, longitude double, body string", max_files), freq)
        return weather_stream.marked_entries(rows, _opt(options, "initial_mark", default=weather.INITIAL_MARK))
    if feed == "files":
        return ss.file_monitor(spark, path, max_files)
    raise ValueError(f"unknown stream feed {feed!r}")


def write_stream(df: DataFrame, sink: str, **options):
    """Streaming delivery: ``crm`` (ledger + checkpoint in the shared folder)."""
    if sink.lower() != "crm":
        raise ValueError(f"unknown stream sink {sink!r}")
    from feedloom.sinks import crm

    crm.check_options(_opt(options, "username"), _opt(options, "password"),
                      _opt(options, "security_token"))
    return crm.deliver_stream(
        df, _opt(options, "key"), _opt(options, "transport"), _opt(options, "ledger"),
        _opt(options, "checkpointLocation"), schema=_opt(options, "schema"),
        object_type=_opt(options, "salesforce_object", "object", default=crm.DEFAULT_OBJECT),
        batch_size=int(_opt(options, "batch_size", default=crm.BATCH_SIZE)),
        trigger=_opt(options, "trigger"), dedupe=_opt(options, "dedupe", default="ledger"))
