"""Daily price series feed, plus weekly / monthly series by resampling.

Payload: ``{"Meta Data": {...}, "<series name>": {"<date>": {"1. open": "..",
"2. high": "..", "3. low": "..", "4. close": "..", "5. volume": ".."}}}`` with
values as text.  The series is the first key that is not ``Meta Data``.  An
error payload (``{"Note": ...}`` or text) gives no rows and a row in the
error output; volume is parsed as a number, then truncated to a long.

Weekly and monthly series are computed from the daily rows on Spark
(``groupBy(symbol, date_trunc)``), dated by the last trading day of the
period, instead of being asked from the remote service.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions.safe import safe_double

# The output schema.
SCHEMA = ("date string, open double, high double, low double, close double, volume long, "
          "symbol string")

# The supported series functions and their resampling unit.
FUNCTIONS = {"TIME_SERIES_DAILY": None, "TIME_SERIES_WEEKLY": "week", "TIME_SERIES_MONTHLY": "month"}


def check_function(function: str) -> str:
    if function not in FUNCTIONS:
        raise ValueError(f"unknown series function {function!r}; known: {', '.join(FUNCTIONS)}")
    return function


def series_url(symbol, function: str = "TIME_SERIES_DAILY", api_key: str = "demo"):
    check_function(function)
    return F.concat(F.lit(f"https://www.alphavantage.co/query?function={function}&symbol="),
                    symbol, F.lit(f"&apikey={api_key}"))


def _rest(body):
    """Top-level entries other than ``Meta Data`` (key -> JSON text)."""
    return F.map_filter(F.from_json(body, "map<string,string>"), lambda k, _v: k != "Meta Data")


def _series(rest):
    """The map date -> values under the first key of ``rest``, and that key."""
    first_key = F.get(F.map_keys(rest), 0)
    return F.from_json(F.try_element_at(rest, first_key), "map<string,map<string,string>>"), first_key


def normalise(captures: DataFrame, symbol_col: str = "symbol", body_col: str = "body") -> DataFrame:
    # each payload is parsed once; the series map is materialised, then exploded
    top = captures.select(F.col(symbol_col).alias("symbol"), _rest(F.col(body_col)).alias("_r"))
    series, _ = _series(F.col("_r"))
    rows = top.select("symbol", series.alias("_m")).select("symbol", F.explode("_m").alias("date", "_v"))
    v = F.col("_v")
    num = lambda k: safe_double(F.try_element_at(v, F.lit(k)))
    return rows.select(
        "date",
        num("1. open").alias("open"), num("2. high").alias("high"),
        num("3. low").alias("low"), num("4. close").alias("close"),
        num("5. volume").try_cast("bigint").alias("volume"),  # float text, truncated
        "symbol",
    )


def errors(captures: DataFrame, symbol_col: str = "symbol", body_col: str = "body") -> DataFrame:
    """Payloads without a series: the symbol and the payload text."""
    top = captures.select(F.col(symbol_col).alias("symbol"), F.col(body_col).alias("error"),
                          _rest(F.col(body_col)).alias("_r"))
    series, key = _series(F.col("_r"))
    return top.where(series.isNull() | key.isNull()).select("symbol", "error")


def resample(daily: DataFrame, unit: str) -> DataFrame:
    """Daily rows -> one row per symbol and week / month.

    open is the first day's open, close the last day's close, high / low the
    extremes, volume the sum; the row is dated by the period's last day.  All
    aggregates are partial-aggregated before the shuffle.
    """
    if unit not in ("week", "month"):
        raise ValueError("unit must be week or month")
    d = F.to_date("date")
    period = F.date_trunc(unit, d)
    return (daily.groupBy("symbol", period.alias("_p"))
            .agg(F.max(d).alias("_last"),
                 F.min_by("open", d).alias("open"), F.max("high").alias("high"),
                 F.min("low").alias("low"), F.max_by("close", d).alias("close"),
                 F.sum("volume").alias("volume"))
            .select(F.date_format("_last", "yyyy-MM-dd").alias("date"),
                    "open", "high", "low", "close", "volume", "symbol"))
