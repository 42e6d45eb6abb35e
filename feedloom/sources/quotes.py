"""Crypto quote feed: symbol lists and best bid / ask payloads.

``symbols`` turns a comma list into trading pairs: split, trim, upper-case,
``-USD`` added when there is no ``-``, blanks dropped.  ``normalise`` reads
``{results: [{price, bid_inclusive_of_sell_spread,
ask_inclusive_of_buy_spread, timestamp}]}``; a missing, empty or unparsable
number becomes 0.0.  A failed symbol (error, no ``results``) yields no rows
and does not affect the others; ``errors`` lists it with a message.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.jsonx import vget, vget_default
from feedloom.functions.safe import safe_double_or_zero, strip_ws

# The output schema.
SCHEMA = "symbol string, price double, bid_price double, ask_price double, updated_at string"


def symbols(text: Column) -> Column:
    """array<string> of normalised pairs (order kept)."""
    parts = F.transform(F.split(text, ","), lambda s: F.upper(strip_ws(s)))
    parts = F.filter(parts, lambda s: s != "")
    return F.transform(parts, lambda s: F.when(F.instr(s, "-") > 0, s)
                       .otherwise(F.concat(s, F.lit("-USD"))))


def explode_symbols(df: DataFrame, text_col: str, out: str = "symbol") -> DataFrame:
    return df.withColumn(out, F.explode(symbols(F.col(text_col))))


def option_symbols(spark, text: str | None) -> list[str]:
    """The pairs of an option value (errors before any request)."""
    found = spark.range(1).select(symbols(F.lit(text or "")).alias("s")).first()["s"]
    if not found:
        raise ValueError("symbols is required: a comma list of crypto pairs, e.g. 'BTC-USD,ETH-USD'")
    return found


def quote_path(symbol: Column) -> Column:
    return F.concat(F.lit("/api/v1/crypto/marketdata/best_bid_ask/?symbol="), symbol)


def normalise(captures: DataFrame, symbol_col: str = "symbol", body_col: str = "body") -> DataFrame:
    v = F.try_parse_json(body_col)
    results = F.try_variant_get(v, "$.results", "array<variant>")
    rows = captures.select(F.col(symbol_col).alias("symbol"), F.explode(results).alias("_q"))
    q = F.col("_q")
    # each field is taken out of the payload once, then read
    texts = rows.select(
        "symbol",
        vget(q, "$.price").alias("_price"),
        vget(q, "$.bid_inclusive_of_sell_spread").alias("_bid"),
        vget(q, "$.ask_inclusive_of_buy_spread").alias("_ask"),
        vget_default(q, "$.timestamp", "string", "").alias("updated_at"),
    )
    return texts.select(
        "symbol",
        safe_double_or_zero(F.col("_price")).alias("price"),
        safe_double_or_zero(F.col("_bid")).alias("bid_price"),
        safe_double_or_zero(F.col("_ask")).alias("ask_price"),
        "updated_at",
    )


def errors(captures: DataFrame, symbol_col: str = "symbol", body_col: str = "body",
           error_col: str | None = "_corrupt_record") -> DataFrame:
    """(symbol, error) of the captures that give no quote."""
    v = F.try_parse_json(body_col)
    results = F.try_variant_get(v, "$.results", "array<variant>")
    known = F.col(error_col) if error_col in captures.columns else F.lit(None).cast("string")
    error = (F.when(known.isNotNull(), known)
             .when(F.col(body_col).isNull(), F.lit("no response"))
             .when(v.isNull(), F.lit("response is not JSON"))
             .when(results.isNull(), F.coalesce(F.try_variant_get(v, "$.detail", "string"), F.lit("no results in the response")))
             .when(F.size(results) == 0, F.lit("results are empty")))
    return captures.select(F.col(symbol_col).alias("symbol"), error.alias("error")).where(F.col("error").isNotNull())
