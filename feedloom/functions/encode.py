"""URL encoding of parameter values as Spark expressions.

Form encoding follows the ``application/x-www-form-urlencoded`` rule used by
Python's ``urlencode``: unreserved ``A-Z a-z 0-9 _ . - ~`` stay, space
becomes ``+``, every other byte of the UTF-8 text becomes ``%XX``.  Spark's
``url_encode`` (Java's URLEncoder) differs only for ``*`` (kept) and ``~``
(escaped), so two replacements fix it.  Path quoting keeps ``/`` and writes
space as ``%20``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType, DataType, DoubleType, FloatType, TimestampNTZType, TimestampType,
)

from feedloom.functions.safe import iso_text


def form_encode(c: Column) -> Column:
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")),
                     F.lit("%7E"), F.lit("~"))


def path_quote(c: Column) -> Column:
    # '+' only stems from spaces here: a literal '+' is already '%2B'.
    return F.replace(F.replace(form_encode(c), F.lit("+"), F.lit("%20")),
                     F.lit("%2F"), F.lit("/"))


def float_text(c: Column) -> Column:
    """A double as Python's ``str()`` writes it: plain digits from 1e-4 up to
    1e16, else ``1e+16`` / ``1.5e-07``; ``nan`` and ``inf`` in lower case.

    The JVM may write more digits than name the double; 17 or 16 digits are
    taken if they read back as the same number.
    """
    t = F.abs(c).cast("string")
    exact = F.abs(c)
    written = F.length(F.regexp_replace(F.substring_index(t, "E", 1), r"\.", ""))
    for digits in (17, 16):
        shorter = F.replace(F.upper(F.format_string(f"%.{digits - 1}e", exact)), F.lit("E+"), F.lit("E"))
        fits = (written > digits) & F.contains(t, F.lit("E")) & (shorter.try_cast("double") == exact)
        t = F.when(fits, shorter).otherwise(t)
    sign = F.when(c.cast("string").startswith("-"), "-").otherwise("")
    digits = F.regexp_replace(F.regexp_replace(F.substring_index(t, "E", 1), r"\.", ""), r"(?<=.)0+$", "")
    e = F.substring_index(t, "E", -1).try_cast("int")
    n = F.length(digits)
    whole = F.when(n <= e + 1, F.concat(F.rpad(digits, e + 1, F.lit("0")), F.lit(".0"))).otherwise(
        F.concat(F.substring(digits, F.lit(1), e + 1), F.lit("."), F.substring(digits, e + 2, n)))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -e - 1), digits)
    scientific = F.concat(
        F.when(n == 1, digits).otherwise(F.concat(F.substring(digits, 1, 1), F.lit("."), F.substring(digits, F.lit(2), n))),
        F.when(e < 0, "e-").otherwise("e+"), F.lpad(F.abs(e).cast("string"), F.greatest(F.lit(2), F.length(F.abs(e).cast("string"))), F.lit("0")))
    written = (F.when(F.isnan(c), "nan").when(t == "Infinity", "inf").when(~F.contains(t, F.lit("E")), t)
               .when((e >= 16) | (e < -4), scientific).when(e < 0, small).otherwise(whole))
    return F.when(F.isnan(c), "nan").otherwise(F.concat(sign, written))


def param_text(c: Column, dtype: DataType | None = None) -> Column:
    """Text of a parameter value as Python's ``str()`` would give it."""
    if isinstance(dtype, BooleanType):
        return F.when(c, F.lit("True")).when(~c, F.lit("False"))
    if isinstance(dtype, (FloatType, DoubleType)):
        return float_text(c.cast("double"))
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return F.replace(iso_text(c, dtype), F.lit("T"), F.lit(" "))
    return c.cast("string")


def query_string(params: Mapping[str, Column]) -> Column:
    """``k1=v1&k2=v2`` with form-encoded values; null parameters are left out."""
    parts = [F.concat(F.lit(form_encode_name(k) + "="), form_encode(v))
             for k, v in params.items()]
    return F.concat_ws("&", *parts)


def form_encode_name(name: str) -> str:
    from urllib.parse import quote_plus
    return quote_plus(name)
