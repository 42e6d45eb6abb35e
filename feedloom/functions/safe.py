"""Lenient conversions: bad input becomes null (or a default), never an error.

ANSI mode is on in Spark 4, so every conversion goes through ``try_*``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType


# Text accepted as a number: Python's float() grammar (ASCII digits), i.e.
# optional sign, digits with single "_" between them, optional fraction and
# exponent, or inf / infinity / nan; surrounding whitespace allowed.  Java
# forms Spark's own cast would take ("1.5d", "0x1p3") are rejected.
_DIGITS = r"[0-9](?:_?[0-9])*"
FLOAT_TEXT = (r"(?iU)^\s*[+-]?(?:(?:(?:" + _DIGITS + r")?\." + _DIGITS + r"|" + _DIGITS + r"\.?)"
              r"(?:e[+-]?" + _DIGITS + r")?|inf|infinity|nan)\s*$")


def strip_ws(c: Column) -> Column:
    """Python's ``str.strip()``: leading / trailing whitespace of any kind
    (Spark's ``trim`` removes spaces only)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def safe_double(c: Column) -> Column:
    """Number or numeric text -> double, like Python's ``float()``; anything
    else -> null.

    Text that begins and ends like a plain ASCII number and has no ``x`` is
    read by the engine's own cast, which agrees with the grammar there; only
    what that cast refuses goes through the full grammar.
    """
    t = c.cast("string")
    plain = (F.substring(t, 1, 1).isin(*"0123456789+-.") & F.substring(t, -1, 1).isin(*"0123456789.")
             & (F.instr(t, "x") == 0) & (F.instr(t, "X") == 0))
    low = F.lower(strip_ws(t))
    special = (F.when(low.rlike(r"^[+-]?nan$"), F.lit(float("nan")))
               .when(low.rlike(r"^\+?inf(inity)?$"), F.lit(float("inf")))
               .when(low.rlike(r"^-inf(inity)?$"), F.lit(float("-inf"))))
    number = F.regexp_replace(low, "_", "").try_cast("double")
    return F.coalesce(F.when(plain, t.try_cast("double")),
                      F.when(t.rlike(FLOAT_TEXT), F.coalesce(special, number)))


def safe_double_or_zero(c: Column) -> Column:
    """Missing, empty or unparsable -> 0.0 (quotes keep this rule)."""
    return F.coalesce(safe_double(c), F.lit(0.0))


INT_TEXT = r"(?U)^\s*[+-]?" + _DIGITS + r"\s*$"


def safe_int(c: Column) -> Column:
    """Integer or integer text -> int, like Python's ``int()`` on text
    ("1_000" yes, "1.5" no); anything else -> null."""
    t = c.cast("string")
    return F.when(t.rlike(INT_TEXT), F.regexp_replace(t, "_", "").try_cast("int"))


def truthy(v: Column) -> Column:
    """Python truthiness of a JSON value held in a variant.

    false, 0, 0.0, "", [] and {} are false; JSON null stays null; every
    other value (including the text "false") is true.
    """
    kind = F.schema_of_variant(v)
    as_text = F.try_variant_get(v, "$", "string")
    return (F.when(v.isNull() | F.is_variant_null(v), F.lit(None).cast("boolean"))
            .when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))
            .when(kind == "STRING", F.length(as_text) > 0)
            .when(kind.startswith("ARRAY"), F.to_json(v) != "[]")
            .when(kind.startswith("OBJECT"), F.to_json(v) != "{}")
            .otherwise(F.try_variant_get(v, "$", "double") != 0))


def iso_text(c: Column, dtype) -> Column:
    """ISO-8601 text of a date or timestamp, as ``isoformat()`` writes it."""
    if isinstance(dtype, DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        frac = F.date_format(c, "SSSSSS")
        base = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
        return F.when(frac == "000000", base).otherwise(F.concat(base, F.lit("."), frac))
    return c.cast("string")
