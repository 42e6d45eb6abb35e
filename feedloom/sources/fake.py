"""Synthetic rows: one generator expression per field name.

Rows are keyed on a long id (``spark.range`` or a column of an existing
table), and every value is a pure function of (id, seed): the same id gives
the same row on any executor, after any retry, on any number of partitions.
Generators pick from small word lists with ``pmod(id * a + b, n)``.

The schema names the generators (default ``name, date, zipcode, state``);
an unknown name or a non-string field is rejected before any job runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

DEFAULT_SCHEMA = "name string, date string, zipcode string, state string"

# The word lists the generators draw from (own lists).
FIRST_NAMES = ["Ada", "Ben", "Cleo", "Dev", "Ema", "Finn", "Gus", "Hana", "Ivo", "Jun",
               "Kai", "Lea", "Milo", "Nia", "Omar", "Pia", "Quin", "Rosa", "Sami", "Tara",
               "Uma", "Vito", "Wren", "Xavi", "Yara", "Zane"]
LAST_NAMES = ["Abbott", "Baker", "Castro", "Dalton", "Ellis", "Fischer", "Garcia", "Hughes",
              "Ibarra", "Jensen", "Kowalski", "Larsen", "Moreau", "Novak", "Okafor", "Price",
              "Quintero", "Rossi", "Sato", "Turner", "Ueda", "Vargas", "Walsh", "Young", "Zeller"]
STATES = ["Alabama", "Alaska", "Arizona", "Arkansas", "California", "Colorado", "Connecticut",
          "Delaware", "Florida", "Georgia", "Hawaii", "Idaho", "Illinois", "Indiana", "Iowa",
          "Kansas", "Kentucky", "Louisiana", "Maine", "Maryland", "Massachusetts", "Michigan",
          "Minnesota", "Mississippi", "Missouri", "Montana", "Nebraska", "Nevada",
          "New Hampshire", "New Jersey", "New Mexico", "New York", "North Carolina",
          "North Dakota", "Ohio", "Oklahoma", "Oregon", "Pennsylvania", "Rhode Island",
          "South Carolina", "South Dakota", "Tennessee", "Texas", "Utah", "Vermont",
          "Virginia", "Washington", "West Virginia", "Wisconsin", "Wyoming"]
CITIES = ["Ashford", "Brookvale", "Cedar Falls", "Dunmore", "Eastwick", "Fairview", "Glenrock",
          "Harborton", "Ironwood", "Juniper", "Kingsley", "Lakeside", "Maplewood", "Northgate",
          "Oakridge", "Pinecrest", "Queensbury", "Riverton", "Stonebridge", "Westfield"]
COUNTRIES = ["Argentina", "Brazil", "Canada", "Denmark", "Egypt", "France", "Germany", "India",
             "Japan", "Kenya", "Mexico", "Norway", "Peru", "Spain", "Turkey", "Vietnam"]
COMPANY_WORDS = ["Acme", "Bright", "Cobalt", "Delta", "Evergreen", "Fulcrum", "Granite",
                 "Horizon", "Ion", "Juniper", "Keystone", "Lumen", "Meridian", "Nimbus"]
COMPANY_SUFFIXES = ["LLC", "Inc", "Group", "and Sons", "Ltd"]
STREETS = ["Main", "Oak", "Pine", "Maple", "Cedar", "Elm", "Lake", "Hill", "Park", "River"]
STREET_SUFFIXES = ["Street", "Avenue", "Road", "Lane", "Drive", "Court"]
WORDS = ["alpha", "bravo", "cobalt", "dune", "ember", "fjord", "grove", "harbor", "island",
         "jade", "kelp", "lumen", "meadow", "nectar", "orbit", "prairie", "quartz", "ridge",
         "sierra", "tundra"]
DOMAINS = ["example.com", "example.org", "example.net"]


def _pick(words: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in words]), (idx + 1).cast("int"))


def _h(id_col: Column, a: int, b: int, n: int, seed: int) -> Column:
    # reduced first, so no id can overflow the product
    return F.pmod(F.pmod(id_col, F.lit(n)) * F.lit(a) + F.lit((b + 7919 * seed) % n), F.lit(n))


def _generators(i: Column, seed: int) -> dict[str, Column]:
    first = _pick(FIRST_NAMES, _h(i, 7, 1, len(FIRST_NAMES), seed))
    last = _pick(LAST_NAMES, _h(i, 13, 5, len(LAST_NAMES), seed))
    day = F.date_add(F.lit("1970-01-01").cast("date"), _h(i, 37, 11, 20000, seed).cast("int"))
    return {
        "first_name": first,
        "last_name": last,
        "name": F.concat_ws(" ", first, last),
        "date": F.date_format(day, "yyyy-MM-dd"),
        "zipcode": F.lpad(_h(i, 7919, 3, 100000, seed).cast("string"), 5, "0"),
        "state": _pick(STATES, _h(i, 17, 2, len(STATES), seed)),
        "city": _pick(CITIES, _h(i, 19, 4, len(CITIES), seed)),
        "country": _pick(COUNTRIES, _h(i, 23, 6, len(COUNTRIES), seed)),
        "company": F.concat_ws(" ", _pick(COMPANY_WORDS, _h(i, 29, 8, len(COMPANY_WORDS), seed)),
                               _pick(COMPANY_SUFFIXES, _h(i, 31, 9, len(COMPANY_SUFFIXES), seed))),
        "street_address": F.concat_ws(" ", (_h(i, 41, 12, 9999, seed) + 1).cast("string"),
                                      _pick(STREETS, _h(i, 43, 13, len(STREETS), seed)),
                                      _pick(STREET_SUFFIXES, _h(i, 47, 14, len(STREET_SUFFIXES), seed))),
        "email": F.concat(F.lower(first), F.lit("."), F.lower(last), F.lit("@"),
                          _pick(DOMAINS, _h(i, 53, 15, len(DOMAINS), seed))),
        "phone_number": F.format_string("+1-%03d-%04d", _h(i, 59, 16, 1000, seed).cast("int"),
                                        _h(i, 61, 17, 10000, seed).cast("int")),
        "word": _pick(WORDS, _h(i, 67, 18, len(WORDS), seed)),
    }


GENERATORS = ("first_name", "last_name", "name", "date", "zipcode", "state", "city", "country",
              "company", "street_address", "email", "phone_number", "word")


def check_schema(schema) -> StructType:
    st = schema if isinstance(schema, StructType) else StructType.fromDDL(schema or DEFAULT_SCHEMA)
    for f in st.fields:
        if f.name not in GENERATORS:
            raise ValueError(f"no generator is named {f.name!r}; known: {', '.join(GENERATORS)}")
        if not isinstance(f.dataType, StringType):
            raise ValueError(f"column {f.name!r} must be a string: generators make strings")
    return st


def fake_columns(id_col: Column, schema=DEFAULT_SCHEMA, seed: int = 0) -> list[Column]:
    st = check_schema(schema)
    gens = _generators(id_col, seed)
    return [gens[f.name].alias(f.name) for f in st.fields]


def with_fake(df: DataFrame, id_col: str, schema=DEFAULT_SCHEMA, seed: int = 0) -> DataFrame:
    """Add generated columns keyed on an existing id column."""
    return df.select("*", *fake_columns(F.col(id_col), schema, seed))


def fake(spark, num_rows: int = 3, schema=DEFAULT_SCHEMA, partitions: int | None = None,
         seed: int = 0) -> DataFrame:
    """``num_rows`` generated rows over ``partitions`` range splits."""
    st = check_schema(schema)
    n = int(num_rows)
    if n < 0:
        raise ValueError("numRows must be >= 0")
    parts = partitions or max(1, min(spark.sparkContext.defaultParallelism, (n // 100_000) + 1))
    return spark.range(0, n, 1, parts).select(*fake_columns(F.col("id"), st, seed))
