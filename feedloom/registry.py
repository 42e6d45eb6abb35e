"""Feed name -> the functions that implement it.

Everything that takes a table is a DataFrame function (a Python data source
cannot read another DataFrame); registered Spark formats are kept for the
file formats only (``arrowfiles``, ``arrowdataset``, ``jsonarray``).
"""

from __future__ import annotations

from feedloom.operators import fetch, requests
from feedloom.sinks import crm, json_array
from feedloom.sources import (
    arrow, datasets, fake, flights, github, hub, placeholder, quotes, sheets, stock, weather,
)
from feedloom.streaming import flights as flight_stream
from feedloom.streaming import sources as stream_sources
from feedloom.streaming import weather as weather_stream

REGISTRY = {
    "rest": {"plan": requests.build_requests, "fetch": fetch.fetch, "replay": fetch.replay,
             "parse": fetch.parse_output, "stats": fetch.call_stats},
    "arrow": {"read": arrow.read_arrow, "append": arrow.append_arrow},
    "fake": {"read": fake.fake, "columns": fake.with_fake, "stream": stream_sources.fake_stream},
    "pull_requests": {"normalise": github.normalise, "url": github.pulls_url},
    "sheets": {"read": sheets.read_sheet, "lines": sheets.sheet_from_lines, "locate": sheets.locate},
    "hub": {"read": hub.read_split},
    "datasets": {"read": datasets.read_file},
    "blog_demo": {"normalise": placeholder.normalise, "limit": placeholder.first_n},
    "quotes": {"normalise": quotes.normalise, "symbols": quotes.explode_symbols},
    "price_series": {"normalise": stock.normalise, "resample": stock.resample, "errors": stock.errors},
    "flights": {"normalise": flights.normalise, "regions": flights.tag_regions,
                "stream": flight_stream.flight_stream},
    "weather": {"normalise": weather.normalise, "increment": weather.increment,
                "marks": weather.advance_marks, "stream": weather_stream.marked_entries},
    "json_array": {"write": json_array.write_json_array, "read": json_array.read_json_array},
    "arrow_dataset": {"append": arrow.append_arrow, "read": arrow.read_arrow},
    "crm": {"records": crm.records, "batches": crm.batches, "deliver": crm.deliver,
            "accounting": crm.accounting, "fallback": crm.fallback, "stream": crm.deliver_stream},
}


def register_formats(spark) -> None:
    """Register the three file formats with a session."""
    arrow.register(spark)
    json_array.register(spark)


def get(name: str) -> dict:
    if name not in REGISTRY:
        raise ValueError(f"unknown feed {name!r}; known: {', '.join(sorted(REGISTRY))}")
    return REGISTRY[name]
