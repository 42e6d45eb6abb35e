"""Queries for the streaming operators.

Each lands slices of a driver table as files in the shared folder, runs the
stream with ``availableNow`` (twice where a restart is the point), writes
to parquet and returns that output read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.operators.fetch import land
from feedloom.plans import captures as C
from feedloom.plans.landing import land_text, slices
from feedloom.plans.q_feeds import _STATES_SQL, _WEATHER_SQL
from feedloom.plans.q_sinks import ACCOUNT, NEGATIVE, _accounts, tree_endpoint
from feedloom.plans.registry import query
from feedloom.plans.tables import load
from feedloom.session import fresh_dir
from feedloom.sinks import crm
from feedloom.sources import weather
from feedloom.streaming import flights as flight_stream
from feedloom.streaming import weather as weather_stream
from feedloom.streaming.log import BatchLog, read_table
from feedloom.streaming.sources import file_chunks, file_monitor, json_lines, run_available


#: Bytes of a landed snapshot file: a task writes it.
SLICE = 128 << 20


def _snapshots(spark, d, root):
    """The snapshots' bodies and their times.  They are landed, so that every
    choice among them sees the same texts."""
    snaps = land(C.flight_snapshots(load(spark, d, "events")).select("body"), f"{root}/snapshots", partition_by=None)
    return snaps, F.get_json_object("body", "$.time").cast("long")


def _land_files(part, time, least, path):
    """Files of some bytes each, every one with a range of the times, newest first."""
    part.repartitionByRange(slices(part, least, SLICE), time.desc(), F.xxhash64("body")).write.text(path)


@query("stream_flights", f"""
SELECT DISTINCT icao24, time_ingest, callsign, longitude, latitude, category FROM ({_STATES_SQL})
""")
def stream_flights(spark, d):
    """Landed snapshots -> typed states, repeated vectors dropped.

    One file per micro-batch, the newest snapshots first, and a second run
    over re-landed snapshots: the result must not depend on any of it.
    """
    root = fresh_dir(spark, "stream-flights")
    snaps, time = _snapshots(spark, d, root)
    late = F.pmod(F.xxhash64("body"), F.lit(3)) == 0
    cols = ["icao24", "time_ingest", "callsign", "longitude", "latitude", "category"]
    again = snaps.where(late).unionByName(snaps.where(time % 2 == 0))
    for run, part, least in (("run1", snaps.where(~late), 4), ("run2", again, 2)):
        _land_files(part, time, least, f"{root}/in/{run}")
        states = flight_stream.state_rows(spark, f"{root}/in/*", max_files_per_trigger=1).select(*cols)
        flight_stream.write_states(states, f"{root}/out", f"{root}/ckpt").awaitTermination()
    return read_table(spark, f"{root}/out").select(*cols)


_WEATHER_START = "2023-12-31T00:00:00Z"


@query("stream_weather", f"SELECT * FROM ({_WEATHER_SQL}) WHERE timestamp > '{_WEATHER_START}'")
def stream_weather(spark, d):
    """Per-location marks in keyed state: a re-sent overlap is not emitted twice."""
    root = fresh_dir(spark, "stream-weather")
    bodies = land(C.weather_timelines(load(spark, d, "events")), f"{root}/bodies", partition_by=None)
    day = F.get_json_object("body", "$.timelines.hourly[0].time").substr(9, 2).cast("int")
    first = bodies.where(day <= 15)
    second = bodies.where(day >= 10)  # days 10-15 are landed again
    schema = "latitude double, longitude double, body string"
    first.select("latitude", "longitude", "body").write.json(f"{root}/in/run1")
    rows = weather.normalise(json_lines(spark, f"{root}/in/*", schema), "hourly")
    run_available(weather_stream.marked_entries(rows, _WEATHER_START), f"{root}/out", f"{root}/ckpt")
    second.select("latitude", "longitude", "body").write.json(f"{root}/in/run2")
    rows = weather.normalise(json_lines(spark, f"{root}/in/*", schema), "hourly")
    run_available(weather_stream.marked_entries(rows, _WEATHER_START), f"{root}/out", f"{root}/ckpt")
    return spark.read.parquet(f"{root}/out")


@query("stream_files", """
SELECT CAST(sum(length(text) + 1) AS BIGINT) AS total_chars FROM documents
""")
def stream_files(spark, d):
    """File monitor: each new file once, as (name, content); two runs."""
    root = fresh_dir(spark, "stream-files")
    docs = load(spark, d, "documents")
    docs.where(F.col("lang") == "en").select("text").write.text(f"{root}/in/a")
    files = file_monitor(spark, f"{root}/in/*")
    run_available(files, f"{root}/out", f"{root}/ckpt")
    docs.where(F.col("lang") != "en").select("text").write.text(f"{root}/in/b")
    files = file_monitor(spark, f"{root}/in/*")
    run_available(files, f"{root}/out", f"{root}/ckpt")
    out = spark.read.parquet(f"{root}/out")
    return out.agg(F.sum(F.length("content")).cast("bigint").alias("total_chars"))


@query("stream_files_chunks", """
SELECT lang, CAST(sum(length(text) + 1) AS BIGINT) AS total_chars, CAST(sum(length(encode(text)) + 1) AS BIGINT) AS total_bytes,
       CAST(ceil(sum(length(encode(text)) + 1) / 5000.0) AS BIGINT) AS chunks
FROM documents GROUP BY lang
""".replace("length(encode(text))", "octet_length(encode(text))"))
def stream_files_chunks(spark, d):
    """File monitor in parts: one file a language, read by many tasks; two runs."""
    root = fresh_dir(spark, "stream-chunks")
    docs = load(spark, d, "documents").select("lang", "text")
    for run, part in (("a", docs.where("lang < 'es'")), ("b", docs.where("lang >= 'es'"))):
        land_text(part, f"{root}/in/{run}", "lang")
        run_available(file_chunks(spark, f"{root}/in/*/*", 5000), f"{root}/out", f"{root}/ckpt")
    out = spark.read.parquet(f"{root}/out").withColumn("lang", F.regexp_extract("path", "lang=([^/]*)/", 1))
    return out.groupBy("lang").agg(
        F.sum(F.length("content")).alias("total_chars"), F.sum(F.octet_length("content")).cast("long").alias("total_bytes"),
        F.count(F.lit(1)).alias("chunks"))


def _crm_runs(spark, d, endpoints):
    """Accounts delivered in two runs; the second re-sends part of the first,
    and each landing holds some rows twice."""
    root = fresh_dir(spark, "stream-crm")
    acc = _accounts(spark, d)
    seg = F.col("Industry")
    first = seg.isin("AUTOMOBILE", "FURNITURE")
    twice = F.pmod(F.col("c_custkey"), F.lit(7)) == 0
    for run, part, endpoint in (
            ("run1", acc.where(first), endpoints[0]),
            ("run2", acc.where(~first | seg.isNull()).unionByName(acc.where(seg == "AUTOMOBILE")), endpoints[1])):
        part.unionByName(part.where(twice)).write.parquet(f"{root}/in/{run}")
        src = spark.readStream.schema(acc.schema).parquet(f"{root}/in/*")
        crm.deliver_stream(src, "c_custkey", endpoint, f"{root}/ledger", f"{root}/ckpt",
                           schema=ACCOUNT).awaitTermination()
    return f"{root}/ledger"


@query("stream_crm_resume", """
SELECT CAST(c_custkey AS VARCHAR) AS key, 1 AS deliveries FROM customer WHERE c_acctbal >= 0
""")
def stream_crm_resume(spark, d):
    """Delivery resumes from the checkpoint; each accepted record once."""
    ledger = crm.accepted(spark, _crm_runs(spark, d, [tree_endpoint] * 2))
    return ledger.groupBy("key").agg(F.count(F.lit(1)).cast("int").alias("deliveries"))


@query("stream_crm_failures", f"""
SELECT CAST(c_custkey AS VARCHAR) AS key, '{NEGATIVE}' AS message,
       CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 2 ELSE 1 END AS refusals
FROM customer WHERE c_acctbal < 0
""")
def stream_crm_failures(spark, d):
    """Refused records are no deliveries: they are listed with their message."""
    refused = spark.read.parquet(_crm_runs(spark, d, [tree_endpoint] * 2) + "_rejected")
    return refused.groupBy("key", "message").agg(F.count(F.lit(1)).cast("int").alias("refusals"))


def _one_by_one(object_type, payload):
    """Refuses payloads of several records, as a call that failed."""
    if payload.count('"referenceId"') > 1:
        raise ConnectionError("batch call failed")
    return tree_endpoint(object_type, payload)


def _down(object_type, payload):
    raise ConnectionError("service is down")


@query("stream_crm_fallback", """
SELECT CAST(c_custkey AS VARCHAR) AS key, 1 AS deliveries FROM customer WHERE c_acctbal >= 0
""")
def stream_crm_fallback(spark, d):
    """Every call of the first run fails, in the second only those of several
    records: the second run sends the first one's records again, one by one."""
    ledger = crm.accepted(spark, _crm_runs(spark, d, [_down, _one_by_one]))
    return ledger.groupBy("key").agg(F.count(F.lit(1)).cast("int").alias("deliveries"))


@query("stream_weather_marks_table", f"SELECT * FROM ({_WEATHER_SQL}) WHERE timestamp > '{_WEATHER_START}'")
def stream_weather_marks_table(spark, d):
    """Per-location marks as a versioned table (no keyed state): same result."""
    root = fresh_dir(spark, "stream-weather-table")
    bodies = C.weather_timelines(load(spark, d, "events"))
    day = F.get_json_object("body", "$.timelines.hourly[0].time").substr(9, 2).cast("int")
    schema = "latitude double, longitude double, body string"
    for run, part in (("run1", bodies.where(day <= 15)), ("run2", bodies.where(day >= 10))):
        part.select("latitude", "longitude", "body").write.json(f"{root}/in/{run}")
        rows = weather.normalise(json_lines(spark, f"{root}/in/*", schema), "hourly")
        weather_stream.marks_by_batch(rows, f"{root}/out", f"{root}/marks", f"{root}/ckpt",
                                      _WEATHER_START).awaitTermination()
    return read_table(spark, f"{root}/out").drop("batch_id")


@query("stream_flights_moved", f"""
SELECT DISTINCT icao24, time_ingest, callsign, longitude, latitude, category FROM ({_STATES_SQL})
""")
def stream_flights_moved(spark, d):
    """A second stream with a checkpoint of its own goes on with the same
    output: nothing is lost, nothing twice, though both number their
    micro-batches from 0; days of many micro-batches are merged."""
    root = fresh_dir(spark, "stream-flights-moved")
    snaps, time = _snapshots(spark, d, root)
    cols = ["icao24", "time_ingest", "callsign", "longitude", "latitude", "category"]
    first = snaps.where(time % 3 < 2)
    first.repartition(slices(first, 18, SLICE)).write.text(f"{root}/in/a")
    _land_files(snaps.where(time % 3 > 0), time, 3, f"{root}/in/b")
    for run in ("a", "b"):
        states = flight_stream.state_rows(spark, f"{root}/in/{run}", max_files_per_trigger=1).select(*cols)
        flight_stream.write_states(states, f"{root}/out", f"{root}/ckpt-{run}").awaitTermination()
    return read_table(spark, f"{root}/out").select(*cols)


@query("stream_weather_moved", f"""
SELECT 'entry' AS kind, latitude, longitude, timestamp, weather FROM ({_WEATHER_SQL}) WHERE timestamp > '{_WEATHER_START}'
UNION ALL
SELECT 'mark', latitude, longitude, greatest(max(timestamp), '{_WEATHER_START}'), NULL FROM ({_WEATHER_SQL})
GROUP BY latitude, longitude
""")
def stream_weather_moved(spark, d):
    """Entries and marks when the second run has a checkpoint of its own."""
    root = fresh_dir(spark, "stream-weather-moved")
    bodies = C.weather_timelines(load(spark, d, "events"))
    day = F.get_json_object("body", "$.timelines.hourly[0].time").substr(9, 2).cast("int")
    schema = "latitude double, longitude double, body string"
    for run, part in (("run1", bodies.where(day <= 15)), ("run2", bodies.where(day >= 10))):
        part.select("latitude", "longitude", "body").write.json(f"{root}/in/{run}")
        rows = weather.normalise(json_lines(spark, f"{root}/in/{run}", schema), "hourly")
        weather_stream.marks_by_batch(rows, f"{root}/out", f"{root}/marks", f"{root}/ckpt-{run}",
                                      _WEATHER_START).awaitTermination()
    cols = ["kind", "latitude", "longitude", "timestamp", "weather"]
    newest = spark.read.parquet(BatchLog(spark, f"{root}/marks").fragments()[-1])
    marks = newest.select(F.lit("mark").alias("kind"), "latitude", "longitude", F.col("mark").alias("timestamp"),
                          F.lit(None).cast("string").alias("weather"))
    return read_table(spark, f"{root}/out").withColumn("kind", F.lit("entry")).select(*cols).unionByName(marks.select(*cols))


@query("stream_crm_moved", """
SELECT CAST(c_custkey AS VARCHAR) AS key, 1 AS deliveries FROM customer WHERE c_acctbal >= 0
""")
def stream_crm_moved(spark, d):
    """Delivery that goes on with a checkpoint of its own: the first run's
    records are re-sent to it, and no key is lost or delivered twice."""
    root = fresh_dir(spark, "stream-crm-moved")
    acc = _accounts(spark, d)
    part = F.pmod(F.col("c_custkey"), F.lit(3))
    for run, rows in (("run1", acc.where(part < 2)), ("run2", acc.where(part > 0))):
        rows.repartition(2).write.parquet(f"{root}/in/{run}")
        src = spark.readStream.schema(acc.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in/{run}")
        crm.deliver_stream(src, "c_custkey", tree_endpoint, f"{root}/ledger", f"{root}/ckpt-{run}",
                           schema=ACCOUNT).awaitTermination()
    ledger = crm.accepted(spark, f"{root}/ledger")
    return ledger.groupBy("key").agg(F.count(F.lit(1)).cast("int").alias("deliveries"))
