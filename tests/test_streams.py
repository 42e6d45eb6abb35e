"""Streams: generated rows, file monitor restart, keyed weather marks."""

import json
import os

from pyspark.sql import functions as F

from feedloom.session import ensure_dir, local_path
from feedloom.sources import weather
from feedloom.streaming import flights as fstream
from feedloom.streaming import weather as wstream
from feedloom.streaming.sources import fake_stream, file_monitor, json_lines, run_available


def test_fake_stream_counts_up(spark, tmp_out):
    s = fake_stream(spark, rows_per_batch=3)
    q = (s.writeStream.format("memory").queryName("fake_rows").option("checkpointLocation", tmp_out + "/c")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    rows = spark.sql("SELECT * FROM fake_rows").collect()
    assert len(rows) == 3 and len(rows[0]) == 4


def test_file_monitor_only_new_files(spark, tmp_out):
    d = local_path(ensure_dir(tmp_out + "/in"))
    open(os.path.join(d, "a.txt"), "w").write("hello")
    run_available(file_monitor(spark, tmp_out + "/in"), tmp_out + "/out", tmp_out + "/ckpt")
    open(os.path.join(d, "b.txt"), "w").write("world!")
    run_available(file_monitor(spark, tmp_out + "/in"), tmp_out + "/out", tmp_out + "/ckpt")
    got = sorted((r.name, r.content) for r in spark.read.parquet(tmp_out + "/out").collect())
    assert got == [("a.txt", "hello"), ("b.txt", "world!")]


def _tl(*times):
    return json.dumps({"timelines": {"hourly": [{"time": t, "values": {"t": i}} for i, t in enumerate(times)]}})


def test_weather_marks_survive_restart(spark, tmp_out):
    d = local_path(ensure_dir(tmp_out + "/in"))
    schema = "latitude double, longitude double, body string"
    with open(os.path.join(d, "1.json"), "w") as f:
        f.write(json.dumps({"latitude": 1.0, "longitude": 2.0, "body": _tl("2024-09-02T00:00:00Z", "2024-09-03T00:00:00Z")}))
    rows = weather.normalise(json_lines(spark, tmp_out + "/in", schema), "hourly")
    run_available(wstream.marked_entries(rows), tmp_out + "/out", tmp_out + "/ckpt")
    with open(os.path.join(d, "2.json"), "w") as f:  # re-sends the 3rd, adds the 4th
        f.write(json.dumps({"latitude": 1.0, "longitude": 2.0, "body": _tl("2024-09-03T00:00:00Z", "2024-09-04T00:00:00Z")}))
    rows = weather.normalise(json_lines(spark, tmp_out + "/in", schema), "hourly")
    run_available(wstream.marked_entries(rows), tmp_out + "/out", tmp_out + "/ckpt")
    got = sorted(r.timestamp for r in spark.read.parquet(tmp_out + "/out").collect())
    assert got == ["2024-09-02T00:00:00Z", "2024-09-03T00:00:00Z", "2024-09-04T00:00:00Z"]


def test_flight_stream_drops_repeats(spark, tmp_out):
    d = local_path(ensure_dir(tmp_out + "/in"))
    st = '["ab", "CS", "NL", 1, 2, 4.5, 52.0, 1.0, false, 1, 1, 1, null, 1, "1", false, 1]'
    with open(os.path.join(d, "s.txt"), "w") as f:
        f.write('{"time": 1700000000, "states": [%s, %s]}\n' % (st, st))
        f.write('{"time": 1700000000, "states": [%s]}\n' % st)
    s = fstream.flight_stream(spark, tmp_out + "/in").select("icao24", "time_ingest")
    run_available(s, tmp_out + "/out", tmp_out + "/ckpt")
    assert spark.read.parquet(tmp_out + "/out").count() == 1


def test_crm_stream_three_then_two(spark, tmp_out):
    from feedloom.sinks import crm

    def tree(_obj, payload):
        n = len(json.loads(payload)["records"])
        return json.dumps({"hasErrors": False, "results": [{"id": "x"}] * n})

    schema = "id int, name string, industry string, revenue double"
    first = spark.createDataFrame([(1, "A", "Tech", 1.0), (2, "B", "Retail", 2.0), (3, "C", "Tech", 3.0)], schema)
    first.coalesce(1).write.mode("append").parquet(tmp_out + "/in")

    def run():
        src = spark.readStream.schema(schema).parquet(tmp_out + "/in")
        renamed = src.selectExpr("id", "name AS Name", "industry AS Industry", "revenue AS AnnualRevenue")
        crm.deliver_stream(renamed, "id", tree, tmp_out + "/ledger", tmp_out + "/ckpt").awaitTermination()
        return spark.read.parquet(tmp_out + "/ledger")

    assert run().count() == 3
    spark.createDataFrame([(4, "D", "Tech", 4.0), (5, "E", "Retail", 5.0)], schema) \
        .coalesce(1).write.mode("append").parquet(tmp_out + "/in")
    ledger = run()
    assert ledger.count() == 5
    assert sorted(r.key for r in ledger.where("batch_id = 1").collect()) == ["4", "5"]


def test_weather_marks_table_new_location_and_retry(spark, tmp_out):
    d = local_path(ensure_dir(tmp_out + "/in"))
    schema = "latitude double, longitude double, body string"
    with open(os.path.join(d, "1.json"), "w") as f:
        f.write(json.dumps({"latitude": 1.0, "longitude": 2.0, "body": _tl("2024-01-02T00:00:00Z")}))

    def run():
        rows = weather.normalise(json_lines(spark, tmp_out + "/in", schema), "hourly")
        wstream.marks_by_batch(rows, tmp_out + "/out", tmp_out + "/marks", tmp_out + "/ckpt",
                               "2024-01-01T00:00:00Z").awaitTermination()

    run()
    with open(os.path.join(d, "2.json"), "w") as f:  # a new location, and a re-send
        f.write(json.dumps({"latitude": 5.0, "longitude": 6.0, "body": _tl("2024-01-03T00:00:00Z")}) + "\n")
        f.write(json.dumps({"latitude": 1.0, "longitude": 2.0, "body": _tl("2024-01-02T00:00:00Z")}) + "\n")
    run()
    got = sorted((r.latitude, r.timestamp) for r in spark.read.parquet(tmp_out + "/out").collect())
    assert got == [(1.0, "2024-01-02T00:00:00Z"), (5.0, "2024-01-03T00:00:00Z")]


def test_marks_versions_are_pruned(spark, tmp_out):
    d = local_path(ensure_dir(tmp_out + "/in"))
    schema = "latitude double, longitude double, body string"
    for i in range(4):
        with open(os.path.join(d, f"{i}.json"), "w") as f:
            f.write(json.dumps({"latitude": 1.0, "longitude": 2.0,
                                "body": _tl(f"2024-01-0{i + 1}T00:00:00Z")}))
        rows = weather.normalise(json_lines(spark, tmp_out + "/in", schema), "hourly")
        wstream.marks_by_batch(rows, tmp_out + "/out", tmp_out + "/marks", tmp_out + "/ckpt",
                               "2023-12-31T00:00:00Z").awaitTermination()
    versions = sorted(n for n in os.listdir(local_path(tmp_out + "/marks")) if n.startswith("batch_id="))
    assert versions == ["batch_id=2", "batch_id=3"]
    assert spark.read.parquet(tmp_out + "/out").count() == 4


def test_crm_stream_state_dedupe(spark, tmp_out):
    from feedloom.sinks import crm

    def tree(_obj, payload):
        n = len(json.loads(payload)["records"])
        return json.dumps({"hasErrors": False, "results": [{"id": "x"}] * n})

    schema = "id int, Name string"
    spark.createDataFrame([(1, "A"), (2, "B")], schema).coalesce(1).write.mode("append").parquet(tmp_out + "/in")

    def run():
        src = spark.readStream.schema(schema).parquet(tmp_out + "/in")
        crm.deliver_stream(src, "id", tree, tmp_out + "/ledger", tmp_out + "/ckpt",
                           dedupe="state").awaitTermination()
        return spark.read.parquet(tmp_out + "/ledger")

    assert run().count() == 2
    # a re-landed copy of id 2 plus a new id 3: only id 3 is delivered
    spark.createDataFrame([(2, "B"), (3, "C")], schema).coalesce(1).write.mode("append").parquet(tmp_out + "/in")
    ledger = run()
    assert sorted(r.key for r in ledger.collect()) == ["1", "2", "3"]
