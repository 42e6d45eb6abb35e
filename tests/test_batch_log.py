"""Outputs of streams under new checkpoints, retries and crashes; files in parts."""

import json
import os

import pytest

from feedloom.session import ensure_dir, local_path
from feedloom.sinks import crm
from feedloom.sources import weather
from feedloom.streaming import flights as fstream
from feedloom.streaming import log as L
from feedloom.streaming import weather as wstream
from feedloom.streaming.sources import file_chunks, json_lines, run_available


def test_numbers_stay_over_retries_runs_and_snapshots(spark, tmp_out):
    for run, batches in (("a", 40), ("b", 40)):
        for n in range(batches):
            log = L.BatchLog(spark, tmp_out)
            seq = log.begin(run, n)
            assert L.BatchLog(spark, tmp_out).begin(run, n) == seq  # a retry before the commit
            log.commit(run, n, {"x": f"batch_id={seq}"})
            assert log.begin(run, n) is None  # and after it
    log = L.BatchLog(spark, tmp_out)
    assert [f.rsplit("=", 1)[1] for f in log.fragments(["x"])] == [str(i) for i in range(80)]
    assert log.state["runs"] == {"a": 39, "b": 39} and log.state["open"] == {} and log.fragments(["y"]) == []
    files = [f for f in os.listdir(local_path(tmp_out + "/_batches")) if f.endswith(".json")]
    assert len(files) <= 3 * L.SNAPSHOT


def test_of_two_writers_one_fails(spark, tmp_out):
    one, two = L.BatchLog(spark, tmp_out), L.BatchLog(spark, tmp_out)
    one.begin("a", 0)
    with pytest.raises(Exception, match="(?i)exist"):
        two.begin("b", 0)
    assert L.BatchLog(spark, tmp_out).state["open"] == {"a/0": 0}


def test_merging_keeps_rows_and_bounds_fragments(spark, tmp_out):
    for n in range(3 * L.FAN):
        log = L.BatchLog(spark, tmp_out)
        seq = log.begin("a", n)
        spark.createDataFrame([(n, n % 2)], "v int, day int").write.partitionBy("day").parquet(f"{tmp_out}/batch_id={seq}")
        log.commit("a", n, {p: f"batch_id={seq}/{x}" for p, x in L.written_parts(spark, f"{tmp_out}/batch_id={seq}").items()})
        log.merge(["0", "1"], "v int", "day")
        assert len(log.fragments(["0"])) <= 2 * L.FAN
    rows = sorted((r.v, r.day) for r in L.read_table(spark, tmp_out).collect())
    assert rows == [(n, n % 2) for n in range(3 * L.FAN)]


def test_tables_without_a_log_are_taken_over(spark, tmp_out):
    spark.createDataFrame([(1, 3), (2, 4)], "v int, day int").write.partitionBy("day").parquet(f"{tmp_out}/batch_id=7")
    log = L.BatchLog(spark, tmp_out)
    assert log.begin("new", 0) == 8 and [f.rsplit("/", 1)[1] for f in log.fragments(["4"])] == ["day=4"]


def _snapshot(folder, name, time, *icao):
    vectors = ",".join(f'["{i}", "CS", "NL", 1, 2, 4.5, 52.0, 1.0, false, 1, 1, 1, null, 1, "1", false, 1]' for i in icao)
    with open(os.path.join(folder, name), "w") as f:
        f.write('{"time": %d, "states": [%s]}\n' % (time, vectors))


def test_flights_go_on_under_a_new_checkpoint(spark, tmp_out):
    d = local_path(ensure_dir(tmp_out + "/in"))
    _snapshot(d, "a.txt", 1700000000, "a", "b")

    def run(checkpoint):
        fstream.write_states(fstream.state_rows(spark, tmp_out + "/in").select("icao24", "time_ingest"),
                             tmp_out + "/out", f"{tmp_out}/{checkpoint}").awaitTermination()
        return sorted(r.icao24 for r in L.read_table(spark, tmp_out + "/out").collect())

    assert run("c1") == ["a", "b"]
    _snapshot(d, "b.txt", 1700000000, "b", "c")
    assert run("c2") == ["a", "b", "c"] and run("c1") == ["a", "b", "c"]


def test_weather_goes_on_under_a_new_checkpoint_and_after_a_crash(spark, tmp_out, monkeypatch):
    d = local_path(ensure_dir(tmp_out + "/in"))
    schema = "latitude double, longitude double, body string"

    def put(name, *times):
        body = json.dumps({"timelines": {"hourly": [{"time": t, "values": {"t": 1}} for t in times]}})
        with open(os.path.join(d, name), "w") as f:
            f.write(json.dumps({"latitude": 1.0, "longitude": 2.0, "body": body}))

    def run(checkpoint):
        rows = weather.normalise(json_lines(spark, tmp_out + "/in", schema), "hourly")
        wstream.marks_by_batch(rows, tmp_out + "/out", tmp_out + "/marks", f"{tmp_out}/{checkpoint}",
                               "2024-01-01T00:00:00Z").awaitTermination()
        return sorted(r.timestamp[8:10] for r in L.read_table(spark, tmp_out + "/out").collect())

    put("1.json", "2024-01-02T00:00:00Z", "2024-01-03T00:00:00Z")
    real = weather.advance_marks

    def broken(*a):
        raise OSError("lost between the entries and their marks")
    monkeypatch.setattr(weather, "advance_marks", broken)
    with pytest.raises(Exception, match="lost between"):
        run("c1")
    monkeypatch.setattr(weather, "advance_marks", real)
    assert run("c1") == ["02", "03"]
    put("2.json", "2024-01-03T00:00:00Z", "2024-01-04T00:00:00Z")
    assert run("c2") == ["02", "03", "04"]


def test_delivery_goes_on_under_a_new_checkpoint(spark, tmp_out):
    def tree(_obj, payload):
        recs = json.loads(payload)["records"]
        return json.dumps({"hasErrors": False, "results": [
            {"referenceId": r["attributes"]["referenceId"], "id": r["Name"]} for r in recs]})

    schema = "id int, Name string, seen int"

    def run(rows, checkpoint):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(tmp_out + "/in")
        src = spark.readStream.schema(schema).parquet(tmp_out + "/in")
        crm.deliver_stream(src, "id", tree, tmp_out + "/ledger", f"{tmp_out}/{checkpoint}", schema="Name string",
                           order="seen").awaitTermination()
        return sorted((r.key, r.id) for r in crm.accepted(spark, tmp_out + "/ledger").collect())

    assert run([(1, "A", 1), (2, "B", 1), (2, "B", 1)], "c1") == [("1", "A"), ("2", "B")]
    # other records of a key: the newest goes, the others are listed
    got = run([(3, "zed old", 1), (3, "abe new", 2), (4, "D", 1)], "c2")
    assert got == [("1", "A"), ("2", "B"), ("3", "abe new"), ("4", "D")]
    lost = spark.read.parquet(tmp_out + "/ledger_rejected").where(f"message = '{crm.SUPERSEDED}'").collect()
    assert [(r.key, json.loads(r.record)["Name"]) for r in lost] == [("3", "zed old")]


def test_parts_of_files_are_the_files(spark, tmp_out):
    d = local_path(ensure_dir(tmp_out + "/in"))
    texts = {"a.txt": "aé漢😀\n" * 40, "b.txt": "", "c.txt": "x", "d.txt": "😀" * 33}
    for name, text in texts.items():
        with open(os.path.join(d, name), "w", encoding="utf-8", newline="") as f:
            f.write(text)
    run_available(file_chunks(spark, tmp_out + "/in", 7), tmp_out + "/out", tmp_out + "/ckpt")
    rows = spark.read.parquet(tmp_out + "/out").collect()
    for name, text in texts.items():
        mine = sorted((r["chunk"], r["content"]) for r in rows if r["name"] == name)
        assert "".join(c for _, c in mine) == text and len(mine) == -(-len(text.encode()) // 7)
    with pytest.raises(ValueError):
        file_chunks(spark, tmp_out + "/in", 3)
