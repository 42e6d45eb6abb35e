"""Figures that must not grow with the tables, on rows of the tests' own."""

import glob
import os

from pyspark.sql import functions as F

import __spark_entry__ as entry
from feedloom.plans import q_streams
from feedloom.plans.landing import land_text
from feedloom.session import local_path
from feedloom.sinks import crm
from feedloom.streaming import weather as weather_stream


def test_items_of_payloads_are_not_broadcast(spark, tmp_out):
    n = 2000
    spark.sql(f"SELECT id AS c_custkey, concat('c#', id) AS c_name, 0 AS c_nationkey, 1.0D AS c_acctbal, 'BUILDING' AS c_mktsegment "
              f"FROM range({n})").write.parquet(f"{tmp_out}/customer.parquet")
    spark.sql(f"SELECT id AS o_orderkey, id % {n} AS o_custkey, 'O' AS o_orderstatus, '1-URGENT' AS o_orderpriority "
              f"FROM range({n})").write.parquet(f"{tmp_out}/orders.parquet")
    spark.sql(f"SELECT id div 2 AS l_orderkey, 1 AS l_partkey, 1 AS l_suppkey, cast(id % 2 AS int) AS l_linenumber, 'F' AS l_linestatus, "
              f"'R' AS l_returnflag, 1.0D AS l_quantity FROM range({2 * n})").write.parquet(f"{tmp_out}/lineitem.parquet")
    spark.sql("SELECT 0 AS n_nationkey, 'N' AS n_name, 0 AS n_regionkey").write.parquet(f"{tmp_out}/nation.parquet")
    spark.sql("SELECT 0 AS r_regionkey, 'R' AS r_name").write.parquet(f"{tmp_out}/region.parquet")
    for name, joins in (("jp_posts_users", 1), ("jp_posts_comments", 1), ("jp_user_photos", 2)):
        df = entry.queries()[name](spark, tmp_out)
        assert len(df.collect()) == n
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("SortMergeJoin") == joins, name


def test_replies_are_parsed_once_a_payload(spark):
    results = ",".join(f'{{"referenceId":"ref{i}","id":"x{i}"}}' for i in (1, 0))
    again = results + ',{"referenceId":"ref0","id":"late"}'
    recs = ",".join(f'{{"attributes":{{"type":"A","referenceId":"ref{i}"}},"Name":"n{i}"}}' for i in range(3))
    rows = [("a", ["k0", "k1", "k2"], f'{{"records":[{recs}]}}', f'{{"hasErrors":true,"results":[{again}]}}', None),
            ("b", ["k3"], '{"records":[{"Name":"n"}]}', "no JSON", None), ("c", [], '{"records":[]}', None, "down")]
    sent = spark.createDataFrame(rows, "batch_key string, keys array<string>, payload string, response string, error string")
    out = crm.outcomes(sent.repartition(2))
    got = {r.key: (r.record, r.status, r.id) for r in out.collect()}
    assert got == {"k0": ('{"Name":"n0"}', "accepted", "x0"), "k1": ('{"Name":"n1"}', "accepted", "x1"),
                   "k2": ('{"Name":"n2"}', "rejected", None), "k3": ('{"Name":"n"}', "failed", None)}
    plan = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    explode = next(i for i, line in enumerate(plan) if "Generate" in line)
    assert not any("from_json" in line for line in plan[:explode])
    assert not any("from_json" in line for line in plan if "Filter" in line)


def test_state_does_not_grow_by_a_call_a_location(spark, tmp_out):
    n = 3 * weather_stream.BUCKETS
    spark.sql(f"SELECT CASE WHEN id = 0 THEN null ELSE id * 0.5D END AS latitude, -0.0D AS longitude, '{{}}' AS weather, "
              f"'2024-01-02' AS timestamp FROM range({n})").write.parquet(f"{tmp_out}/in/a")
    schema = spark.read.parquet(f"{tmp_out}/in/a").schema
    for run in ("a", "b"):
        rows = spark.readStream.schema(schema).parquet(f"{tmp_out}/in/*")
        q = (weather_stream.marked_entries(rows, "2024-01-01").writeStream.option("checkpointLocation", f"{tmp_out}/ckpt")
             .option("path", f"{tmp_out}/out").format("parquet").trigger(availableNow=True).start())
        q.awaitTermination()
        assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= weather_stream.BUCKETS
        # the same entries again, and one later entry of a location
        spark.sql(f"SELECT * FROM (SELECT latitude, 0.0D AS longitude, weather, timestamp FROM parquet.`{tmp_out}/in/a`) "
                  "UNION ALL SELECT null, 0.0D, '{}', '2024-01-03'").write.mode("overwrite").parquet(f"{tmp_out}/in/b")
    got = spark.read.parquet(f"{tmp_out}/out")
    assert got.count() == n + 1 and got.where("latitude IS NULL").count() == 2


def test_one_text_file_is_written_by_many_tasks(spark, tmp_out):
    rows = spark.range(0, 999, 1, 5).selectExpr("concat('é', id, ',', repeat('x', cast(id % 50 AS int))) AS t", "concat('l', id % 3) AS l")
    want = [r.t for r in rows.collect()]
    land_text(rows.select("t"), f"{tmp_out}/whole")
    files = glob.glob(local_path(f"{tmp_out}/whole/[!_]*"))
    assert len(files) == 1 and open(files[0], encoding="utf-8").read() == "".join(f"{t}\n" for t in want)
    land_text(rows, f"{tmp_out}/by", "l")
    files = sorted(glob.glob(local_path(f"{tmp_out}/by/*/*")))
    assert [f.split("/")[-2] for f in files] == ["l=l0", "l=l1", "l=l2"]
    assert open(files[1], encoding="utf-8").read() == "".join(f"{t}\n" for t in want[1::3])
    land_text(rows.where("t = ''").select("t"), f"{tmp_out}/none")
    assert spark.read.text(f"{tmp_out}/none").count() == 0


def test_files_of_snapshots_are_bounded(spark, tmp_out, monkeypatch):
    monkeypatch.setattr(q_streams, "SLICE", 10_000)
    snaps = spark.range(1000).selectExpr("""concat('{"time":', id % 7, ',"states":[', id, ']}', repeat(' ', 100)) AS body""")
    q_streams._land_files(snaps, F.get_json_object("body", "$.time").cast("long"), 4, f"{tmp_out}/in")
    sizes = [os.path.getsize(f) for f in glob.glob(local_path(f"{tmp_out}/in/part-*"))]
    assert len(sizes) > 10 and max(sizes) < 30_000
    assert spark.read.text(f"{tmp_out}/in").count() == 1000
