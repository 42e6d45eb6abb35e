"""A key holding a third of all rows: results stay whole and exact."""

from pyspark.sql import functions as F

from feedloom.operators.fetch import call_once, enrich, replay
from feedloom.operators.requests import build_requests, cut_pages, plan_pages
from feedloom.sources import weather


def _hot(spark, n=30000):
    # key 0 holds a third of the rows
    return spark.range(n).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"))


def test_enrich_and_call_once_with_hot_key(spark):
    facts = _hot(spark)

    def lookup(keys):
        return keys.withColumn("v", F.col("k") * 2)

    out = enrich(facts, "k", lookup, ["v"])
    assert out.count() == 30000
    assert out.where((F.col("k") == 0) & (F.col("v") == 0)).count() == 10000
    once = call_once(facts, ["k"], lookup, ["v"])
    assert once.count() == 30000


def test_replay_with_hot_request_key(spark):
    reqs = build_requests(_hot(spark).select(F.col("k").cast("string").alias("k")),
                          "http://h/{k}", method="GET", query_type="inline")
    caps = spark.range(30000).select(
        F.lit("f").alias("feed"), F.concat(F.lit("http://h/"), F.col("id")).alias("key"),
        F.lit(200).alias("status"), F.col("id").cast("string").alias("body"),
        F.lit(None).cast("string").alias("error"), F.lit(None).cast("timestamp").alias("fetched_at"))
    got = replay(reqs, caps)
    assert got.count() == 30000
    assert got.where(F.col("_corrupt_record").isNull()).count() == 30000


def test_pages_and_marks_with_hot_key(spark):
    keys = spark.createDataFrame([("hot", 100000), ("cold", 5)], "k string, total long")
    pages = plan_pages(keys, "total", 10)
    assert pages.count() == 10001 + 2
    pages = pages.withColumn("has_more", F.col("page") < 10000).withColumn("n_items", F.lit(10))
    assert cut_pages(pages, ["k"]).where(F.col("k") == "hot").count() == 10000
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0.0)).otherwise(F.col("id").cast("double")).alias("latitude"),
        F.lit(1.0).alias("longitude"), F.lit("{}").alias("weather"),
        F.format_string("2024-01-%02dT00:00:00Z", (F.col("id") % 28 + 1).cast("int")).alias("timestamp"))
    marks = spark.createDataFrame([(0.0, 1.0, "2024-01-14T00:00:00Z")], "latitude double, longitude double, mark string")
    inc = weather.increment(rows, marks)
    hot_new = rows.where((F.col("latitude") == 0.0) & (F.col("timestamp") > "2024-01-14T00:00:00Z")).count()
    assert inc.where(F.col("latitude") == 0.0).count() == hot_new
    m = {r.latitude: r.mark for r in weather.advance_marks(rows, marks).where(F.col("latitude") == 0.0).collect()}
    assert m[0.0] == "2024-01-28T00:00:00Z"
