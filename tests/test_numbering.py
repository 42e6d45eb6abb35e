import random

import pytest
from pyspark.sql import functions as F

from feedloom.operators.numbering import running
from feedloom.session import fresh_dir


def model(rows):
    out, state = [], {}
    order = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0)
    for g, o, v in sorted(rows, key=order):
        n, s, x = state.get(g, (0, 0, 0))
        state[g] = (n + 1, s + (v or 0), x ^ (v or 0))
        out.append((g, o, v, *state[g]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("kind", ["hot", "many", "one", "none"])
def test_numbers_and_totals_equal_a_model(spark, kind):
    rng = random.Random(7)
    rows = {"hot": [(rng.choice([1, 1, 1, 1, 2, 3, None]), i, rng.randrange(-50, 50)) for i in range(3000)],
            "many": [(i // 3, i, rng.randrange(2**40)) for i in range(3000)] + [(-1, None, None)],
            "one": [(5, i, 1) for i in range(2000)], "none": []}[kind]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g long, o long, v long").repartition(5)
    got = running(df, ["g"], ["o"], fresh_dir(spark, "tests"), "n", {"s": "v"}, {"x": "v"})
    assert got.columns == ["g", "o", "v", "n", "s", "x"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == model(rows)


def test_one_group_is_dealt_over_tasks_and_equal_rows_too(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = fresh_dir(spark, "tests")
        got = running(spark.range(4000).select(F.lit("k").alias("k"), F.lit(1).alias("o")), ["k"], ["o"], path)
        assert sorted(r["at"] for r in got.collect()) == list(range(1, 4001))
        sizes = [r["count"] for r in spark.read.parquet(path).groupBy("_part").count().collect()]
        assert len(sizes) == 8 and max(sizes) < 1000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_no_group_numbers_the_whole_table(spark):
    got = running(spark.range(1000).repartition(7), [], ["id"], fresh_dir(spark, "tests"))
    assert all(r["at"] == r["id"] + 1 for r in got.collect())
    with pytest.raises(ValueError):
        running(spark.range(3), [], ["id"], fresh_dir(spark, "tests"), index="id")
