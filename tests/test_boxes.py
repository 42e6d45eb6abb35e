"""Boxes met through cells, against every pair."""

import random


from feedloom.sources import flights


def test_boxes_of_every_size(spark):
    rng = random.Random(2)
    points = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(400)]
    points += [(900, None, 1.0), (901, 90.0, 180.0), (902, -90.0, -180.0), (903, float("nan"), 0.0), (904, 1e9, 0.0), (905, 12.5, -45.0)]
    boxes = []
    for i in range(60):
        a, c, e = rng.uniform(-90, 90), rng.uniform(-180, 180), 10 ** rng.uniform(-3, 2.5)
        boxes.append((f"b{i}", a, a + e, c, c + e * rng.uniform(0, 1.5)))
    boxes += [("world", -90.0, 90.0, -180.0, 180.0), ("all", -1e12, 1e12, -1e12, 1e12), ("point", 12.5, 12.5, -45.0, -45.0),
              ("wrong", 5.0, -5.0, 0.0, 9.0), ("none", None, 1.0, 0.0, 1.0), ("inf", float("-inf"), float("inf"), 0.0, 1.0)]
    p = spark.createDataFrame(points, "id int, latitude double, longitude double")
    b = spark.createDataFrame(boxes, "region string, lamin double, lamax double, lomin double, lomax double")
    want = sorted((i, n) for i, y, x in points if y is not None for n, a, z, c, e in boxes
                  if a is not None and a <= y <= z and c <= x <= e)
    got = flights.tag_boxes(p, b)
    assert got.columns == ["id", "latitude", "longitude", "region"]
    assert sorted((r["id"], r["region"]) for r in got.collect()) == want
    assert flights.tag_boxes(p, b.limit(0)).count() == 0 and flights.tag_boxes(p.limit(0), b).count() == 0
