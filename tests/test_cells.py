"""Cells of many levels: boxes of any size take a few rows each."""

import random

from pyspark.sql import functions as F

from terraloom.functions.projection import SceneProjection
from terraloom.operators import geometry as G
from terraloom.operators import joins as J
from terraloom.operators import terrain as T

BOX = ("xmin", "ymin", "xmax", "ymax")
NO_RING = "cast(null as array<struct<x:double,y:double>>) as ring"


def boxes(spark, n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        w, h = 10 ** rng.uniform(-2, 5), 10 ** rng.uniform(-2, 5)
        x, y = rng.uniform(-1e4, 1e4), rng.uniform(-1e4, 1e4)
        rows.append((i, x, y, x + w, y + h))
    return rows, spark.createDataFrame(rows, "id long, xmin double, ymin double, xmax double, ymax double")


def test_a_box_takes_few_cells(spark):
    rows, frame = boxes(spark, 300, 1)
    n = {r.id: r["count"] for r in G.covering_cells(frame, 2.0, tuple(map(F.col, BOX))).groupBy("id").count().collect()}
    assert len(n) == 300 and max(n.values()) <= 4


def test_points_find_boxes_of_every_size(spark):
    rng = random.Random(3)
    rows, frame = boxes(spark, 60, 2)
    rows = [r for r in rows if r[3] - r[1] < 2e4]
    frame = frame.where("xmax - xmin < 2e4")
    pts = [(i, rng.uniform(-1e4, 1e4), rng.uniform(-1e4, 1e4)) for i in range(500)] + [(1000 + i, r[1], r[4]) for i, r in enumerate(rows)]
    p = spark.createDataFrame(pts, "pid long, x double, y double")
    hit = F.col("a.x").between(F.col("b.xmin"), F.col("b.xmax")) & F.col("a.y").between(F.col("b.ymin"), F.col("b.ymax"))
    got = {r.pid for r in G.outside(p, frame, 2.0, tuple(map(F.col, BOX)), hit).collect()}
    assert got == {i for i, x, y in pts if not any(r[1] <= x <= r[3] and r[2] <= y <= r[4] for r in rows)} and 0 < len(got) < len(pts)


def test_boxes_meet_once(spark):
    a, left = boxes(spark, 80, 4)
    b, right = boxes(spark, 80, 5)
    left = left.toDF("aid", "x0", "y0", "x1", "y1")
    got = G.meeting_boxes(left, right, 2.0, ("x0", "y0", "x1", "y1"), BOX).select("aid", "id").collect()
    want = [(p[0], q[0]) for p in a for q in b if p[1] <= q[3] and q[1] <= p[3] and p[2] <= q[4] and q[2] <= p[4]]
    assert sorted((r.aid, r.id) for r in got) == sorted(want) and len(want) > 100
    some = G.meeting_boxes(left, right, 2.0, ("x0", "y0", "x1", "y1"), BOX, "left_semi").select("aid").distinct()
    assert {r.aid for r in some.collect()} == {p for p, _ in want}


def test_one_zone_over_the_whole_scene(spark):
    """A zone of 50 km and small ones on cells of 2 m."""
    zones = spark.createDataFrame([("box", 0.0, 0.0, None, 50_000.0, 100.0), ("circle", 9.0, 9_000.0, 3.0, None, None)], "kind string, cx double, cy double, r double, w double, h double").selectExpr("*", NO_RING)
    pts = spark.createDataFrame([(1, 24_999.0, 49.0), (2, 24_999.0, 51.0), (3, 9.0, 9_003.0), (4, 9.0, 9_003.1)], "pid long, x double, y double")
    assert sorted(r.pid for r in J.exclude_zones(pts, zones, 2.0).collect()) == [2, 4]
    bounds = (F.lit(-25_000.0), F.lit(-50.0), F.lit(25_000.0), F.lit(50.0))
    assert G.covering_cells(zones.where("kind = 'box'"), 2.0, bounds).count() <= 4
    assert J.exclude_zones(pts, zones.limit(0), 2.0).count() == 4
    whole = spark.createDataFrame([(-1e6, -1e6, 1e6, 1e6)], "xmin double, ymin double, xmax double, ymax double")
    root = spark.createDataFrame([(0, 0, 0)], "level long, i long, j long")
    assert T.refine_cells(root, T.meeting_zones(64.0, whole, 0.01), 3).count() == 64
    assert T.refine_cells(root, T.meeting_zones(64.0, whole.limit(0), 0.01), 3).count() == 1


def test_zones_in_degrees(spark):
    scene = SceneProjection(45.0, 8.0)
    ring = "array(named_struct('x', 7.99D, 'y', 44.99D), named_struct('x', 8.01D, 'y', 44.99D), named_struct('x', 8.0D, 'y', 45.01D)) as ring"
    geo = spark.sql(f"select 'polygon' as kind, 'geographic' as coord_type, 0.0D as cx, 0.0D as cy, 0.0D as r, 0.0D as w, 0.0D as h, {ring} union all select 'circle', 'geographic', 8.05D, 45.0D, 100.0D, 0.0D, 0.0D, null union all select 'box', 'scene', -900.0D, -2000.0D, 0.0D, 50.0D, 60.0D, null")
    out = J.zones_in_scene(geo, scene)
    x, y = scene.forward(F.lit(45.0), F.lit(8.05))
    far = spark.range(1).select(x.alias("x"), y.alias("y")).first()
    pts = spark.createDataFrame([(1, 0.0, 0.0), (2, far.x + 99.0, far.y), (3, far.x + 101.0, far.y), (4, -900.0, -1971.0), (5, -700.0, 1000.0)], "pid long, x double, y double")
    assert sorted(r.pid for r in J.exclude_zones(pts, out, 100.0).collect()) == [3, 5]
