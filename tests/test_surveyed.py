"""Parts of surveyed operators that queries once left out."""

import math

from pyspark.sql import functions as F

from terraloom.functions import projection as P
from terraloom.operators import compositing as C
from terraloom.operators import joins as J
from terraloom.operators import sampling as SM
from terraloom.plans import QUERIES


def test_nearest_cell_takes_the_month(spark):
    obs = spark.createDataFrame([(1, 0.2, 0.9, "2024-03-05"), (2, 0.2, 0.9, "2024-12-31")], "pid int, x double, y double, ts string").withColumn("ts", F.to_timestamp("ts"))
    grid = spark.createDataFrame([(i, j, m, 100.0 * i + 10 * j + m) for i in (0, 1) for j in (0, 1) for m in range(1, 12)], "ix long, iy long, month int, v double")
    assert {r.pid: (r.x_cell, r.y_cell, r.month, r.v) for r in J.nearest_cell(obs, grid).collect()} == {1: (0, 1, 3, 13.0), 2: (0, 1, 12, None)}


def test_reflectance_inputs_list_what_they_skip(spark):
    measures = spark.createDataFrame([("a", 1, 1), ("b", 9, 1), ("c", 1, 9), ("d", None, 1), ("e", 2, 1), ("f", 3, 1)], "measure_id string, sensor_id int, irradiance_id int")
    radiance = spark.createDataFrame([(1, 400.0, 2.0), (1, 410.0, 3.0), (2, 500.0, 1.0), (3, 400.0, None)], "sensor_id int, w double, radiance double")
    irradiance = spark.createDataFrame([(1, 400.0, 4.0)], "irradiance_id int, w double, irradiance double")
    found, skipped = J.reflectance_inputs(measures, radiance, irradiance)
    assert [(r.measure_id, r.w, r.radiance, r.irradiance) for r in found.collect()] == [("a", 400.0, 2.0, 4.0)]
    assert {r.measure_id: r.reason for r in skipped.collect()} == {"b": "radiance", "c": "irradiance", "d": "ids", "e": "wavelengths", "f": "radiance"}


def test_catalog_search_leaves_scenes_off_the_area(spark):
    rows = [(1, 0.0, 0.0, 1.0, 1.0), (2, 5.0, 5.0, 6.0, 6.0), (3, 2.0, 2.0, 3.0, 3.0)]
    scenes = spark.createDataFrame(rows, "scene_id int, xmin double, ymin double, xmax double, ymax double").withColumns({"acq_date": F.lit("2024-01-05").cast("date"), "cloud_cover": F.lit(1.0)})
    day = F.lit("2024-01-05").cast("date")
    assert [r.scene_id for r in C.catalog_search(scenes, day, 1, 5.0, aoi=(1.0, 1.0, 2.5, 2.5)).collect()] == [1, 3]
    assert C.catalog_search(scenes, day, 1, 5.0).count() == 3


def test_utm_forward(spark):
    points = spark.createDataFrame([(0.0, 3.0), (45.0, 3.0), (-23.6, 15.1), (-23.59, 15.1), (-23.6, 15.11)], "lat double, lon double")
    at = lambda epsg: points.select(*(c.alias(k) for k, c in zip("en", P.utm_forward(F.col("lat"), F.col("lon"), epsg)))).collect()
    north, south = at(32631), at(32733)
    assert abs(north[0].e - 500_000) < 1e-6 and abs(north[0].n) < 1e-6 and abs(north[1].e - 500_000) < 1e-6
    # on the central meridian the northing is 0.9996 of the meridian's arc
    a, e2, steps = 6378137.0, (2 - 1 / 298.257223563) / 298.257223563, 20_000
    arc = sum(a * (1 - e2) / (1 - e2 * math.sin(math.radians(45 * (k + 0.5) / steps)) ** 2) ** 1.5 for k in range(steps)) * math.radians(45) / steps
    assert abs(north[1].n - 0.9996 * arc) < 1e-3
    # near points keep their distance in the scene projection but for the scale near the meridian
    scene = P.SceneProjection(-23.6, 15.1)
    local = points.select(*(c.alias(k) for k, c in zip("xy", scene.forward(F.col("lat"), F.col("lon"))))).collect()
    for k in (3, 4):
        metres = math.hypot(local[k].x, local[k].y)
        assert abs(math.hypot(south[k].e - south[2].e, south[k].n - south[2].n) / metres - 0.9996) < 1e-5


def test_reproject_goes_through_both_projections(spark):
    scene = P.SceneProjection(-23.6, 15.1)
    e, n = spark.range(1).select(*P.utm_forward(F.lit(-23.6), F.lit(15.1), 32733)).first()
    grid = spark.range(400).selectExpr("id % 20 as ix", "id div 20 as iy", "cast(id % 20 as double) as value").withColumn("value", F.when((F.col("ix") == 0) & (F.col("iy") == 0), F.lit(float("nan"))).otherwise(F.col("value")))
    cells = spark.createDataFrame([(0, 0.0, 0.0), (1, 20.0, 0.0), (2, 0.0, 1000.0), (3, -95.0, -95.0)], "k int, x double, y double")
    got = {r.k: r.value for r in SM.reproject_bilinear(grid, cells, scene, 32733, (e - 100.0, n - 100.0), 10.0).collect()}
    assert abs(got[0] - 10.0) < 1e-6 and abs(got[1] - 11.9992) < 1e-3 and got[2] is None and got[3] is None
    out = QUERIES["smp5_reproject_utm"](spark, "/root/testdata/sf0.01")
    assert out.count() == 64 * 64 and 3000 < out.where("v is not null").count() < 64 * 64
