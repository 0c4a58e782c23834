"""Scene-wide steps against worked cases."""

import pytest
from pyspark.sql import functions as F

from terraloom.functions import projection as P
from terraloom.operators import compositing as C
from terraloom.operators import scene as Z
from terraloom.operators import terrain as T
from terraloom.sources import tables as S

CENTRE = P.SceneProjection(45.0, 8.0)


def plane(spark, holes=()):
    """A source on degrees whose value is linear in latitude and longitude."""
    rows = [(i, j, 3.0 * i + 5.0 * j) for i in range(6) for j in range(6) if (i, j) not in holes]
    return spark.createDataFrame(rows, "ix long, iy long, v double")


def test_zone_grid_keeps_the_outer_centres(spark):
    xs = [r.x for r in Z.zone_grid(spark, 1.0, 300.0).where("iy = 0").orderBy("ix").collect()]
    assert xs == pytest.approx([-350.0, 0.0, 350.0])
    assert [r.x for r in Z.zone_grid(spark, 1.0, 900.0).collect()] == [-50.0]
    with pytest.raises(ValueError):
        Z.zone_grid(spark, 0.1, 900.0)


def test_regrid_carries_a_plane_on_beyond_the_source(spark):
    grid = Z.regrid_scene(plane(spark), CENTRE, 2.0, 250.0, (44.998, 7.998), (0.001, 0.001), "linear", "v")
    lat, lon = CENTRE.inverse(F.col("x"), F.col("y"))
    rows = grid.select("v", (3 * (lon - 7.998) / 0.001 + 5 * (lat - 44.998) / 0.001).alias("want"), ((lon < 7.998) | (lat > 45.003)).alias("out")).collect()
    assert len(rows) == 64 and any(r.out for r in rows)
    assert [r.v for r in rows] == pytest.approx([r.want for r in rows], abs=1e-6)


def test_regrid_fills_holes_and_holds_edges(spark):
    source = plane(spark, [(2, 2)]).withColumn("v", F.when(F.col("ix") == 0, F.lit(float("nan"))).otherwise(F.col("v")))
    linear = Z.regrid_scene(source, CENTRE, 2.0, 250.0, (44.998, 7.998), (0.001, 0.001), "linear", "v", -1.0)
    assert 0 < linear.where("v = -1").count() < 64 and linear.where("v is null or isnan(v)").count() == 0
    nearest = Z.regrid_scene(plane(spark), CENTRE, 2.0, 250.0, (44.998, 7.998), (0.001, 0.001), "nearest", "v")
    assert {r.v for r in nearest.collect()} <= {3.0 * i + 5.0 * j for i in range(6) for j in range(6)}
    with pytest.raises(ValueError):
        Z.regrid_scene(source, CENTRE, 2.0, 250.0, (0, 0), (1, 1), "cubic", "v")


def test_objects_by_degrees_and_by_metres(spark):
    dem = spark.createDataFrame([(i, j, 100.0 * i + j) for i in range(3) for j in range(3)], "ix long, iy long, elevation double")
    objects = spark.createDataFrame([(1, "geographic", 8.0, 45.0, 2.0), (2, "scene", 100.0, -100.0, None), (3, "scene", 9000.0, 0.0, 1.0), (4, None, 0.0, 100.0, 0.0)], "id int, coord_type string, c1 double, c2 double, elevation_offset double")
    out = {r.id: (round(r.x, 3), round(r.y, 3), r.z) for r in Z.place_objects(objects, dem, CENTRE, (-100.0, -100.0), 100.0).collect()}
    assert out == {1: (0.0, 0.0, 103.0), 2: (100.0, -100.0, 200.0), 3: (9000.0, 0.0, 202.0), 4: (0.0, 100.0, 102.0)}


def test_zones_leave_out_what_they_may_not_have(spark):
    layer = lambda name, rule: lambda g: g.where(rule).withColumn("material", F.lit(name))
    layers = {"base": layer("b", "true"), "snow": layer("s", "ix = 0"), "roads": layer("r", "iy = 0")}
    out = Z.zones_union(spark, {"target": (0.02, 10.0), "buffer": (0.04, 20.0), "background": (0.3, 100.0)}, layers)
    found = {(r.zone, r.ix, r.iy): r.material for r in out.collect()}
    assert len(found) == 4 + 4 + 9
    assert [found["target", *p] for p in ((0, 0), (1, 0), (0, 1), (1, 1))] == ["r", "r", "s", "b"]
    assert [found["buffer", *p] for p in ((0, 0), (1, 0), (0, 1), (1, 1))] == ["s", "b", "s", "b"]
    assert {m for (z, *_), m in found.items() if z == "background"} == {"b"}
    with pytest.raises(ValueError):
        Z.zones_union(spark, {"target": (1.0, 10.0)}, {"snow": layers["snow"]})


def test_cap_keeps_the_least_draws(spark):
    rows = spark.createDataFrame([(1, 0, 0.9), (2, 0, 0.1), (3, 0, 0.1), (4, 1, 0.5), (5, None, 0.2)], "pid int, px int, u double")
    assert {r.pid for r in Z.cap_per_pixel(rows, [F.col("px")], 2, F.col("u"), "pid").collect()} == {2, 3, 4, 5}


def test_series_without_a_part_are_listed(spark):
    part = spark.createDataFrame([(1, 0.5), (9, 0.1)], "series int, v double")
    series = spark.createDataFrame([(1, 10.0), (2, 20.0)], "series int, zenith double")
    found, missing = Z.combine_series([part], series)
    assert [(r.series, r.v, r.zenith) for r in found.collect()] == [(1, 0.5, 10.0)] and [r.series for r in missing.collect()] == [2]
    for parts in ([], [part.where("series = 9")]):
        with pytest.raises(ValueError):
            Z.combine_series(parts, series)


def test_composites_tell_what_they_lack(spark):
    rows = spark.createDataFrame([(1, 1.0), (2, None)], "pixel int, v double")
    _, covered, short = C.checked_composite(rows, "v", 0.6)
    assert (covered, short) == (0.5, True) and not C.checked_composite(rows, "v", 0.5)[2]
    for none in (rows.where("v is null"), rows.where("false")):
        with pytest.raises(ValueError):
            C.checked_composite(none, "v")


def test_refinement_follows_the_error(spark):
    pyramid = spark.createDataFrame([(0, 0, 0, 9.0), (1, 0, 0, 1.0), (1, 1, 0, 5.0), (1, 0, 1, 0.0), (1, 1, 1, 2.0)], "level long, i long, j long, error double")
    root = spark.createDataFrame([(0, 0, 0)], "level long, i long, j long")
    leaves = {tuple(r) for r in T.refine_cells(root, T.exceeding(pyramid, 2.0), 2).collect()}
    assert leaves == {(1, 0, 0), (1, 0, 1), (1, 1, 1), (2, 2, 0), (2, 2, 1), (2, 3, 0), (2, 3, 1)}


def test_result_metadata(spark, tmp_path):
    types = spark.createDataFrame([("uav",), ("uav",)], "type string")
    S.write_result(spark.range(1), str(tmp_path), "r", "brf", {"name": "n"}, types, types.limit(0))
    rows = [(r.key, r.value) for r in spark.read.parquet(f"{tmp_path}/meta").where("key <> 'created_at'").collect()]
    assert sorted(rows) == [("name", "n"), ("num_measurements", "0"), ("num_sensors", "2"), ("sensor_types", "uav"), ("sensor_types", "uav")]
    assert spark.read.parquet(f"{tmp_path}/meta").where("key = 'created_at'").count() == 1
