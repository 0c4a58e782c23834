"""Operators without SQL, edge cases, and values known in closed form."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraloom.functions import projection as P
from terraloom.functions import scalars as S
from terraloom.operators import aggregates as A
from terraloom.operators import compositing as C
from terraloom.operators import geometry as G
from terraloom.operators import joins as J
from terraloom.operators import matching as M
from terraloom.operators import sampling as SM
from terraloom.operators import terrain as T
from terraloom.operators import vegetation as V
from terraloom.plans import QUERIES
from terraloom.sources import tables as S_IO
from terraloom.session import shared_path

FOLDER = "/root/testdata/sf0.001"


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_projection_round_trip_and_distance(spark):
    p = P.SceneProjection(-23.6, 15.1)
    pts = spark.createDataFrame([(-23.6, 15.1), (-23.5, 15.2), (-23.9, 14.8)], "lat double, lon double")
    x, y = p.forward(F.col("lat"), F.col("lon"))
    xy = pts.select("lat", "lon", x.alias("x"), y.alias("y"))
    lat, lon = p.inverse(F.col("x"), F.col("y"))
    out = xy.select("lat", "lon", "x", "y", lat.alias("a"), lon.alias("b")).collect()
    assert abs(out[0].x) < 1e-6 and abs(out[0].y) < 1e-6
    for r in out:
        assert abs(r.lat - r.a) < 1e-9 and abs(r.lon - r.b) < 1e-9
    # a tenth of a degree north of the centre is some 11.08 km at this latitude
    assert 11_000 < out[1].y < 11_150 and 10_100 < out[1].x < 10_250


def test_place_in_pixel_keeps_spacing_and_repeats(spark):
    a = QUERIES["gen3_place_in_pixel"](spark, FOLDER).toPandas()
    b = QUERIES["gen3_place_in_pixel"](spark, FOLDER).repartition(3).toPandas()
    key = ["ix", "iy", "species", "k"]
    assert a.sort_values(key).reset_index(drop=True).equals(b.sort_values(key).reset_index(drop=True))
    for _, g in a.groupby(["ix", "iy", "species"]):
        p = g[["x", "y"]].to_numpy()
        d = np.hypot(*(p[:, None] - p[None]).transpose(2, 0, 1)) + np.eye(len(p)) * 99
        assert d.min() >= 3.0
        assert (np.abs(p[:, 0] - g.ix.iloc[0] * 20 - 10) <= 10).all()


def test_min_spacing_is_the_greedy_result(spark):
    pts = spark.range(400).selectExpr("id as pid", "(id * 7919 % 640) / 100.0D as x", "(id * 104729 % 640) / 100.0D as y")
    from terraloom.functions.keyed import draw

    order = sorted((r.u, r.pid, r.x, r.y) for r in pts.withColumn("u", draw(1, "pid")).collect())
    kept = []
    for _, pid, x, y in order:
        if all((x - a) ** 2 + (y - b) ** 2 >= 0.5**2 for _, a, b in kept):
            kept.append((pid, x, y))
    assert sorted(r.pid for r in V.min_spacing(pts, 0.5, 1).collect()) == sorted(k[0] for k in kept)
    assert V.min_spacing(pts, 0.0, 1).count() == 400


def test_balanced_cells_cover_and_differ_by_one(spark):
    cells = [(r.level, r.i, r.j) for r in QUERIES["gen12_balance_cells"](spark, "/root/testdata/sf0.01").collect()]
    assert abs(sum(4.0**-l for l, _, _ in cells) - 1) < 1e-12
    level = np.zeros((32, 32), int)
    for l, i, j in cells:
        n = 32 >> l
        level[i * n : (i + 1) * n, j * n : (j + 1) * n] = l
    assert np.abs(np.diff(level, axis=0)).max() <= 1 and np.abs(np.diff(level, axis=1)).max() <= 1


def test_clusters_have_distinct_palettes(spark):
    rows = [(i, 10, 0.1 + 0.5 * (i % 2) + 0.001 * i, 0.2, 0.3, 0.4) for i in range(40)] + [(99, 20, 0.1, 0.1, 0.1, 0.1), (98, 10, float("nan"), 0.1, 0.1, 0.1)]
    pixels = spark.createDataFrame(rows, "pixel_id long, class int, b02 double, b03 double, b04 double, b08 double")
    labels, palette = M.cluster_class(pixels, 10, ["b02", "b03", "b04", "b08"], 2, 1)
    by = {r.pixel_id: r.cluster for r in labels.collect()}
    assert by[99] == -1 and by[98] == -1
    assert len({by[i] for i in range(0, 40, 2)}) == 1 and by[0] != by[1]
    assert palette.count() == 2


def test_vegetation_avoids_zones(spark):
    from terraloom.plans.views import view

    plants = QUERIES["gen13_vegetation"](spark, FOLDER).toPandas()
    zones = view(spark, FOLDER, "v_zones").where("radius > 0").collect()
    assert len(plants) > 0 and len(zones) > 3
    for z in zones:
        assert ((plants.x - z.cx) ** 2 + (plants.y - z.cy) ** 2 > z.radius**2).all()
    free = view(spark, FOLDER, "v_landcover").where("class in (10, 20, 30)").count()
    assert plants[["x", "y"]].drop_duplicates().shape[0] > free / 10  # the zones leave most of the scene to them


def test_diversified_pixels_take_new_indices(spark):
    painted = QUERIES["gen10_diversify"](spark, FOLDER)
    assert painted.where("idx > 1").count() > 0


def test_parse_height_cases(spark):
    cases = {"HHT:12.5": (12.5, True), "H:4": (12.0, True), "HBET:2-4": (9.0, True), "HHT:x+H:2": (6.0, True), "H:2+HHT:7": (7.0, True), "": (3.0, False), "12": (3.0, False), "HBET:3": (3.0, False), "HAPP:5": (15.0, True)}
    df = spark.createDataFrame([(k,) for k in [*cases]] + [(None,)], "h string")
    m, ok = S.parse_height(F.col("h"))
    out = {r.h: (r.m, r.ok) for r in df.select("h", m.alias("m"), ok.alias("ok")).collect()}
    assert out == cases | {None: (3.0, False)}


def test_parse_width_cases(spark):
    df = spark.createDataFrame([("5.5",), ("5 m",), ("5.5m",), (" 4 M ",), ("wide",), ("",)], "w string")
    assert [r[0] for r in df.select(S.parse_width(F.col("w"))).collect()] == [5.5, 5.0, 5.5, 4.0, None, None]


def test_road_overrides_and_surfaces(spark):
    ways = spark.createDataFrame([(1, "track", "7", None, None, None), (2, "track", None, None, "grass", None), (3, "odd", None, None, "moon", "yes")], "way_id long, highway string, width string, lanes string, surface string, oneway string")
    over = spark.createDataFrame([("track", 9.0, None, None, "concrete")], "highway string, total_width_m double, lane_count int, lane_width_m double, default_material string")
    out = {r.way_id: (r.width_m, r.material) for r in S.road_attributes(ways, over).collect()}
    assert out == {1: (9.0, "concrete"), 2: (9.0, "grassland"), 3: (4.0, "asphalt")}


def test_point_in_polygon_counts_the_ring(spark):
    ring = G.polygon((0, 0), (4, 0), (4, 4), (0, 4))
    df = spark.createDataFrame([(2.0, 2.0), (0.0, 2.0), (4.0, 4.0), (5.0, 2.0)], "x double, y double")
    assert [r[0] for r in df.select(G.in_polygon(F.col("x"), F.col("y"), ring)).collect()] == [True, True, True, False]


def test_outside_modes(spark):
    dem = spark.createDataFrame([(i, j, 10.0 * i + j) for i in range(3) for j in range(3)], "ix long, iy long, elevation double")
    pts = spark.createDataFrame([(1, 0.5, 0.5), (2, 9.0, 1.0), (3, 2.0, 2.0)], "pid long, x double, y double")
    at = lambda m: {r.pid: r.z for r in SM.sample_bilinear(pts, dem, m).collect()}
    assert at("drop") == {1: 5.5, 3: 22.0}
    assert at("zero") == {1: 5.5, 2: 0.0, 3: 22.0}
    assert at("clamp") == {1: 5.5, 2: 21.0, 3: 22.0}


def test_plane_has_no_error_and_slope_is_known(spark):
    dem = spark.createDataFrame([(i, j, 3.0 * i - 4.0 * j) for i in range(8) for j in range(8)], "ix long, iy long, elevation double")
    assert max(r.error for r in A.error_pyramid(dem, 2, 8, 8).collect()) < 1e-9
    assert {round(r.slope, 9) for r in SM.slope(dem).collect()} == {5.0}


def test_mosaic_reports_conflicts(spark):
    t = spark.createDataFrame([(0, 0, 1.0), (0, 0, 1.0), (1, 0, 1.0), (1, 0, 2.0), (2, 0, None)], "ix long, iy long, v double")
    merged, bad = C.mosaic_tiles(t, ["ix", "iy"], "v", 7.0)
    assert {(r.ix, r.v) for r in merged.collect()} == {(0, 1.0), (1, 2.0), (2, 7.0)}
    assert [r.ix for r in bad.collect()] == [1]


def test_indices_run_out(spark):
    base = spark.createDataFrame([("a", 254)], "name string, idx int")
    names = spark.createDataFrame([("b",), ("a",)], "name string")
    assert {r.name: r.idx for r in A.allocate_indices(base, names).collect()} == {"a": 254, "b": 255}
    with pytest.raises(Exception, match="no index left"):
        A.allocate_indices(base, spark.createDataFrame([("b",), ("c",)], "name string")).collect()


def test_line_that_comes_back_falls_in_pieces(spark):
    line = spark.createDataFrame([(1, [(1.0, 1.0), (3.0, 1.0), (3.0, 9.0), (1.0, 9.0)])], "way_id long, nodes array<struct<x:double,y:double>>")
    out = T.split_roads(line, (0.0, 0.0, 2.0, 10.0)).collect()
    assert sorted((r.piece, r.seg) for r in out) == [(1, 0), (2, 2)]
    assert {(r.cx1, r.cx2) for r in out} == {(1.0, 2.0), (2.0, 1.0)}


def test_roads_end_flat(spark):
    pts = spark.createDataFrame([(1, 5.0, 0.9), (2, 10.4, 0.0), (3, 11.2, 0.0), (4, 10.4, 1.2)], "pid long, x double, y double")
    seg = spark.createDataFrame([(0.0, 0.0, 10.0, 0.0, 2.0)], "x1 double, y1 double, x2 double, y2 double, width_m double")
    assert sorted(r.pid for r in J.exclude_roads(pts, seg, 0.5, 4.0).collect()) == [3]
    assert J.exclude_roads(pts, seg, 0.5, 4.0, enabled=False).count() == 4


def test_smoothing_keeps_a_constant(spark):
    g = spark.createDataFrame([(i, j, 2.5) for i in range(5) for j in range(4)], "ix long, iy long, p double")
    assert {round(r.p, 9) for r in A.smooth(g, 3.0, 5, 4).collect()} == {2.5}
    assert A.smooth(g, 0.0, 5, 4) is g


def test_poisson_matches_its_distribution(spark):
    out = spark.range(4000).select(V.poisson(F.lit(1.7), (F.col("id") + 0.5) / 4000, 20).alias("n")).groupBy("n").count().collect()
    for r in out:
        assert abs(r["count"] / 4000 - math.exp(-1.7) * 1.7 ** r.n / math.factorial(r.n)) < 1e-3


def test_spectral_angle_of_nothing(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 1.0]), ([1.0, 0.0], [0.0, 1.0]), ([2.0, 2.0], [1.0, 1.0])], "a array<double>, b array<double>")
    assert [round(r[0], 6) for r in df.select(P.spectral_angle(F.col("a"), F.col("b"))).collect()] == [round(math.pi / 2, 6), round(math.pi / 2, 6), 0.0]


def test_grid_scan_pushes_the_filter(spark):
    path = shared_path(spark, "pushed")
    spark.range(1000).selectExpr("id as ix", "id % 10 as iy", "id * 1.0D as value", "id as other").write.parquet(path)
    plan = S_IO.grid_scan(spark, path).where("ix between 3 and 9")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(ix), GreaterThanOrEqual(ix,3), LessThanOrEqual(ix,9)]" in plan
    assert "other" not in plan.split("ReadSchema")[-1]


def test_spatial_joins_are_equi_joins(spark):
    plan = QUERIES["jon3_exclude_zones"](spark, FOLDER)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_malformed_and_old_files_give_no_rows(spark, tmp_path):
    bad = tmp_path / "bad.json"
    bad.write_text("{not json")
    assert S_IO.ways_scan(spark, f"file://{bad}").count() == 0
    good = tmp_path / "ways.json"
    good.write_text('{"elements": [{"type": "way", "id": 7, "tags": {"highway": "path"}, "geometry": [{"lat": 1, "lon": 2}]}, {"type": "node", "id": 8}]}')
    assert [r.way_id for r in S_IO.ways_scan(spark, f"file://{good}").collect()] == [7]
    old = tmp_path / "roads.json"
    old.write_text('{"material": "a", "version": 2, "segments": []}')
    assert S_IO.read_roads(spark, f"file://{old}").count() == 0


def test_stream_of_scenes(spark, tmp_path):
    from terraloom.streaming.composites import stream_daily_mosaic

    folder = f"file://{tmp_path}/in"
    rows = [("2024-01-01 10:00:00", 2, 1, 5.0), ("2024-01-01 09:00:00", 1, 1, None), ("2024-01-01 11:00:00", 3, 1, 9.0), ("2024-01-09 00:00:00", 4, 1, 1.0)]
    df = spark.createDataFrame(rows, "ts string, scene_id int, pixel int, v double").withColumn("ts", F.to_timestamp("ts"))
    df.coalesce(1).write.parquet(folder)
    stream = stream_daily_mosaic(spark.readStream.schema(df.schema).parquet(folder), "ts", "scene_id", ["pixel"], "v")
    q = stream.writeStream.format("memory").queryName("daily").outputMode("append").option("checkpointLocation", f"file://{tmp_path}/c").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert [(str(r.acq_date), r.v) for r in spark.table("daily").collect()] == [("2024-01-01", 5.0)]


def test_crossing_tiles_and_no_hit(spark):
    select_tiles = J.select_tiles
    at = lambda x, y: {"x": float(x), "y": float(y)}
    bar = [at(0, 4), at(10, 4), at(10, 6), at(0, 6)]
    far = [at(20, 20), at(21, 20), at(21, 21), at(20, 21)]
    touching = [at(6, 9), at(8, 9), at(8, 11), at(6, 11)]
    index = spark.createDataFrame([("bar", bar), ("far", far), ("touching", touching)], "path string, ring array<struct<x:double,y:double>>")
    upright = G.polygon((4, 0), (6, 0), (6, 10), (4, 10))
    assert {r.path for r in select_tiles(index, upright, must_hit=True).collect()} == {"bar", "touching"}
    away = G.polygon((-9, -9), (-8, -9), (-8, -8))
    assert select_tiles(index, away).isEmpty()
    with pytest.raises(ValueError):
        select_tiles(index, away, must_hit=True)


def test_numeric_heights(spark):
    m, ok = S.parse_height(F.col("h"))
    for kind, values in (("double", [12.5, 0.0, -3.0, None, float("nan"), float("inf")]), ("int", [7, 0, None]), ("string", ["12.5", "H:2", "nan"])):
        got = {r.h if r.h == r.h else "nan": (r.m, r.ok) for r in spark.createDataFrame([(v,) for v in values], f"h {kind}").select("h", m.alias("m"), ok.alias("ok")).collect()}
        told = {"double": {12.5: 12.5}, "int": {7: 7.0}, "string": {"H:2": 6.0}}[kind]
        assert got == {(v if v == v else "nan"): (told.get(v, 3.0), v in told) for v in values}
