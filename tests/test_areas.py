"""Polygons of many corners, clusters of all classes, matching by bins, missing files and empty searches."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraloom.operators import compositing as C
from terraloom.operators import filters as O
from terraloom.operators import geometry as G
from terraloom.operators import matching as M
from terraloom.operators import spectra as X
from terraloom.sources import tables as S

RINGS = "area int, ring array<struct<x:double,y:double>>"


def star(n, cx, cy, low, high, seed):
    rng = random.Random(seed)
    return [(cx + (r := rng.uniform(low, high)) * math.cos(2 * math.pi * k / n), cy + r * math.sin(2 * math.pi * k / n)) for k in range(n)]


def inside(p, rings):
    odd = False
    for ring in rings:
        for a, b in zip(ring, ring[1:] + ring[:1], strict=True):
            if (a[1] > p[1]) != (b[1] > p[1]) and p[0] < (b[0] - a[0]) * (p[1] - a[1]) / (b[1] - a[1]) + a[0]:
                odd = not odd
    return odd


def test_parts_and_holes_of_many_corners(spark):
    rng = random.Random(1)
    areas = {1: [star(2_000, 0, 0, 50, 90, 2), star(500, 3, 4, 10, 30, 3)], 2: [star(300, 120, 10, 5, 25, 4), star(3, -150, 0, 20, 20, 5)]}
    frame = spark.createDataFrame([(k, [{"x": x, "y": y} for x, y in ring]) for k, rings in areas.items() for ring in rings], RINGS)
    pts = [(i, rng.uniform(-170, 170), rng.uniform(-100, 100)) for i in range(1_500)]
    points = spark.createDataFrame(pts, "pid long, x double, y double")
    got = {(r.x, r.y, r.area) for r in O.in_areas(points, frame, 0.5).collect()}
    assert got == {(x, y, k) for _, x, y in pts for k, rings in areas.items() if inside((x, y), rings)} and len(got) > 200
    assert {r.pid for r in O.clip_to_areas(points, frame, 0.5).collect()} == {i for i, x, y in pts if any(inside((x, y), rings) for rings in areas.values())}
    assert O.clip_to_areas(points, frame.limit(0), 0.5).count() == 0


def test_edges_and_corners_count_as_inside(spark):
    square = spark.createDataFrame([(1, [{"x": x, "y": y} for x, y in ((0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0))])], RINGS)
    pts = spark.createDataFrame([(1, 0.0, 0.0), (2, 4.0, 2.0), (3, 2.0, 4.0), (4, 2.0, 0.0), (5, 4.0, 4.0), (6, 4.0000001, 2.0), (7, 2.0, -0.1), (8, 0.0, 2.0)], "pid long, x double, y double")
    assert sorted(r.pid for r in O.clip_to_areas(pts, square, 1.0).collect()) == [1, 2, 3, 4, 5, 8]


def test_a_point_does_not_try_every_edge(spark):
    ring = [{"x": x, "y": y} for x, y in star(20_000, 0, 0, 50, 90, 6)]
    areas = spark.createDataFrame([(1, ring)], RINGS)
    points = spark.range(400).select((F.rand(1) * 180 - 90).alias("x"), (F.rand(2) * 180 - 90).alias("y"))
    found = O.in_areas(points, areas, 0.05)
    assert 50 < found.count() < 350
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert any("Join [_lv#" in line for line in plan.splitlines()) and "CartesianProduct" not in plan


def test_clusters_of_all_classes_at_once(spark):
    rng = np.random.default_rng(7)
    rows, true = [], {}
    for c in (10, 30, 50):
        for g in range(3):
            for _ in range(40):
                v = rng.normal(0, 0.05, 2) + [g * 3 + c, (g * 7) % 5]
                true[len(rows)] = (c, g)
                rows.append((len(rows), c, float(v[0]), float(v[1])))
    rows += [(1000, 70, 1.0, 1.0), (1001, 10, None, 1.0), (1002, 90, 5.0, 5.0)]
    pixels = spark.createDataFrame(rows, "pixel_id long, class int, a double, b double")
    labels, palette = M.cluster_classes(pixels, [10, 30, 50, 70], ["a", "b"], 3, 5)
    got = {r.pixel_id: (r["class"], r.cluster) for r in labels.collect()}
    assert got.keys() == {*range(360), 1000} and got[1000] == (70, 0)
    # a round of assignment and means changes nothing: each pixel has its nearest centre, in the standard scores of its class
    for c in (10, 30, 50):
        x = np.array([r[2:] for r in rows if r[1] == c and r[2] is not None])
        ids = [r[0] for r in rows if r[1] == c and r[2] is not None]
        z = (x - x.mean(0)) / x.std(0)
        own = np.array([got[i][1] for i in ids])
        centres = np.array([z[own == k].mean(0) for k in sorted(set(own))])
        assert (((z[:, None] - centres) ** 2).sum(2).argmin(1) == np.searchsorted(sorted(set(own)), own)).all()
        for k in set(own):
            vector = next(r.vector for r in palette.collect() if (r["class"], r.cluster) == (c, k))
            assert np.allclose(vector, x[own == k].mean(0))
    none, empty = M.cluster_classes(pixels, [123], ["a", "b"], 3, 5)
    assert none.count() == 0 and empty.count() == 0


def test_matching_by_bins_tries_few(spark):
    rng = np.random.default_rng(8)
    c, l = np.abs(rng.normal(size=(40, 4))), np.abs(rng.normal(size=(300, 4)))
    l[7] = 0
    clusters = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(c)], "cluster long, vector array<double>")
    library = spark.createDataFrame([(i, i % 150, v.tolist()) for i, v in enumerate(l)], "lib_pos long, material_id long, vector array<double>")
    out = {r.cluster: (r.material_id, r.angle) for r in X.match_sam(clusters, library, 9.0).collect()}
    for i, v in enumerate(c):
        with np.errstate(invalid="ignore"):
            angle = np.degrees(np.arccos(np.clip(l @ v / np.linalg.norm(l, axis=1) / np.linalg.norm(v), -1, 1)))
        best = int(np.nanargmin(angle))
        assert out[i][0] == (best % 150 if angle[best] <= 9 else None)
    assert any(m is None for m, _ in out.values()) and any(m is not None for m, _ in out.values())
    assert "CartesianProduct" not in X.match_sam(clusters, library, 9.0)._jdf.queryExecution().toString()


def test_missing_files_give_no_rows(spark, tmp_path):
    gone = f"file://{tmp_path}/gone"
    box = (0.0, 0.0, 9.0, 9.0)
    assert S.ways_scan(spark, gone).count() == 0 and S.ways_scan(spark, gone, lines=True).count() == 0
    assert S.read_roads(spark, gone).count() == 0 and S.footprints_scan(spark, [gone], box).count() == 0
    meta = S.instances_metadata(S.read_instances(spark, gone)).first()
    assert meta["count"] == 0 and meta.min_x is None
    spark.createDataFrame([(1, 1.0, 1.0, 2.0, 2.0)], "building_id long, xmin double, ymin double, xmax double, ymax double").write.parquet(f"file://{tmp_path}/here")
    assert S.footprints_scan(spark, [gone, f"file://{tmp_path}/here"], box).count() == 1
    with pytest.raises(ValueError, match="degrees"):
        S.footprints_scan(spark, [gone], box, epsg=32632)


def test_a_search_that_finds_nothing(spark):
    day = F.lit("2024-01-05").cast("date")
    at = lambda x, y: f"named_struct('x', {x}D, 'y', {y}D)"
    scenes = spark.sql(f"select 1 as scene_id, date'2024-01-06' as acq_date, 5.0D as cloud_cover, 'a' as collection, array({at(0, 0)}, {at(4, 0)}, {at(4, 4)}, {at(0, 4)}) as ring")
    near, far = G.polygon((3, 3), (9, 3), (9, 9)), G.polygon((5, 5), (9, 5), (9, 9))
    assert C.catalog_search(scenes, day, 3, 50.0, aoi=near, collection="a", must_hit=True).count() == 1
    assert C.catalog_search(scenes, day, 3, 50.0, aoi=far).count() == 0
    for bad in ({"aoi": far}, {"aoi": near, "collection": "b"}):
        with pytest.raises(ValueError, match="no scene"):
            C.catalog_search(scenes, day, 3, 50.0, must_hit=True, **bad)


def test_an_area_reads_its_folders_alone(spark, tmp_path):
    path = f"file://{tmp_path}/grid"
    grid = spark.range(64 * 64).selectExpr("id % 64 as ix", "id div 64 as iy", "id * 1.0D as elevation")
    S.write_grid(grid, path, 16)
    area = S.grid_area(spark, path, (3, 18, 20, 30), 16)
    assert area.count() == 18 * 13
    area.collect()
    scan = next(line for line in area._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line)
    assert "PartitionFilters: [" in scan and "PartitionFilters: []" not in scan
    assert "PushedFilters: [" in scan and "GreaterThanOrEqual(ix" in scan


def test_too_many_patterns_are_an_error(spark, monkeypatch):
    from terraloom.operators import joins as J

    monkeypatch.setattr(J, "MOST_PATTERNS", 1)
    rows = spark.createDataFrame([(0, "*1", False, "brick"), (1, "x", True, "wood")], "pos int, pattern string, is_regex boolean, material string")
    with pytest.raises(ValueError, match="patterns"):
        J.assign_materials(spark.createDataFrame([("a1", None)], "name string, own_material string"), rows)
