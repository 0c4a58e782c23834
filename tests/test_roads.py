"""Roads are written by segment and read back whole."""

import glob
import json

from terraloom.plans import QUERIES
from terraloom.sources import tables as S


def test_no_row_holds_a_whole_material(spark, tmp_path):
    path = f"file://{tmp_path}/roads"
    names = "case when id % 10 < 8 then 'hot' when id % 10 = 8 then '007' when id % 4 = 1 then '' end"
    segments = spark.range(5000).selectExpr("id div 2 as road_id", "cast(id % 2 as int) as seg", "id * 1.5D as x1", "0.0D as y1", "1.0D as x2", "id * 0.5D as y2", "3.0D as width", f"{names} as material").repartition(4)
    S.write_roads(segments, path)
    lines = [line for f in glob.glob(f"{tmp_path}/roads/layer=*/*.json") for line in open(f)]
    assert len(lines) == 5000 and max(map(len, lines)) < 300
    key = lambda r: (r.road_id, r.seg)
    want, got = (sorted(df.select("road_id", "seg", "x1", "y1", "x2", "y2", "width", "material").collect(), key=key) for df in (segments, S.read_roads(spark, path)))
    assert got == want


def test_files_of_a_row_a_material_are_still_read(spark, tmp_path):
    seg = {"road_id": 1, "seg": 0, "x1": 1.0, "y1": 2.0, "x2": 3.0, "y2": 4.0, "width": 5.0}
    (tmp_path / "old.json").write_text(json.dumps({"material": "a", "version": 1, "segments": [seg, seg | {"seg": 1}]}))
    assert sorted((r.road_id, r.seg, r.width, r.material) for r in S.read_roads(spark, f"file://{tmp_path}/old.json").collect()) == [(1, 0, 5.0, "a"), (1, 1, 5.0, "a")]


def test_ways_scan_reads_elements_by_line(spark, tmp_path):
    way = {"type": "way", "id": 7, "tags": {"highway": "path"}, "geometry": [{"lat": 1, "lon": 2}]}
    (tmp_path / "ways.json").write_text("\n".join([json.dumps(way), json.dumps(way | {"type": "node", "id": 8}), "{not json", json.dumps(way | {"id": 9})]))
    assert sorted(r.way_id for r in S.ways_scan(spark, f"file://{tmp_path}/ways.json", lines=True).collect()) == [7, 9]


def test_src7_reads_through_the_operator(spark, monkeypatch):
    calls, scan = [], S.ways_scan
    monkeypatch.setattr(S, "ways_scan", lambda *a, **k: calls.append(k) or scan(*a, **k))
    QUERIES["src7_ways_scan"](spark, "/root/testdata/sf0.001")
    assert calls == [{"lines": True}]


def bent(spark, *lines):
    from terraloom.operators.roads import with_next

    rows = [(k, i, *map(float, (*a, *b))) for k, nodes in enumerate(lines) for i, (a, b) in enumerate(zip(nodes, nodes[1:], strict=False))]
    return with_next(spark.createDataFrame(rows, "way_id long, seg long, x1 double, y1 double, x2 double, y2 double"), "way_id")


def test_a_right_angle_is_painted_excluded_and_flattened_without_a_notch(spark):
    from pyspark.sql import functions as F

    from terraloom.operators import joins as J
    from terraloom.operators import terrain as T

    road = bent(spark, [(2, 10), (20, 10), (20, 30)]).withColumns({"width_m": F.lit(8.0), "layer": F.lit(1)})
    pts = spark.createDataFrame([(1, 22.0, 8.0), (2, 23.5, 6.5), (3, 22.0, 29.9), (4, 22.0, 30.1), (5, 1.9, 10.0), (6, 24.0, 10.0)], "pid long, x double, y double")
    # (23.5, 6.5) is 4.95 m from the bend, the ends are flat
    assert sorted(r.pid for r in J.exclude_roads(pts, road, 0.0, 2.0).collect()) == [2, 4, 5]
    painted = {(r.ix, r.iy) for r in T.rasterize_roads(road, 40, 40).collect()}
    assert {(21, 7), (22, 7)} <= painted and (23, 6) not in painted and (24, 5) not in painted
    narrow = road.withColumns({"pos": F.lit(0), "z0": F.lit(100.0)})
    ground = spark.createDataFrame([(1, 17.0, 13.0, 50.0), (2, 22.0, 8.0, 50.0), (3, 24.0, 6.0, 50.0), (4, 20.5, 9.5, 50.0)], "pid long, x double, y double, z double")
    z = {r.pid: r.z for r in T.flatten_under_roads(ground, narrow, F.lit(1.0), 4.0, F.col("z0"), 2.0).collect()}
    assert abs(z[1] - 75.0) < 1e-9  # 3 m off: blended by a half, once
    assert abs(z[2] - (50 + 50 * (1 - (8**0.5 - 1) / 4))) < 1e-9 and z[3] == 50.0 and z[4] == 100.0


def test_bends_against_a_dense_outline(spark):
    """Footprints of crooked lines: a point is on the road if it is near enough to the line and not beyond a flat end."""
    import random

    from pyspark.sql import functions as F

    from terraloom.operators import joins as J

    rng = random.Random(2)
    lines = [[(rng.uniform(0, 40), rng.uniform(0, 40)) for _ in range(rng.randrange(2, 6))] for _ in range(8)]
    pts = [(i, rng.uniform(-5, 45), rng.uniform(-5, 45)) for i in range(1500)]
    h = 1.7

    def on(p, line):
        best = None
        for k, (a, b) in enumerate(zip(line, line[1:], strict=False)):
            dx, dy = b[0] - a[0], b[1] - a[1]
            t = ((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / (dx * dx + dy * dy)
            c = max(0.0, min(1.0, t))
            d = ((p[0] - a[0] - c * dx) ** 2 + (p[1] - a[1] - c * dy) ** 2) ** 0.5
            past = (t < 0 and k == 0) or (t > 1 and k == len(line) - 2)
            if d <= h and not past and (0 <= t <= 1 or (t > 1 and beyond(p, line, k))):
                best = True
        return best

    def beyond(p, line, k):
        b, c = line[k + 1], line[k + 2]
        return (p[0] - b[0]) * (c[0] - b[0]) + (p[1] - b[1]) * (c[1] - b[1]) <= 0

    want = {i for i, *p in pts if not any(on(p, line) for line in lines)}
    road = bent(spark, *lines).withColumn("width_m", F.lit(2 * h))
    got = {r.pid for r in J.exclude_roads(spark.createDataFrame(pts, "pid long, x double, y double"), road, 0.0, 3.0).collect()}
    assert got == want and 0 < len(want) < len(pts)


def test_lines_that_part_have_no_joint(spark):
    from terraloom.operators.roads import with_next

    rows = [(1, 0, 0.0, 0.0, 5.0, 0.0), (1, 1, 5.0, 0.0, 5.0, 0.0), (1, 2, 5.0, 0.0, 5.0, 5.0), (1, 3, 9.0, 9.0, 9.0, 12.0), (2, 0, 9.0, 12.0, 1.0, 1.0)]
    out = {(r.way_id, r.seg): (r.next_x, r.next_y) for r in with_next(spark.createDataFrame(rows, "way_id long, seg long, x1 double, y1 double, x2 double, y2 double"), "way_id").collect()}
    assert out == {(1, 0): (0.0, 1.0), (1, 2): (None, None), (1, 3): (None, None), (2, 0): (None, None)}
