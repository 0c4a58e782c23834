"""Many rows at few places: pairs of copies are never written or compared."""

import numpy as np
from pyspark.sql import functions as F


def stages(spark, field):
    """The most of a figure (records written or shuffled) that a stage has so far, by stage."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    none = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0)
    seq = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, none, None)
    return {(s.stageId(), s.attemptId()): getattr(s, field)() for s in (seq.apply(i) for i in range(seq.size()))}


def most(spark, field, work):
    before = stages(spark, field)
    out = work()
    return max((n for k, n in stages(spark, field).items() if k not in before), default=0), out


def test_spacing_of_dense_points_writes_no_pairs(spark):
    from terraloom.functions.keyed import draw
    from terraloom.operators.vegetation import min_spacing

    rng = np.random.default_rng(4)
    places = rng.uniform(0, 3, (700, 2))
    pts = spark.createDataFrame([(i, *map(float, places[i % 700])) for i in range(2100)], "pid long, x double, y double")
    odd = spark.createDataFrame([(5000, None, 1.0), (5001, float("nan"), 1.0)], "pid long, x double, y double")
    written, got = most(spark, "outputRecords", lambda: {r.pid for r in min_spacing(pts.unionByName(odd), 0.5, 6).collect()})
    order = [(r._u, r.pid, r.x, r.y) for r in pts.withColumn("_u", draw(6, "pid")).collect()]
    kept = []
    for _, pid, x, y in sorted(order):
        if all((x - a) ** 2 + (y - b) ** 2 >= 0.25 for _, a, b in kept):
            kept.append((pid, x, y))
    assert got == {k[0] for k in kept} | {5000, 5001} and 10 < len(kept) < 100
    assert written <= 2100  # pairs that are too near are 164,694


def test_nearest_of_one_long_series_reads_each_row_once(spark):
    from terraloom.operators.joins import nearest_by

    rng = np.random.default_rng(9)
    at = [int(t) for t in rng.choice(4000, 900, replace=False)]
    left = spark.createDataFrame([(i, int(t)) for i, t in enumerate(rng.integers(0, 4000, 600))], "id long, t long")
    right = spark.createDataFrame([(t, float(i) if i % 7 else None) for i, t in enumerate(at)], "t long, v double")
    known = sorted((t, float(i)) for i, t in enumerate(at) if i % 7)
    for by in (None, ["g"]):
        a, b = (x.withColumn("g", F.lit(1)) for x in (left, right))
        out = nearest_by(a, b, "t", "v", by)
        assert {r.id: r.value for r in out.collect()} == {r.id: min(known, key=lambda k: (abs(k[0] - r.t), k[0]))[1] for r in left.collect()}
        frames = out._jdf.queryExecution().optimizedPlan().toString()
        assert "currentrow$(), unboundedfollowing$()" not in frames  # such a frame is read anew for each row


def test_points_at_one_place_are_flattened_once(spark):
    from terraloom.operators.terrain import flatten_under_roads

    rng = np.random.default_rng(7)
    roads = [(k, *map(float, rng.uniform(0, 20, 4)), float(rng.uniform(0, 9))) for k in range(200)]
    places = [tuple(map(float, p)) for p in rng.uniform(0, 20, (20, 2))]
    rows = [(i, *places[i % 20], 50.0 if i % 3 else None) for i in range(2000)] + [(9000, None, 1.0, 7.0)]
    pts, on = spark.createDataFrame(rows, "pid long, x double, y double, z double"), spark.createDataFrame(roads, "pos long, x1 double, y1 double, x2 double, y2 double, z0 double")
    sent, got = most(spark, "shuffleWriteRecords", lambda: {r.pid: r.z for r in flatten_under_roads(pts, on, F.lit(3.0), 2.0, F.col("z0"), 2.0).collect()})

    def blended(x, y, z):
        for _, x1, y1, x2, y2, z0 in roads:
            n = (x2 - x1) ** 2 + (y2 - y1) ** 2
            t = ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / n
            d = np.hypot(x - x1 - t * (x2 - x1), y - y1 - t * (y2 - y1))
            if 0 <= t <= 1 and d <= 5:
                a = 1.0 if d <= 3 else 1 - (d - 3) / 2
                z = a * z0 + (1 - a) * z
        return z

    for pid, x, y, z in rows:
        want = z if x is None or z is None else blended(x, y, z)
        assert got[pid] == want or abs(got[pid] - want) < 1e-9
    assert sent < 20_000  # a pair of point and road each would be over 60,000


def test_road_cells_follow_the_road_and_miss_no_point(spark):
    from terraloom.operators.geometry import strip_cells, strip_levels
    from terraloom.operators.joins import exclude_roads

    rng = np.random.default_rng(8)
    lines = [(*a, *(a + rng.uniform(-1, 1, 2) * s), w) for a, s, w in zip(rng.uniform(-30, 30, (60, 2)), [0.5, 8, 60] * 20, rng.uniform(0.05, 0.6, 60), strict=True)] + [(3.0, 3.0, 3.0, 3.0, 0.5), (0.0, 0.0, 8.0, 6.0, 0.1)]
    lines = [tuple(map(float, line)) for line in lines]
    roads = spark.createDataFrame(lines * 3, "x1 double, y1 double, x2 double, y2 double, width_m double")
    ends, reach = tuple(F.col(c) for c in ("x1", "y1", "x2", "y2")), F.col("width_m") / 2 + 0.3
    one = roads.where("x2 = 8 and y2 = 6").distinct()
    assert strip_levels(one, 2.0, ends, reach) == [0] and strip_cells(one, 2.0, ends, reach, 0).count() <= 14
    pts = [(i, *map(float, p)) for i, p in enumerate(rng.uniform(-40, 40, (1500, 2)))]
    pts += [(i + 1500, x, y) for i, x, y in pts[:500]] + [(5000, None, 0.0), (5001, 3.0, 3.1)]
    got = {r.pid for r in exclude_roads(spark.createDataFrame(pts, "pid long, x double, y double"), roads, 0.3, 2.0).collect()}

    def off(x, y):
        for x1, y1, x2, y2, w in lines:
            n = np.hypot(x2 - x1, y2 - y1)
            if n == 0:
                if np.hypot(x - x1, y - y1) <= w / 2 + 0.3:
                    return False
                continue
            t = ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / (n * n)
            side = abs((x - x1) * (y2 - y1) - (y - y1) * (x2 - x1)) / n
            if np.hypot(max(0, -t * n, (t - 1) * n), max(0, side - w / 2)) <= 0.3:
                return False
        return True

    want = {i for i, x, y in pts if x is None or off(x, y)}
    assert got == want and 100 < len(want) < len(pts) - 100


def test_equal_boxes_are_counted_as_one(spark):
    from terraloom.operators.geometry import count_meeting

    rng = np.random.default_rng(3)
    box = lambda: (lambda p, s: (*map(float, p), *map(float, p + s)))(rng.integers(0, 30, 2), rng.integers(0, 9, 2))
    few, many = [box() for _ in range(12)], [box() for _ in range(40)]
    zones, ways = [(i, *few[i % 12]) for i in range(400)], [(i, *many[i % 40]) for i in range(800)] + [(900, None, 0.0, 5.0, 5.0)]
    a = spark.createDataFrame(zones, "zone long, xmin double, ymin double, xmax double, ymax double")
    b = spark.createDataFrame(ways, "way long, x1 double, y1 double, x2 double, y2 double")
    sent, got = most(spark, "shuffleWriteRecords", lambda: {r.zone: r.n for r in count_meeting(a, b, 4.0, ("xmin", "ymin", "xmax", "ymax"), ("x1", "y1", "x2", "y2"), "n").collect()})
    want = {z: sum(w[1] is not None and w[1] <= x1 and x0 <= w[3] and w[2] <= y1 and y0 <= w[4] for w in ways) for z, x0, y0, x1, y1 in zones}
    assert got == {k: n for k, n in want.items() if n} and sent < 2000
