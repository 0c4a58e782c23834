"""Exact quantiles by selection, the one-pass pyramid, orders without a key, and checks that fail."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terraloom.operators import aggregates as A
from terraloom.operators import joins as J
from terraloom.operators import sampling as SM
from terraloom.operators import spectra as X
from terraloom.operators import vegetation as V


def test_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(1)
    groups = {1: rng.random(5000), 2: np.round(rng.random(3000) * 4), 3: np.array([7.5]), 4: np.exp(rng.normal(0, 30, 2000)), None: rng.normal(size=101), 5: np.r_[np.zeros(999), 1e300]}
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [(1, None), (6, None)]
    frame = spark.createDataFrame(rows, "k long, v double").repartition(7)
    for q in (0.0, 0.37, 0.5, 0.99, 1.0):
        got = {r.k: r.quantile for r in A.exact_quantile(frame, ["k"], "v", q).collect()}
        assert got.keys() == groups.keys()
        for k, vs in groups.items():
            assert got[k] == pytest.approx(np.quantile(vs, q), rel=1e-12, abs=1e-300)
    whole = A.exact_quantile(frame.where("k = 1"), [], "v", 0.5).collect()
    assert len(whole) == 1 and whole[0].quantile == pytest.approx(np.quantile(groups[1], 0.5))
    assert A.exact_quantile(frame.limit(0), ["k"], "v", 0.5).count() == 0


def test_no_task_holds_a_group(spark):
    rows = spark.range(200_000).select((F.col("id") % 2).alias("k"), F.rand(3).alias("v"))
    plan = A.exact_quantile(rows, ["k"], "v", 0.9)._jdf.queryExecution().toString()
    assert "percentile" not in plan and "collect" not in plan


def test_pyramid_reads_the_grid_twice_at_any_depth(spark, tmp_path):
    rng = np.random.default_rng(2)
    z = rng.random((13, 16))
    path = f"file://{tmp_path}/dem"
    spark.createDataFrame([(i, j, float(z[i, j])) for i in range(13) for j in range(16)], "ix long, iy long, elevation double").write.parquet(path)
    dem = spark.read.parquet(path)
    for depth in (0, 1, 3, 4):
        out = A.error_pyramid(dem, depth, 13, 16)
        assert out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("FileScan") <= 2
        got = {(r.level, r.i, r.j): r.error for r in out.collect()}
        want = {}
        for level in range(depth, -1, -1):
            k = 1 << (depth - level)
            for i in range(13 // k):
                for j in range(16 // k):
                    block = z[i * k : i * k + k, j * k : j * k + k]
                    u, v = np.meshgrid(range(k), range(k), indexing="ij")
                    a = np.c_[np.ones(k * k), u.ravel(), v.ravel()]
                    own = np.abs(block.ravel() - a @ np.linalg.lstsq(a, block.ravel(), rcond=None)[0]).max() if k > 1 else 0.0
                    below = [want.get((level + 1, 2 * i + a_, 2 * j + b_), 0.0) for a_ in (0, 1) for b_ in (0, 1)] if level < depth else []
                    want[level, i, j] = max([own, *below])
        assert got.keys() == want.keys() and all(abs(got[key] - want[key]) < 1e-9 for key in want)


def test_nearest_without_a_key_needs_no_single_task(spark):
    rng = np.random.default_rng(3)
    left = [(i, float(x)) for i, x in enumerate(rng.integers(-50, 400, 300))]
    right = [(float(t), int(t) * 10) for t in sorted({*map(int, rng.integers(0, 350, 60))})]
    l, r = spark.createDataFrame(left, "id long, t double").repartition(5), spark.createDataFrame([*right, (5.5, None)], "t double, v long").repartition(3)
    out = J.nearest_by(l, r, "t", "v")
    got = {x.id: x.value for x in out.collect()}
    assert got == {i: min(right, key=lambda p: (abs(p[0] - t), p[0]))[1] for i, t in left}
    assert J.nearest_by(l, r.limit(0), "t", "v").where("value is null").count() == len(left)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(-100, 100), min_size=1, max_size=40, unique=True))
def test_brackets_over_ranges(spark, levels):
    frame = spark.createDataFrame([(float(x), x * 2.0) for x in levels], "at double, v double").repartition(4)
    got = sorted((r.lo, r.hi, r.vlo, r.vhi) for r in SM.brackets(frame, "at", "v").collect())
    xs = sorted(levels)
    assert got == [(a, b, a * 2.0, b * 2.0) for a, b in zip(xs, xs[1:], strict=False)]


def test_alignment_out_of_range_fails_unless_filled(spark):
    rad = spark.createDataFrame([("a", 400.0), ("a", 460.0)], "s string, w double")
    ref = spark.createDataFrame([("a", 410.0, 1.0), ("a", 470.0, 2.0)], "s string, w double, e double")
    with pytest.raises(Exception, match="outside the reference"):
        X.align_wavelengths(rad, ref, "s", "e").collect()
    assert {r.w: r.e for r in X.align_wavelengths(rad, ref, "s", "e", 0.0).collect()} == {400.0: 0.0, 460.0: pytest.approx(1 + 50 / 60)}
    assert X.align_wavelengths(rad.where("w > 410"), ref, "s", "e").count() == 1


def test_plants_keep_their_distance_and_their_tries(spark):
    counts = spark.createDataFrame([(0, 0, 10.0, 10.0, "oak", 30), (1, 0, 30.0, 10.0, "oak", 3), (2, 0, 50.0, 10.0, "oak", 0)], "ix long, iy long, x double, y double, species string, n long")
    out = V.place_in_pixel(counts, 20.0, 4.0, 1, [("a", 1.0), ("b", 1.0)])
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    rows = out.collect()
    by = {k: [(r.x, r.y) for r in rows if r.ix == k] for k in (0, 1, 2)}
    assert len(by[1]) == 3 and not by[2] and 5 < len(by[0]) <= 30 and {r.asset for r in rows} == {"a", "b"}
    for pts in by.values():
        assert all((a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2 >= 16 for i, a in enumerate(pts) for b in pts[:i])
    assert all(0 <= x <= 20 and 0 <= y <= 20 for x, y in by[0])
    assert sorted(r.k for r in rows if r.ix == 0) == list(range(len(by[0])))
    free = V.place_in_pixel(counts, 20.0, 0.0, 1, [("a", 1.0)])
    assert free.where("ix = 0").count() == 30
