"""Filters over grids, points, ways and footprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraloom.operators.geometry import bounds_overlap, covering_cells, in_polygon, levels_of, ring_bounds, same_cell, segment_distance, with_cell

Box = tuple[float, float, float, float]


def bbox_prefilter(df: DataFrame, box: Box, x: str = "x", y: str = "y") -> DataFrame:
    """Rows within the box (xmin, ymin, xmax, ymax); plain comparisons, so that parquet takes the filter."""
    return df.where(F.col(x).between(box[0], box[2]) & F.col(y).between(box[1], box[3]))


def clip_to_aoi(df: DataFrame, corners: list[tuple[float, float]], x: str = "x", y: str = "y") -> DataFrame:
    """Rows within a polygon: its bounds first, then the exact test."""
    xs, ys = [c[0] for c in corners], [c[1] for c in corners]
    ring = F.array(*(F.struct(F.lit(float(a)).alias("x"), F.lit(float(b)).alias("y")) for a, b in corners))
    return bbox_prefilter(df, (min(xs), min(ys), max(xs), max(ys)), x, y).where(in_polygon(F.col(x), F.col(y), ring))


def in_areas(points: DataFrame, areas: DataFrame, band: float, x: str = "x", y: str = "y") -> DataFrame:
    """Places and areas (x, y, area) of the points that lie in an area; on its edge counts.

    areas: (area, ring array<struct<x, y>>), a row a ring, open or closed: the parts and holes of an area are rings of it (even-odd rule). Edges stand in
    bands of rows, on the level of their height, ``band`` that of a short one; a place meets the edges of its band alone, and the parity
    of those to its right tells. So a ring of many corners is not tried in full for each place.
    """
    ring = F.transform("ring", lambda p, i: F.struct(p.alias("a"), F.get("ring", F.pmod(i + 1, F.size("ring"))).alias("b")))
    edges = areas.select("area", F.explode(ring).alias("e")).select("area", *(F.col(f"e.{p}.{c}").alias(f"{c}{n}") for n, p in ((1, "a"), (2, "b")) for c in ("x", "y")))
    edges = edges.where("not (x1 = x2 and y1 = y2)")
    bounds = F.lit(0.0), F.least("y1", "y2"), F.lit(0.0), F.greatest("y1", "y2")
    box = edges.agg(F.min(F.least("x1", "x2")).alias("_x0"), F.max(F.greatest("x1", "x2")).alias("_x1"))  # one row
    places = points.select(F.col(x).alias("x"), F.col(y).alias("y")).distinct().join(F.broadcast(box)).where("x between _x0 and _x1").drop("_x0", "_x1")
    at = with_cell(places.withColumn("_zero", F.lit(0.0)), band, "_zero", "y", levels_of(edges, band, bounds)).alias("a")
    px, py = F.col("a.x"), F.col("a.y")
    reach = py.between(F.least("y1", "y2"), F.greatest("y1", "y2")) & (px <= F.greatest("x1", "x2"))
    j = at.join(covering_cells(edges, band, bounds).alias("b"), same_cell() & reach)
    ends = tuple(F.col(c) for c in ("x1", "y1", "x2", "y2"))
    crosses = ((F.col("y1") > py) != (F.col("y2") > py)) & (px < (ends[2] - ends[0]) * (py - ends[1]) / F.nullif(ends[3] - ends[1], F.lit(0.0)) + ends[0])
    on = segment_distance(px, py, *ends) == 0
    found = j.groupBy(px.alias("x"), py.alias("y"), "area").agg(F.count_if(F.coalesce(crosses, F.lit(False))).alias("_n"), F.max(on).alias("_on"))
    return found.where("_n % 2 = 1 or _on").select("x", "y", "area")


def clip_to_areas(df: DataFrame, areas: DataFrame, band: float, x: str = "x", y: str = "y") -> DataFrame:
    """Rows within any area of a table (see ``in_areas``): polygons of any number of corners, with parts and holes."""
    inside = in_areas(df, areas, band, x, y).select(F.col("x").alias("_px"), F.col("y").alias("_py"))
    return df.join(inside, (F.col(x) == F.col("_px")) & (F.col(y) == F.col("_py")), "left_semi")


def extent(df: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """One row of bounds; nulls where there is nothing."""
    return df.agg(F.min(x).alias("xmin"), F.min(y).alias("ymin"), F.max(x).alias("xmax"), F.max(y).alias("ymax"))


def extent_overlaps(grid: DataFrame, polygons: DataFrame, ring: str = "ring", x: str = "x", y: str = "y") -> DataFrame:
    """Polygons with ``overlaps``: whether their bounds meet the grid's; an empty grid meets none."""
    box = F.broadcast(extent(grid, x, y))  # one row
    meets = bounds_overlap(ring_bounds(F.col(ring)), tuple(F.col(c) for c in ("xmin", "ymin", "xmax", "ymax")))
    return polygons.join(box).withColumn("overlaps", F.coalesce(meets, F.lit(False))).drop("xmin", "ymin", "xmax", "ymax")


def in_scene_limit(df: DataFrame, max_km: float = 50.0, x: str = "x", y: str = "y") -> DataFrame:
    return df.withColumn("in_limit", F.hypot(F.col(x), F.col(y)) <= max_km * 1000.0)


def within_dem(points: DataFrame, dem: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """Points with ``within``: closed test against the bounds of the elevation grid."""
    box = F.broadcast(extent(dem.select(F.col("ix").alias("x"), F.col("iy").alias("y"))))  # one row
    inside = F.col(x).between(F.col("xmin"), F.col("xmax")) & F.col(y).between(F.col("ymin"), F.col("ymax"))
    return points.join(box).withColumn("within", F.coalesce(inside, F.lit(False))).drop("xmin", "ymin", "xmax", "ymax")


def valid_ways(ways: DataFrame, highway_types: list[str] | None = None, geometry: str = "geometry") -> DataFrame:
    """Ways with a highway tag (of the list, if given) and two or more nodes that have coordinates; other nodes go."""
    nodes = F.filter(geometry, lambda n: n["lat"].isNotNull() & n["lon"].isNotNull())
    tagged = F.col("highway").isin(highway_types) if highway_types else F.col("highway").isNotNull()
    return ways.where(tagged).withColumn(geometry, nodes).where(F.size(geometry) >= 2)


def finite_masked(df: DataFrame, bands: list[str], cover: Column) -> DataFrame:
    """Rows of a class whose bands are all finite."""
    good = cover
    for b in bands:
        good = good & F.col(b).isNotNull() & ~F.isnan(b) & (F.abs(F.col(b)) != float("inf"))
    return df.where(good)


def usable_candidates(library: DataFrame, vector: str = "vector") -> DataFrame:
    """Diffuse materials with a finite vector of some length."""
    v = F.col(vector)
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return library.where((F.col("type") == "diffuse") & v.isNotNull() & sound & F.exists(v, lambda x: x != 0))


def drop_invalid_footprints(df: DataFrame, ring: str = "ring") -> tuple[DataFrame, DataFrame]:
    """Footprints with a geometry, and one row counting those skipped."""
    bad = F.col(ring).isNull() | (F.size(ring) == 0)
    return df.where(~bad), df.agg(F.count_if(bad).alias("skipped"))


def circular_fov(df: DataFrame, key: list[str], value: str = "radiance") -> DataFrame:
    """Values farther from the film's centre than half its shorter side become null."""
    size = df.groupBy(*key).agg((F.max("x_index") + 1).alias("_nx"), (F.max("y_index") + 1).alias("_ny"))
    far = F.hypot(F.col("x_index") - (F.col("_nx") - 1) / 2, F.col("y_index") - (F.col("_ny") - 1) / 2) > F.least("_nx", "_ny") / 2
    return df.join(size, key).withColumn(value, F.when(~far, F.col(value))).drop("_nx", "_ny")


def cover_filter(df: DataFrame, classes: list[int], cover: str = "class") -> DataFrame:
    return df.where(F.col(cover).isin(classes))


def buffer_mask(grid: DataFrame, size: int, target: int) -> DataFrame:
    """255 outside and 0 inside a centred square hole (integer halves)."""
    first = size // 2 - target // 2
    hole = F.col("ix").between(first, first + target - 1) & F.col("iy").between(first, first + target - 1)
    return grid.withColumn("mask", F.when(hole, 0).otherwise(255))


def rect_mask(grid: DataFrame, box: Box) -> DataFrame:
    inside = F.col("x").between(box[0], box[2]) & F.col("y").between(box[1], box[3])
    return grid.withColumn("mask", inside)


def polygon_mask(grid: DataFrame, corners: list[tuple[float, float]]) -> DataFrame:
    """Whether a pixel's centre lies in the polygon."""
    xs, ys = [c[0] for c in corners], [c[1] for c in corners]
    ring = F.array(*(F.struct(F.lit(float(a)).alias("x"), F.lit(float(b)).alias("y")) for a, b in corners))
    near = F.col("x").between(min(xs), max(xs)) & F.col("y").between(min(ys), max(ys))
    return grid.withColumn("mask", F.when(near, in_polygon(F.col("x"), F.col("y"), ring)).otherwise(False))
