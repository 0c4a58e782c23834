"""Regions, road rasters, clipped roads, flattened ground and adaptive cells."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraloom.operators.geometry import along_segment, covering_cells, in_polygon, levels_of, meeting_boxes, ring_bounds, same_cell, segment_distance, strip_cells, strip_levels, with_cell
from terraloom.operators.roads import in_joint, next_of
from terraloom.session import cut, discard


def split_roads(lines: DataFrame, box: tuple[float, float, float, float], key: str = "way_id") -> DataFrame:
    """Segments of lines (key, nodes array<struct<x, y>>) clipped to a box: (key, piece, seg, cx1, cy1, cx2, cy2).

    Liang-Barsky on each segment; a line that leaves and comes back falls into pieces. A line's segments are the rows of one window.
    """
    pairs = F.zip_with(F.slice("nodes", 1, F.size("nodes") - 1), F.slice("nodes", 2, F.size("nodes") - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    s = lines.where(F.size("nodes") >= 2).select(key, F.posexplode(pairs).alias("seg", "p")).select(key, "seg", *(F.col(f"p.{e}.{c}").alias(f"{c}{n}") for n, e in ((1, "a"), (2, "b")) for c in ("x", "y")))
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    sides = [(-dx, F.col("x1") - box[0]), (dx, F.lit(box[2]) - F.col("x1")), (-dy, F.col("y1") - box[1]), (dy, F.lit(box[3]) - F.col("y1"))]
    outside = reduce(lambda a, b: a | b, [(p == 0) & (q < 0) for p, q in sides])
    t0 = F.greatest(F.lit(0.0), *(F.when(p < 0, q / F.nullif(p, F.lit(0.0))) for p, q in sides))
    t1 = F.least(F.lit(1.0), *(F.when(p > 0, q / F.nullif(p, F.lit(0.0))) for p, q in sides))
    s = s.withColumns({"_t0": t0, "_t1": t1}).where(~outside & (F.col("_t0") < F.col("_t1")))
    w = Window.partitionBy(key).orderBy("seg")
    joined = (F.lag("seg").over(w) == F.col("seg") - 1) & (F.lag("_t1").over(w) == 1) & (F.col("_t0") == 0)
    s = s.withColumn("_new", F.when(F.coalesce(joined, F.lit(False)), 0).otherwise(1)).withColumn("piece", F.sum("_new").over(w))
    at = lambda c, d, t: (F.col(c) + F.col(t) * d).alias
    return s.select(key, "piece", "seg", at("x1", dx, "_t0")("cx1"), at("y1", dy, "_t0")("cy1"), at("x1", dx, "_t1")("cx2"), at("y1", dy, "_t1")("cy2"))


def rasterize_roads(segments: DataFrame, nx: int, ny: int) -> DataFrame:
    """Pixels (unit cells) that a road's flat-ended footprint touches: (ix, iy, layer), the last layer of each.

    Only the cells of a segment's bounding box are tried, by the separating axes of cell and rectangle. segments: (x1, y1, x2, y2, width_m, layer), of lines
    with bends after ``with_next``: then the cells about a bend are tried as well, by the place of the cell nearest to the bend.
    """
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    n = F.hypot(dx, dy)
    s = segments.where(n > 0).withColumns({"_ux": dx / n, "_uy": dy / n, "_h": F.col("width_m") / 2, "_l": n / 2, "_mx": (F.col("x1") + F.col("x2")) / 2, "_my": (F.col("y1") + F.col("y2")) / 2})
    ex = F.col("_l") * F.abs("_ux") + F.col("_h") * F.abs("_uy")
    ey = F.col("_l") * F.abs("_uy") + F.col("_h") * F.abs("_ux")
    s = s.withColumns({"_ex": ex, "_ey": ey})
    low = lambda c, e: F.greatest(F.lit(0), F.ceil(F.col(c) - F.col(e)) - 1)
    high = lambda c, e, m: F.least(F.lit(m - 1), F.floor(F.col(c) + F.col(e)))
    s = s.withColumns({"_x0": low("_mx", "_ex"), "_x1": high("_mx", "_ex", nx), "_y0": low("_my", "_ey"), "_y1": high("_my", "_ey", ny)}).where("_x0 <= _x1 and _y0 <= _y1")
    c = s.withColumn("ix", F.explode(F.sequence("_x0", "_x1"))).withColumn("iy", F.explode(F.sequence("_y0", "_y1")))
    qx, qy = F.col("ix") + 0.5 - F.col("_mx"), F.col("iy") + 0.5 - F.col("_my")
    cell = 0.5 * (F.abs("_ux") + F.abs("_uy"))
    touch = (F.abs(qx * F.col("_ux") + qy * F.col("_uy")) <= F.col("_l") + cell) & (F.abs(qy * F.col("_ux") - qx * F.col("_uy")) <= F.col("_h") + cell)
    painted = c.where(touch & (F.abs(qx) <= F.col("_ex") + 0.5) & (F.abs(qy) <= F.col("_ey") + 0.5)).select("ix", "iy", "layer")
    if "next_x" in segments.columns:
        ends = tuple(F.col(e) for e in ("x1", "y1", "x2", "y2"))
        bends = segments.where("next_x is not null and (x1 != x2 or y1 != y2)").withColumn("_h", F.col("width_m") / 2)
        bends = bends.withColumns({"_x0": low("x2", "_h"), "_x1": high("x2", "_h", nx), "_y0": low("y2", "_h"), "_y1": high("y2", "_h", ny)}).where("_x0 <= _x1 and _y0 <= _y1")
        near = bends.withColumn("ix", F.explode(F.sequence("_x0", "_x1"))).withColumn("iy", F.explode(F.sequence("_y0", "_y1")))
        # a cell that meets the wedge but neither rectangle meets it at its place nearest to the bend: else it crosses an end of a rectangle
        gap = lambda c, i: F.greatest(F.lit(0.0), F.col(i) - F.col(c)) - F.greatest(F.lit(0.0), F.col(c) - F.col(i) - 1)
        gx, gy = gap("x2", "ix"), gap("y2", "iy")
        painted = painted.unionByName(near.where((F.hypot(gx, gy) <= F.col("_h")) & in_joint(gx, gy, ends, *next_of(segments))).select("ix", "iy", "layer"))
    return painted.groupBy("ix", "iy").agg(F.max("layer").alias("layer"))


def apply_regions(grid: DataFrame, regions: DataFrame) -> DataFrame:
    """Pixels (centres x, y) with the material of the last region that holds them, if any.

    regions: (pos, kind rectangle or circle or polygon, x0, y0, x1, y1, cx, cy, r, ring, classes or null, material). Pixels meet the regions about them by
    an equi join on cells, whatever the regions' number and size.
    """
    x, y = F.col("a.x"), F.col("a.y")
    ringed, round_ = F.col("kind") == "polygon", F.col("kind") == "circle"
    edges = zip(("x0", "y0", "x1", "y1"), ring_bounds(F.col("ring")), (F.col("cx") - F.col("r"), F.col("cy") - F.col("r"), F.col("cx") + F.col("r"), F.col("cy") + F.col("r")), strict=True)
    bounds = tuple(F.when(ringed, of_ring).when(round_, of_circle).otherwise(F.col(own)) for own, of_ring, of_circle in edges)
    near = covering_cells(regions, 8.0, bounds).drop("x", "y").alias("b")
    hit = F.when(F.col("kind") == "rectangle", x.between(F.col("x0"), F.col("x1")) & y.between(F.col("y0"), F.col("y1"))).when(round_, F.hypot(x - F.col("cx"), y - F.col("cy")) <= F.col("r")).otherwise(in_polygon(x, y, F.col("ring")))
    held = F.col("classes").isNull() | F.array_contains("classes", F.col("class"))
    cells = with_cell(grid.select("ix", "iy", "x", "y", "class"), 8.0, levels=levels_of(regions, 8.0, bounds)).alias("a")
    painted = cells.join(near, same_cell() & hit & held).groupBy("ix", "iy").agg(F.max_by("material", "pos").alias("region"))
    return grid.join(painted, ["ix", "iy"], "left")


def flatten_under_roads(points: DataFrame, roads: DataFrame, half: Column, buffer_m: float, reference: Column, cell: float, key: str = "pid") -> DataFrame:
    """Points with z blended toward the road's elevation: fully within half the width, linearly over the buffer, road after road.

    roads: segments (pos of the road, x1, y1, x2, y2, and what ``half`` and ``reference`` name, with ``t`` the place along the segment), of lines with bends
    after ``with_next``. A road acts once on a point: from the nearest place of its whole centreline. Zones end flat and are round outside a bend.
    """
    reach = half + buffer_m
    own = tuple(F.col(c) for c in ("x1", "y1", "x2", "y2"))
    ends = tuple(F.col(f"b.{c}") for c in ("x1", "y1", "x2", "y2"))
    px, py = F.col("a.x"), F.col("a.y")
    t = along_segment(px, py, *ends)
    d = segment_distance(px, py, *ends)
    held = t.between(0, 1) | in_joint(px - ends[2], py - ends[3], ends, *next_of(roads, "b"))
    # points at one place are blended once: roads meet places, and the blended places meet the points
    places = points.select("x", "y").distinct()
    found = None
    for level in strip_levels(roads, cell, own, reach):
        part = with_cell(places, cell, levels=[level]).alias("a").join(strip_cells(roads, cell, own, reach, level).alias("b"), same_cell() & (d <= reach))
        part = part.withColumns({"t": F.greatest(F.lit(0.0), F.least(F.lit(1.0), t)), "_d": d, "_held": held})
        alpha = F.when(F.col("_d") <= half, 1.0).otherwise(1 - (F.col("_d") - half) / buffer_m if buffer_m > 0 else 0.0)
        part = part.select(F.col("a.x").alias("_x"), F.col("a.y").alias("_y"), "pos", "_d", "_held", F.struct(alpha.alias("a"), reference.alias("z")).alias("op"))
        found = part if found is None else found.unionByName(part)
    if found is None:
        return points.select(key, *(c for c in points.columns if c != key))
    ops = found.groupBy("_x", "_y", "pos").agg(F.min_by("op", "_d").alias("op"), F.max("_held").alias("_held")).where("_held")
    ops = ops.groupBy("_x", "_y").agg(F.sort_array(F.collect_list(F.struct("pos", "op.a", "op.z"))).alias("ops"))
    blend = F.aggregate("ops", F.col("_z"), lambda z, o: o["a"] * o["z"] + (1 - o["a"]) * z)
    heights = points.select(F.col("x").alias("_x"), F.col("y").alias("_y"), F.col("z").alias("_z")).distinct()
    heights = heights.join(ops, ["_x", "_y"]).select("_x", "_y", "_z", blend.alias("_to"), F.lit(True).alias("_on"))
    same = (F.col("x") == F.col("_x")) & (F.col("y") == F.col("_y")) & F.col("z").eqNullSafe(F.col("_z"))
    out = points.join(heights, same, "left").withColumn("z", F.when(F.col("_on"), F.col("_to")).otherwise(F.col("z")))
    return out.select(key, *(c for c in points.columns if c != key))


def cell_box(size: float) -> tuple[Column, Column, Column, Column]:
    edge = F.lit(size) / F.pow(F.lit(2.0), F.col("level"))
    return F.col("i") * edge, F.col("j") * edge, (F.col("i") + 1) * edge, (F.col("j") + 1) * edge


def refine_cells(cells: DataFrame, splits, depth: int) -> DataFrame:  # noqa: ANN001
    """Leaves (level, i, j) after splitting, level by level, those that ``splits(cells)`` returns into four."""
    done = None
    current = cells
    quad = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (0, 1) for b in (0, 1)))
    for _ in range(depth):
        open_ = current.where(F.col("level") < depth)
        chosen = splits(open_).select("level", "i", "j").distinct()
        kept = current.join(chosen, ["level", "i", "j"], "left_anti")
        done = kept if done is None else done.unionByName(kept)
        current = chosen.withColumn("q", F.explode(quad)).select((F.col("level") + 1).alias("level"), (F.col("i") * 2 + F.col("q.a")).alias("i"), (F.col("j") * 2 + F.col("q.b")).alias("j"))
        current = cut(current, "cells")
    return current if done is None else done.unionByName(current)


def meeting_zones(size: float, zones: DataFrame, cell: float):  # noqa: ANN201
    """A split rule: cells whose closed box meets a zone's box (xmin, ymin, xmax, ymax)."""

    def rule(cells: DataFrame) -> DataFrame:
        x0, y0, x1, y1 = cell_box(size)
        c = cells.withColumns({"_x0": x0, "_y0": y0, "_x1": x1, "_y1": y1})
        found = meeting_boxes(c, zones, cell, ("_x0", "_y0", "_x1", "_y1"), ("xmin", "ymin", "xmax", "ymax"), "left_semi")
        return found.select("level", "i", "j").distinct()  # a cell takes part on several levels

    return rule


def exceeding(pyramid: DataFrame, tolerance: float):  # noqa: ANN201
    """A split rule: cells whose error in a pyramid (level, i, j, error) is above the tolerance. Levels of cells and pyramid are the same."""
    worse = pyramid.where(F.col("error") > tolerance).select("level", "i", "j")
    return lambda cells: cells.join(worse, ["level", "i", "j"], "left_semi")


def balance_cells(leaves: DataFrame) -> DataFrame:
    """Splits leaves until neighbours differ by at most one level.

    Each round, every leaf names the cells beside it one level up; a leaf that holds such a place from two or more levels above is split.
    """
    quad = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (0, 1) for b in (0, 1)))
    sides = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in ((-1, 0), (1, 0), (0, -1), (0, 1))))
    own = None  # the last round's table, which the next one replaces
    while True:
        # a neighbour at the leaf's own level, and the ancestors of it that would be too coarse
        beside = leaves.withColumn("s", F.explode(sides)).select("level", (F.col("i") + F.col("s.a")).alias("i"), (F.col("j") + F.col("s.b")).alias("j")).where("i >= 0 and j >= 0 and level >= 2").distinct()
        up = beside.withColumn("k", F.explode(F.sequence(F.lit(2), F.col("level").cast("int"))))
        coarse = up.select((F.col("level") - F.col("k")).alias("level"), F.expr("shiftright(i, k)").alias("i"), F.expr("shiftright(j, k)").alias("j")).distinct()
        split = cut(leaves.join(coarse, ["level", "i", "j"], "left_semi"), "balance")
        if split.isEmpty():
            discard(split)
            return leaves
        children = split.withColumn("q", F.explode(quad)).select((F.col("level") + 1).alias("level"), (F.col("i") * 2 + F.col("q.a")).alias("i"), (F.col("j") * 2 + F.col("q.b")).alias("j"))
        leaves = cut(leaves.join(split, ["level", "i", "j"], "left_anti").unionByName(children), "balance")
        discard(split, *([own] if own is not None else []))
        own = leaves

