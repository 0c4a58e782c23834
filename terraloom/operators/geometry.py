"""Plane geometry as column expressions, and cell keys that turn spatial joins into equi joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bounds_overlap(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Closed overlap of two boxes (xmin, ymin, xmax, ymax); touching counts."""
    return (a[0] <= b[2]) & (b[0] <= a[2]) & (a[1] <= b[3]) & (b[1] <= a[3])


def along_segment(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Where the foot of a point lies on a segment's line: 0 at its start, 1 at its end; 0 for a segment without length."""
    dx, dy = x2 - x1, y2 - y1
    length = dx * dx + dy * dy
    return F.when(length > 0, ((px - x1) * dx + (py - y1) * dy) / F.nullif(length, F.lit(0.0))).otherwise(0.0)


def segment_distance(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), along_segment(px, py, x1, y1, x2, y2)))
    return F.hypot(px - (x1 + t * (x2 - x1)), py - (y1 + t * (y2 - y1)))


def in_polygon(px: Column, py: Column, ring: Column) -> Column:
    """Even-odd test against an array of (x, y) corners, open or closed; points on the ring count as inside."""
    n = F.size(ring)
    edges = F.transform(ring, lambda p, i: F.struct(p.alias("a"), F.get(ring, F.pmod(i + 1, n)).alias("b")))

    def crosses(e: Column) -> Column:
        a, b = e["a"], e["b"]
        meets = (a["y"] > py) != (b["y"] > py)
        return meets & (px < (b["x"] - a["x"]) * (py - a["y"]) / F.nullif(b["y"] - a["y"], F.lit(0.0)) + a["x"])

    odd = F.size(F.filter(edges, lambda e: F.coalesce(crosses(e), F.lit(False)))) % 2 == 1
    on = F.exists(edges, lambda e: segment_distance(px, py, e["a"]["x"], e["a"]["y"], e["b"]["x"], e["b"]["y"]) == 0)
    return odd | on


def rings_cross(one: Column, other: Column) -> Column:
    """Whether an edge of one ring meets an edge of the other, at their ends too; open or closed rings."""

    def edges(ring: Column) -> Column:
        return F.transform(ring, lambda p, i: F.struct(p.alias("a"), F.get(ring, F.pmod(i + 1, F.size(ring))).alias("b")))

    def side(a: Column, b: Column, p: Column) -> Column:
        return F.signum((b["x"] - a["x"]) * (p["y"] - a["y"]) - (b["y"] - a["y"]) * (p["x"] - a["x"]))

    def boxed(e: Column, f: Column) -> Column:
        low = lambda g, k: F.least(g["a"][k], g["b"][k])
        high = lambda g, k: F.greatest(g["a"][k], g["b"][k])
        return bounds_overlap((low(e, "x"), low(e, "y"), high(e, "x"), high(e, "y")), (low(f, "x"), low(f, "y"), high(f, "x"), high(f, "y")))

    def meet(e: Column, f: Column) -> Column:
        parted = (side(e["a"], e["b"], f["a"]) * side(e["a"], e["b"], f["b"]) <= 0) & (side(f["a"], f["b"], e["a"]) * side(f["a"], f["b"], e["b"]) <= 0)
        return boxed(e, f) & parted  # edges on one line meet where their boxes do

    return F.exists(edges(one), lambda e: F.exists(edges(other), lambda f: meet(e, f)))


def ring_bounds(ring: Column) -> tuple[Column, Column, Column, Column]:
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)


def rings_meet(one: Column, other: Column) -> Column:
    """Whether two polygons meet: bounds first, then corners of either within the other, then edges."""
    close = bounds_overlap(ring_bounds(one), ring_bounds(other))
    holds = F.exists(one, lambda p: in_polygon(p["x"], p["y"], other)) | F.exists(other, lambda p: in_polygon(p["x"], p["y"], one))
    return close & (holds | rings_cross(one, other))


def polygon(*corners: tuple[float, float]) -> Column:
    return F.array(*(F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in corners))


def with_cell(points: DataFrame, size: float, x: str = "x", y: str = "y", levels: list[int] | None = None) -> DataFrame:
    """Points with the key of their cell in ``_lv``, ``_cx``, ``_cy``: one row for each of the levels (the finest alone if none are given)."""
    level = F.lit(0) if not levels else F.lit(levels[0]) if len(levels) == 1 else F.explode(F.array(*map(F.lit, levels)))
    edge = size * F.pow(F.lit(4.0), F.col("_lv"))
    return points.withColumn("_lv", level).withColumn("_cx", F.floor(F.col(x) / edge)).withColumn("_cy", F.floor(F.col(y) / edge))


def box_level(size: float, bounds: tuple[Column, Column, Column, Column]) -> Column:
    """The level whose cells, of edge ``size`` times a power of four, are the smallest that are no smaller than a box."""
    span = F.greatest(bounds[2] - bounds[0], bounds[3] - bounds[1])
    return F.when(span > size, F.ceil(F.log2(span / size) / 2)).otherwise(0).cast("int")


def covering_cells(boxes: DataFrame, size: float, bounds: tuple[Column, Column, Column, Column], least: Column | None = None) -> DataFrame:
    """A row for each cell that a box touches on the level of its own size (or on the level ``least``, if that is higher).

    Four cells at most, however large the box: so an equi join on the key finds every box near a point without a row for each fine cell.
    """
    level = box_level(size, bounds)
    boxes = boxes.withColumn("_lv", level if least is None else F.greatest(level, least))
    edge = size * F.pow(F.lit(4.0), F.col("_lv"))
    x0, y0, x1, y1 = (F.floor(b / edge) for b in bounds)
    return boxes.withColumn("_cx", F.explode(F.sequence(x0, x1))).withColumn("_cy", F.explode(F.sequence(y0, y1)))


def levels_of(boxes: DataFrame, size: float, bounds: tuple[Column, Column, Column, Column]) -> list[int]:
    """The levels that boxes have: a few small numbers, found when called."""
    found = boxes.select(box_level(size, bounds).alias("level")).where("level is not null").distinct().collect()
    return sorted(r.level for r in found)


def strip_level(size: float, bounds: tuple[Column, Column, Column, Column]) -> Column:
    """The level on which a segment with such bounds takes nine cells a side at most."""
    return box_level(size, tuple(b / 8 for b in bounds))


def strip_cells(segments: DataFrame, size: float, ends: tuple[Column, Column, Column, Column], reach: Column, level: int) -> DataFrame:
    """A row for each cell of ``level`` that may hold a place within ``reach`` of a segment that has this level.

    The cells follow the segment: those of its box that lie apart from it are left out.
    """
    bounds = strip_bounds(ends, reach)
    edge = size * 4.0**level
    x0, y0, x1, y1 = (F.floor(b / edge) for b in bounds)
    here = segments.where(strip_level(size, bounds) == level).withColumn("_lv", F.lit(level))
    here = here.withColumn("_cx", F.explode(F.sequence(x0, x1))).withColumn("_cy", F.explode(F.sequence(y0, y1)))
    return here.where(segment_distance((F.col("_cx") + 0.5) * edge, (F.col("_cy") + 0.5) * edge, *ends) <= reach + 0.7072 * edge)  # half the diagonal of a cell


def strip_bounds(ends: tuple[Column, Column, Column, Column], reach: Column) -> tuple[Column, Column, Column, Column]:
    x1, y1, x2, y2 = ends
    return F.least(x1, x2) - reach, F.least(y1, y2) - reach, F.greatest(x1, x2) + reach, F.greatest(y1, y2) + reach


def strip_levels(segments: DataFrame, size: float, ends: tuple[Column, Column, Column, Column], reach: Column) -> list[int]:
    """The levels that segments have: a few small numbers, found when called."""
    found = segments.select(strip_level(size, strip_bounds(ends, reach)).alias("level")).where("level is not null").distinct().collect()
    return sorted(r.level for r in found)


def same_cell(a: str = "a", b: str = "b") -> Column:
    return (F.col(f"{a}._lv") == F.col(f"{b}._lv")) & (F.col(f"{a}._cx") == F.col(f"{b}._cx")) & (F.col(f"{a}._cy") == F.col(f"{b}._cy"))


def outside(points: DataFrame, boxes: DataFrame, size: float, bounds: tuple[Column, Column, Column, Column], hit: Column) -> DataFrame:
    """Points (alias a) that no box (alias b) hits: an anti join on cells for each level that boxes have, the largest boxes first."""
    for level in reversed(levels_of(boxes, size, bounds)):
        here = covering_cells(boxes.where(box_level(size, bounds) == level), size, bounds).alias("b")
        points = with_cell(points, size, levels=[level]).alias("a").join(here, same_cell() & hit, "left_anti").drop("_lv", "_cx", "_cy")
    return points


def meeting_boxes(left: DataFrame, right: DataFrame, size: float, own: tuple[str, str, str, str], other: tuple[str, str, str, str], how: str = "inner") -> DataFrame:
    """Left (alias a) and right rows (alias b) whose boxes meet, each pair once; or the left rows that meet any, for ``how`` left_semi.

    Two boxes meet on the level of the larger one, so each takes part on its own level and on those above that some box has. ``own`` and ``other`` name the
    bounds (xmin, ymin, xmax, ymax) of either side; all eight names differ.
    """
    mine, theirs = (tuple(F.col(c) for c in names) for names in (own, other))
    levels = sorted({*levels_of(left, size, mine), *levels_of(right, size, theirs)}) or [0]
    sides = []
    for boxes, bounds in ((left, mine), (right, theirs)):
        up = boxes.withColumn("_own", box_level(size, bounds)).withColumn("_up", F.explode(F.array(*map(F.lit, levels)))).where("_up >= _own")
        sides.append(covering_cells(up, size, bounds, F.col("_up")))
    a, b = sides[0].alias("a"), sides[1].alias("b")
    on = same_cell() & (F.col("a._up") == F.greatest("a._own", "b._own")) & bounds_overlap(mine, theirs)
    if how == "inner":  # a pair that shares several cells counts in the one that holds the corner of its overlap
        edge = size * F.pow(F.lit(4.0), F.col("a._lv"))
        on = on & (F.col("a._cx") == F.floor(F.greatest(own[0], other[0]) / edge)) & (F.col("a._cy") == F.floor(F.greatest(own[1], other[1]) / edge))
    return a.join(b, on, how)


def count_meeting(left: DataFrame, right: DataFrame, size: float, own: tuple[str, str, str, str], other: tuple[str, str, str, str], out: str) -> DataFrame:
    """Left rows that meet any right box, with the number of right rows they meet as ``out``.

    Equal boxes of either side meet as one, with their number, so pairs of copies are never made. A missing bound meets nothing.
    """
    kinds, many = left.select(*own).distinct(), right.groupBy(*other).agg(F.count("*").alias("_many"))
    found = meeting_boxes(many, kinds, size, other, own).groupBy(*own).agg(F.sum("_many").alias(out))
    return left.join(found, list(own)).select(*left.columns, out)
