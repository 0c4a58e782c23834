"""Operators on road centrelines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraloom.operators.sampling import sample_clamped


def steep_roads(vertices: DataFrame, slope: DataFrame, threshold: float, thin_m: float | None = None, key: str = "way_id") -> DataFrame:
    """Roads whose steepest vertex reaches the threshold (0 or less keeps all) and that are not thinner than ``thin_m``: (key, steepest)."""
    at = sample_clamped(vertices, slope, out="s", value="slope")
    if thin_m is not None:
        at = at.where(F.col("width_m") >= thin_m)
    most = at.groupBy(key).agg(F.max("s").alias("steepest"))
    return most if threshold <= 0 else most.where(F.col("steepest") >= threshold)


def with_next(segments: DataFrame, *key: str, order: str = "seg") -> DataFrame:
    """Segments (x1, y1, x2, y2) with ``next_x``, ``next_y``: the unit direction of the segment that goes on where one ends, null at the last.

    A line's segments are the rows of one window. Segments without length have no direction and are left out.
    """
    w = Window.partitionBy(*key).orderBy(order)
    long = segments.where("x1 != x2 or y1 != y2")
    n = F.hypot(F.lead("x2").over(w) - F.lead("x1").over(w), F.lead("y2").over(w) - F.lead("y1").over(w))
    on = (F.lead("x1").over(w) == F.col("x2")) & (F.lead("y1").over(w) == F.col("y2"))
    return long.withColumns({f"next_{c}": F.when(on, (F.lead(f"{c}2").over(w) - F.lead(f"{c}1").over(w)) / n) for c in "xy"})


def in_joint(dx: Column, dy: Column, ends: tuple[Column, Column, Column, Column], next_x: Column, next_y: Column) -> Column:
    """Whether a place, given from the end of a segment, lies past that segment and before the next one: in the wedge outside their bend."""
    along = dx * (ends[2] - ends[0]) + dy * (ends[3] - ends[1])
    return F.coalesce((along >= 0) & (dx * next_x + dy * next_y <= 0), F.lit(False))


def next_of(segments: DataFrame, alias: str | None = None) -> tuple[Column, Column]:
    """The columns of ``with_next``, or nulls for segments that stand alone."""
    if "next_x" not in segments.columns:
        return F.lit(None).cast("double"), F.lit(None).cast("double")
    return tuple(F.col(f"{alias}.{c}" if alias else c) for c in ("next_x", "next_y"))
