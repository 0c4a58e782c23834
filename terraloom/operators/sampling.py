"""Resampling and sampling of grids kept as (ix, iy, value) rows with unit index steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraloom.functions.projection import SceneProjection, utm_forward
from terraloom.session import cut


def corner_table(grid: DataFrame, value: str = "elevation") -> DataFrame:
    """For each grid cell its four corner values, where all four exist."""
    g = grid.select("ix", "iy", F.col(value).alias("v"))
    moved = g.select(F.explode(F.array(*(F.struct((F.col("ix") - a).alias("ix"), (F.col("iy") - b).alias("iy"), F.lit(2 * b + a).alias("k"), F.col("v").alias("v")) for a in (0, 1) for b in (0, 1)))).alias("c"))
    c = moved.select("c.*").groupBy("ix", "iy")
    return c.agg(*(F.max(F.when(F.col("k") == k, F.col("v"))).alias(f"v{k}") for k in range(4))).where("v0 is not null and v1 is not null and v2 is not null and v3 is not null")


def bilinear(points: DataFrame, grid: DataFrame, x: Column, y: Column, out: str = "z", value: str = "elevation", beyond: bool = False) -> DataFrame:
    """Points with the bilinear value at fractional grid indices x and y; null where a corner is missing.

    One aggregate over the grid and one equi join on the cell: no point is compared with more than its own cell. On the far edge
    the last cell serves. Outside the grid the value is null or, if ``beyond``, that of the edge cell's plane carried on.
    """
    size = F.broadcast(grid.agg(F.max("ix").alias("_mx"), F.max("iy").alias("_my")))  # one row
    p = points.withColumn("_x", x).withColumn("_y", y).join(size)
    p = p.withColumn("_ix", F.greatest(F.lit(0), F.least(F.floor("_x"), F.col("_mx") - 1))).withColumn("_iy", F.greatest(F.lit(0), F.least(F.floor("_y"), F.col("_my") - 1)))
    c = corner_table(grid, value).withColumnsRenamed({"ix": "_ix", "iy": "_iy"})
    u, v = F.col("_x") - F.col("_ix"), F.col("_y") - F.col("_iy")
    z = (F.col("v0") * (1 - u) + F.col("v1") * u) * (1 - v) + (F.col("v2") * (1 - u) + F.col("v3") * u) * v
    inside = (F.col("_x") >= 0) & (F.col("_y") >= 0) & (F.col("_x") <= F.col("_mx")) & (F.col("_y") <= F.col("_my"))
    return p.join(c, ["_ix", "_iy"], "left").withColumn(out, z if beyond else F.when(inside, z)).drop("_x", "_y", "_ix", "_iy", "_mx", "_my", "v0", "v1", "v2", "v3")


def sample_bilinear(points: DataFrame, grid: DataFrame, outside: str = "drop", out: str = "z", value: str = "elevation") -> DataFrame:
    """Bilinear samples; outside the grid the point is dropped, gets 0.0 (``zero``), or the nearest edge (``clamp``)."""
    if outside == "clamp":
        return sample_clamped(points, grid, out, value)
    found = bilinear(points, grid, F.col("x"), F.col("y"), out, value)
    return found.where(F.col(out).isNotNull()) if outside == "drop" else found.withColumn(out, F.coalesce(out, F.lit(0.0)))


def sample_clamped(points: DataFrame, grid: DataFrame, out: str = "z", value: str = "elevation") -> DataFrame:
    size = F.broadcast(grid.agg(F.max("ix").alias("_nx"), F.max("iy").alias("_ny")))  # one row
    p = points.join(size)
    x = F.greatest(F.lit(0.0), F.least(F.col("x"), F.col("_nx")))
    y = F.greatest(F.lit(0.0), F.least(F.col("y"), F.col("_ny")))
    return bilinear(p, grid, x, y, out, value).drop("_nx", "_ny")


def sample_nearest(points: DataFrame, grid: DataFrame, out: str = "z", value: str = "elevation") -> DataFrame:
    """The value of the nearest grid index, held at the edges."""
    size = F.broadcast(grid.agg(F.max("ix").alias("_mx"), F.max("iy").alias("_my")))  # one row
    p = points.join(size)
    p = p.withColumn("_ix", F.greatest(F.lit(0), F.least(F.floor(F.col("x") + 0.5), F.col("_mx")))).withColumn("_iy", F.greatest(F.lit(0), F.least(F.floor(F.col("y") + 0.5), F.col("_my"))))
    g = grid.select(F.col("ix").alias("_ix"), F.col("iy").alias("_iy"), F.col(value).alias(out))
    return p.join(g, ["_ix", "_iy"], "left").drop("_ix", "_iy", "_mx", "_my")


def regrid(grid: DataFrame, cells: DataFrame, method: str, value: str, fill: float) -> DataFrame:
    """``cells`` (id columns and source indices x, y) with the source's value, linear or nearest, held at the edges; nulls take the fill."""
    found = sample_clamped(cells, grid, value, value) if method == "linear" else sample_nearest(cells, grid, value, value)
    return found.withColumn(value, F.coalesce(value, F.lit(fill)))


def reproject_bilinear(composite: DataFrame, cells: DataFrame, projection: SceneProjection, epsg: int, origin: tuple[float, float], step: float, value: str = "value") -> DataFrame:
    """``cells`` (with scene metres x, y) with the bilinear value of a UTM composite (ix, iy, value); null where a corner is missing or NaN.

    origin: easting and northing of the centre of pixel (0, 0); iy grows northward.
    """
    lat, lon = projection.inverse(F.col("x"), F.col("y"))
    east, north = utm_forward(F.col("_lat"), F.col("_lon"), epsg)
    at = cells.withColumns({"_lat": lat, "_lon": lon}).withColumns({"_fx": (east - origin[0]) / step, "_fy": (north - origin[1]) / step})
    clean = composite.withColumn(value, F.when(~F.isnan(F.col(value).cast("double")), F.col(value)))
    return bilinear(at, clean, F.col("_fx"), F.col("_fy"), value, value).drop("_lat", "_lon", "_fx", "_fy")


def upsample_nearest(grid: DataFrame, scale: int) -> DataFrame:
    """Each pixel as scale x scale children."""
    k = F.sequence(F.lit(0), F.lit(scale - 1))
    split = grid.withColumn("_a", F.explode(k)).withColumn("_b", F.explode(k))
    return split.withColumn("ix", F.col("ix") * scale + F.col("_a")).withColumn("iy", F.col("iy") * scale + F.col("_b")).drop("_a", "_b")


def in_ranges(rows: DataFrame, order: list[str], last: Column, first: Column) -> tuple[DataFrame, DataFrame]:
    """Rows sorted over ranges, with ``_part`` (the range) and ``_line`` (ascends over all), and a row a range with what its neighbours hold.

    That row has ``_before``, the last known ``last`` of the ranges before, and ``_after``, the next known ``first`` of those after; both
    aggregates of a range in order. So an order without a key needs no task that sees all rows. The rows are written once.
    """
    line = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_line", F.monotonically_increasing_id())
    line = cut(line.withColumn("_part", F.shiftright("_line", 33)), "ranges")
    own = Window.partitionBy("_part").orderBy("_line")
    whole = own.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = line.withColumns({"_last": last.over(whole), "_first": first.over(whole)}).groupBy("_part").agg(F.first("_last").alias("_last"), F.first("_first").alias("_first"))
    over = Window.orderBy("_part")  # a row a range
    before = F.last("_last", ignorenulls=True).over(over.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first("_first", ignorenulls=True).over(over.rowsBetween(1, Window.unboundedFollowing))
    return line, ends.select("_part", before.alias("_before"), after.alias("_after"))


def brackets(profile: DataFrame, at: str, value: str, by: list[str] | None = None) -> DataFrame:
    """Neighbouring rows of a profile side by side: (lo, hi, vlo, vhi), one for each interval of each group; without groups over ranges of all rows."""
    if by:
        w = Window.partitionBy(*by).orderBy(at)
        nxt = profile.select(*by, F.col(at).alias("lo"), F.col(value).alias("vlo"), F.lead(at).over(w).alias("hi"), F.lead(value).over(w).alias("vhi"))
        return nxt.where("hi is not null")
    here = F.struct(F.col(at).alias("at"), F.col(value).alias("v"))
    line, carry = in_ranges(profile.select(at, value), [at], F.last(here), F.first(here))
    nxt = line.withColumn("_next", F.lead(here).over(Window.partitionBy("_part").orderBy("_line"))).join(carry, "_part")
    nxt = nxt.withColumn("_next", F.coalesce("_next", "_after")).where("_next is not null")
    return nxt.select(F.col(at).alias("lo"), F.col(value).alias("vlo"), F.col("_next.at").alias("hi"), F.col("_next.v").alias("vhi"))


def in_brackets(rows: DataFrame, profile: DataFrame, x: Column, at: str, value: str) -> DataFrame:
    """Rows with ``_x`` (``x`` held within the profile), its ``_first`` and ``_last`` row, and the interval about it: lo, hi, vlo, vhi.

    An equi join on bins as wide as the mean interval: an interval stands in each bin that it touches, some two a level,
    and a row looks into one.
    """
    ends = profile.agg(F.min(F.struct(at, value)).alias("_first"), F.max(F.struct(at, value)).alias("_last"), F.count("*").alias("_levels"))
    ends = F.broadcast(ends.withColumn("_step", (F.col(f"_last.{at}") - F.col(f"_first.{at}")).cast("double") / F.greatest("_levels", F.lit(1))))  # one row
    bin_of = lambda v: F.coalesce(F.floor(F.try_divide((v - F.col(f"_first.{at}")).cast("double"), F.col("_step"))), F.lit(0))
    steps = brackets(profile, at, value).join(ends)
    steps = steps.select("lo", "hi", "vlo", "vhi", F.explode(F.sequence(bin_of(F.col("lo")), bin_of(F.col("hi")))).alias("_bin"))
    r = rows.withColumn("_x", x).join(ends)
    r = r.withColumn("_x", F.greatest(F.col(f"_first.{at}"), F.least(F.col("_x"), F.col(f"_last.{at}"))))
    r = r.withColumn("_at_bin", bin_of(F.col("_x")))
    hit = (F.col("_x") >= F.col("lo")) & ((F.col("_x") < F.col("hi")) | ((F.col("_x") == F.col("hi")) & (F.col("hi") == F.col(f"_last.{at}"))))
    return r.join(steps, (F.col("_at_bin") == F.col("_bin")) & hit, "left").drop("_bin", "_at_bin", "_levels", "_step")


def interp_profile(rows: DataFrame, profile: DataFrame, x: Column, at: str, value: str, out: str) -> DataFrame:
    """Linear interpolation of a profile (a lookup of levels), end values held outside."""
    j = in_brackets(rows, profile, x, at, value)
    v = F.col("vlo") + (F.col("_x") - F.col("lo")) * F.try_divide(F.col("vhi") - F.col("vlo"), F.col("hi") - F.col("lo"))
    return j.withColumn(out, F.coalesce(v, F.col(f"_first.{value}"))).drop("_x", "_first", "_last", "lo", "hi", "vlo", "vhi")


def slope(grid: DataFrame, value: str = "elevation", step: float = 1.0) -> DataFrame:
    """Gradient magnitude by central differences, one-sided at the edges of each row and column of the grid.

    Each cell hands its value to its four neighbours and itself in one explode and one aggregate, so that a long row is not one task.
    """
    places = F.array(*(F.struct(F.lit(n).alias("n"), F.lit(a).alias("a"), F.lit(b).alias("b")) for n, a, b in (("o", 0, 0), ("e", -1, 0), ("w", 1, 0), ("n", 0, -1), ("s", 0, 1))))
    each = grid.select("ix", "iy", F.col(value).alias("v"), F.explode(places).alias("p")).select((F.col("ix") + F.col("p.a")).alias("ix"), (F.col("iy") + F.col("p.b")).alias("iy"), "p.n", "v")
    held = lambda n: F.max(F.when(F.col("n") == n, F.col("v")))
    near = each.groupBy("ix", "iy").agg(F.max(F.col("n") == "o").alias("_own"), held("o").alias("v"), *(held(n).alias(n) for n in "ewns")).where("_own")

    def gradient(after: str, before: str) -> Column:
        span = F.when(F.col(after).isNotNull(), 1).otherwise(0) + F.when(F.col(before).isNotNull(), 1).otherwise(0)
        return F.coalesce((F.coalesce(after, "v") - F.coalesce(before, "v")) / (F.nullif(span, F.lit(0)) * step), F.lit(0.0))

    return near.select("ix", "iy", F.sqrt(gradient("e", "w") ** 2 + gradient("n", "s") ** 2).alias("slope"))


def crop_square(df: DataFrame, size_km: float, x: str = "x", y: str = "y") -> DataFrame:
    h = size_km * 500.0
    return df.where((F.abs(F.col(x)) <= h) & (F.abs(F.col(y)) <= h))
