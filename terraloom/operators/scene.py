"""Scene-wide steps on the projected grid: regridding from degrees, object places, zones with grids of their own."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terraloom.functions.projection import SceneProjection
from terraloom.operators.compositing import paint
from terraloom.operators.generate import scene_grid
from terraloom.operators.sampling import bilinear, sample_nearest

#: Layers that a zone's materials may have; those not named here are left out of the zone.
ZONE_LAYERS = {"target": ("base", "snow", "matched", "regions", "roads"), "buffer": ("base", "snow"), "background": ("base",)}


def zone_grid(spark: SparkSession, size_km: float, resolution: float) -> DataFrame:
    """Pixels (ix, iy) of a square about the centre with their centres x, y in metres.

    round(size / resolution) pixels a side; the outer centres lie half a resolution inside the square, whether it divides the size or not.
    """
    width = size_km * 1000.0
    n = round(width / resolution)
    if n < 1:
        raise ValueError("the resolution is coarser than the scene")
    step = (width - resolution) / (n - 1) if n > 1 else 0.0
    place = lambda i: F.col(i) * step + (resolution - width) / 2
    return scene_grid(spark, n).select("ix", "iy", place("ix").alias("x"), place("iy").alias("y"))


def regrid_scene(source: DataFrame, projection: SceneProjection, size_km: float, resolution: float, origin: tuple[float, float], step: tuple[float, float], method: str, value: str, fill: float | None = None) -> DataFrame:
    """The scene's pixels (ix, iy, x, y) with a source's value, linear or nearest.

    The source is a grid (ix, iy, value) on degrees: pixel (0, 0) has its centre at ``origin`` (lat, lon), rows and columns are ``step`` (lat, lon)
    apart, either of which may be negative. Outside it linear values go on with the slope of the edge cell and nearest ones hold the edge.
    A pixel with a missing or NaN corner takes the fill, if one is given.
    """
    if method not in ("linear", "nearest"):
        raise ValueError("method must be linear or nearest")
    cells = zone_grid(source.sparkSession, size_km, resolution).withColumnsRenamed({"ix": "_px", "iy": "_py", "x": "_sx", "y": "_sy"})
    lat, lon = projection.inverse(F.col("_sx"), F.col("_sy"))
    at = cells.withColumns({"_fx": (lon - origin[1]) / step[1], "_fy": (lat - origin[0]) / step[0]})
    clean = source.select("ix", "iy", F.when(~F.isnan(F.col(value).cast("double")), F.col(value)).alias(value))
    if method == "linear":
        found = bilinear(at, clean, F.col("_fx"), F.col("_fy"), value, value, beyond=True)
    else:  # halfway between two centres the lower index is taken
        found = sample_nearest(at.withColumns({"x": F.ceil(F.col("_fx") - 0.5), "y": F.ceil(F.col("_fy") - 0.5)}), clean, value, value)
    filled = F.col(value) if fill is None else F.coalesce(value, F.lit(fill))
    return found.select(F.col("_px").alias("ix"), F.col("_py").alias("iy"), F.col("_sx").alias("x"), F.col("_sy").alias("y"), filled.alias(value))


def place_objects(objects: DataFrame, dem: DataFrame, projection: SceneProjection, origin: tuple[float, float], step: float, value: str = "elevation") -> DataFrame:
    """Objects with their scene position x, y in metres and z: the nearest elevation plus ``elevation_offset`` (null: 0).

    ``coord_type`` tells what c1, c2 hold: longitude and latitude (``geographic``) or scene metres (any other). Pixel (0, 0) of ``dem`` has
    its centre at ``origin`` (x, y) and its pixels are ``step`` metres wide; beyond its edge the edge pixel serves.
    """
    east, north = projection.forward(F.col("c2"), F.col("c1"))
    geographic = F.coalesce(F.col("coord_type") == "geographic", F.lit(False))
    placed = objects.withColumns({"_sx": F.when(geographic, east).otherwise(F.col("c1")), "_sy": F.when(geographic, north).otherwise(F.col("c2"))})
    found = sample_nearest(placed.withColumns({"x": (F.col("_sx") - origin[0]) / step, "y": (F.col("_sy") - origin[1]) / step}), dem, "_h", value)
    z = F.col("_h") + F.coalesce("elevation_offset", F.lit(0.0))
    return found.withColumns({"x": F.col("_sx"), "y": F.col("_sy"), "z": z}).drop("_sx", "_sy", "_h")


def zones_union(spark: SparkSession, zones: dict[str, tuple[float, float]], layers: dict[str, Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Materials (zone, ix, iy, x, y, material) of the zones target, buffer and background, each on a grid of its own size in km and resolution.

    ``layers`` maps a layer to a function from a zone's pixels (ix, iy, x, y) to rows (ix, iy, material); the later of ZONE_LAYERS paint over
    the earlier, and a layer that a zone may not have (snow on the background, regions, matches and roads off the target) is not run there.
    """
    unknown = [z for z in zones if z not in ZONE_LAYERS] + [n for n in layers if n not in ZONE_LAYERS["target"]]
    if unknown or not zones or "base" not in layers:
        raise ValueError(f"zones and layers must be those of ZONE_LAYERS, with a base: {unknown}")

    def one(name: str, size_km: float, resolution: float) -> DataFrame:
        pixels = zone_grid(spark, size_km, resolution)
        chosen = [n for n in ZONE_LAYERS[name] if n in layers]
        stack = [layers[n](pixels).select("ix", "iy", F.lit(i).alias("layer"), "material") for i, n in enumerate(chosen)]
        painted = paint(reduce(DataFrame.unionByName, stack), ["ix", "iy"])
        return pixels.join(painted, ["ix", "iy"], "left").select(F.lit(name).alias("zone"), "ix", "iy", "x", "y", "material")

    return reduce(DataFrame.unionByName, (one(name, *grid) for name, grid in zones.items()))


def cap_per_pixel(instances: DataFrame, pixel: list[Column], most: int, draw: Column, key: str) -> DataFrame:
    """At most ``most`` instances of each pixel, those of the least draws, ties by ``key``; Spark thins each partition before its shuffle."""
    rank = F.row_number().over(Window.partitionBy(*pixel).orderBy(draw, F.col(key)))
    return instances.withColumn("_rank", rank).where(F.col("_rank") <= most).drop("_rank")


def combine_series(parts: list[DataFrame], series: DataFrame, by: str = "series") -> tuple[DataFrame, DataFrame]:
    """Spectra of all parts stacked and given their series' columns (angles, time), and the series of which no part has rows.

    Rows of series that are not in ``series`` are left out. No part, or parts without any such row, is an error.
    """
    if not parts:
        raise ValueError("no parts to combine")
    stacked = reduce(DataFrame.unionByName, parts)
    found = stacked.join(series, by)
    if found.isEmpty():
        raise ValueError("no part has rows of the series")
    return found, series.join(stacked.select(by), by, "left_anti")
