"""Mosaics and cloud-gap composites of scene rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraloom.operators.geometry import bounds_overlap, rings_meet
from terraloom.session import cut


def mosaic_tiles(tiles: DataFrame, keys: list[str], value: str, fill: float) -> tuple[DataFrame, DataFrame]:
    """Pixels of overlapping tiles merged, nulls filled; and the keys where tiles disagree, which callers treat as an error."""
    merged = tiles.groupBy(*keys).agg(F.max(value).alias(value), F.min(value).alias("_low"))
    return merged.select(*keys, F.coalesce(value, F.lit(fill)).alias(value)), merged.where(F.col("_low") != F.col(value)).select(*keys)


def daily_mosaic(scenes: DataFrame, day: str, order: str, keys: list[str], value: str) -> DataFrame:
    """The first valid value of a day for each key."""
    return scenes.where(F.col(value).isNotNull()).groupBy(day, *keys).agg(F.min_by(value, order).alias(value))


def coverage(layer: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """Share of pixels with a value in the first band."""
    return layer.groupBy(*(by or [])).agg(F.avg(F.col(value).isNotNull().cast("double")).alias("coverage"))


def nearest_dates(dates: DataFrame, day: str, anchor: Column, n: int = 8) -> DataFrame:
    """Dates by distance to the anchor, the earlier first on ties, with their rank from 1; the n nearest."""
    gap = F.abs(F.datediff(F.col(day), anchor))
    near = dates.select(day).distinct().orderBy(gap, day).limit(n)
    return near.withColumn("rank", F.row_number().over(Window.orderBy(gap, F.col(day))))  # n rows


def closest_composite(daily: DataFrame, pixels: DataFrame, day: str, anchor: Column, keys: list[str], value: str, least: float = 0.99, most: int = 8) -> DataFrame:
    """Pixels with the value of the nearest date that has one, over as many dates as coverage asks for.

    Dates are taken by distance until the share of covered pixels reaches ``least`` or ``most`` dates are used. The cut is found from
    a count of pixels by the rank that first covers them (a row a date), before any value is read.
    """
    ranked = F.broadcast(nearest_dates(daily, day, anchor, most))  # at most ``most`` rows
    valid = daily.where(F.col(value).isNotNull()).join(ranked, day)
    firsts = valid.groupBy(*keys).agg(F.min("rank").alias("rank"))
    total = F.broadcast(pixels.agg(F.count("*").alias("_all")))
    new = firsts.groupBy("rank").agg(F.count("*").alias("new"))
    every = ranked.select("rank").join(new, "rank", "left").join(total)
    run = F.sum(F.coalesce("new", F.lit(0))).over(Window.orderBy("rank")) / F.col("_all")
    steps = every.select("rank", run.alias("covered"))
    cut = steps.agg(F.coalesce(F.min(F.when(F.col("covered") >= least, F.col("rank"))), F.max("rank")).alias("_cut"))
    used = valid.join(F.broadcast(cut), F.col("rank") <= F.col("_cut"))
    best = used.groupBy(*keys).agg(F.min_by(value, "rank").alias(value), F.min("rank").alias("rank"))
    return pixels.join(best, keys, "left")


def checked_composite(composite: DataFrame, value: str, least: float = 0.99) -> tuple[DataFrame, float, bool]:
    """A composite, written once; the share of its pixels that have a value; and whether that falls short of ``least``.

    Falling short is for the caller to report; a composite without any value (no date, or nothing but gaps) is an error.
    """
    kept = cut(composite, "composite")
    covered = kept.agg(F.avg(F.col(value).isNotNull().cast("double"))).first()[0]
    if not covered:
        raise ValueError("no date covers any pixel")
    return kept, covered, covered < least


def catalog_search(catalog: DataFrame, anchor: Column, days: int, cloud_below: float, n: int = 100, aoi: tuple[float, float, float, float] | Column | None = None, collection: str | None = None, must_hit: bool = False) -> DataFrame:
    """Scenes of a date window with cloud cover strictly below the limit that meet ``aoi``, of one ``collection`` if given; the first n by id.

    ``aoi`` is a box, met by a scene's box (xmin, ymin, xmax, ymax), or a ring, met by a scene's ``ring``: bounds first, then corners and edges. With
    ``must_hit`` a search that finds nothing is a ValueError; to know that, it runs once when called.
    """
    found = F.col("acq_date").between(F.date_sub(anchor, days), F.date_add(anchor, days)) & (F.col("cloud_cover") < cloud_below)
    if collection is not None:
        found &= F.col("collection") == collection
    if isinstance(aoi, Column):
        found &= rings_meet(F.col("ring"), aoi)
    elif aoi is not None:
        found &= bounds_overlap(tuple(F.col(c) for c in ("xmin", "ymin", "xmax", "ymax")), tuple(F.lit(v) for v in aoi))
    scenes = catalog.where(found).orderBy("scene_id").limit(n)
    if must_hit and scenes.isEmpty():
        raise ValueError("no scene of the window meets the area of interest")
    return scenes


def paint(layers: DataFrame, keys: list[str], value: str = "material", pos: str = "layer") -> DataFrame:
    """The value of the last layer of each pixel; layers without a value do not paint."""
    return layers.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.max_by(value, pos).alias(value))
