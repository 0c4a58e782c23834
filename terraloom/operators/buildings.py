"""Building rows: heights, roofs and totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraloom.functions.keyed import draw
from terraloom.functions.scalars import parse_height
from terraloom.operators.sampling import sample_clamped


def building_attributes(footprints: DataFrame, dem: DataFrame, offset: float = 0.0, share: float = 0.0, min_area: float | None = None, min_height: float | None = None, roof: float = 2.5, seed: int | str = 0, story: float = 3.0, default: float = 3.0) -> DataFrame:
    """Footprints (building_id, centroid x and y, area_m2, height text) with base, height, roof and eaves.

    A roof is pitched if the footprint is large and high enough and its draw lies below the share; it takes the target height, at most half of the building.
    """
    metres, parsed = parse_height(F.col("height"), story, default)
    b = sample_clamped(footprints, dem, out="base_z").withColumn("base_z", F.col("base_z") + offset)
    b = b.withColumns({"height_m": metres, "parsed": parsed})
    eligible = F.lit(share > 0)
    if min_area is not None:
        eligible = eligible & (F.col("area_m2") >= min_area)
    if min_height is not None:
        eligible = eligible & (F.col("height_m") >= min_height)
    b = b.withColumn("pitched", eligible & (draw(seed, "building_id") < share))
    b = b.withColumn("roof_m", F.when(F.col("pitched"), F.least(F.lit(roof), F.col("height_m") / 2)).otherwise(0.0))
    return b.withColumn("eaves_m", F.col("height_m") - F.col("roof_m"))


def building_stats(buildings: DataFrame) -> DataFrame:
    """Totals by material: all, pitched and flat roofs where known, unparsed heights."""
    extra = [F.count_if("pitched").alias("pitched")] if "pitched" in buildings.columns else []
    return buildings.groupBy("material").agg(F.count("*").alias("total"), F.count_if(~F.col("parsed")).alias("unparsed"), *extra)
