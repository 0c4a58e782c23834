"""Row generators: grids, plants, cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scene_grid(spark: SparkSession, n: int, resolution: float = 1.0) -> DataFrame:
    """n x n pixels with their centres about the origin; row 0 is south."""
    half = n * resolution / 2
    g = spark.range(n * n).select((F.col("id") % n).alias("ix"), F.floor(F.col("id") / n).alias("iy"))
    return g.withColumn("x", (F.col("ix") + 0.5) * resolution - half).withColumn("y", (F.col("iy") + 0.5) * resolution - half)
