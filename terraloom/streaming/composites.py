"""Daily mosaics over a stream of scene rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_daily_mosaic(scenes: DataFrame, time: str, order: str, keys: list[str], value: str, late: str = "2 days") -> DataFrame:
    """The first valid value of each day and key, closed once the watermark passes the day's end; later rows are dropped."""
    day = F.window(time, "1 day")
    valid = scenes.where(F.col(value).isNotNull()).withWatermark(time, late)
    return valid.groupBy(day, *keys).agg(F.min_by(value, order).alias(value)).withColumn("acq_date", F.to_date("window.start")).drop("window")
