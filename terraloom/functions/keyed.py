"""Draws that hang on a row's key alone: the same in any partitioning and in any engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def draw(seed: int | str, *key: Column | str) -> Column:
    """Uniform in [0, 1): the first 32 bits of md5("seed:key[:key...]")."""
    text = F.concat_ws(":", F.lit(str(seed)), *(F.col(k).cast("string") if isinstance(k, str) else k.cast("string") for k in key))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / float(1 << 32)
