"""Clusters of classes' reflectances and their materials."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraloom.functions.keyed import draw
from terraloom.operators.aggregates import allocate_indices
from terraloom.operators.filters import finite_masked
from terraloom.operators.spectra import match_sam
from terraloom.session import cut, discard


def _square(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)


def cluster_classes(pixels: DataFrame, covers: list[int], bands: list[str], k: int, seed: int | str, key: str = "pixel_id", rounds: int = 10) -> tuple[DataFrame, DataFrame]:
    """Labels (key, class, cluster) of the pixels of all listed classes, and a palette (class, cluster, vector of mean raw bands).

    K-means of each class on its own standard scores, all classes in the same jobs: k starts, each drawn with odds of its squared distance to the nearest start
    before it, then at most ``rounds`` rounds of assignment and means. A class with fewer different pixels than k has as many clusters; an
    empty cluster keeps its centre and has no palette. The draws hang on the pixel's key. Only the centres, k a class, reach the driver.
    """
    masked = finite_masked(pixels.where(F.col("class").isin(covers)), bands, F.lit(True)).select(key, "class", *(F.col(b).cast("double").alias(b) for b in bands))
    stats = masked.groupBy("class").agg(F.array(*(F.avg(b) for b in bands)).alias("_mean"), F.array(*(F.stddev_pop(b) for b in bands)).alias("_dev"))
    dev = F.transform("_dev", lambda d: F.when(d > 0, d).otherwise(1.0))
    raw = F.array(*bands)
    scored = F.zip_with(F.zip_with(raw, F.col("_mean"), lambda x, m: x - m), dev, lambda x, d: x / d)
    rows = cut(masked.join(F.broadcast(stats), "class").select(key, "class", raw.alias("raw"), scored.alias("f")), "scores")  # a row a listed class
    spark = pixels.sparkSession
    kind = f"class {rows.schema['class'].dataType.simpleString()}, centres array<array<double>>"
    centres: dict[int, list[list[float]]] = {}

    def near(rows: DataFrame) -> DataFrame:
        known = spark.createDataFrame(list(centres.items()), kind)
        return rows.join(F.broadcast(known), "class")  # k vectors a listed class

    for turn in range(k):
        found = rows.withColumn("_w", F.lit(1.0)) if turn == 0 else near(rows).withColumn("_w", F.array_min(F.transform("centres", lambda c: _square(F.col("f"), c)))).where("_w > 0")
        odds = F.log(draw(f"{seed}:{turn}", key) + 2.0**-33) / F.col("_w")
        new = found.groupBy("class").agg(F.max_by("f", F.struct(odds, F.col(key))).alias("f")).collect()
        for r in new:
            centres.setdefault(r["class"], []).append(list(r.f))
        if not new:
            break
    if not centres:
        return rows.select(key, "class", F.lit(0).alias("cluster")), rows.select("class", F.lit(0).alias("cluster"), F.col("raw").alias("vector"))
    place = F.array_min(F.transform("centres", lambda c, i: F.struct(_square(F.col("f"), c).alias("d"), i.alias("i"))))["i"].alias("cluster")
    mean = lambda c: F.array(*(F.avg(F.get(c, F.lit(i))) for i in range(len(bands))))
    for _ in range(rounds):
        moved = near(rows).select("class", "f", place).groupBy("class", "cluster").agg(mean(F.col("f")).alias("f")).collect()
        before = {c: list(v) for c, v in centres.items()}
        for r in moved:
            centres[r["class"]][r.cluster] = list(r.f)
        if centres == before:
            break
    labels = cut(near(rows).select(key, "class", place, "raw"), "labels")
    discard(rows)
    return labels.select(key, "class", "cluster"), labels.groupBy("class", "cluster").agg(mean(F.col("raw")).alias("vector"))


def cluster_class(pixels: DataFrame, cover: int, bands: list[str], k: int, seed: int | str, key: str = "pixel_id") -> tuple[DataFrame, DataFrame]:
    """Labels (key, cluster; -1 off the class or without bands) and a palette (cluster, vector of mean raw bands) of one class."""
    found, palette = cluster_classes(pixels, [cover], bands, k, seed, key)
    labels = pixels.select(key).join(found.select(key, "cluster"), key, "left").select(key, F.coalesce("cluster", F.lit(-1)).alias("cluster"))
    return labels, palette.select("cluster", "vector")


def diversify(pixels: DataFrame, covers: list[int], library: DataFrame, base: DataFrame, bands: list[str], k: int, seed: int, max_degrees: float, key: str = "pixel_id") -> tuple[DataFrame, DataFrame]:
    """Pixels of the classes painted with the index of their cluster's material, unmatched ones as they were; and the index table.

    pixels: key, class, idx, bands; base: (name, idx).
    """
    labels, palette = cluster_classes(pixels, covers, bands, k, seed, key)
    own = F.struct("class", "cluster")
    match = match_sam(palette.select(own.alias("cluster"), "vector"), library, max_degrees).where("material_id is not null")
    found = labels.withColumn("cluster", own).join(match.select("cluster", "material_id"), "cluster").select(key, "material_id")
    index = allocate_indices(base, found.select(F.col("material_id").alias("name")))
    painted = found.join(index, F.col("material_id") == F.col("name")).select(key, F.col("idx").alias("_new"))
    return pixels.join(painted, key, "left").withColumn("idx", F.coalesce("_new", "idx")).drop("_new"), index
