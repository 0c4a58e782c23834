"""Plants: counts per pixel, spillover, places, spacing, attributes and exclusion."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraloom.functions.keyed import draw
from terraloom.functions.projection import max_per_pixel
from terraloom.operators.sampling import sample_bilinear
from terraloom.session import cut, discard


def plants_per_pixel(pixels: DataFrame, species: DataFrame, resolution: float, spacing: float, variation: float, seed: int | str) -> DataFrame:
    """Pixels by species of their class with ``n`` plants: density times area times (1 + variation * u), held between 0 and what the
    spacing allows; whole part and a Bernoulli rest. species: (class, species, density_per_hectare)."""
    area = resolution * resolution / 10_000
    u = draw(f"{seed}v", "ix", "iy", "species") * 2 - 1
    most = max_per_pixel(F.lit(resolution), F.lit(resolution), F.lit(spacing))
    want = F.least(F.greatest(F.lit(0.0), F.col("density_per_hectare") * area * (1 + variation * u)), most.cast("double"))
    j = pixels.join(species, "class").withColumn("_w", want)
    extra = (draw(f"{seed}b", "ix", "iy", "species") < F.col("_w") - F.floor("_w")).cast("long")
    return j.withColumn("n", F.floor("_w") + extra).drop("_w")


def poisson(lam: Column, u: Column, most: int) -> Column:
    """Inverse of the Poisson distribution at a draw, at most ``most``."""
    steps = F.aggregate(
        F.sequence(F.lit(1), F.lit(most)),
        F.struct(F.lit(0).cast("long").alias("n"), F.exp(-lam).alias("p"), F.exp(-lam).alias("c")),
        lambda s, k: F.struct((s["n"] + (s["c"] < u).cast("long")).alias("n"), (s["p"] * lam / k).alias("p"), (s["c"] + s["p"] * lam / k).alias("c")),
    )
    return steps["n"]


def spillover(pixels: DataFrame, primary: int, compatibility: dict[int, float], density: float, resolution: float, max_m: float, most: int, seed: int | str) -> DataFrame:
    """Pixels of compatible classes near the primary class with their distance (pixels), rate ``lam`` and drawn ``n``.

    The nearest primary pixel comes from an equi join on cells as wide as the reach, so a pixel meets those of nine cells alone.
    """
    reach = max_m / resolution
    cell = max(1, math.ceil(reach))
    own = lambda c: F.floor(F.col(c) / cell)
    near = F.array(*(F.lit(k) for k in (-1, 0, 1)))
    src = pixels.where(F.col("class") == primary).select(F.col("ix").alias("px"), F.col("iy").alias("py"), F.explode(near).alias("_a")).withColumn("_b", F.explode(near))
    src = src.withColumn("_cx", F.floor(F.col("px") / cell) + F.col("_a")).withColumn("_cy", F.floor(F.col("py") / cell) + F.col("_b")).drop("_a", "_b")
    score = F.create_map(*(F.lit(x) for k, v in compatibility.items() if v > 0 for x in (k, float(v))))
    open_ = pixels.withColumn("score", F.try_element_at(score, F.col("class"))).where("score is not null").withColumn("_cx", own("ix")).withColumn("_cy", own("iy"))
    away = F.hypot(F.col("ix") - F.col("px"), F.col("iy") - F.col("py"))
    j = open_.join(src, ["_cx", "_cy"]).withColumn("_d", away).where(F.col("_d") <= reach)
    d = j.groupBy("ix", "iy", "class", "score").agg(F.min("_d").alias("distance"))
    lam = F.lit(density) * F.col("score") * (1 - F.col("distance") / reach) * (resolution * resolution / 10_000)
    d = d.withColumn("lam", lam)
    return d.withColumn("n", poisson(F.col("lam"), draw(f"{seed}p", "ix", "iy"), most))


def place_in_pixel(counts: DataFrame, resolution: float, spacing: float, seed: int | str, assets: list[tuple[str, float]]) -> DataFrame:
    """Up to ``n`` points in each pixel (ix, iy, x, y, species, n) by rejection: at most min(5 n, 100) tries, each kept point at least
    ``spacing`` from the earlier ones; assets by weight. The draws hang on the pixel, the species and the number of the try alone."""
    total, run, bounds = sum(w for _, w in assets), 0.0, []
    for _, w in assets[:-1]:
        run += w
        bounds.append(run / total)
    part = lambda h, i: F.conv(F.substring(h, i, 8), 16, 10).cast("double") / float(1 << 32)
    key = F.concat_ws(":", F.lit(str(seed)), "ix", "iy", "species")
    prints = F.transform(F.sequence(F.lit(1), F.least(5 * F.col("n"), F.lit(100)).cast("int")), lambda i: F.md5(F.concat_ws(":", key, i.cast("string")).cast("binary")))
    tries = F.transform(prints, lambda h: F.struct((F.col("x") + (part(h, 1) - 0.5) * resolution).alias("x"), (F.col("y") + (part(h, 9) - 0.5) * resolution).alias("y"), part(h, 17).alias("u")))

    def add(kept: Column, p: Column) -> Column:
        near = F.exists(kept, lambda q: (q["x"] - p["x"]) ** 2 + (q["y"] - p["y"]) ** 2 < spacing * spacing) if spacing > 0 else F.lit(False)
        return F.when((F.size(kept) < F.col("n")) & ~near, F.concat(kept, F.array(p))).otherwise(kept)

    kept = F.aggregate("_tries", F.array().cast("array<struct<x:double,y:double,u:double>>"), add)
    held = counts.where("n > 0").select("ix", "iy", "species", "n", tries.alias("_tries")).select("ix", "iy", "species", F.posexplode(kept).alias("k", "p"))
    asset = F.element_at(F.array(*(F.lit(a) for a, _ in assets)), F.lit(1) + sum(((F.col("p.u") >= b).cast("int") for b in bounds), F.lit(0)))
    return held.select("ix", "iy", "species", F.col("k").cast("long").alias("k"), "p.x", "p.y", asset.alias("asset"))


def instance_attributes(df: DataFrame, seed: int | str, *key: str, turn: float = 360.0, low: float = 0.8, high: float = 1.2, tilt: float = 5.0) -> DataFrame:
    """Rotation from 0 to ``turn``, scale between its limits, tilts within +-``tilt``."""
    u = lambda n: draw(f"{seed}{n}", *key)
    return df.withColumns({"rotation": u("r") * turn, "scale": low + u("s") * (high - low), "tilt_x": (u("x") * 2 - 1) * tilt, "tilt_y": (u("y") * 2 - 1) * tilt})


def min_spacing(points: DataFrame, spacing: float, seed: int | str, key: str = "pid") -> DataFrame:
    """Points kept in the order of their draws: each one unless a kept one is nearer than the spacing.

    The greedy result is unique, so it can be found in rounds: the first open point of a cell that comes before all other open ones within two
    cells stays, and what it is too near to goes. Of points at one place the first alone takes part: what removes it removes the others as well. So no pairs
    are written, however dense the points; each round writes the points that it leaves open.
    """
    if spacing <= 0:
        return points
    edge = 0.7 * spacing  # points of one cell are all too near to each other, and what is too near to a point lies within two cells
    known = points.where("abs(x) < double('Infinity') and abs(y) < double('Infinity')")
    first = known.select(key, F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), draw(seed, key).alias("_u")).groupBy("x", "y").agg(F.min(F.struct("_u", F.col(key).alias("_k"))).alias("_f"))
    open_ = cut(first.select("x", "y", "_f", F.floor(F.col("x") / edge).alias("_cx"), F.floor(F.col("y") / edge).alias("_cy")), "spacing")
    two = F.array(*(F.lit(k) for k in range(-2, 3)))

    def around(rows: DataFrame) -> DataFrame:
        out = rows.withColumn("_i", F.explode(two)).withColumn("_j", F.explode(two))
        return out.withColumns({"_cx": F.col("_cx") + F.col("_i"), "_cy": F.col("_cy") + F.col("_j")}).drop("_i", "_j")

    kept = []
    while not open_.isEmpty():
        lead = open_.groupBy("_cx", "_cy").agg(F.min(F.struct("_f", "x", "y")).alias("_l")).select("_cx", "_cy", "_l.*")
        before = around(lead).groupBy("_cx", "_cy").agg(F.min("_f").alias("_before"))
        new = cut(lead.join(before, ["_cx", "_cy"]).where("_f = _before").drop("_before"), "spacing")
        kept.append(new)
        near = around(new).alias("b")
        close = (F.col("a.x") - F.col("b.x")) ** 2 + (F.col("a.y") - F.col("b.y")) ** 2 < spacing**2
        same = (F.col("a._cx") == F.col("b._cx")) & (F.col("a._cy") == F.col("b._cy"))
        last, open_ = open_, cut(open_.alias("a").join(near, same & close, "left_anti"), "spacing")
        discard(last)
    discard(open_)
    if not kept:
        return points
    stay = reduce(DataFrame.unionByName, kept).select(F.col("_f._k").alias("_k"))
    lost = known.select(F.col(key).alias("_p")).join(stay, F.col("_p") == F.col("_k"), "left_anti")
    return points.join(lost, F.col(key) == F.col("_p"), "left_anti")


def spilled(pixels: DataFrame, species: DataFrame, spill: dict[str, dict[int, float]], resolution: float, spacing: float, max_m: float, most: int, seed: int | str, assets: list[tuple[str, float]]) -> DataFrame:
    """Plants of each species that ``spill`` names in compatible classes near its own: counts, then places, as in their own pixels.

    ``pid`` names the class a plant spills from, and each class and species draws by seeds of its own.
    """
    at = pixels.select("ix", "iy", "x", "y")
    out = None
    for r in species.where(F.col("species").isin(*spill)).orderBy("class", "species").collect():  # a configuration: a row a class and species
        if not any(v > 0 for v in spill[r.species].values()):
            continue
        own = f"{seed}s{r['class']}"
        counts = spillover(pixels, r["class"], spill[r.species], r.density_per_hectare, resolution, max_m, most, f"{own}:{r.species}")
        counts = counts.select("ix", "iy", "n").join(at, ["ix", "iy"]).withColumn("species", F.lit(r.species))
        part = place_in_pixel(counts, resolution, spacing, own, assets)
        part = part.withColumn("pid", F.concat_ws("_", F.lit("spill"), F.lit(r["class"]), "ix", "iy", "species", "k"))
        out = part if out is None else out.unionByName(part)
    return out


def vegetation(
    pixels: DataFrame, dem: DataFrame, species: DataFrame, zones: DataFrame, segments: DataFrame, resolution: float, spacing: float, seed: int | str, assets: list[tuple[str, float]], spill: dict[str, dict[int, float]] | None = None, spill_m: float = 30.0, most: int = 50
) -> DataFrame:
    """Counts, places, spillover, elevation, spacing, attributes and exclusion of zones and roads, in that order; grid units are metres.

    ``spill``: compatible classes and their scores by species (classes within ``spill_m``, at most ``most`` plants a pixel); others do not spill.
    """
    from terraloom.operators.joins import exclude_roads, exclude_zones

    counts = plants_per_pixel(pixels, species, resolution, spacing, 0.3, seed)
    placed = place_in_pixel(counts, resolution, spacing, seed, assets).withColumn("pid", F.concat_ws("_", "ix", "iy", "species", "k"))
    over = spilled(pixels, species, spill, resolution, spacing, spill_m, most, seed, assets) if spill else None
    placed = cut(placed if over is None else placed.unionByName(over), "plants")
    kept = min_spacing(sample_bilinear(placed, dem), spacing, seed)
    full = instance_attributes(kept, seed, "pid")
    return exclude_roads(exclude_zones(full, zones, resolution), segments, 0.0, resolution)
