"""Statistics over grids, radiance and instances."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terraloom.session import cut, discard

BINS = 1024  # ranges that one round of a selection tells apart


def zscore(df: DataFrame, bands: list[str]) -> DataFrame:
    """Bands as standard scores with the population deviation; a deviation of 0 counts as 1."""
    stats = df.agg(*(F.avg(b).alias(f"_m_{b}") for b in bands), *(F.stddev_pop(b).alias(f"_s_{b}") for b in bands))
    j = df.join(F.broadcast(stats))  # one row
    out = j.withColumns({b: (F.col(b) - F.col(f"_m_{b}")) / F.when(F.col(f"_s_{b}") > 0, F.col(f"_s_{b}")).otherwise(1.0) for b in bands})
    return out.select(*df.columns)


def spatial_mean(df: DataFrame, by: list[str], value: str) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(value).alias(value))


def boa_irradiance(df: DataFrame, by: list[str], value: str = "radiance") -> DataFrame:
    """pi times the mean radiance of the disk."""
    return df.groupBy(*by).agg((F.avg(value) * math.pi).alias("irradiance"))


def radiosity(df: DataFrame, by: list[str], names: tuple[str, ...] = ("radiosity", "radiant_flux", "flux")) -> DataFrame:
    """The first of the named quantities that the table has, averaged over all but the keys."""
    have = [n for n in names if n in df.columns]
    if not have:
        raise ValueError(f"none of {names} is there")
    return df.groupBy(*by).agg(F.avg(have[0]).alias("radiosity"))


def histogram(df: DataFrame, value: str, low: float, high: float, bins: int = 50) -> DataFrame:
    """Counts of equal bins; the upper edge belongs to the last."""
    width = (high - low) / bins
    at = F.least(F.floor((F.col(value) - low) / width), F.lit(bins - 1))
    return df.where(F.col(value).between(low, high)).groupBy(at.alias("bin")).agg(F.count("*").alias("n"))


def exact_quantile(df: DataFrame, by: list[str], value: str, q: float, out: str = "quantile") -> DataFrame:
    """Linear quantile of each group (finite values, nulls left out), exactly, with no task that holds a group.

    A selection in rounds: each counts the values between two bounds in BINS ranges of equal width, and goes down into the range that holds the two
    wanted ranks, or ends where they fall in different ranges or on one value. Only counts leave the tasks: some log of the number of
    different values to the base BINS rounds, and only the question whether all groups are done reaches the driver. Groups may be null.
    """
    keys, names = [f"_g{i}" for i in range(len(by))], [f"_k{i}" for i in range(len(by))]
    same = reduce(lambda x, y: x & y, (F.col(g).eqNullSafe(F.col(k)) for g, k in zip(keys, names, strict=True)), F.lit(True))
    rows = df.where(F.col(value).isNotNull()).select(*(F.col(c).alias(g) for c, g in zip(by, keys, strict=True)), F.col(value).cast("double").alias("_v"))
    ends = rows.groupBy(*(F.col(g).alias(k) for g, k in zip(keys, names, strict=True))).agg(F.count("*").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    place = (F.col("_n") - 1) * q
    known = F.when(F.col("_low") == F.col("_high"), F.col("_low"))
    ends = ends.withColumns({"_rank": F.floor(place), "_next": F.least(F.floor(place) + 1, F.col("_n") - 1), "_share": place - F.floor(place), "_below": F.lit(0).cast("long"), "_a": known, "_b": known})
    state = cut(ends, "quantile")
    while not state.where("_a is null").isEmpty():
        near = rows.join(state.where("_a is null"), same).where("_v between _low and _high")
        at = F.least(F.floor((F.col("_v") - F.col("_low")) / ((F.col("_high") - F.col("_low")) / BINS)), F.lit(BINS - 1))
        bins = near.groupBy(*keys, "_rank", "_next", "_below", at.alias("_bin")).agg(F.count("*").alias("_c"), F.min("_v").alias("_min"), F.max("_v").alias("_max"))
        upto = F.col("_below") + F.sum("_c").over(Window.partitionBy(*keys).orderBy("_bin"))  # BINS rows a group
        bins = bins.withColumns({"_to": upto, "_from": upto - F.col("_c")}).where("(_rank >= _from and _rank < _to) or (_next >= _from and _next < _to)")
        found = bins.groupBy(*keys).agg(F.min(F.struct("_from", "_min", "_max")).alias("_f"), F.max(F.struct("_from", "_min", "_max")).alias("_l"))
        apart = F.col("_f._from") != F.col("_l._from")  # then the ranks are the last of one range and the first of the next
        done = apart | (F.col("_f._min") == F.col("_f._max"))
        found = found.select(*keys, F.struct(F.col("_f._from").alias("_below"), F.col("_f._min").alias("_low"), F.col("_f._max").alias("_high"), F.when(done, F.col("_f._max")).alias("_a"), F.when(done, F.col("_l._min")).alias("_b")).alias("_new"))
        before = state
        moved = state.join(found, same, "left")
        state = cut(moved.select(*names, "_n", "_rank", "_next", "_share", *(F.when(F.col("_new").isNull(), F.col(c)).otherwise(F.col(f"_new.{c}")).alias(c) for c in ("_below", "_low", "_high", "_a", "_b"))), "quantile")
        discard(before)
    return state.select(*(F.col(k).alias(c) for c, k in zip(by, names, strict=True)), (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_share")).alias(out))


def display_limit(df: DataFrame, by: list[str], size: int, value: str = "radiance", q: float = 0.99) -> DataFrame:
    """Quantile (linear) of the inner pixels without the first wavelength; nulls count as 0."""
    first = df.agg(F.min("w").alias("_w0"))
    inner = df.join(F.broadcast(first)).where((F.col("w") > F.col("_w0")) & F.col("x_index").between(1, size - 2) & F.col("y_index").between(1, size - 2))
    return exact_quantile(inner.withColumn(value, F.coalesce(value, F.lit(0.0))), by, value, q, "limit")


def class_histogram(df: DataFrame, cover: str = "class") -> DataFrame:
    return df.groupBy(cover).agg(F.count("*").alias("pixels"))


def paint_stats(df: DataFrame, painted: str, temperature: str) -> DataFrame:
    """Share painted in percent, with the range of temperatures."""
    return df.agg((F.avg(F.col(painted).cast("double")) * 100).alias("percent"), F.min(temperature).alias("coldest"), F.max(temperature).alias("warmest"))


def instance_groups(df: DataFrame) -> DataFrame:
    """Count and bounds by species and asset."""
    return df.groupBy("species", "asset").agg(F.count("*").alias("n"), *(f(c).alias(f"{c}_{n}") for c in ("x", "y") for n, f in (("min", F.min), ("max", F.max))))


def error_level(dem: DataFrame, k: int, nx: int, ny: int, value: str = "elevation") -> DataFrame:
    """Largest distance from the least-squares plane in each k x k block: (i, j, error); ragged edges are left out.

    On a full block the axes are orthogonal once centred, so the plane is three sums: mean, and slopes over the spread of an axis.
    """
    i, j = F.floor(F.col("ix") / k), F.floor(F.col("iy") / k)
    b = dem.where((F.col("ix") < nx // k * k) & (F.col("iy") < ny // k * k)).withColumns({"i": i, "j": j})
    mid = (k - 1) / 2
    b = b.withColumns({"_u": F.pmod("ix", F.lit(k)) - mid, "_v": F.pmod("iy", F.lit(k)) - mid})
    spread = k * k * (k * k - 1) / 12
    if k == 1:
        return b.select("i", "j", F.lit(0.0).alias("error"))
    z = F.col(value)
    fit = b.groupBy("i", "j").agg(F.avg(z).alias("_c"), (F.sum(F.col("_u") * z) / spread).alias("_a"), (F.sum(F.col("_v") * z) / spread).alias("_b"))
    far = F.abs(z - F.col("_c") - F.col("_a") * F.col("_u") - F.col("_b") * F.col("_v"))
    return b.join(fit, ["i", "j"]).groupBy("i", "j").agg(F.max(far).alias("error"))


def error_pyramid(dem: DataFrame, depth: int, nx: int, ny: int, value: str = "elevation") -> DataFrame:
    """(level, i, j, error) for levels 0 to depth with blocks of 2^(depth - level); parents are at least their worst child.

    One pass sums the planes of all levels, one takes the residuals of all levels, and one aggregate carries each error to all blocks above it.
    """
    sizes = F.array(*(F.struct(F.lit(depth - e).cast("long").alias("level"), F.lit(1 << e).cast("long").alias("k")) for e in range(depth + 1)))
    whole = lambda n: F.floor(F.lit(n) / F.col("k")) * F.col("k")
    at = lambda c: F.floor(F.col(c) / F.col("k"))
    each = dem.select("ix", "iy", F.col(value).cast("double").alias("_z"), F.explode(sizes).alias("_s")).select("ix", "iy", "_z", "_s.*")
    each = each.where((F.col("ix") < whole(nx)) & (F.col("iy") < whole(ny))).withColumns({"i": at("ix"), "j": at("iy")})
    mid = (F.col("k") - 1) / 2
    each = each.select("level", "k", "i", "j", "_z", (F.col("ix") - F.col("i") * F.col("k") - mid).alias("_u"), (F.col("iy") - F.col("j") * F.col("k") - mid).alias("_v"))
    spread = F.col("k") * F.col("k") * (F.col("k") * F.col("k") - 1) / 12.0
    fits = each.where("k > 1").groupBy("level", "k", "i", "j").agg(F.avg("_z").alias("_c"), F.sum(F.col("_u") * F.col("_z")).alias("_su"), F.sum(F.col("_v") * F.col("_z")).alias("_sv"))
    fits = fits.select("level", "i", "j", "_c", (F.col("_su") / spread).alias("_a"), (F.col("_sv") / spread).alias("_b"))
    far = F.abs(F.col("_z") - F.col("_c") - F.col("_a") * F.col("_u") - F.col("_b") * F.col("_v"))
    own = each.join(fits, ["level", "i", "j"], "left").groupBy("level", "i", "j").agg(F.coalesce(F.max(far), F.lit(0.0)).alias("error"))  # the finest have no plane
    up = own.withColumn("_up", F.explode(F.sequence(F.lit(0).cast("long"), "level")))
    shift = lambda c: F.floor(F.col(c) / F.pow(F.lit(2.0), F.col("_up")))
    carried = up.select((F.col("level") - F.col("_up")).alias("level"), shift("i").alias("i"), shift("j").alias("j"), "error", (F.col("_up") == 0).alias("_own"))
    # a ragged block that is no block of its level takes no error from below
    return carried.groupBy("level", "i", "j").agg(F.max("error").alias("error"), F.max("_own").alias("_own")).where("_own").drop("_own")


def layer_height(layers: DataFrame, by: str, share: float = 0.92, fallback: float = 2000.0) -> DataFrame:
    """Top of the first layer from the ground up where the summed share of optical depth reaches the limit."""
    run = F.sum("frac").over(Window.partitionBy(by).orderBy("lay").rowsBetween(Window.unboundedPreceding, 0))
    s = layers.withColumn("_run", run)
    return s.groupBy(by).agg(F.coalesce(F.min_by("top", F.when(F.col("_run") >= share, F.col("lay"))), F.lit(fallback)).alias("height"))


def gaussian_kernel(sigma: float, truncate: float = 4.0) -> list[tuple[int, float]]:
    radius = int(truncate * sigma + 0.5)
    weights = [math.exp(-0.5 * (k / sigma) ** 2) for k in range(-radius, radius + 1)]
    return [(k - radius, w / sum(weights)) for k, w in enumerate(weights)]


def smooth(df: DataFrame, sigma: float, nx: int, ny: int, value: str = "p") -> DataFrame:
    """Gaussian smoothing of a full grid with nearest edges: two passes, each an explode over the kernel and a sum by cell."""
    if sigma <= 0:
        return df
    kernel = gaussian_kernel(sigma)
    reach = len(kernel) // 2
    for axis, n in (("ix", nx), ("iy", ny)):
        other = "iy" if axis == "ix" else "ix"
        # a cell feeds every cell in reach; an edge cell also stands for those beyond the edge
        ghosts = F.when((F.col(axis) == 0) & (F.col(axis) == n - 1), F.sequence(F.lit(-reach), F.lit(n - 1 + reach))).when(F.col(axis) == 0, F.sequence(F.lit(-reach), F.lit(0))).when(F.col(axis) == n - 1, F.sequence(F.lit(n - 1), F.lit(n - 1 + reach))).otherwise(F.array(F.col(axis).cast("int")))
        k = F.array(*(F.struct(F.lit(o).alias("o"), F.lit(w).alias("w")) for o, w in kernel))
        spread = df.select(other, F.explode(ghosts).alias("_at"), value).withColumn("_k", F.explode(k))
        moved = spread.select(other, (F.col("_at") - F.col("_k.o")).cast("long").alias(axis), (F.col(value) * F.col("_k.w")).alias("_v")).where(F.col(axis).between(0, n - 1))
        df = moved.groupBy("ix", "iy").agg(F.sum("_v").alias(value))
    return df


def allocate_indices(base: DataFrame, names: DataFrame, most: int = 255) -> DataFrame:
    """Known names keep their index; new ones, sorted, take the next. More than ``most`` fails the query."""
    new = names.select("name").distinct().join(base, "name", "left_anti")
    top = base.agg(F.coalesce(F.max("idx"), F.lit(-1)).alias("_top"))
    # indices are at most a byte: the order is over a few hundred names
    numbered = new.withColumn("_n", F.row_number().over(Window.orderBy("name"))).join(F.broadcast(top))
    idx = F.col("_top") + F.col("_n")
    held = F.when(idx <= most, idx).otherwise(F.raise_error(F.concat(F.lit("no index left for "), F.col("name"))).cast("int"))
    return base.select("name", F.col("idx").cast("long").alias("idx")).unionByName(numbered.select("name", held.cast("long").alias("idx")))


def class_index(mapping: DataFrame, column: str = "mapping") -> DataFrame:
    """(class, material, idx): the place of each class in an ordered map."""
    return mapping.select(F.posexplode(F.map_entries(column)).alias("idx", "e")).select(F.col("e.key").alias("class"), F.col("e.value").alias("material"), F.col("idx").cast("long").alias("idx"))


def overlay_names(named: DataFrame, cover: DataFrame) -> DataFrame:
    """Distinct names that are no land-cover names."""
    return named.select("name").where("name is not null").distinct().join(cover.select("name"), "name", "left_anti")
