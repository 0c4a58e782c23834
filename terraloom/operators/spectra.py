"""Spectral operators: units, band interpolation, alignment, response, matching."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def to_nanometres(spectra: DataFrame, key: str = "material_id", w: str = "w") -> DataFrame:
    """Wavelengths of a spectrum whose largest is below 100 are micrometres."""
    most = F.max(w).over(Window.partitionBy(key))
    return spectra.withColumn(w, F.when(most < 100, F.col(w) * 1000.0).otherwise(F.col(w)))


def align_wavelengths(radiance: DataFrame, reference: DataFrame, by: str, value: str, fill: float | None = None, w: str = "w") -> DataFrame:
    """Distinct (by, w) of the radiance with the reference interpolated there; out of its range the fill. Without one such a row fails the query.

    An as-of join both ways over each series: the neighbours of a wavelength come from one ordered window.
    """
    want = radiance.select(by, w).distinct().withColumn("_want", F.lit(True))
    both = want.join(reference.select(by, w, value), [by, w], "full_outer")
    order = Window.partitionBy(by).orderBy(w)
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(w).alias("w"), F.col(value).alias("v")))
    both = both.withColumn("_lo", F.last(known, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    both = both.withColumn("_hi", F.first(known, ignorenulls=True).over(order.rowsBetween(0, Window.unboundedFollowing)))
    lo, hi = F.col("_lo"), F.col("_hi")
    line = lo["v"] + (F.col(w) - lo["w"]) * F.coalesce(F.try_divide(hi["v"] - lo["v"], hi["w"] - lo["w"]), F.lit(0.0))
    inside = lo.isNotNull() & hi.isNotNull()
    lost = F.raise_error(F.concat(F.lit("outside the reference of "), F.coalesce(F.col(by).cast("string"), F.lit("null")), F.lit(": wavelength "), F.col(w).cast("string"))).cast("double")
    return both.where("_want").select(by, w, F.when(inside, line).otherwise(lost if fill is None else F.lit(fill).cast("double")).alias(value))


#: Centres in nanometres of the four 10 m bands.
BAND_CENTRES = [("b02", 490.0), ("b03", 560.0), ("b04", 665.0), ("b08", 842.0)]


def interp_to_bands(spectra: DataFrame, key: str = "material_id", w: str = "w", value: str = "value") -> DataFrame:
    """A row a material with its value at the band centres; a spectrum that does not span them is left out.

    Wavelengths below 100 are micrometres. A spectrum of a single value (null wavelength) is the same in all bands.
    """
    s = to_nanometres(spectra, key, w)
    order = Window.partitionBy(key).orderBy(w)
    steps = s.where(F.col(w).isNotNull()).select(key, F.col(w).alias("lo"), F.col(value).alias("vlo"), F.lead(w).over(order).alias("hi"), F.lead(value).over(order).alias("vhi"))
    bands = F.array(*(F.struct(F.lit(n).alias("band"), F.lit(c).alias("at")) for n, c in BAND_CENTRES))
    at = steps.where("hi is not null").withColumn("b", F.explode(F.filter(bands, lambda b: (b["at"] >= F.col("lo")) & (b["at"] <= F.col("hi")))))
    v = F.col("vlo") + (F.col("b.at") - F.col("lo")) * (F.col("vhi") - F.col("vlo")) / (F.col("hi") - F.col("lo"))
    wide = at.groupBy(key).agg(*(F.max(F.when(F.col("b.band") == n, v)).alias(n) for n, _ in BAND_CENTRES))
    wide = wide.where(" and ".join(f"{n} is not null" for n, _ in BAND_CENTRES))
    flat = s.where(F.col(w).isNull()).select(key, *(F.col(value).alias(n) for n, _ in BAND_CENTRES))
    return wide.unionByName(flat)


def match_sam(clusters: DataFrame, library: DataFrame, max_degrees: float) -> DataFrame:
    """Clusters (cluster, vector) with the library material (lib_pos, material_id, vector) of the smallest spectral angle.

    Ties go to the first of the library; null beyond the limit. Angles are a metric: two vectors within the limit differ by no more in their angles to
    any third one. So clusters and materials meet by an equi join on their angles to the first two axes, in steps of the limit, each cluster in
    nine of them, and not all with all.
    """
    from terraloom.functions.projection import spectral_angle

    step = max(float(max_degrees), 1e-3) + 1e-6

    def with_bins(rows: DataFrame) -> DataFrame:
        norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
        angle = lambda i: F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.coalesce(F.get("vector", F.lit(i)), F.lit(0.0)) / F.nullif(norm, F.lit(0.0))))))
        return rows.withColumns({f"_b{i}": F.floor(angle(i) / step) for i in (0, 1)})

    near = F.array(*(F.lit(i) for i in (-1, 0, 1)))
    few = with_bins(clusters).select("cluster", F.col("vector").alias("_c"), F.explode(F.transform(near, lambda i: F.col("_b0") + i)).alias("_b0"), "_b1")
    few = few.withColumn("_b1", F.explode(F.transform(near, lambda i: F.col("_b1") + i)))
    pairs = with_bins(library).join(few, ["_b0", "_b1"]).withColumn("angle", F.degrees(spectral_angle(F.col("_c"), F.col("vector"))))
    best = pairs.where(~F.isnan("angle") & (F.col("angle") <= max_degrees)).groupBy("cluster").agg(F.min(F.struct("angle", "lib_pos", "material_id")).alias("m"))
    return clusters.select("cluster").join(best, "cluster", "left").select("cluster", F.col("m.material_id").alias("material_id"), F.col("m.angle").alias("angle"))


def gaussian_srf(radiance: DataFrame, outputs: DataFrame, keys: list[str], value: str = "radiance", w: str = "w") -> DataFrame:
    """Gaussian-weighted mean about each output wavelength (w_out, fwhm), weights times bin widths.

    The normalised mean and the cut at 3 FWHM are our own definition. radiance: keys, w, bin_wmin, bin_wmax, value. An equi join
    on bins as wide as the widest response: an output stands in each bin that it reaches, two at most.
    """
    sigma = F.col("fwhm") / 2.3548200450309493
    near = F.abs(F.col(w) - F.col("w_out")) <= 3 * F.col("fwhm")
    widest = F.broadcast(outputs.agg(F.greatest(6 * F.max("fwhm"), F.lit(1e-6)).alias("_wide")))  # one row
    bin_of = lambda v: F.floor(v / F.col("_wide"))
    reach = outputs.join(widest).withColumn("_bin", F.explode(F.sequence(bin_of(F.col("w_out") - 3 * F.col("fwhm")), bin_of(F.col("w_out") + 3 * F.col("fwhm"))))).drop("_wide")
    j = radiance.join(widest).withColumn("_bin", bin_of(F.col(w))).join(reach, "_bin").where(near)
    weight = F.exp(-0.5 * ((F.col(w) - F.col("w_out")) / sigma) ** 2) * (F.col("bin_wmax") - F.col("bin_wmin"))
    return j.groupBy(*keys, "w_out").agg((F.sum(weight * F.col(value)) / F.sum(weight)).alias(value))


def pick_channels(df: DataFrame, targets: list[float], keys: list[str], brightness: float = 1.0, value: str = "radiance", w: str = "w") -> DataFrame:
    """Nearest wavelength to each target, scaled, clipped to 0..1, as 0..255; pixels without a value are white."""
    axis = df.select(F.col(w).alias("_w")).distinct()
    near = axis.agg(*(F.min(F.struct(F.abs(F.col("_w") - t), "_w"))["_w"].alias(f"_t{i}") for i, t in enumerate(targets)))
    j = df.join(F.broadcast(near))  # one row
    out = j.groupBy(*keys).agg(*(F.max(F.when(F.col(w) == F.col(f"_t{i}"), F.col(value))).alias(f"c{i}") for i in range(len(targets))))
    byte = lambda c: F.coalesce(F.floor(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col(c) * brightness)) * 255), F.lit(255)).cast("long")
    return out.select(*keys, *(byte(f"c{i}").alias(f"c{i}") for i in range(len(targets))))


def wavelength_grid(spark, first: float, last: float, step: float) -> DataFrame:  # noqa: ANN001
    """Regular grid that keeps its end by half a step."""
    n = int((last - first) / step + 0.5) + 1
    return spark.range(n).select((F.lit(first) + F.col("id") * step).alias("w"))


def check_spectra(spectra: DataFrame) -> DataFrame:
    """Violations (material_id, rule) of value range, positive and rising wavelengths, and two points at least.

    spectra: (material_id, pos, w, value).
    """
    order = Window.partitionBy("material_id").orderBy("pos")
    s = spectra.withColumn("_before", F.lag("w").over(order))
    rules = F.filter(
        F.array(
            F.when((F.col("value") < 0) | (F.col("value") > 1), "value outside 0..1"),
            F.when(F.col("w") <= 0, "wavelength not positive"),
            F.when(F.col("w") <= F.col("_before"), "wavelengths not rising"),
        ),
        lambda r: r.isNotNull(),
    )
    rows = s.select("material_id", F.explode(rules).alias("rule"))
    short = spectra.groupBy("material_id").count().where("count < 2").select("material_id", F.lit("fewer than two points").alias("rule"))
    return rows.unionByName(short).distinct()


#: Parameters whose values lie in 0..1.
UNIT = ("reflectance", "transmittance", "rho_0", "rho_c")
#: (rule, parameters it holds for or None for all, violation) over rows of one parameter; RGB is a uniform value of several components.
RULES: tuple[tuple[str, tuple[str, ...] | None, str], ...] = (
    ("unknown kind", None, "kind is null or kind not in ('uniform', 'interpolated', 'file')"),
    ("no value", None, "kind = 'uniform' and value is null and rgb is null"),
    ("value outside 0..1", UNIT, "kind = 'uniform' and (value < 0 or value > 1 or exists(rgb, c -> c < 0 or c > 1))"),
    ("rgb without three components", None, "kind = 'uniform' and size(rgb) <> 3 and rgb is not null"),
    ("wavelengths or values missing", None, "kind = 'interpolated' and (wavelengths is null or values is null)"),
    ("wavelengths and values differ in number", None, "kind = 'interpolated' and size(wavelengths) <> size(values) and wavelengths is not null and values is not null"),
    ("fewer than two points", None, "kind = 'interpolated' and size(wavelengths) < 2 and wavelengths is not null"),
    ("wavelength not positive", None, "kind = 'interpolated' and exists(wavelengths, w -> w <= 0)"),
    ("wavelengths not rising", None, "kind = 'interpolated' and exists(zip_with(wavelengths, slice(wavelengths, 2, greatest(size(wavelengths), 1)), (a, b) -> b <= a), x -> x)"),
    ("interpolated value outside 0..1", UNIT, "kind = 'interpolated' and exists(values, v -> v < 0 or v > 1)"),
    ("file without path or variable", None, "kind = 'file' and (path is null or variable is null)"),
    ("k below 0", ("k",), "kind = 'uniform' and value < 0"),
    ("Theta outside -1..1", ("Theta",), "kind = 'uniform' and not value between -1 and 1"),
)


def check_parameters(parameters: DataFrame) -> DataFrame:
    """Violations (material_id, parameter, rule) of RULES, and of energy conservation: uniform reflectance and transmittance of one material above 1.

    parameters: (material_id, parameter, kind uniform or interpolated or file, value, rgb, wavelengths, values, path, variable), a row a parameter; what a kind
    does not use is null. One pass for the rules and one aggregate for the pairs; a null never counts as out of range.
    """
    held = lambda names: F.lit(True) if names is None else F.col("parameter").isin(*names)
    broken = F.array_compact(F.array(*(F.when(held(names) & F.coalesce(F.expr(test), F.lit(False)), F.lit(rule)) for rule, names, test in RULES)))
    rows = parameters.select("material_id", "parameter", F.explode(broken).alias("rule"))
    scalar = lambda name: F.max(F.when((F.col("parameter") == name) & (F.col("kind") == "uniform"), F.col("value")))
    pairs = parameters.groupBy("material_id").agg(scalar("reflectance").alias("_r"), scalar("transmittance").alias("_t")).where("_r + _t > 1")
    return rows.unionByName(pairs.select("material_id", F.lit("transmittance").alias("parameter"), F.lit("reflectance and transmittance above 1").alias("rule")))
