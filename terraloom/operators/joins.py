"""Spatial, temporal, spectral and reference joins."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraloom.operators.geometry import along_segment, covering_cells, in_polygon, levels_of, outside, ring_bounds, rings_meet, same_cell, segment_distance, strip_cells, strip_levels, with_cell
from terraloom.operators.roads import in_joint, next_of
from terraloom.operators.sampling import in_brackets, in_ranges


def select_tiles(index: DataFrame, aoi: Column, ring: str = "ring", must_hit: bool = False) -> DataFrame:
    """Distinct paths of tiles whose footprint meets the area of interest (a ring): bounds first, then corners and edges.

    With ``must_hit`` an area that no tile meets raises a ValueError; to know that, the search runs once when called.
    """
    found = index.where(rings_meet(F.col(ring), aoi)).select("path").distinct()
    if must_hit and found.isEmpty():
        raise ValueError("no tile meets the area of interest")
    return found


def quadkey(x: Column, y: Column, zoom: int) -> Column:
    """Base-4 key of a web tile: a digit a zoom level, the x bit counts 1 and the y bit 2."""
    digit = lambda i: (F.shiftright(x, i).bitwiseAND(F.lit(1)) + F.shiftright(y, i).bitwiseAND(F.lit(1)) * 2).cast("string")
    return F.concat(*(digit(i) for i in range(zoom - 1, -1, -1)))


def web_tile(lat: Column, lon: Column, zoom: int) -> tuple[Column, Column]:
    """Tile numbers of a place; those of the poles are held at the edge."""
    n = float(1 << zoom)
    s = F.sin(F.radians(lat))
    x = F.floor((lon / 360.0 + 0.5) * n)
    y = F.floor((0.5 - 0.25 * F.log((1 + s) / (1 - s)) / math.pi) * n)
    hold = lambda v: F.greatest(F.lit(0), F.least(v, F.lit(int(n) - 1)))
    return hold(x).cast("long"), hold(y).cast("long")


def quadkey_tiles(boxes: DataFrame, index: DataFrame, zoom: int) -> tuple[DataFrame, DataFrame]:
    """Tiles of an index (quadkey, present) that cover boxes (west, south, east, north): those present, and those listed but absent."""
    x0, y1 = web_tile(F.col("south"), F.col("west"), zoom)
    x1, y0 = web_tile(F.col("north"), F.col("east"), zoom)
    tiles = boxes.withColumn("_x", F.explode(F.sequence(x0, x1))).withColumn("_y", F.explode(F.sequence(y0, y1)))
    keys = tiles.select(quadkey(F.col("_x"), F.col("_y"), zoom).alias("quadkey")).distinct()
    listed = index.join(keys, "quadkey", "left_semi")
    return listed.where("present"), listed.where("not present")


def exclude_zones(points: DataFrame, zones: DataFrame, cell: float) -> DataFrame:
    """Points that meet no zone; boundaries count as inside.

    zones: (kind, cx, cy, r, w, h, ring), kind circle, box or polygon; cell: an edge near that of the small ones. Zones of any size take a few
    cells each, on the level of their size.
    """
    r, w, h = (F.coalesce(c, F.lit(0.0)) for c in ("r", "w", "h"))
    ringed = F.col("kind") == "polygon"
    rx0, ry0, rx1, ry1 = ring_bounds(F.col("ring"))
    ex, ey = F.greatest(r, w / 2), F.greatest(r, h / 2)
    bounds = tuple(F.when(ringed, a).otherwise(b) for a, b in ((rx0, F.col("cx") - ex), (ry0, F.col("cy") - ey), (rx1, F.col("cx") + ex), (ry1, F.col("cy") + ey)))
    px, py = F.col("a.x"), F.col("a.y")
    circle = (px - F.col("b.cx")) ** 2 + (py - F.col("b.cy")) ** 2 <= F.col("b.r") ** 2
    box = (F.abs(px - F.col("b.cx")) <= F.col("b.w") / 2) & (F.abs(py - F.col("b.cy")) <= F.col("b.h") / 2)
    hit = F.when(F.col("b.kind") == "circle", circle).when(F.col("b.kind") == "box", box).otherwise(in_polygon(px, py, F.col("b.ring")))
    return outside(points, zones, cell, bounds, hit)


def zones_in_scene(zones: DataFrame, projection) -> DataFrame:  # noqa: ANN001
    """Zones (as for ``exclude_zones``, with ``coord_type``) in scene metres: centres and corners of those that are ``geographic`` (x is
    longitude, y latitude) are projected by ``projection``; radii, widths and heights are metres already."""
    geographic = F.col("coord_type") == "geographic"
    cx, cy = projection.forward(F.col("cy"), F.col("cx"))

    def corner(p: Column) -> Column:
        x, y = projection.forward(p["y"], p["x"])
        return F.struct(x.alias("x"), y.alias("y"))

    ring = F.when(geographic, F.transform("ring", corner)).otherwise(F.col("ring"))
    return zones.withColumns({"cx": F.when(geographic, cx).otherwise(F.col("cx")), "cy": F.when(geographic, cy).otherwise(F.col("cy")), "ring": ring}).drop("coord_type")


def exclude_roads(points: DataFrame, segments: DataFrame, buffer_m: float, cell: float, enabled: bool = True) -> DataFrame:
    """Points off every road widened by ``buffer_m``: the road itself ends flat, the buffer about it is round.

    segments: (x1, y1, x2, y2, width_m), of lines with bends after ``with_next``: the outside of a bend is rounded.
    """
    if not enabled:
        return points
    reach = F.col("width_m") / 2 + buffer_m
    own = tuple(F.col(c) for c in ("x1", "y1", "x2", "y2"))
    ends = tuple(F.col(f"b.{c}") for c in ("x1", "y1", "x2", "y2"))
    px, py = F.col("a.x"), F.col("a.y")
    half = F.col("b.width_m") / 2
    t = along_segment(px, py, *ends)
    length = F.hypot(ends[2] - ends[0], ends[3] - ends[1])
    side = F.abs((px - ends[0]) * (ends[3] - ends[1]) - (py - ends[1]) * (ends[2] - ends[0])) / F.nullif(length, F.lit(0.0))
    # distance to the flat-ended rectangle: past the ends by so much, beyond the side by so much
    past = F.greatest(F.lit(0.0), -t * length, (t - 1) * length)
    out = F.greatest(F.lit(0.0), side - half)
    hit = F.when(length > 0, F.hypot(past, out) <= buffer_m).otherwise(segment_distance(px, py, *ends) <= half + buffer_m)
    joint = in_joint(px - ends[2], py - ends[3], ends, *next_of(segments, "b")) & (F.hypot(px - ends[2], py - ends[3]) <= half + buffer_m)
    # different places meet different segments, on cells along these; the points then take what holds of their place
    roads = segments.select(*(c for c in ("x1", "y1", "x2", "y2", "width_m", "next_x", "next_y") if c in segments.columns)).distinct()
    places = points.select("x", "y").distinct()
    levels = strip_levels(roads, cell, own, reach)
    off = places
    for level in reversed(levels):
        here = strip_cells(roads, cell, own, reach, level).alias("b")
        off = with_cell(off, cell, levels=[level]).alias("a").join(here, same_cell() & (hit | joint), "left_anti").drop("_lv", "_cx", "_cy")
    off = off.select(F.col("x").alias("_x"), F.col("y").alias("_y"))
    return points.join(off, F.col("x").eqNullSafe(F.col("_x")) & F.col("y").eqNullSafe(F.col("_y")), "left_semi") if levels else points


def species_for_pixels(pixels: DataFrame, mapping: DataFrame) -> DataFrame:
    """Pixels with every species of their class; the mapping holds a row a class and species."""
    return pixels.join(mapping, "class")


def nearest_by(left: DataFrame, right: DataFrame, at: str, value: str, by: list[str] | None = None, out: str = "value") -> DataFrame:
    """Left rows with the right value nearest along ``at`` (the earlier on ties), null right values left out: an as-of join both ways.

    With ``by`` each series is the rows of one window. Without it the rows are sorted over ranges, and what is known at the end of one range is carried
    into the next, a row a range.
    """
    by = by or []
    l = left.withColumn("_row", F.struct(*left.columns)).select(*by, F.col(at).alias("_at"), "_row", F.lit(None).cast(right.schema[value].dataType).alias("_v"), F.lit(1).alias("_k"))
    r = right.where(F.col(value).isNotNull()).select(*by, F.col(at).alias("_at"), F.lit(None).cast(l.schema["_row"].dataType).alias("_row"), F.col(value).alias("_v"), F.lit(0).alias("_k"))
    found = F.when(F.col("_v").isNotNull(), F.struct(F.col("_at").alias("t"), F.col("_v").alias("v")))
    both = l.unionByName(r).withColumn("_f", found)
    part, order = by, ["_at", "_k"]
    if not by:
        both, carry = in_ranges(both, ["_at", "_k"], F.last("_f", ignorenulls=True), F.first("_f", ignorenulls=True))
        part, order = ["_part"], ["_line"]
    # what comes next is what came last in the opposite order: a frame that ends with the window is read anew for each row
    ahead, back = (Window.partitionBy(*part).orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0) for keys in (order, [F.desc(c) for c in order]))
    both = both.withColumn("_p", F.last("_f", ignorenulls=True).over(ahead)).withColumn("_n", F.last("_f", ignorenulls=True).over(back))
    if not by:
        both = both.join(carry, "_part").withColumns({"_p": F.coalesce("_p", "_before"), "_n": F.coalesce("_n", "_after")})
    gap = lambda c: F.abs(F.col(c)["t"].cast("double") - F.col("_at").cast("double"))
    best = F.when(F.col("_n").isNull() | (gap("_p") <= gap("_n")), F.col("_p")["v"]).otherwise(F.col("_n")["v"])
    return both.where("_k = 1").select("_row.*", best.alias(out))


def nearest_axis(values: DataFrame, axis: DataFrame, value: str, at: str) -> DataFrame:
    """Distinct values with the nearest point of an axis (the smaller on ties)."""
    points = axis.where(F.col(at).isNotNull()).select(F.col(at).alias("_axis")).distinct().withColumn("_point", F.col("_axis"))
    held = in_brackets(values.where(F.col(value).isNotNull()).select(value).distinct(), points, F.col(value), "_axis", "_point")
    near = F.when(F.col("lo").isNull(), F.col("_first._point")).when(F.col("_x") - F.col("lo") <= F.col("hi") - F.col("_x"), F.col("vlo")).otherwise(F.col("vhi"))
    return held.select(value, near.alias(f"{value}_cell"))


def nearest_cell(obs: DataFrame, grid: DataFrame, at: str = "ts") -> DataFrame:
    """Observations (x, y, time) with the nearest grid cell's row of their calendar month, nulls where the grid lacks it.

    grid: (ix, iy, month, values); the cell comes back as x_cell, y_cell.
    """
    near = obs.join(nearest_axis(obs, grid, "x", "ix"), "x", "left").join(nearest_axis(obs, grid, "y", "iy"), "y", "left")
    g = grid.withColumnsRenamed({"ix": "x_cell", "iy": "y_cell"})
    return near.withColumn("month", F.month(at)).join(g.withColumn("month", F.col("month").cast("int")), ["x_cell", "y_cell", "month"], "left")


def reflectance_inputs(measures: DataFrame, radiance: DataFrame, irradiance: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Radiance rows of each measurement with the irradiance of their wavelength, and the measurements skipped with the reason.

    measures: (measure_id, sensor_id, irradiance_id); skipped are those without ids, radiance, irradiance, or a common wavelength.
    """
    r, i = radiance.where("radiance is not null"), irradiance.where("irradiance is not null")
    found = measures.join(r, "sensor_id").join(i, ["irradiance_id", "w"])
    common = measures.join(r.select("sensor_id", "w").distinct(), "sensor_id").join(i.select("irradiance_id", "w"), ["irradiance_id", "w"], "left_semi")
    lost = measures.join(common.select("measure_id").distinct(), "measure_id", "left_anti")
    lost = lost.join(r.select("sensor_id", F.lit(True).alias("_r")).distinct(), "sensor_id", "left").join(i.select("irradiance_id", F.lit(True).alias("_i")).distinct(), "irradiance_id", "left")
    reason = F.when(F.col("sensor_id").isNull() | F.col("irradiance_id").isNull(), "ids").when(F.col("_r").isNull(), "radiance").when(F.col("_i").isNull(), "irradiance").otherwise("wavelengths")
    return found, lost.select("measure_id", reason.alias("reason"))


def fwhm_for(df: DataFrame, regions: DataFrame, w: str = "w") -> DataFrame:
    """Rows with the FWHM of the region (wmin <= w < wmax); below all of them the first one's, else the last one's.

    Different wavelengths meet the regions by an equi join on cells of an axis, whatever their number; the rows then take theirs by wavelength.
    """
    ends = regions.agg(F.min(F.struct("wmin", "fwhm")).alias("_first"), F.max(F.struct("wmin", "fwhm")).alias("_last"))  # one row
    bounds = F.col("wmin"), F.lit(0.0), F.col("wmax"), F.lit(0.0)
    axis = df.where(F.col(w).isNotNull()).select(F.col(w).alias("_w"), F.lit(0.0).alias("_y")).distinct()
    cells = with_cell(axis, 10.0, "_w", "_y", levels_of(regions, 10.0, bounds)).alias("a")
    found = cells.join(covering_cells(regions, 10.0, bounds).alias("b"), same_cell() & (F.col("_w") >= F.col("wmin")) & (F.col("_w") < F.col("wmax"))).select("_w", "fwhm").distinct()
    j = df.join(found, F.col(w) == F.col("_w"), "left").join(F.broadcast(ends))
    held = F.when(F.col(w) < F.col("_first.wmin"), F.col("_first.fwhm")).otherwise(F.col("_last.fwhm"))
    return j.withColumn("fwhm", F.coalesce("fwhm", held)).drop("_w", "_first", "_last")


def check_references(rows: DataFrame, known: DataFrame, id_col: str, ref_col: str, known_col: str) -> DataFrame:
    """Violations (kind, id): ids that come twice or more, and references to nothing."""
    twice = rows.groupBy(F.col(id_col).alias("id")).count().where("count > 1").select(F.lit("duplicate").alias("kind"), "id")
    names = known.select(F.col(known_col).alias("_known")).distinct()
    lost = rows.where(F.col(ref_col).isNotNull()).join(names, F.col(ref_col) == F.col("_known"), "left_anti").select(F.lit("dangling").alias("kind"), F.col(id_col).alias("id"))
    return twice.unionByName(lost)


#: (measurement types, reference column, what it must be, type it must have there): sensors with a field of view are cameras.
REFERENCES: tuple[tuple[tuple[str, ...], str, str, str | None], ...] = (
    (("hdrf", "hcrf", "brf"), "radiance_sensor_id", "sensor", None),
    (("hcrf",), "radiance_sensor_id", "sensor", "camera"),
    (("pixel_brf", "pixel_hdrf"), "satellite_sensor_id", "sensor", "satellite"),
    (("hdrf", "hcrf", "brf", "bhr"), "irradiance_measurement_id", "measurement", "irradiance"),
)


def check_simulation(sensors: DataFrame, measurements: DataFrame) -> DataFrame:
    """Violations (id, rule, reference) of a simulation's ids and references.

    sensors: (id, type, fov or null); measurements: (id, type, radiance_sensor_id, satellite_sensor_id, irradiance_measurement_id). Ids come once; a reference
    that is given must be there, of the type that REFERENCES asks; the satellite sensor of a pixel measurement must be given. The references of all columns
    are rows of one table, joined once with the known ids.
    """
    twice = lambda rows, what: rows.where("id is not null").groupBy("id").count().where("count > 1").select("id", F.lit(f"duplicate {what}").alias("rule"), F.lit(None).cast("string").alias("reference"))
    must = F.array(*(F.struct(F.array(*map(F.lit, types)).alias("types"), F.lit(column).alias("column"), F.col(column).cast("string").alias("to"), F.lit(what).alias("what"), F.lit(kind).cast("string").alias("kind")) for types, column, what, kind in REFERENCES))
    asked = measurements.select("id", "type", F.explode(F.filter(must, lambda r: F.array_contains(r["types"], F.col("type")))).alias("r")).select("id", "r.column", "r.to", "r.what", "r.kind")
    missing = asked.where("to is null and column = 'satellite_sensor_id'").select("id", F.lit("no sensor given").alias("rule"), F.lit(None).cast("string").alias("reference"))
    is_a = F.when(F.col("fov").isNotNull(), F.array("type", F.lit("camera"))).otherwise(F.array("type"))
    known = sensors.select(F.lit("sensor").alias("what"), F.col("id").cast("string").alias("to"), is_a.alias("is_a")).unionByName(measurements.select(F.lit("measurement").alias("what"), F.col("id").cast("string").alias("to"), F.array("type").alias("is_a")))
    known = known.groupBy("what", "to").agg(F.array_distinct(F.flatten(F.collect_list("is_a"))).alias("is_a"))
    found = asked.where("to is not null").join(known, ["what", "to"], "left")
    rule = F.when(F.col("is_a").isNull(), F.concat(F.lit("unknown "), "what")).when(F.col("kind").isNotNull() & ~F.array_contains("is_a", F.col("kind")), F.concat("what", F.lit(" is no "), "kind"))
    dangling = found.select("id", rule.alias("rule"), F.col("to").alias("reference")).where("rule is not null").distinct()
    return twice(sensors, "sensor").unionByName(twice(measurements, "measurement")).unionByName(missing).unionByName(dangling)


def merge_libraries(*libraries: DataFrame, key: str = "material_id") -> DataFrame:
    """Union of material tables; where ids clash the later library wins."""
    union = None
    for i, lib in enumerate(libraries):
        part = lib.withColumn("_lib", F.lit(i))
        union = part if union is None else union.unionByName(part)
    rest = [c for c in union.columns if c != key]
    best = union.groupBy(key).agg(F.max_by(F.struct(*rest), "_lib").alias("_m"))
    return best.select(key, *(F.col("_m")[c].alias(c) for c in rest if c != "_lib"))


MOST_PATTERNS = 10_000  # every different name is tried with each


def glob_to_regex(pattern: Column) -> Column:
    quoted = F.regexp_replace(pattern, r"([.+^$(){}|\\\[\]])", r"\\$1")
    return F.concat(F.lit("^"), F.replace(F.replace(quoted, F.lit("*"), F.lit(".*")), F.lit("?"), F.lit(".")), F.lit("$"))


def assign_materials(meshes: DataFrame, patterns: DataFrame, fallback: str = "concrete") -> DataFrame:
    """Meshes (name, own_material) with the material of the first pattern (pos, pattern, is_regex, material) that matches.

    Otherwise their own cleaned material, else the fallback. Patterns are an ordered list of a configuration, MOST_PATTERNS at most: they are broadcast.
    """
    if patterns.limit(MOST_PATTERNS + 1).count() > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} patterns")
    p = patterns.withColumn("_re", F.when(F.col("is_regex"), F.col("pattern")).otherwise(glob_to_regex(F.col("pattern"))))
    names = meshes.select("name").distinct().join(F.broadcast(p.select("_re", "pos", F.col("material").alias("_m"))), F.expr("name rlike _re"))
    first = names.groupBy("name").agg(F.min_by("_m", "pos").alias("_m"))
    own = F.nullif(F.translate(F.col("own_material"), ".-", "__"), F.lit(""))
    return meshes.join(first, "name", "left").withColumn("material", F.coalesce("_m", own, F.lit(fallback))).drop("_m")


def pixel_targets(pixels: DataFrame, sensors: DataFrame, z: Column | float = 0.0) -> tuple[DataFrame, DataFrame]:
    """One row for each listed pixel of a measurement with its scene target, and the measurements whose sensor is unknown.

    pixels: (measure_id, sensor_id, pixels array<struct<row, col>>, offset); sensors: (sensor_id, xmin, ymin, xmax, ymax, width, height).
    """
    from terraloom.functions.projection import pixel_centre

    each = pixels.withColumn("p", F.explode("pixels")).select("measure_id", "sensor_id", "offset", "p.row", "p.col")
    x, y = pixel_centre(F.col("row"), F.col("col"), tuple(F.col(c) for c in ("xmin", "ymin", "xmax", "ymax")), F.col("width"), F.col("height"))
    found = each.join(sensors, "sensor_id").select(F.concat("measure_id", F.lit("_r"), "row", F.lit("_c"), "col").alias("target_id"), "measure_id", x.alias("x"), y.alias("y"), "offset")
    return found, pixels.join(sensors, "sensor_id", "left_anti").select("measure_id", "sensor_id")
