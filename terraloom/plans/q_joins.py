"""Queries of joins and spectral operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.functions import projection as P
from terraloom.operators import geometry as G
from terraloom.operators import joins as J
from terraloom.operators import sampling as SM
from terraloom.operators import spectra as X
from terraloom.operators.roads import with_next
from terraloom.plans.q_filters import _BILINEAR, _CORNERS, DIAMOND, boxes, dem_at, r6
from terraloom.plans.q_functions import _FORWARD, _HOTINE, CENTRE
from terraloom.plans.registry import query
from terraloom.plans.views import duckdb, table, view


@query("jon1_select_tiles", duckdb("v_zones", then="""WITH c AS (SELECT zone_id, cx, cy, radius FROM v_zones) SELECT DISTINCT 'tile_' || (zone_id // 2) || '.tif' AS path FROM c WHERE
  abs(cx - radius - 32) + abs(cy - radius - 32) <= 20.005 OR abs(cx + radius - 32) + abs(cy - radius - 32) <= 20.005 OR abs(cx + radius - 32) + abs(cy + radius - 32) <= 20.005 OR abs(cx - radius - 32) + abs(cy + radius - 32) <= 20.005
  OR (32 BETWEEN cx - radius AND cx + radius AND (11.995 BETWEEN cy - radius AND cy + radius OR 52.005 BETWEEN cy - radius AND cy + radius)) OR (32 BETWEEN cy - radius AND cy + radius AND (11.995 BETWEEN cx - radius AND cx + radius OR 52.005 BETWEEN cx - radius AND cx + radius))"""))
def jon1(spark: SparkSession, d: str) -> DataFrame:
    at = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    index = boxes(spark, d).withColumn("ring", F.array(at("xmin", "ymin"), at("xmax", "ymin"), at("xmax", "ymax"), at("xmin", "ymax")))
    index = index.withColumn("path", F.concat(F.lit("tile_"), F.floor(F.col("zone_id") / 2), F.lit(".tif")))
    return J.select_tiles(index, G.polygon(*DIAMOND))


@query("jon1_select_tiles_crossing", duckdb("v_zones", then="""SELECT DISTINCT 'bar_' || zone_id || '.tif' AS path FROM v_zones WHERE
  CASE WHEN zone_id % 2 = 0 THEN cy + radius >= 31 AND cy - radius <= 33 ELSE cx + radius >= 10 AND cx - radius <= 54 END"""))
def jon1_crossing(spark: SparkSession, d: str) -> DataFrame:
    """Bars across a flat area, no corner of either within the other: rows lie across, the others stand."""
    even = F.col("zone_id") % 2 == 0
    at = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    x0, x1 = F.when(even, 0.0).otherwise(F.col("cx") - F.col("radius")), F.when(even, 64.0).otherwise(F.col("cx") + F.col("radius"))
    y0, y1 = F.when(even, F.col("cy") - F.col("radius")).otherwise(0.0), F.when(even, F.col("cy") + F.col("radius")).otherwise(64.0)
    bars = view(spark, d, "v_zones").withColumn("ring", F.array(at(x0, y0), at(x1, y0), at(x1, y1), at(x0, y1)))
    bars = bars.withColumn("path", F.concat(F.lit("bar_"), "zone_id", F.lit(".tif")))
    return J.select_tiles(bars, G.polygon((10, 31), (54, 31), (54, 33), (10, 33)), must_hit=True)


_TILE = "CAST(floor((({lon}) / 360.0 + 0.5) * 4096) AS BIGINT)", "CAST(floor((0.5 - 0.25 * ln((1 + sin(radians({lat}))) / (1 - sin(radians({lat})))) / pi()) * 4096) AS BIGINT)"
_KEY = " || ".join(f"CAST((({{x}} >> {i}) & 1) + (({{y}} >> {i}) & 1) * 2 AS VARCHAR)" for i in range(11, -1, -1))


@query("jon2_quadkey_tiles", duckdb("v_points", "v_zones", then=f"""WITH i AS (SELECT DISTINCT {_TILE[0].format(lon='x - 32')} AS tx, {_TILE[1].format(lat='y')} AS ty FROM v_points),
b AS (SELECT {_TILE[0].format(lon='cx - radius / 4 - 32')} AS x0, {_TILE[0].format(lon='cx + radius / 4 - 32')} AS x1, {_TILE[1].format(lat='cy + radius / 4')} AS y0, {_TILE[1].format(lat='cy - radius / 4')} AS y1 FROM v_zones)
SELECT DISTINCT {_KEY.format(x='tx', y='ty')} AS quadkey, (tx + ty) % 5 <> 0 AS present FROM i JOIN b ON tx BETWEEN x0 AND x1 AND ty BETWEEN y0 AND y1"""))
def jon2(spark: SparkSession, d: str) -> DataFrame:
    x, y = J.web_tile(F.col("y"), F.col("x") - 32, 12)
    index = view(spark, d, "v_points").select(x.alias("tx"), y.alias("ty")).distinct()
    index = index.select(J.quadkey(F.col("tx"), F.col("ty"), 12).alias("quadkey"), ((F.col("tx") + F.col("ty")) % 5 != 0).alias("present"))
    r = F.col("radius") / 4
    area = view(spark, d, "v_zones").select((F.col("cx") - r - 32).alias("west"), (F.col("cy") - r).alias("south"), (F.col("cx") + r - 32).alias("east"), (F.col("cy") + r).alias("north"))
    here, gone = J.quadkey_tiles(area, index, 12)
    return here.unionByName(gone)


@query("jon3_exclude_zones", duckdb("v_points", "v_zones", then="SELECT pid FROM v_points p WHERE NOT EXISTS (SELECT 1 FROM v_zones z WHERE CASE WHEN zone_id % 3 = 0 THEN abs(x - cx) <= radius AND abs(y - cy) <= radius / 2 ELSE (x - cx) ** 2 + (y - cy) ** 2 <= (radius + 0.00137) ** 2 END)"))
def jon3(spark: SparkSession, d: str) -> DataFrame:
    k, r = F.col("zone_id"), F.col("radius")
    z = view(spark, d, "v_zones").select(F.when(k % 3 == 0, "box").otherwise("circle").alias("kind"), "cx", "cy", (r + 0.00137).alias("r"), (r * 2).alias("w"), r.alias("h"), F.lit(None).cast("array<struct<x:double,y:double>>").alias("ring"))
    return J.exclude_zones(view(spark, d, "v_points"), z, 2.0).select("pid")


_T = "((px - x1) * (x2 - x1) + (py - y1) * (y2 - y1)) / ((x2 - x1) ** 2 + (y2 - y1) ** 2)"
_LEN = "sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2)"


@query("jon4_exclude_roads", duckdb("v_points", "v_ways", then=f"""SELECT pid FROM (SELECT pid, x AS px, y AS py FROM v_points) WHERE NOT EXISTS (SELECT 1 FROM v_ways WHERE
 sqrt(greatest(0, -{_T} * {_LEN}, ({_T} - 1) * {_LEN}) ** 2 + greatest(0, abs((px - x1) * (y2 - y1) - (py - y1) * (x2 - x1)) / {_LEN} - 0.05) ** 2) <= 0.0513)"""))
def jon4(spark: SparkSession, d: str) -> DataFrame:
    w = view(spark, d, "v_ways").select("x1", "y1", "x2", "y2", F.lit(0.1).alias("width_m"))
    return J.exclude_roads(view(spark, d, "v_points"), w, 0.0513, 2.0).select("pid")


_WEDGE = "nx IS NOT NULL AND (px - x2) * (x2 - x1) + (py - y2) * (y2 - y1) >= 0 AND (px - x2) * nx + (py - y2) * ny <= 0 AND sqrt((px - x2) ** 2 + (py - y2) ** 2) <= 0.3613"


@query("jon4_exclude_roads_bends", duckdb("v_points", "v_bends", then=f"""WITH b AS (SELECT *, lead(x2 - x1) OVER w AS nx, lead(y2 - y1) OVER w AS ny FROM v_bends WINDOW w AS (PARTITION BY way_id ORDER BY seg))
SELECT pid FROM (SELECT pid, x AS px, y AS py FROM v_points) WHERE NOT EXISTS (SELECT 1 FROM b WHERE
 sqrt(greatest(0, -{_T} * {_LEN}, ({_T} - 1) * {_LEN}) ** 2 + greatest(0, abs((px - x1) * (y2 - y1) - (py - y1) * (x2 - x1)) / {_LEN} - 0.3601) ** 2) <= 0.0012 OR ({_WEDGE}))"""))
def jon4_bends(spark: SparkSession, d: str) -> DataFrame:
    """Off roads with bends, which are rounded outside them."""
    w = with_next(view(spark, d, "v_bends"), "way_id").withColumn("width_m", F.lit(0.7202))
    return J.exclude_roads(view(spark, d, "v_points"), w, 0.0012, 2.0).select("pid")


@query("jon3_exclude_zones_geographic", duckdb("v_points", "v_zones", then=f"""WITH p AS (SELECT zone_id AS pid, 44.9 + cy / 320.0 AS lat, 7.9 + cx / 320.0 AS lon FROM v_zones), {_HOTINE}, {_FORWARD},
z AS (SELECT zone_id, x AS zx, y AS zy, radius * 250 + 0.137 AS r FROM v_zones JOIN g ON pid = zone_id)
SELECT pid FROM (SELECT pid, x * 250 - 8000 AS px, y * 250 - 8000 AS py FROM v_points) WHERE NOT EXISTS (SELECT 1 FROM z WHERE CASE WHEN zone_id % 3 = 0 THEN abs(px - zx) <= r AND abs(py - zy) <= r / 2 ELSE (px - zx) ** 2 + (py - zy) ** 2 <= r * r END)"""))
def jon3_geographic(spark: SparkSession, d: str) -> DataFrame:
    """Zones given by longitude and latitude."""
    k, r = F.col("zone_id"), F.col("radius") * 250 + 0.137
    z = view(spark, d, "v_zones").select(
        F.when(k % 3 == 0, "box").otherwise("circle").alias("kind"), F.lit("geographic").alias("coord_type"), (7.9 + F.col("cx") / 320.0).alias("cx"), (44.9 + F.col("cy") / 320.0).alias("cy"),
        r.alias("r"), (r * 2).alias("w"), r.alias("h"), F.lit(None).cast("array<struct<x:double,y:double>>").alias("ring"),
    )
    points = view(spark, d, "v_points").withColumns({"x": F.col("x") * 250 - 8000, "y": F.col("y") * 250 - 8000})
    return J.exclude_zones(points, J.zones_in_scene(z, P.SceneProjection(*CENTRE)), 500.0).select("pid")


_SPECIES = "m(class, species) AS (VALUES (10, 'oak'), (10, 'pine'), (30, 'grass'), (20, 'juniper'), (20, 'oak'))"


def mapping(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(10, "oak"), (10, "pine"), (30, "grass"), (20, "juniper"), (20, "oak")], "class int, species string")


@query("jon5_species_for_pixels", duckdb("v_landcover", then=f"WITH {_SPECIES} SELECT ix, iy, class, species FROM v_landcover JOIN m USING (class)"))
def jon5(spark: SparkSession, d: str) -> DataFrame:
    return J.species_for_pixels(view(spark, d, "v_landcover"), mapping(spark)).select("ix", "iy", "class", "species")


_ANGLE = "degrees(acos(greatest(-1.0, least(1.0, (c.b02 * l.b02 + c.b03 * l.b03 + c.b04 * l.b04 + c.b08 * l.b08) / (sqrt(c.b02 ** 2 + c.b03 ** 2 + c.b04 ** 2 + c.b08 ** 2) * sqrt(l.b02 ** 2 + l.b03 ** 2 + l.b04 ** 2 + l.b08 ** 2))))))"
_BANDS = ", ".join(f"avg({b}::DOUBLE) AS {b}" for b in ("b02", "b03", "b04", "b08"))


@query("jon6_match_sam", duckdb("v_refl", then=f"""WITH c AS (SELECT label, {_BANDS} FROM v_refl GROUP BY label), l AS (SELECT pixel_id % 40 AS lib_pos, {_BANDS} FROM v_refl GROUP BY 1),
a AS (SELECT label, lib_pos, {_ANGLE} AS angle FROM c, l), b AS (SELECT label, min(angle) AS m FROM a GROUP BY label)
SELECT label AS cluster, CASE WHEN m <= 8 THEN (SELECT min(lib_pos) FROM a WHERE a.label = b.label AND a.angle = b.m) END AS material_id, CASE WHEN m <= 8 THEN round(m, 5) END AS angle FROM b"""))
def jon6(spark: SparkSession, d: str) -> DataFrame:
    r = view(spark, d, "v_refl")
    mean = F.array(*(F.avg(F.col(b).cast("double")) for b in ("b02", "b03", "b04", "b08"))).alias("vector")
    lib = r.groupBy((F.col("pixel_id") % 40).alias("lib_pos")).agg(mean).withColumn("material_id", F.col("lib_pos"))
    return X.match_sam(r.groupBy(F.col("label").alias("cluster")).agg(mean), lib, 8.0).select("cluster", "material_id", F.round("angle", 5).alias("angle"))


@query("jon7_reflectance_inputs", duckdb("v_radiance", "v_irradiance", then="SELECT sensor_id, r.w, x_index, y_index, radiance, irradiance FROM v_radiance r JOIN v_irradiance i ON irradiance_id = sensor_id % 7 + 1 AND i.w = r.w"))
def jon7(spark: SparkSession, d: str) -> DataFrame:
    r = view(spark, d, "v_radiance")
    k = F.col("sensor_id")
    measures = r.select(k.alias("measure_id"), k, (k % 7 + 1).alias("irradiance_id")).distinct()
    return J.reflectance_inputs(measures, r, view(spark, d, "v_irradiance"))[0].select("sensor_id", "w", "x_index", "y_index", "radiance", "irradiance")


@query("jon7_reflectance_skipped", duckdb("v_zones", "v_radiance", "v_irradiance", then="""WITH m AS (SELECT zone_id AS measure_id, CASE zone_id % 4 WHEN 2 THEN zone_id + 1000000 ELSE zone_id END AS s, CASE zone_id % 4 WHEN 0 THEN NULL WHEN 1 THEN zone_id + 1000000 ELSE zone_id % 7 + 1 END AS i FROM v_zones)
SELECT measure_id, CASE WHEN s IS NULL OR i IS NULL THEN 'ids' WHEN NOT EXISTS (SELECT 1 FROM v_radiance WHERE sensor_id = s) THEN 'radiance' WHEN NOT EXISTS (SELECT 1 FROM v_irradiance WHERE irradiance_id = i) THEN 'irradiance' ELSE 'wavelengths' END AS reason
FROM m WHERE NOT EXISTS (SELECT 1 FROM v_radiance r JOIN v_irradiance e ON e.w = r.w WHERE r.sensor_id = s AND e.irradiance_id = i)"""))
def jon7_skipped(spark: SparkSession, d: str) -> DataFrame:
    """Measurements that lack an id, radiance or irradiance."""
    k = F.col("zone_id")
    sensor = F.when(k % 4 == 2, k + 1_000_000).otherwise(k)
    reference = F.when(k % 4 == 1, k + 1_000_000).when(k % 4 != 0, k % 7 + 1)
    measures = view(spark, d, "v_zones").select(k.alias("measure_id"), sensor.alias("sensor_id"), reference.alias("irradiance_id"))
    return J.reflectance_inputs(measures, view(spark, d, "v_radiance"), view(spark, d, "v_irradiance"))[1]


@query("jon8_align_wavelengths", duckdb("v_radiance", "v_irradiance", then="""WITH q AS (SELECT DISTINCT sensor_id, w FROM v_radiance)
SELECT sensor_id, q.w, round(a.irradiance + (q.w - a.w) * CASE WHEN b.w > a.w THEN (b.irradiance - a.irradiance) / (b.w - a.w) ELSE 0 END, 6) AS irradiance
FROM q JOIN v_irradiance a ON a.irradiance_id = sensor_id AND a.w = (SELECT max(w) FROM v_irradiance x WHERE x.irradiance_id = sensor_id AND x.w <= q.w)
JOIN v_irradiance b ON b.irradiance_id = sensor_id AND b.w = (SELECT min(w) FROM v_irradiance x WHERE x.irradiance_id = sensor_id AND x.w >= q.w)"""))
def jon8(spark: SparkSession, d: str) -> DataFrame:
    e = view(spark, d, "v_irradiance").withColumnRenamed("irradiance_id", "sensor_id")
    out = X.align_wavelengths(view(spark, d, "v_radiance"), e, "sensor_id", "irradiance")
    return out.where("irradiance is not null").select("sensor_id", "w", *r6(irradiance=F.col("irradiance")))


@query("jon8_align_wavelengths_fill", duckdb("v_radiance", "v_irradiance", then="""WITH q AS (SELECT DISTINCT sensor_id, w FROM v_radiance), e AS (SELECT irradiance_id AS sensor_id, w + 15 AS w, irradiance FROM v_irradiance)
SELECT sensor_id, q.w, coalesce(round(a.irradiance + (q.w - a.w) * CASE WHEN b.w > a.w THEN (b.irradiance - a.irradiance) / (b.w - a.w) ELSE 0 END, 6), 0.25) AS irradiance
FROM q LEFT JOIN e a ON a.sensor_id = q.sensor_id AND a.w = (SELECT max(w) FROM e x WHERE x.sensor_id = q.sensor_id AND x.w <= q.w)
LEFT JOIN e b ON b.sensor_id = q.sensor_id AND b.w = (SELECT min(w) FROM e x WHERE x.sensor_id = q.sensor_id AND x.w >= q.w)""".replace("SELECT sensor_id, q.w", "SELECT q.sensor_id, q.w")))
def jon8_fill(spark: SparkSession, d: str) -> DataFrame:
    """References that begin above the first wavelength: the fill stands there."""
    e = view(spark, d, "v_irradiance").withColumnRenamed("irradiance_id", "sensor_id").withColumn("w", F.col("w") + 15)
    return X.align_wavelengths(view(spark, d, "v_radiance"), e, "sensor_id", "irradiance", 0.25).select("sensor_id", "w", *r6(irradiance=F.col("irradiance")))


_GAPS = """WITH e AS (SELECT event_id, value, epoch_us(ts) AS t FROM events), o AS (SELECT event_id, t FROM e WHERE event_id % 5 = 0), s AS (SELECT t, max(value) AS value FROM e WHERE event_id % 5 <> 0 GROUP BY 1),
b AS (SELECT o.event_id, o.t, s.t AS st, s.value FROM o ASOF LEFT JOIN s ON o.t >= s.t), a AS (SELECT o.event_id, s.t AS st, s.value FROM o ASOF LEFT JOIN s ON o.t <= s.t)
SELECT b.event_id, CASE WHEN a.st IS NULL OR (b.st IS NOT NULL AND b.t - b.st <= a.st - b.t) THEN b.value ELSE a.value END AS nearest FROM b JOIN a USING (event_id)"""


@query("jon9_nearest_in_time_of_all", _GAPS)
def jon9_all(spark: SparkSession, d: str) -> DataFrame:
    """One series for all observations: an order without a key, over ranges."""
    e = table(spark, d, "events").withColumn("t", F.unix_micros(F.col("ts").cast("timestamp")))
    series = e.where("event_id % 5 <> 0").groupBy("t").agg(F.max("value").alias("value"))
    return J.nearest_by(e.where("event_id % 5 = 0").select("event_id", "t"), series, "t", "value", None, "nearest").select("event_id", "nearest")


@query("jon9_nearest_in_time", """WITH o AS (SELECT event_id, user_id, epoch_us(ts) AS t FROM events WHERE event_id % 5 = 0), s AS (SELECT user_id, epoch_us(ts) AS t, max(value) AS value FROM events WHERE event_id % 5 <> 0 GROUP BY 1, 2),
p AS (SELECT event_id, o.t, s.t AS st, s.value, abs(o.t - s.t) AS gap FROM o JOIN s USING (user_id))
SELECT event_id, arg_min(value, (gap, st)) AS nearest FROM p GROUP BY event_id UNION ALL SELECT event_id, NULL FROM o WHERE user_id NOT IN (SELECT user_id FROM s)""")
def jon9(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumn("t", F.unix_micros(F.col("ts").cast("timestamp")))
    obs = e.where("event_id % 5 = 0").select("event_id", "user_id", "t")
    series = e.where("event_id % 5 <> 0").groupBy("user_id", "t").agg(F.max("value").alias("value"))
    return J.nearest_by(obs, series, "t", "value", ["user_id"], "nearest").select("event_id", "nearest")


_NEAREST = """WITH a AS (SELECT DISTINCT ix FROM v_dem), b AS (SELECT DISTINCT iy FROM v_dem),
p AS (SELECT pid, (SELECT arg_min(ix, (abs(ix - x), ix)) FROM a) AS cx, (SELECT arg_min(iy, (abs(iy - y), iy)) FROM b) AS cy FROM v_points) SELECT pid, cx, cy, elevation FROM p JOIN v_dem ON ix = cx AND iy = cy"""


@query("jon10_nearest_cell", duckdb("v_points", "v_dem", then=_NEAREST))
def jon10(spark: SparkSession, d: str) -> DataFrame:
    """Over every cell of the grid."""
    p, grid = view(spark, d, "v_points").select("pid", "x", "y"), dem_at(spark, d)
    near = p.join(J.nearest_axis(p, grid, "x", "ix"), "x").join(J.nearest_axis(p, grid, "y", "iy"), "y")
    g = grid.select(F.col("ix").alias("x_cell"), F.col("iy").alias("y_cell"), "elevation")
    return near.join(g, ["x_cell", "y_cell"]).select("pid", F.col("x_cell").alias("cx"), F.col("y_cell").alias("cy"), "elevation")


@query("jon10_nearest_cell_month", duckdb("v_points", "v_dem", then="""WITH a AS (SELECT DISTINCT ix FROM v_dem), b AS (SELECT DISTINCT iy FROM v_dem),
p AS (SELECT pid, month(ts) AS m, (SELECT arg_min(ix, (abs(ix - x), ix)) FROM a) AS cx, (SELECT arg_min(iy, (abs(iy - y), iy)) FROM b) AS cy FROM v_points JOIN events ON event_id = pid) SELECT pid, cx, cy, m AS month, round(elevation + m, 6) AS elevation FROM p LEFT JOIN v_dem ON ix = cx AND iy = cy"""))
def jon10_month(spark: SparkSession, d: str) -> DataFrame:
    """A monthly climatology over every cell of the grid."""
    obs = view(spark, d, "v_points").join(table(spark, d, "events").select(F.col("event_id").alias("pid"), "ts"), "pid").select("pid", "x", "y", "ts")
    grid = dem_at(spark, d).withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12)))).withColumn("elevation", F.col("elevation") + F.col("month"))
    return J.nearest_cell(obs, grid).select("pid", F.col("x_cell").alias("cx"), F.col("y_cell").alias("cy"), F.col("month").cast("long").alias("month"), *r6(elevation=F.col("elevation")))


def regions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(410.0, 430.0, 5.0), (430.0, 450.0, 8.0)], "wmin double, wmax double, fwhm double")


@query("jon11_fwhm_for", duckdb("v_radiance", then="SELECT DISTINCT w, CASE WHEN w < 430 THEN 5.0 ELSE 8.0 END::DOUBLE AS fwhm FROM v_radiance"))
def jon11(spark: SparkSession, d: str) -> DataFrame:
    return J.fwhm_for(view(spark, d, "v_radiance").select("w").distinct(), regions(spark)).select("w", "fwhm")


@query("jon12_pixel_targets", duckdb("v_zones", "v_dem", then=f"""WITH {_CORNERS}, t AS (SELECT zone_id, unnest([[1, 2], [5, zone_id % 8]]) AS p FROM v_zones WHERE zone_id % 4 <> 0),
q AS (SELECT zone_id, p[1] AS r, p[2] AS c, (p[2] + 0.5) / 8 * 60 AS fx, 60 - (p[1] + 0.5) / 8 * 60 AS fy, mx, my FROM t, ext), qq AS (SELECT *, least(floor(fx), mx - 1) AS cx, least(floor(fy), my - 1) AS cy FROM q)
SELECT zone_id || '_r' || r || '_c' || c AS target_id, round(fx, 6) AS x, round(fy, 6) AS y, round({_BILINEAR} + 2, 6) AS z FROM qq JOIN cor ON ix = cx AND iy = cy"""))
def jon12(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("zone_id")
    at = lambda r, c: F.struct(r.alias("row"), c.alias("col"))
    measures = view(spark, d, "v_zones").select(k.cast("string").alias("measure_id"), (k % 4).alias("sensor_id"), F.array(at(F.lit(1).cast("long"), F.lit(2).cast("long")), at(F.lit(5).cast("long"), k % 8)).alias("pixels"), F.lit(2.0).alias("offset"))
    sensors = spark.createDataFrame([(i, 0.0, 0.0, 60.0, 60.0, 8, 8) for i in (1, 2, 3)], "sensor_id long, xmin double, ymin double, xmax double, ymax double, width int, height int")
    found, _ = J.pixel_targets(measures, sensors)
    return SM.sample_bilinear(found, dem_at(spark, d)).select("target_id", *r6(x=F.col("x"), y=F.col("y"), z=F.col("z") + F.col("offset")))


@query("jon13_check_references", "SELECT 'duplicate' AS kind, s_nationkey::BIGINT AS id FROM supplier GROUP BY s_nationkey HAVING count(*) > 1 UNION ALL SELECT 'dangling', s_nationkey::BIGINT FROM supplier WHERE s_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 2)")
def jon13(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier").select(F.col("s_nationkey").cast("long").alias("id"))
    return J.check_references(s, table(spark, d, "nation").where("n_regionkey <> 2"), "id", "id", "n_nationkey")


_SENSORS = "SELECT CASE WHEN s_suppkey % 19 = 0 THEN 's1' ELSE 's' || s_suppkey END AS id, CASE s_suppkey % 3 WHEN 0 THEN 'satellite' WHEN 1 THEN 'uav' ELSE 'ground' END AS type, CASE WHEN s_suppkey % 3 = 1 THEN 30.0 END AS fov FROM supplier"
_TYPE = "CASE c_custkey % 7 WHEN 0 THEN 'irradiance' WHEN 1 THEN 'hdrf' WHEN 2 THEN 'hcrf' WHEN 3 THEN 'brf' WHEN 4 THEN 'pixel_brf' WHEN 5 THEN 'pixel_hdrf' ELSE 'bhr' END"
_MEASURES = f"SELECT CASE WHEN c_custkey % 101 = 0 THEN 'm7' ELSE 'm' || c_custkey END AS id, {_TYPE} AS type, CASE WHEN c_custkey % 4 <> 0 THEN 's' || (c_custkey % 13) END AS radiance_sensor_id, CASE WHEN c_custkey % 9 <> 0 THEN 's' || (c_custkey % 11) END AS satellite_sensor_id, CASE WHEN c_custkey % 5 <> 0 THEN 'm' || (c_custkey - c_custkey % 3) END AS irradiance_measurement_id FROM customer"


@query("jon13_check_simulation", f"""WITH s AS ({_SENSORS}), m AS ({_MEASURES}), one AS (SELECT id, type, fov FROM s),
r AS (SELECT id, radiance_sensor_id AS t, NULL AS kind, 'sensor' AS what FROM m WHERE type IN ('hdrf', 'hcrf', 'brf') UNION ALL SELECT id, radiance_sensor_id, 'camera', 'sensor' FROM m WHERE type = 'hcrf'
 UNION ALL SELECT id, satellite_sensor_id, 'satellite', 'sensor' FROM m WHERE type IN ('pixel_brf', 'pixel_hdrf') UNION ALL SELECT id, irradiance_measurement_id, 'irradiance', 'measurement' FROM m WHERE type IN ('hdrf', 'hcrf', 'brf', 'bhr')),
x AS (SELECT *, CASE what WHEN 'sensor' THEN EXISTS (SELECT 1 FROM s WHERE s.id = t) ELSE EXISTS (SELECT 1 FROM m WHERE m.id = t) END AS there,
 CASE kind WHEN 'camera' THEN EXISTS (SELECT 1 FROM s WHERE s.id = t AND fov IS NOT NULL) WHEN 'satellite' THEN EXISTS (SELECT 1 FROM s WHERE s.id = t AND type = 'satellite') WHEN 'irradiance' THEN EXISTS (SELECT 1 FROM m WHERE m.id = t AND type = 'irradiance') ELSE true END AS fits FROM r WHERE t IS NOT NULL)
SELECT DISTINCT id, CASE WHEN NOT there THEN 'unknown ' || what ELSE what || ' is no ' || kind END AS rule, t AS reference FROM x WHERE NOT there OR NOT fits
UNION ALL SELECT id, 'duplicate sensor', NULL FROM s GROUP BY id HAVING count(*) > 1 UNION ALL SELECT id, 'duplicate measurement', NULL FROM m GROUP BY id HAVING count(*) > 1
UNION ALL SELECT id, 'no sensor given', NULL FROM m WHERE type IN ('pixel_brf', 'pixel_hdrf') AND satellite_sensor_id IS NULL""")
def jon13_simulation(spark: SparkSession, d: str) -> DataFrame:
    """A violation of each rule: repeated ids, unknown sensors and measurements, sensors and measurements of the wrong type."""
    sensors = spark.sql(_SENSORS.replace("FROM supplier", "FROM {supplier}"), supplier=table(spark, d, "supplier"))
    measures = spark.sql(_MEASURES.replace("FROM customer", "FROM {customer}"), customer=table(spark, d, "customer"))
    return J.check_simulation(sensors, measures)


@query("jon14_merge_libraries", "SELECT p_partkey AS material_id, CASE WHEN p_partkey % 3 = 0 THEN 'late' ELSE 'early' END AS source, p_size::BIGINT AS size FROM part WHERE p_partkey % 2 = 0 OR p_partkey % 3 = 0")
def jon14(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select(F.col("p_partkey").alias("material_id"), F.col("p_size").cast("long").alias("size"))
    return J.merge_libraries(p.where("material_id % 2 = 0").withColumn("source", F.lit("early")), p.where("material_id % 3 = 0").withColumn("source", F.lit("late"))).select("material_id", "source", "size")


@query("jon15_assign_materials", "SELECT p_partkey, CASE WHEN p_name LIKE '%1' THEN 'brick' WHEN regexp_matches(p_name, '[23]$') THEN 'wood' WHEN p_partkey % 2 = 0 THEN 'own_x' ELSE 'concrete' END AS material FROM part")
def jon15(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select("p_partkey", F.col("p_name").alias("name"), F.when(F.col("p_partkey") % 2 == 0, "own-x").alias("own_material"))
    patterns = spark.createDataFrame([(0, "*1", False, "brick"), (1, "[23]$", True, "wood")], "pos int, pattern string, is_regex boolean, material string")
    return J.assign_materials(p, patterns).select("p_partkey", "material")


_STEPS = "s AS (SELECT material_id, w AS lo, value AS vlo, lead(w) OVER o AS hi, lead(value) OVER o AS vhi FROM v_spectra WINDOW o AS (PARTITION BY material_id ORDER BY w))"


@query("smp8_interp_to_bands", duckdb("v_spectra", then=f"""WITH {_STEPS}, b(n, c) AS (VALUES ('b02', 490.0::DOUBLE), ('b03', 560.0), ('b04', 665.0), ('b08', 842.0)),
v AS (SELECT material_id, n, vlo + (c - lo) * (vhi - vlo) / (hi - lo) AS v FROM s JOIN b ON c >= lo AND c <= hi)
SELECT material_id, round(max(v) FILTER (n = 'b02'), 6) AS b02, round(max(v) FILTER (n = 'b03'), 6) AS b03, round(max(v) FILTER (n = 'b04'), 6) AS b04, round(max(v) FILTER (n = 'b08'), 6) AS b08 FROM v GROUP BY 1 HAVING count(DISTINCT n) = 4"""))
def smp8(spark: SparkSession, d: str) -> DataFrame:
    s = view(spark, d, "v_spectra").withColumn("w", F.when(F.col("material_id") % 2 == 0, F.col("w") / 1000).otherwise(F.col("w")))
    s = s.withColumn("w", F.round("w", 6))
    return X.interp_to_bands(s).select("material_id", *r6(**{b: F.col(b) for b, _ in X.BAND_CENTRES}))


@query("smp9_pick_channels", duckdb("v_radiance", then="""SELECT sensor_id, x_index, y_index, CAST(coalesce(floor(greatest(0, least(1, max(radiance) FILTER (w = 450) * 0.8)) * 255), 255) AS BIGINT) AS c0,
  CAST(coalesce(floor(greatest(0, least(1, max(radiance) FILTER (w = 420) * 0.8)) * 255), 255) AS BIGINT) AS c1, CAST(coalesce(floor(greatest(0, least(1, max(radiance) FILTER (w = 400) * 0.8)) * 255), 255) AS BIGINT) AS c2 FROM v_radiance GROUP BY 1, 2, 3"""))
def smp9(spark: SparkSession, d: str) -> DataFrame:
    return X.pick_channels(view(spark, d, "v_radiance"), [451.0, 423.0, 390.0], ["sensor_id", "x_index", "y_index"], 0.8)


@query("prj19_wavelength_grid", duckdb("v_spectra", then="SELECT material_id, w FROM (SELECT DISTINCT material_id FROM v_spectra), (SELECT 400 + i * 7.5 AS w FROM range(14) t(i))"))
def prj19(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "v_spectra").select("material_id").distinct().join(X.wavelength_grid(spark, 400.0, 500.0, 7.5))


@query("prj26_check_spectra", duckdb("v_spectra", then="""WITH s AS (SELECT material_id, w, CASE WHEN w > 600 THEN -w ELSE w END AS pos, value * 1.5 AS value, lag(w) OVER (PARTITION BY material_id ORDER BY CASE WHEN w > 600 THEN -w ELSE w END) AS b FROM v_spectra)
SELECT DISTINCT material_id, 'value outside 0..1' AS rule FROM s WHERE value < 0 OR value > 1 UNION SELECT DISTINCT material_id, 'wavelengths not rising' FROM s WHERE w <= b UNION SELECT material_id, 'fewer than two points' FROM s GROUP BY 1 HAVING count(*) < 2"""))
def prj26(spark: SparkSession, d: str) -> DataFrame:
    s = view(spark, d, "v_spectra").select("material_id", F.when(F.col("w") > 600, -F.col("w")).otherwise(F.col("w")).alias("pos"), "w", (F.col("value") * 1.5).alias("value"))
    return X.check_spectra(s)


_BY = "p_partkey % 16"
_KIND = f"CASE WHEN {_BY} = 0 THEN 'gradient' WHEN {_BY} IN (4, 5, 6, 7, 8, 9) THEN 'interpolated' WHEN {_BY} = 10 THEN 'file' ELSE 'uniform' END"
_NAME = f"CASE WHEN {_BY} = 11 THEN 'k' WHEN {_BY} = 12 THEN 'Theta' WHEN p_partkey % 2 = 0 THEN 'reflectance' ELSE 'transmittance' END"


@query("prj26_check_parameters", f"""WITH a AS (SELECT p_partkey AS id, {_BY} AS c, p_size / 50.0 AS u, {_NAME} AS parameter FROM part),
v AS (SELECT id, parameter, unnest([CASE WHEN c = 0 THEN 'unknown kind' END, CASE WHEN c = 1 THEN 'no value' END, CASE WHEN c IN (2, 13) AND u * 1.5 > 1 THEN 'value outside 0..1' END, CASE WHEN c = 3 THEN 'rgb without three components' END,
 CASE WHEN c = 4 THEN 'wavelengths or values missing' END, CASE WHEN c = 5 THEN 'wavelengths and values differ in number' END, CASE WHEN c = 6 THEN 'fewer than two points' END, CASE WHEN c = 7 THEN 'wavelength not positive' END,
 CASE WHEN c = 8 THEN 'wavelengths not rising' END, CASE WHEN c = 9 AND u * 1.2 > 1 THEN 'interpolated value outside 0..1' END, CASE WHEN c = 10 THEN 'file without path or variable' END, CASE WHEN c = 11 THEN 'k below 0' END, CASE WHEN c = 12 AND u * 1.5 > 1 THEN 'Theta outside -1..1' END]) AS rule FROM a)
SELECT id AS material_id, parameter, rule FROM v WHERE rule IS NOT NULL UNION ALL SELECT id, 'transmittance', 'reflectance and transmittance above 1' FROM a WHERE c IN (14, 15) AND u + 0.45 > 1""")
def prj26_parameters(spark: SparkSession, d: str) -> DataFrame:
    """A violation of each rule by turns, and pairs of reflectance and transmittance."""
    c, u = F.expr(_BY), F.col("p_size") / 50.0
    none = lambda kind: F.lit(None).cast(kind)
    list_of = lambda *v: F.array(*(x if hasattr(x, "cast") else F.lit(float(x)) for x in v))
    value = F.when(c.isin(2, 12, 13), u * 1.5).when(c == 11, -u).when(c.isin(14, 15), u)
    points = {5: (list_of(400, 500, 600), list_of(0.1, 0.2)), 6: (list_of(400), list_of(0.1)), 7: (list_of(-1, 500), list_of(0.1, 0.2)), 8: (list_of(500, 500), list_of(0.1, 0.2)), 9: (list_of(400, 500), F.array(F.lit(0.1), u * 1.2))}
    pick = lambda i: F.coalesce(*(F.when(c == k, v[i]) for k, v in points.items()))
    own = table(spark, d, "part").select(
        F.col("p_partkey").alias("material_id"), F.expr(_NAME).alias("parameter"), F.expr(_KIND).alias("kind"), value.alias("value"), F.when(c == 3, list_of(0.1, 0.2)).alias("rgb"),
        pick(0).alias("wavelengths"), F.when(c == 4, list_of(0.1, 0.2)).otherwise(pick(1)).alias("values"), F.when(c == 10, "a.nc").alias("path"), none("string").alias("variable"),
    )
    other = F.when(F.col("parameter") == "reflectance", "transmittance").otherwise("reflectance")
    more = own.where(F.col("material_id") % 16 >= 14).withColumns({"parameter": other, "value": F.lit(0.45)})
    return X.check_parameters(own.unionByName(more))


@query("agg10_gaussian_srf", duckdb("v_radiance", then="""WITH o(w_out, fwhm) AS (VALUES (420.0::DOUBLE, 8.0::DOUBLE), (450.0, 12.0)), j AS (SELECT *, exp(-0.5 * ((w - w_out) / (fwhm / 2.3548200450309493)) ** 2) * 10 AS g FROM v_radiance JOIN o ON abs(w - w_out) <= 3 * fwhm)
SELECT sensor_id, x_index, y_index, w_out, round(sum(g * radiance) / sum(g), 5) AS radiance FROM j GROUP BY 1, 2, 3, 4"""))
def agg10(spark: SparkSession, d: str) -> DataFrame:
    r = view(spark, d, "v_radiance").withColumn("bin_wmin", F.col("w") - 5).withColumn("bin_wmax", F.col("w") + 5)
    out = spark.createDataFrame([(420.0, 8.0), (450.0, 12.0)], "w_out double, fwhm double")
    return X.gaussian_srf(r, out, ["sensor_id", "x_index", "y_index"]).select("sensor_id", "x_index", "y_index", "w_out", F.round("radiance", 5).alias("radiance"))
