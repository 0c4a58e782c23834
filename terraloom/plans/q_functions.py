"""Queries of projections and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.functions import projection as P
from terraloom.functions import scalars as S
from terraloom.functions.keyed import draw
from terraloom.operators.spectra import to_nanometres
from terraloom.plans.registry import query
from terraloom.plans.views import duckdb, table, view

CENTRE = (45.0, 8.0)


def r6(**columns) -> list:  # noqa: ANN003
    return [F.round(c, 6).alias(k) for k, c in columns.items()]


_HOTINE = """
k AS (SELECT 0.00669437999014::DOUBLE AS e2, sqrt(0.00669437999014::DOUBLE) AS e, 6378137.0::DOUBLE AS a0, radians(45.0::DOUBLE) AS p0, radians(8.0::DOUBLE) AS l0),
k1 AS (SELECT *, sqrt(1 + e2 * pow(cos(p0), 4) / (1 - e2)) AS b, tan(pi() / 4 - p0 / 2) / pow((1 - e * sin(p0)) / (1 + e * sin(p0)), e / 2) AS t0 FROM k),
k2 AS (SELECT *, a0 * b * sqrt(1 - e2) / (1 - e2 * sin(p0) * sin(p0)) AS a, greatest(1.0, b * sqrt(1 - e2) / (cos(p0) * sqrt(1 - e2 * sin(p0) * sin(p0)))) AS d FROM k1),
k3 AS (SELECT *, (d + sqrt(d * d - 1)) * pow(t0, b) AS ee, a / b * atan2(sqrt(d * d - 1), 1.0) AS u0 FROM k2)
"""
_POINTS = "p AS (SELECT pid, 44.9 + y / 320.0 AS lat, 7.9 + x / 320.0 AS lon FROM v_points)"
_FORWARD = """
f AS (SELECT pid, lat, lon, sin((radians(lon) - l0) * b) AS vv, cos((radians(lon) - l0) * b) AS cc, a, b, u0,
  ee / pow(tan(pi() / 4 - radians(lat) / 2) / pow((1 - e * sin(radians(lat))) / (1 + e * sin(radians(lat))), e / 2), b) AS q FROM p, k3),
g AS (SELECT pid, lat, lon, ln((1 + vv / ((q + 1 / q) / 2)) / (1 - vv / ((q + 1 / q) / 2))) * (a / (2 * b)) AS x, atan2((q - 1 / q) / 2, cc) * (a / b) - u0 AS y FROM f)
"""


def _degrees(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "v_points").select("pid", (44.9 + F.col("y") / 320.0).alias("lat"), (7.9 + F.col("x") / 320.0).alias("lon"))


@query("prj1_to_scene", duckdb("v_points", then=f"WITH {_POINTS}, {_HOTINE}, {_FORWARD} SELECT pid, round(x, 3) AS x, round(y, 3) AS y FROM g"))
def prj1(spark: SparkSession, d: str) -> DataFrame:
    x, y = P.SceneProjection(*CENTRE).forward(F.col("lat"), F.col("lon"))
    return _degrees(spark, d).select("pid", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


@query("prj2_to_latlon", duckdb("v_points", then=f"WITH {_POINTS} SELECT pid, round(lat, 6) AS lat, round(lon, 6) AS lon FROM p"))
def prj2(spark: SparkSession, d: str) -> DataFrame:
    """The way back from PRJ1 gives the degrees again."""
    scene = P.SceneProjection(*CENTRE)
    x, y = scene.forward(F.col("lat"), F.col("lon"))
    back = _degrees(spark, d).select("pid", x.alias("x"), y.alias("y"))
    lat, lon = scene.inverse(F.col("x"), F.col("y"))
    return back.select("pid", F.round(lat, 6).alias("lat"), F.round(lon, 6).alias("lon"))


@query("prj3_utm_epsg", duckdb("v_points", then="SELECT pid, CAST((CASE WHEN y - 32 >= 0 THEN 32600 ELSE 32700 END) + floor((x * 5.6 - 179 + 180) / 6) + 1 AS BIGINT) AS epsg FROM v_points"))
def prj3(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "v_points").select("pid", P.utm_epsg(F.col("y") - 32, F.col("x") * 5.6 - 179).alias("epsg"))


@query("prj4_rectangle", duckdb("v_zones", then="SELECT zone_id, cx - radius AS xmin, cy - radius * 0.5 AS ymin, cx + radius AS xmax, cy + radius * 0.5 AS ymax FROM v_zones"))
def prj4(spark: SparkSession, d: str) -> DataFrame:
    r = F.col("radius")
    return view(spark, d, "v_zones").select("zone_id", P.rectangle(F.col("cx"), F.col("cy"), r * 2.0, r).alias("b")).select("zone_id", "b.*")


@query("prj5_pixel_centre", duckdb("v_landcover", then="SELECT ix, iy, round(-32000 + (ix + 0.5) / 64 * 64000, 6) AS x, round(32000 - (iy + 0.5) / 64 * 64000, 6) AS y, 1000.0::DOUBLE AS size_m FROM v_landcover"))
def prj5(spark: SparkSession, d: str) -> DataFrame:
    n, h = F.lit(64), 32000.0
    x, y = P.pixel_centre(F.col("iy"), F.col("ix"), (F.lit(-h), F.lit(-h), F.lit(h), F.lit(h)), n, n)
    return view(spark, d, "v_landcover").select("ix", "iy", *r6(x=x, y=y), P.pixel_size(F.lit(64.0), n).alias("size_m"))


@query(
    "prj6_directions",
    duckdb(
        "v_points",
        then="""SELECT pid, round(sin(radians(x)) * cos(radians(y)) * value, 6) AS dx, round(sin(radians(x)) * sin(radians(y)) * value, 6) AS dy, round(cos(radians(x)) * value, 6) AS dz,
  round(x + sin(radians(x)) * cos(radians(y)) * 1000, 6) AS tx, round(sin(radians(x)) * sin(radians(y)), 6) AS ux, round(-cos(radians(x)), 6) AS uz FROM v_points""",
    ),
)
def prj6(spark: SparkSession, d: str) -> DataFrame:
    z, a = F.col("x"), F.col("y")
    dx, dy, dz = P.spherical_to_xyz(z, a, F.col("value"))
    tx, _, _ = P.target_from_angles((z, a, F.lit(0.0)), z, a)
    ux, _, uz = P.distant_direction(z, a)
    return view(spark, d, "v_points").select("pid", *r6(dx=dx, dy=dy, dz=dz, tx=tx, ux=ux, uz=uz))


@query("prj7_angle_convention", duckdb("v_points", then="SELECT pid, round(180 - x, 6) AS zenith, round(((90 - y * 9) % 360 + 360) % 360, 6) AS azimuth FROM v_points"))
def prj7(spark: SparkSession, d: str) -> DataFrame:
    zenith, azimuth = P.angle_convention(F.col("x"), F.col("y") * 9)
    return view(spark, d, "v_points").select("pid", *r6(zenith=zenith, azimuth=azimuth))


@query(
    "prj8_asset_to_scene",
    duckdb(
        "v_points",
        then="""WITH a AS (SELECT pid, x, y, value * cos(radians(30)) - 1 * sin(radians(30)) AS q, value * sin(radians(30)) + 1 * cos(radians(30)) AS r FROM v_points),
b AS (SELECT pid, x, y, x * cos(radians(20)) + r * sin(radians(20)) AS p, q, r * cos(radians(20)) - x * sin(radians(20)) AS r FROM a)
SELECT pid, round((p * cos(radians(40)) - q * sin(radians(40))) * 2 + 10, 6) AS sx, round((p * sin(radians(40)) + q * cos(radians(40))) * 2 + 20, 6) AS sy, round(r * 2 + 30, 6) AS sz FROM b""",
    ),
)
def prj8(spark: SparkSession, d: str) -> DataFrame:
    turn, move = tuple(F.lit(v) for v in (30.0, 20.0, 40.0)), tuple(F.lit(v) for v in (10.0, 20.0, 30.0))
    sx, sy, sz = P.asset_to_scene((F.col("x"), F.col("value"), F.lit(1.0)), turn, F.lit(2.0), move)
    return view(spark, d, "v_points").select("pid", *r6(sx=sx, sy=sy, sz=sz))


@query("prj10_reflectance", duckdb("v_points", then="SELECT pid, round(greatest(0.0, value * 40 * 1e-4 - 0.1), 6) AS reflectance FROM v_points"))
def prj10(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "v_points").select("pid", *r6(reflectance=P.dn_to_reflectance(F.col("value") * 40)))


_TEMP = "26 - 0.62 * 45.0 + (3.0 + 35.0 * (15.0 / 50.0)) * cos((355 - 172) * (2 * pi() / 365)) - 0.0095 * (elevation - 1900)"


def _cold(spark: SparkSession, d: str) -> DataFrame:
    dem = view(spark, d, "v_dem")
    return dem.withColumn("t", P.season_temperature(F.lit(45.0), F.col("elevation") - 1900, P.MONTH_DAYS["December"]))


@query("prj11_season_temperature", duckdb("v_dem", then=f"SELECT ix, iy, round({_TEMP}, 6) AS t FROM v_dem"))
def prj11(spark: SparkSession, d: str) -> DataFrame:
    return _cold(spark, d).select("ix", "iy", F.round("t", 6).alias("t"))


@query("prj12_snow_probability", duckdb("v_dem", then=f"WITH c AS (SELECT ix, iy, {_TEMP} AS t FROM v_dem) SELECT ix, iy, round(CASE WHEN t <= 0.3 THEN 1 / (1 + exp(t / 0.15)) ELSE 0 END, 6) AS p FROM c"))
def prj12(spark: SparkSession, d: str) -> DataFrame:
    return _cold(spark, d).select("ix", "iy", *r6(p=P.snow_probability(F.col("t"))))


_U = "CAST(CAST('0x' || substr(md5('{seed}:' || {key}), 1, 8) AS UBIGINT) AS DOUBLE) / 4294967296"


@query(
    "prj13_snow_adjust",
    duckdb(
        "v_dem",
        "v_landcover",
        then=f"""WITH c AS (SELECT ix, iy, {_TEMP} AS t FROM v_dem)
SELECT ix, iy, CAST(CASE WHEN (CASE WHEN t <= 0.3 THEN 1 / (1 + exp(t / 0.15)) ELSE 0 END) > {_U.format(seed=7, key="ix || ':' || iy")} THEN 6
  WHEN class IN (10, 20, 30, 40, 50, 60) THEN class / 10 - 1 ELSE 7 END AS BIGINT) AS idx FROM c JOIN v_landcover USING (ix, iy)""",
    ),
)
def prj13(spark: SparkSession, d: str) -> DataFrame:
    both = _cold(spark, d).join(view(spark, d, "v_landcover"), ["ix", "iy"])
    snow = P.snow_probability(F.col("t")) > draw(7, "ix", "iy")
    return both.select("ix", "iy", F.when(snow, 6).otherwise(S.material_index(F.col("class"))).cast("long").alias("idx"))


@query("prj14_material_index", duckdb("v_landcover", then="SELECT ix, iy, CAST(CASE WHEN class IN (10, 20, 30, 50, 60) THEN class / 10 - 1 ELSE 7 END AS BIGINT) AS idx FROM v_landcover"))
def prj14(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "v_landcover").select("ix", "iy", S.material_index(F.col("class")).cast("long").alias("idx"))


@query(
    "prj15_preview_colour",
    duckdb(
        "v_landcover",
        then="""SELECT ix, iy, CAST(CASE class WHEN 10 THEN 40 WHEN 20 THEN 185 WHEN 30 THEN 140 WHEN 50 THEN 150 WHEN 60 THEN 220 WHEN 80 THEN 0 ELSE 128 END AS BIGINT) AS red,
  CAST(CASE class WHEN 10 THEN 30 WHEN 20 THEN 130 WHEN 30 THEN 95 WHEN 50 THEN 150 WHEN 60 THEN 90 WHEN 80 THEN 200 ELSE 128 END AS BIGINT) AS blue FROM v_landcover""",
    ),
)
def prj15(spark: SparkSession, d: str) -> DataFrame:
    c = view(spark, d, "v_landcover").withColumn("rgb", S.preview_colour(F.col("class")))
    return c.select("ix", "iy", F.get("rgb", F.lit(0)).cast("long").alias("red"), F.get("rgb", F.lit(2)).cast("long").alias("blue"))


@query("prj16_max_per_pixel", duckdb("v_zones", then="SELECT zone_id, CAST(CASE WHEN radius - 0.25 <= 0 THEN 100 ELSE floor(greatest(1, trunc(10 / (radius - 0.25))) * greatest(1, trunc(8 / (radius - 0.25))) * 0.75) END AS BIGINT) AS most FROM v_zones"))
def prj16(spark: SparkSession, d: str) -> DataFrame:
    near = view(spark, d, "v_zones").withColumn("s", F.col("radius") - 0.25)
    return near.select("zone_id", P.max_per_pixel(F.lit(10.0), F.lit(8.0), F.col("s")).alias("most"))


@query(
    "prj17_spectral_angle",
    duckdb("v_refl", then="SELECT pixel_id, round(acos(greatest(-1.0, least(1.0, (b02 * 0.1 + b03 * 0.2 + b04 * 0.3 + b08 * 0.4) / (sqrt(b02 * b02 + b03 * b03 + b04 * b04 + b08 * b08) * sqrt(0.3::DOUBLE))))), 5) AS angle FROM v_refl".replace("b02 *", "b02::DOUBLE *").replace("b03 *", "b03::DOUBLE *").replace("b04 *", "b04::DOUBLE *").replace("b08 *", "b08::DOUBLE *")),
)
def prj17(spark: SparkSession, d: str) -> DataFrame:
    bands = F.array(*(F.col(b).cast("double") for b in ("b02", "b03", "b04", "b08")))
    angle = P.spectral_angle(bands, F.array(*map(F.lit, (0.1, 0.2, 0.3, 0.4))))
    return view(spark, d, "v_refl").select("pixel_id", F.round(angle, 5).alias("angle"))


@query(
    "prj18_reflectance_factors",
    duckdb(
        "v_radiance",
        then="SELECT sensor_id, w, x_index, y_index, round(radiance * pi() / (1.5 * cos(radians(30))), 6) AS brf, round(radiance * pi() / 1.5, 6) AS hdrf, round(radiance / 0.83::DOUBLE, 6) AS bhr FROM v_radiance",
    ),
)
def prj18(spark: SparkSession, d: str) -> DataFrame:
    r, e = F.col("radiance"), F.lit(1.5)
    return view(spark, d, "v_radiance").select("sensor_id", "w", "x_index", "y_index", *r6(brf=P.brf(r, e, F.lit(30.0)), hdrf=P.hdrf(r, e), bhr=P.bhr(r, F.lit(0.83))))


@query("prj22_instance_matrix", duckdb("v_points", then="""SELECT pid, round((cos(radians(x)) * cos(radians(5)) - sin(radians(x)) * cos(radians(y)) * sin(radians(5))) * 2, 6) AS m00, x AS m03,
  round(-(cos(radians(x)) * sin(radians(y))) * 2, 6) + 0.0 AS m11, round(cos(radians(y)) * 2, 6) AS m21, round(-sin(radians(y)) * cos(radians(5)) * 2, 6) + 0.0 AS m22 FROM v_points"""))
def prj22(spark: SparkSession, d: str) -> DataFrame:
    m = P.instance_matrix(F.col("x"), F.col("y"), F.col("value"), F.col("x"), F.lit(2.0), F.col("y"), F.lit(5.0))
    at = lambda i: F.get("m", F.lit(i))
    return view(spark, d, "v_points").withColumn("m", m).select("pid", *r6(m00=at(0)), at(3).alias("m03"), *r6(m11=at(5), m21=at(9), m22=at(10)))


@query("prj24_flatten_dem", duckdb("v_dem", then="SELECT ix, iy, 0.0::DOUBLE AS elevation FROM v_dem"))
def prj24(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "v_dem").withColumn("elevation", F.lit(0.0))


_HEIGHT = """h AS (SELECT *, string_split(height, '+') AS parts FROM v_buildings),
hh AS (SELECT *, list_filter(list_transform(parts, lambda p: CASE WHEN p LIKE 'HHT:%' THEN TRY_CAST(split_part(p, ':', 2) AS DOUBLE) END), lambda v: v IS NOT NULL)[1] AS a,
  list_filter(list_transform(parts, lambda p: CASE WHEN p LIKE 'H:%' THEN TRY_CAST(split_part(p, ':', 2) AS DOUBLE) * 3 END), lambda v: v IS NOT NULL)[1] AS b,
  list_filter(list_transform(parts, lambda p: CASE WHEN p LIKE 'HAPP:%' THEN TRY_CAST(split_part(p, ':', 2) AS DOUBLE) * 3 END), lambda v: v IS NOT NULL)[1] AS c,
  list_filter(list_transform(parts, lambda p: CASE WHEN p LIKE 'HBET:%' THEN (TRY_CAST(split_part(split_part(p, ':', 2), '-', 1) AS DOUBLE) + TRY_CAST(split_part(split_part(p, ':', 2), '-', 2) AS DOUBLE)) / 2 * 3 END), lambda v: v IS NOT NULL)[1] AS e FROM h),
hm AS (SELECT *, coalesce(a, b, c, e, 3.0) AS height_m, coalesce(a, b, c, e) IS NOT NULL AS parsed FROM hh)"""


@query("scl1_parse_height", duckdb("v_buildings", then=f"WITH {_HEIGHT} SELECT building_id, height_m, parsed FROM hm"))
def scl1(spark: SparkSession, d: str) -> DataFrame:
    metres, parsed = S.parse_height(F.col("height"))
    return view(spark, d, "v_buildings").select("building_id", metres.alias("height_m"), parsed.alias("parsed"))


@query("scl1_parse_height_numbers", duckdb("v_buildings", then="""SELECT building_id, CASE WHEN given > 0 THEN given ELSE 3.0 END AS height_m, coalesce(given > 0, false) AS parsed
  FROM (SELECT building_id, CASE WHEN building_id % 4 > 0 THEN area_m2 * (building_id % 4 - 2) / 100 END AS given FROM v_buildings)"""))
def scl1_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Heights of a numeric column: above, at and below 0, and null."""
    k = F.col("building_id") % 4
    given = view(spark, d, "v_buildings").select("building_id", F.when(k > 0, F.col("area_m2") * (k - 2) / 100).alias("given"))
    metres, parsed = S.parse_height(F.col("given"))
    return given.select("building_id", metres.alias("height_m"), parsed.alias("parsed"))


@query("scl2_parse_width", duckdb("v_ways", then="SELECT way_id, TRY_CAST(regexp_replace(lower(trim(width)), '\\s*m$', '') AS DOUBLE) AS width_m FROM v_ways"))
def scl2(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "v_ways").select("way_id", S.parse_width(F.col("width")).alias("width_m"))


_ROADS = """r AS (SELECT *, CASE highway WHEN 'residential' THEN 2 WHEN 'motorway' THEN 3 WHEN 'track' THEN 1 WHEN 'service' THEN 1 END AS tl,
  CASE highway WHEN 'residential' THEN 3.0 WHEN 'motorway' THEN 3.5 WHEN 'track' THEN 2.5 WHEN 'service' THEN 2.5 ELSE 3.0 END::DOUBLE AS tw FROM v_ways),
rw AS (SELECT *, coalesce(TRY_CAST(regexp_replace(lower(trim(nullif(width, ''))), '\\s*m$', '') AS DOUBLE),
  coalesce(TRY_CAST(lanes AS INT), tl, CASE WHEN oneway = 'yes' THEN 1 ELSE 2 END) * tw + 1.0) AS width_m,
  CASE surface WHEN 'gravel' THEN 'gravel_road' WHEN 'dirt' THEN 'baresoil' WHEN 'moonrock' THEN 'asphalt' ELSE CASE WHEN highway = 'track' THEN 'gravel_road' ELSE 'asphalt' END END AS material FROM r)"""


@query("scl3_road_width", duckdb("v_ways", then=f"WITH {_ROADS} SELECT way_id, round(width_m, 6) AS width_m FROM rw"))
def scl3(spark: SparkSession, d: str) -> DataFrame:
    return S.road_attributes(view(spark, d, "v_ways")).select("way_id", F.round("width_m", 6).alias("width_m"))


@query("scl4_road_material", duckdb("v_ways", then=f"WITH {_ROADS} SELECT way_id, material FROM rw"))
def scl4(spark: SparkSession, d: str) -> DataFrame:
    return S.road_attributes(view(spark, d, "v_ways")).select("way_id", "material")


@query("scl5_safe_name", "SELECT p_partkey, regexp_replace(p_name || ' ' || p_type, '[^A-Za-z0-9_.-]+', '_', 'g') AS safe, translate(p_name || '.a-b', '.-', '__') AS clean FROM part")
def scl5(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    return p.select("p_partkey", S.safe_name(F.concat_ws(" ", "p_name", "p_type")).alias("safe"), S.clean_id(F.concat("p_name", F.lit(".a-b"))).alias("clean"))


@query("scl6_date_window", duckdb("v_scenes", then="SELECT scene_id, acq_date - 15 AS first, acq_date + 15 AS last FROM v_scenes"))
def scl6(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "v_scenes").select("scene_id", S.date_window(F.col("acq_date"), 15).alias("w")).select("scene_id", "w.*")


@query("scl7_dates", "SELECT event_id, CAST(ts AS DATE) AS day, CAST(month(ts) AS BIGINT) AS month, make_timestamp(CAST(event_id * 1000003 AS BIGINT) * 1000) AS at FROM events")
def scl7(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.to_date("ts").alias("day"), F.month("ts").cast("long").alias("month"), F.to_timestamp_ntz(F.date_format(F.timestamp_millis(F.col("event_id") * 1000003), "yyyy-MM-dd HH:mm:ss.SSS")).alias("at"))


@query("scl8_names", duckdb("v_points", then="SELECT pid, 'B' || lpad(CAST(pid % 12 AS VARCHAR), 2, '0') AS band, 'vegetation_instance_' || species || '_' || pid AS instance, species || '_' || pid AS result FROM v_points"))
def scl8(spark: SparkSession, d: str) -> DataFrame:
    pid = F.col("pid").cast("string")
    return view(spark, d, "v_points").select("pid", S.band_suffix(F.col("pid") % 12).alias("band"), S.instance_id(F.col("species"), pid).alias("instance"), S.result_name(F.col("species"), pid).alias("result"))


@query("scl9_weighted_choice", duckdb("v_buildings", then=f"SELECT building_id, CASE WHEN {_U.format(seed='m', key='building_id')} < 0.5 THEN 'brick' WHEN {_U.format(seed='m', key='building_id')} < 0.875 THEN 'concrete' ELSE 'wood' END AS material FROM v_buildings"))
def scl9(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "v_buildings").select("building_id", S.weighted_choice({"brick": 4, "concrete": 3, "wood": 1}, "m", "building_id").alias("material"))


@query("scl10_to_nm", duckdb("v_spectra", then="WITH s AS (SELECT material_id, CASE WHEN material_id % 2 = 0 THEN w / 1000 ELSE w END AS w FROM v_spectra) SELECT material_id, round(CASE WHEN max(w) OVER (PARTITION BY material_id) < 100 THEN w * 1000 ELSE w END, 6) AS w FROM s"))
def scl10(spark: SparkSession, d: str) -> DataFrame:
    s = view(spark, d, "v_spectra").select("material_id", F.when(F.col("material_id") % 2 == 0, F.col("w") / 1000).otherwise(F.col("w")).alias("w"))
    return to_nanometres(s).select("material_id", F.round("w", 6).alias("w"))
