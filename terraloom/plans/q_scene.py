"""Queries of scene-wide steps: regridding, zones, objects, refinement by error, checks and metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.functions import projection as P
from terraloom.operators import aggregates as A
from terraloom.operators import compositing as C
from terraloom.operators import sampling as SM
from terraloom.operators import scene as Z
from terraloom.operators import terrain as T
from terraloom.operators.generate import scene_grid
from terraloom.plans.q_aggregates import _FULL, _plane, agg4
from terraloom.plans.q_filters import _BILINEAR, _CORNERS, dem_at, r6
from terraloom.plans.q_functions import _FORWARD, _HOTINE, CENTRE
from terraloom.plans.registry import ORACLES, query
from terraloom.plans.views import duckdb, view
from terraloom.session import cut, shared_path
from terraloom.sources import tables as S

_INVERSE = """w AS (SELECT i, j, x, y, (exp(-x * b / a) - exp(x * b / a)) / 2 AS sh, (exp(-x * b / a) + exp(x * b / a)) / 2 AS ch, (y + u0) * b / a AS ang, ee, b, e2, l0 FROM c, k3),
w1 AS (SELECT *, sin(ang) / ch AS uu FROM w), w2 AS (SELECT *, pi() / 2 - 2 * atan(pow(ee / sqrt((1 + uu) / (1 - uu)), 1 / b)) AS chi FROM w1),
deg AS (SELECT i, j, x, y, degrees(l0 - atan2(sh, cos(ang)) / b) AS lon, degrees(chi + sin(2 * chi) * (e2 / 2 + 5 * e2 ** 2 / 24 + e2 ** 3 / 12 + 13 * e2 ** 4 / 360)
  + sin(4 * chi) * (7 * e2 ** 2 / 48 + 29 * e2 ** 3 / 240 + 811 * e2 ** 4 / 11520) + sin(6 * chi) * (7 * e2 ** 3 / 120 + 81 * e2 ** 4 / 1120) + sin(8 * chi) * (4279 * e2 ** 4 / 161280)) AS lat FROM w2)"""
_SCENE = f"""{_HOTINE}, c AS (SELECT i, j, i * (13700.0 / 46) - 6850.0 AS x, j * (13700.0 / 46) - 6850.0 AS y FROM range(47) p(i), range(47) q(j)), {_INVERSE},
idx AS (SELECT i, j, (lon - 7.93) / 0.0022 AS fx, (lat - 45.05) / -0.0016 AS fy FROM deg)"""
_DEM = """dem AS (SELECT ix::BIGINT AS ix, iy::BIGINT AS iy, elevation::DOUBLE AS v FROM v_dem), ext AS (SELECT max(ix) AS mx, max(iy) AS my FROM dem),
cor AS (SELECT a.ix, a.iy, a.v AS v0, b.v AS v1, c.v AS v2, e.v AS v3 FROM dem a JOIN dem b ON b.ix = a.ix + 1 AND b.iy = a.iy JOIN dem c ON c.ix = a.ix AND c.iy = a.iy + 1 JOIN dem e ON e.ix = a.ix + 1 AND e.iy = a.iy + 1)"""


def regridded(spark: SparkSession, d: str, method: str, fill: float) -> DataFrame:
    """A scene of 14 km at 300 m, part of it off the source; 300 m does not divide it."""
    grid = Z.regrid_scene(dem_at(spark, d), P.SceneProjection(*CENTRE), 14.0, 300.0, (45.05, 7.93), (-0.0016, 0.0022), method, "elevation", fill)
    return grid.select("ix", "iy", F.round("elevation", 4).alias("elevation"))


@query("smp1_regrid_scene", duckdb("v_dem", then=f"""WITH {_SCENE}, {_DEM}, q AS (SELECT i, j, fx, fy, greatest(0, least(floor(fx), mx - 1)) AS cx, greatest(0, least(floor(fy), my - 1)) AS cy FROM idx, ext)
SELECT i AS ix, j AS iy, round(coalesce((v0 * (1 - (fx - cx)) + v1 * (fx - cx)) * (1 - (fy - cy)) + (v2 * (1 - (fx - cx)) + v3 * (fx - cx)) * (fy - cy), 0.0), 4) AS elevation FROM q LEFT JOIN cor ON ix = cx AND iy = cy"""))
def smp1_scene(spark: SparkSession, d: str) -> DataFrame:
    return regridded(spark, d, "linear", 0.0)


@query("smp1_regrid_scene_nearest", duckdb("v_dem", then=f"""WITH {_SCENE}, {_DEM}
SELECT i AS ix, j AS iy, round(coalesce(v, -1.0), 4) AS elevation FROM idx CROSS JOIN ext LEFT JOIN dem ON ix = greatest(0, least(ceil(fx - 0.5), mx)) AND iy = greatest(0, least(ceil(fy - 0.5), my))"""))
def smp1_nearest(spark: SparkSession, d: str) -> DataFrame:
    return regridded(spark, d, "nearest", -1.0)


_SOUTH = _HOTINE.replace("radians(45.0", "radians(-23.6").replace("radians(8.0", "radians(15.1").replace("(d + sqrt", "(d - sqrt").replace("a / b * atan2", "-a / b * atan2")
_F = 1 / 298.257223563
_N = _F / (2 - _F)
_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180, 13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440, 61 * _N**3 / 240 - 103 * _N**4 / 140, 49561 * _N**4 / 161280)
_SCALE = 0.9996 * 6378137.0 / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ECC = 2 * _N**0.5 / (1 + _N)
_EAST = "eta" + "".join(f" + cos(xi * {2 * j}) * sinh(eta * {2 * j}) * {a!r}::DOUBLE" for j, a in enumerate(_ALPHA, 1))
_NORTH = "xi" + "".join(f" + sin(xi * {2 * j}) * cosh(eta * {2 * j}) * {a!r}::DOUBLE" for j, a in enumerate(_ALPHA, 1))


@query("smp5_reproject_utm", duckdb("v_dem", then=f"""WITH {_SOUTH}, c AS (SELECT i, j, (i + 0.5) * 10 - 320 AS x, (j + 0.5) * 10 - 320 AS y FROM range(64) p(i), range(64) q(j)), {_INVERSE}, {_CORNERS},
u AS (SELECT i, j, sinh(atanh(sin(radians(lat))) - atanh(sin(radians(lat)) * {_ECC!r}::DOUBLE) * {_ECC!r}::DOUBLE) AS t, radians(lon - 15) AS turn FROM deg), v AS (SELECT i, j, atan2(t, cos(turn)) AS xi, atanh(sin(turn) / sqrt(1 + t * t)) AS eta FROM u),
g AS (SELECT i, j, (({_EAST}) * {_SCALE!r}::DOUBLE + 500000.0 - 509887.0) / 10 AS fx, (({_NORTH}) * {_SCALE!r}::DOUBLE + 10000000.0 - 7389739.0) / 10 AS fy FROM v),
q AS (SELECT *, least(floor(fx), mx - 1) AS cx, least(floor(fy), my - 1) AS cy FROM g, ext)
SELECT i AS gx, j AS gy, CASE WHEN fx <= mx AND fy <= my AND fx >= 0 AND fy >= 0 THEN round({_BILINEAR}, 4) END AS v FROM q LEFT JOIN cor ON ix = cx AND iy = cy"""))
def smp5_utm(spark: SparkSession, d: str) -> DataFrame:
    """A UTM composite of 10 m pixels (the elevation grid) on a scene grid of the same step, through both projections."""
    cells = scene_grid(spark, 64, 10.0).select(F.col("ix").alias("gx"), F.col("iy").alias("gy"), "x", "y")
    found = SM.reproject_bilinear(dem_at(spark, d), cells, P.SceneProjection(-23.6, 15.1), 32733, (509_887.0, 7_389_739.0), 10.0, "elevation")
    return found.select("gx", "gy", F.round("elevation", 4).alias("v"))


@query("prj23_place_objects_geographic", duckdb("v_zones", "v_dem", then=f"""WITH p AS (SELECT zone_id AS pid, 44.9 + cy / 320.0 AS lat, 7.9 + cx / 320.0 AS lon FROM v_zones), {_HOTINE}, {_FORWARD},
o AS (SELECT zone_id, CASE WHEN zone_id % 2 = 0 THEN x ELSE cx * 250 - 8000 END AS x, CASE WHEN zone_id % 2 = 0 THEN y ELSE cy * 250 - 8000 END AS y, zone_id % 3 + 0.5 AS up FROM v_zones JOIN g ON pid = zone_id), ext AS (SELECT max(ix) AS mx, max(iy) AS my FROM v_dem)
SELECT zone_id, round(x, 3) AS x, round(o.y, 3) AS y, round(elevation + up, 6) AS z FROM o CROSS JOIN ext LEFT JOIN v_dem ON ix = greatest(0, least(floor((x + 7875) / 250 + 0.5), mx)) AND iy = greatest(0, least(floor((y + 7875) / 250 + 0.5), my))"""))
def prj23_geographic(spark: SparkSession, d: str) -> DataFrame:
    """Every other object by longitude and latitude, the rest by scene metres."""
    even = F.col("zone_id") % 2 == 0
    objects = view(spark, d, "v_zones").select(
        "zone_id",
        F.when(even, "geographic").otherwise("scene").alias("coord_type"),
        F.when(even, 7.9 + F.col("cx") / 320.0).otherwise(F.col("cx") * 250 - 8000).alias("c1"),
        F.when(even, 44.9 + F.col("cy") / 320.0).otherwise(F.col("cy") * 250 - 8000).alias("c2"),
        (F.col("zone_id") % 3 + 0.5).alias("elevation_offset"),
    )
    placed = Z.place_objects(objects, dem_at(spark, d), P.SceneProjection(*CENTRE), (-7875.0, -7875.0), 250.0)
    return placed.select("zone_id", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"), *r6(z=F.col("z")))


_ZONES = {"target": (0.64, 10.0), "buffer": (1.28, 20.0), "background": (6.4, 200.0)}
_AREAS = " UNION ALL ".join(f"SELECT '{name}' AS zone, {round(km * 1000 / res)} AS n, {res} AS res FROM (SELECT 1)" for name, (km, res) in _ZONES.items())


@query("set5_zones_union_own_grids", duckdb("v_landcover", "v_dem", then=f"""WITH a AS ({_AREAS}), g AS (SELECT zone, i AS ix, j AS iy, (i + 0.5) * res - n * res / 2 AS x, (j + 0.5) * res - n * res / 2 AS y FROM a, range(64) p(i), range(64) q(j) WHERE i < n AND j < n)
SELECT zone, g.ix, g.iy, x, y, CASE WHEN zone = 'target' AND (g.ix + g.iy) % 9 = 0 THEN 'asphalt' WHEN zone <> 'background' AND elevation < 200 THEN 'snow' WHEN class IS NOT NULL THEN 'class_' || class END AS material
FROM g LEFT JOIN v_landcover l ON l.ix = g.ix AND l.iy = g.iy LEFT JOIN v_dem e ON e.ix = g.ix AND e.iy = g.iy"""))
def set5_own(spark: SparkSession, d: str) -> DataFrame:
    """Target, buffer and background, each on its own size and resolution."""
    cover, low = view(spark, d, "v_landcover"), dem_at(spark, d).where("elevation < 200")
    layers = {
        "base": lambda g: g.join(cover, ["ix", "iy"]).select("ix", "iy", F.concat(F.lit("class_"), "class").alias("material")),
        "snow": lambda g: g.join(low, ["ix", "iy"], "left_semi").withColumn("material", F.lit("snow")),
        "roads": lambda g: g.where("(ix + iy) % 9 = 0").withColumn("material", F.lit("asphalt")),
    }
    return Z.zones_union(spark, _ZONES, layers)


_BLOCKS = (2, 4, 8, 16, 32, 64)
_UP = ", ".join(
    f"p{k} AS (SELECT e{k}.i, e{k}.j, " + (f"e{k}.error FROM e{k})" if k == 2 else f"greatest(e{k}.error, coalesce(max(c.error), 0)) AS error FROM e{k} LEFT JOIN p{k // 2} c ON c.i // 2 = e{k}.i AND c.j // 2 = e{k}.j GROUP BY e{k}.i, e{k}.j, e{k}.error)")
    for k in _BLOCKS
)
_LEVELS = " UNION ALL ".join(f"SELECT {6 - k.bit_length() + 1} AS l, i, j FROM p{k} WHERE error > 85" for k in _BLOCKS)


@query("gen11_refine_by_error", duckdb("v_dem", then=f"""WITH {_FULL}, {', '.join(_plane(k) for k in _BLOCKS)}, {_UP}, bad AS ({_LEVELS}), c AS (SELECT l, i, j FROM range(6) a(l), range(32) p(i), range(32) q(j) WHERE i < (1 << l) AND j < (1 << l)),
h AS (SELECT c.l, c.i, c.j, bad.l IS NOT NULL AS hit FROM c LEFT JOIN bad ON bad.l = c.l AND bad.i = c.i AND bad.j = c.j)
SELECT h.l AS level, h.i, h.j FROM h LEFT JOIN h p ON p.l = h.l - 1 AND p.i = h.i // 2 AND p.j = h.j // 2 WHERE coalesce(p.hit, true) AND (h.l = 5 OR NOT h.hit)"""))
def gen11_error(spark: SparkSession, d: str) -> DataFrame:
    """Cells split where the elevation strays from a plane by more than the tolerance."""
    pyramid = cut(A.error_pyramid(dem_at(spark, d), 6, 64, 64), "pyramid")
    root = spark.createDataFrame([(0, 0, 0)], "level long, i long, j long")
    return T.refine_cells(root, T.exceeding(pyramid, 85.0), 5).select("level", "i", "j")


@query("agg4_closest_composite_checked", f"WITH r AS ({ORACLES['agg4_closest_composite']}) SELECT count(*) AS pixels, round(avg((v IS NOT NULL)::INT), 6) AS coverage, avg((v IS NOT NULL)::INT) < 0.7 AS short FROM r")
def agg4_checked(spark: SparkSession, d: str) -> DataFrame:
    """The composite's coverage and whether it falls short of its aim."""
    kept, covered, short = C.checked_composite(agg4(spark, d), "v", 0.7)
    return kept.agg(F.count("*").alias("pixels")).select("pixels", F.round(F.lit(covered), 6).alias("coverage"), F.lit(short).alias("short"))


@query("set4_missing_series", duckdb("v_radiance", "v_zones", then="SELECT zone_id AS series FROM v_zones WHERE zone_id NOT IN (SELECT sensor_id FROM v_radiance WHERE sensor_id % 3 <> 0)"))
def set4_missing(spark: SparkSession, d: str) -> DataFrame:
    """Series without a part: those of the third that was not simulated."""
    r = view(spark, d, "v_radiance").withColumnRenamed("sensor_id", "series")
    parts = [A.spatial_mean(r.where(f"series % 3 = {k}"), ["series", "w"], "radiance") for k in (1, 2)]
    return Z.combine_series(parts, view(spark, d, "v_zones").select(F.col("zone_id").alias("series")))[1].select("series")


_TYPES = "CASE zone_id % 3 WHEN 0 THEN 'satellite' WHEN 1 THEN 'uav' ELSE 'ground' END"


@query("snk6_write_result_metadata", duckdb("v_radiance", "v_zones", then=f"""WITH m AS (SELECT DISTINCT sensor_id FROM v_radiance)
SELECT 'r1' AS result_id, 'name' AS key, 'scene' AS value UNION ALL SELECT 'r1', 'num_sensors', count(*)::VARCHAR FROM v_zones UNION ALL SELECT 'r1', 'sensor_types', {_TYPES} FROM v_zones
UNION ALL SELECT 'r1', 'num_measurements', count(*)::VARCHAR FROM m UNION ALL SELECT 'r1', 'measurement_types', 'brf' FROM m"""))
def snk6_metadata(spark: SparkSession, d: str) -> DataFrame:
    """Metadata of a result; the time of writing, which no rerun repeats, is left out here."""
    path = shared_path(spark, "result")
    r = view(spark, d, "v_radiance")
    sensors = view(spark, d, "v_zones").select(F.expr(_TYPES).alias("type"))
    measurements = r.select("sensor_id").distinct().select(F.lit("brf").alias("type"))
    S.write_result(r, path, "r1", "brf", {"name": "scene"}, sensors, measurements)
    return spark.read.parquet(f"{path}/meta").where("key <> 'created_at'")
