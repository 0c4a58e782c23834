"""Queries of aggregates, windows, compositing, sets and top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terraloom.functions import projection as P
from terraloom.functions import scalars as S
from terraloom.functions.keyed import draw
from terraloom.operators import aggregates as A
from terraloom.operators import compositing as C
from terraloom.operators.generate import scene_grid
from terraloom.operators.geometry import polygon
from terraloom.operators.scene import cap_per_pixel, combine_series
from terraloom.plans.q_filters import DIAMOND, dem_at, r6
from terraloom.plans.q_functions import _U
from terraloom.plans.registry import query
from terraloom.plans.views import duckdb, table, view

ANCHOR = "2024-01-05"


def scenes(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "v_scenes")


def layer(spark: SparkSession, d: str) -> DataFrame:
    """Daily pixels: a tile is a pixel, its value the cloud cover where that is below 60."""
    return scenes(spark, d).select("scene_id", "acq_date", F.col("tile_id").alias("pixel"), F.when(F.col("cloud_cover") < 60, F.col("cloud_cover")).alias("v"))


_LAYER = "l AS (SELECT scene_id, acq_date, tile_id AS pixel, CASE WHEN cloud_cover < 60 THEN cloud_cover END AS v FROM v_scenes)"


@query("agg1_mosaic_tiles", duckdb("v_landcover", then="SELECT ix, iy, coalesce(max(CASE WHEN ix % 7 <> 0 THEN class END), 7)::BIGINT AS class FROM v_landcover GROUP BY ix, iy"))
def agg1(spark: SparkSession, d: str) -> DataFrame:
    t = view(spark, d, "v_landcover").withColumn("class", F.when(F.col("ix") % 7 != 0, F.col("class")))
    overlap = t.where("ix between 20 and 40").withColumn("class", F.when(F.col("iy") % 2 == 0, F.col("class")))
    merged, _ = C.mosaic_tiles(t.unionByName(overlap), ["ix", "iy"], "class", 7)
    return merged.select("ix", "iy", F.col("class").cast("long").alias("class"))


@query("agg2_daily_mosaic", duckdb("v_scenes", then=f"WITH {_LAYER} SELECT acq_date, pixel, arg_min(v, scene_id) AS v FROM l WHERE v IS NOT NULL GROUP BY 1, 2"))
def agg2(spark: SparkSession, d: str) -> DataFrame:
    return C.daily_mosaic(layer(spark, d), "acq_date", "scene_id", ["pixel"], "v")


@query("agg3_coverage", duckdb("v_scenes", then=f"WITH {_LAYER} SELECT acq_date, round(avg(CASE WHEN v IS NULL THEN 0.0 ELSE 1.0 END::DOUBLE), 6) AS coverage FROM l GROUP BY 1"))
def agg3(spark: SparkSession, d: str) -> DataFrame:
    return C.coverage(layer(spark, d), "v", ["acq_date"]).select("acq_date", *r6(coverage=F.col("coverage")))


_NEAR = f"n AS (SELECT acq_date, row_number() OVER (ORDER BY abs(datediff('day', acq_date, DATE '{ANCHOR}')), acq_date) AS rank FROM (SELECT DISTINCT acq_date FROM v_scenes))"


@query("agg4_closest_composite", duckdb("v_scenes", then=f"""WITH {_LAYER}, {_NEAR}, dm AS (SELECT acq_date, pixel, arg_min(v, scene_id) AS v FROM l WHERE v IS NOT NULL GROUP BY 1, 2),
v AS (SELECT pixel, v, rank FROM dm JOIN n USING (acq_date) WHERE rank <= 8), f AS (SELECT pixel, min(rank) AS rank FROM v GROUP BY 1), px AS (SELECT DISTINCT pixel FROM l),
c AS (SELECT n.rank, (SELECT count(*) FROM f WHERE f.rank <= n.rank)::DOUBLE / (SELECT count(*) FROM px) AS covered FROM n WHERE n.rank <= 8), cut AS (SELECT coalesce(min(rank) FILTER (covered >= 0.7), max(rank)) AS cut FROM c)
SELECT px.pixel, arg_min(v, rank) AS v, min(rank)::BIGINT AS rank FROM px LEFT JOIN (SELECT v.* FROM v, cut WHERE rank <= cut) u ON u.pixel = px.pixel GROUP BY 1"""))
def agg4(spark: SparkSession, d: str) -> DataFrame:
    rows = layer(spark, d)
    daily = C.daily_mosaic(rows, "acq_date", "scene_id", ["pixel"], "v")
    all_days = daily.unionByName(rows.select("acq_date", "pixel", F.lit(None).cast("double").alias("v")))
    out = C.closest_composite(all_days, rows.select("pixel").distinct(), "acq_date", F.lit(ANCHOR).cast("date"), ["pixel"], "v", 0.7, 8)
    return out.select("pixel", "v", F.col("rank").cast("long").alias("rank"))


@query("agg5_zscore", duckdb("v_refl", then="SELECT pixel_id, round((b02 - avg(b02::DOUBLE) OVER ()) / stddev_pop(b02::DOUBLE) OVER (), 4) AS b02, round((b08 - avg(b08::DOUBLE) OVER ()) / stddev_pop(b08::DOUBLE) OVER (), 4) AS b08 FROM v_refl"))
def agg5(spark: SparkSession, d: str) -> DataFrame:
    r = view(spark, d, "v_refl").select("pixel_id", F.col("b02").cast("double").alias("b02"), F.col("b08").cast("double").alias("b08"))
    return A.zscore(r, ["b02", "b08"]).select("pixel_id", F.round("b02", 4).alias("b02"), F.round("b08", 4).alias("b08"))


@query("agg7_spatial_mean", duckdb("v_radiance", then="SELECT sensor_id, w, round(avg(radiance), 5) AS radiance FROM v_radiance GROUP BY 1, 2"))
def agg7(spark: SparkSession, d: str) -> DataFrame:
    return A.spatial_mean(view(spark, d, "v_radiance"), ["sensor_id", "w"], "radiance").select("sensor_id", "w", F.round("radiance", 5).alias("radiance"))


@query("agg8_boa_irradiance", duckdb("v_radiance", then="SELECT sensor_id, w, round(pi() * avg(radiance), 5) AS irradiance FROM v_radiance GROUP BY 1, 2"))
def agg8(spark: SparkSession, d: str) -> DataFrame:
    return A.boa_irradiance(view(spark, d, "v_radiance"), ["sensor_id", "w"]).select("sensor_id", "w", F.round("irradiance", 5).alias("irradiance"))


@query("agg9_radiosity", duckdb("v_radiance", then="SELECT sensor_id, w, round(avg(radiance * 3), 5) AS radiosity FROM v_radiance GROUP BY 1, 2"))
def agg9(spark: SparkSession, d: str) -> DataFrame:
    r = view(spark, d, "v_radiance").withColumn("radiant_flux", F.col("radiance") * 3)
    return A.radiosity(r, ["sensor_id", "w"]).select("sensor_id", "w", F.round("radiosity", 5).alias("radiosity"))


_FULL = "d AS (SELECT ix, iy, elevation::DOUBLE AS z FROM v_dem WHERE ix < 64 AND iy < 64)"


def _plane(k: int) -> str:
    m, s = (k - 1) / 2, k * k * (k * k - 1) / 12
    return f"""b{k} AS (SELECT ix // {k} AS i, iy // {k} AS j, ix % {k} - {m} AS u, iy % {k} - {m} AS v, z FROM d), f{k} AS (SELECT i, j, avg(z) AS c, sum(u * z) / {s}::DOUBLE AS a, sum(v * z) / {s}::DOUBLE AS b FROM b{k} GROUP BY 1, 2),
e{k} AS (SELECT i, j, max(abs(z - c - a * u - b * v)) AS error FROM b{k} JOIN f{k} USING (i, j) GROUP BY 1, 2)"""


@query("agg11_error_level", duckdb("v_dem", then=f"WITH {_FULL}, {_plane(8)} SELECT i, j, round(error, 5) AS error FROM e8"))
def agg11(spark: SparkSession, d: str) -> DataFrame:
    return A.error_level(dem_at(spark, d), 8, 64, 64).select("i", "j", F.round("error", 5).alias("error"))


@query("agg12_error_pyramid", duckdb("v_dem", then=f"""WITH {_FULL}, {_plane(2)}, {_plane(4)}, p2 AS (SELECT i, j, error FROM e2), p4 AS (SELECT e4.i, e4.j, greatest(e4.error, max(p2.error)) AS error FROM e4 JOIN p2 ON p2.i // 2 = e4.i AND p2.j // 2 = e4.j GROUP BY e4.i, e4.j, e4.error)
SELECT 2 AS level, ix AS i, iy AS j, round(1e-8, 5) AS error FROM d UNION ALL SELECT 1, i, j, round(error + 1e-8, 5) FROM p2 UNION ALL SELECT 0, i, j, round(error + 1e-8, 5) FROM p4"""))
def agg12(spark: SparkSession, d: str) -> DataFrame:
    return A.error_pyramid(dem_at(spark, d), 2, 64, 64).select("level", "i", "j", F.round(F.col("error") + 1e-8, 5).alias("error"))


@query("agg13_instance_groups", duckdb("v_points", then="SELECT species, 'asset_' || (pid % 3) AS asset, count(*) AS n, min(x) AS x_min, max(x) AS x_max, min(y) AS y_min, max(y) AS y_max FROM v_points GROUP BY 1, 2"))
def agg13(spark: SparkSession, d: str) -> DataFrame:
    return A.instance_groups(view(spark, d, "v_points").withColumn("asset", F.concat(F.lit("asset_"), F.col("pid") % 3)))


@query("agg15_class_histogram", duckdb("v_landcover", then="SELECT class::BIGINT AS class, count(*) AS pixels FROM v_landcover GROUP BY 1"))
def agg15(spark: SparkSession, d: str) -> DataFrame:
    return A.class_histogram(view(spark, d, "v_landcover").withColumn("class", F.col("class").cast("long")))


@query("agg15_paint_stats", duckdb("v_dem", then="SELECT round(avg(CASE WHEN elevation < 200 THEN 1.0 ELSE 0.0 END::DOUBLE) * 100, 5) AS percent, min(elevation) AS coldest, max(elevation) AS warmest FROM v_dem"))
def agg15b(spark: SparkSession, d: str) -> DataFrame:
    p = dem_at(spark, d).withColumn("snow", F.col("elevation") < 200)
    return A.paint_stats(p, "snow", "elevation").select(F.round("percent", 5).alias("percent"), "coldest", "warmest")


@query("agg16_histogram", duckdb("v_radiance", then="SELECT CAST(least(floor((radiance - 0.0) / 0.025), 49) AS BIGINT) AS bin, count(*) AS n FROM v_radiance WHERE radiance BETWEEN 0 AND 1.25 GROUP BY 1"))
def agg16(spark: SparkSession, d: str) -> DataFrame:
    return A.histogram(view(spark, d, "v_radiance"), "radiance", 0.0, 1.25, 50)


@query("agg19_display_limit", duckdb("v_radiance", then="SELECT sensor_id, round(quantile_cont(radiance, 0.99), 5) AS \"limit\" FROM v_radiance WHERE w > 400 AND x_index BETWEEN 1 AND 6 AND y_index BETWEEN 1 AND 6 GROUP BY 1"))
def agg19(spark: SparkSession, d: str) -> DataFrame:
    return A.display_limit(view(spark, d, "v_radiance"), ["sensor_id"], 8).select("sensor_id", F.round("limit", 5).alias("limit"))


@query("win1_layer_height", duckdb("v_spectra", then="""WITH s AS (SELECT material_id, w, value / sum(value) OVER (PARTITION BY material_id) AS f FROM v_spectra), r AS (SELECT material_id, w, round(sum(f) OVER (PARTITION BY material_id ORDER BY w DESC), 9) AS run FROM s)
SELECT material_id, coalesce(max(w * 10) FILTER (run >= 0.92), 2000.0::DOUBLE) AS height FROM r GROUP BY 1"""))
def win1(spark: SparkSession, d: str) -> DataFrame:
    total = F.sum("value").over(Window.partitionBy("material_id"))
    s = view(spark, d, "v_spectra").select("material_id", (-F.col("w")).alias("lay"), (F.col("w") * 10).alias("top"), (F.col("value") / total).alias("frac"))
    return A.layer_height(s, "material_id", 0.92 - 1e-10)


_KERNEL = ", ".join(f"({o}, {w!r}::DOUBLE)" for o, w in A.gaussian_kernel(1.5))
_GRID = "g AS (SELECT i AS ix, j AS iy, coalesce(elevation, 0.0) AS p FROM range(64) a(i) CROSS JOIN range(64) b(j) LEFT JOIN v_dem ON ix = i AND iy = j)"


@query("win3_smooth", duckdb("v_dem", then=f"""WITH {_GRID}, k(o, kw) AS (VALUES {_KERNEL}), a AS (SELECT q.ix, q.iy, sum(g.p * kw) AS p FROM g q, k, g WHERE g.iy = q.iy AND g.ix = greatest(0, least(63, q.ix + o)) GROUP BY 1, 2),
b AS (SELECT q.ix, q.iy, sum(a.p * kw) AS p FROM g q, k, a WHERE a.ix = q.ix AND a.iy = greatest(0, least(63, q.iy + o)) GROUP BY 1, 2) SELECT ix, iy, round(p, 5) AS p FROM b"""))
def win3(spark: SparkSession, d: str) -> DataFrame:
    g = scene_grid(spark, 64).select("ix", "iy").join(dem_at(spark, d), ["ix", "iy"], "left").select("ix", "iy", F.coalesce("elevation", F.lit(0.0)).alias("p"))
    return A.smooth(g, 1.5, 64, 64).select("ix", "iy", F.round("p", 5).alias("p"))


@query("win4_cap_per_pixel", duckdb("v_points", then=f"SELECT pid FROM (SELECT pid, row_number() OVER (PARTITION BY floor(x), floor(y) ORDER BY {_U.format(seed=5, key='pid')}, pid) AS r FROM v_points) WHERE r <= 2"))
def win4(spark: SparkSession, d: str) -> DataFrame:
    return cap_per_pixel(view(spark, d, "v_points"), [F.floor("x"), F.floor("y")], 2, draw(5, "pid"), "pid").select("pid")


@query("win5_paint", duckdb("v_landcover", "v_dem", then="SELECT ix, iy, CASE WHEN (ix + iy) % 9 = 0 THEN 'asphalt' WHEN ix BETWEEN 10 AND 20 THEN 'region' WHEN elevation < 200 THEN 'snow' ELSE 'class_' || class END AS material FROM v_landcover LEFT JOIN v_dem USING (ix, iy)"))
def win5(spark: SparkSession, d: str) -> DataFrame:
    base = view(spark, d, "v_landcover")
    part = lambda df, n, m: df.select("ix", "iy", F.lit(n).alias("layer"), m.alias("material"))
    snow = base.join(dem_at(spark, d).where("elevation < 200"), ["ix", "iy"], "left_semi")
    layers = part(base, 0, F.concat(F.lit("class_"), "class")).unionByName(part(snow, 1, F.lit("snow")))
    layers = layers.unionByName(part(base.where("ix between 10 and 20"), 2, F.lit("region"))).unionByName(part(base.where("(ix + iy) % 9 = 0"), 3, F.lit("asphalt")))
    return C.paint(layers, ["ix", "iy"])


@query("win6_allocate_indices", "WITH b AS (SELECT n_name AS name, n_nationkey::BIGINT AS idx FROM nation WHERE n_nationkey < 5), n AS (SELECT DISTINCT p_type AS name FROM part) SELECT * FROM b UNION ALL SELECT name, 4 + row_number() OVER (ORDER BY name) FROM n WHERE name NOT IN (SELECT name FROM b)")
def win6(spark: SparkSession, d: str) -> DataFrame:
    base = table(spark, d, "nation").where("n_nationkey < 5").select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("idx"))
    return A.allocate_indices(base, table(spark, d, "part").select(F.col("p_type").alias("name")))


@query("win7_class_index", duckdb("v_landcover", then="SELECT ix, iy, CASE class WHEN 10 THEN 0 WHEN 80 THEN 1 WHEN 30 THEN 2 END::BIGINT AS idx FROM v_landcover WHERE class IN (10, 80, 30)"))
def win7(spark: SparkSession, d: str) -> DataFrame:
    names = F.create_map(*(F.lit(x) for x in (10, "trees", 80, "water", 30, "grass")))
    idx = A.class_index(spark.range(1).select(names.alias("mapping")))
    return view(spark, d, "v_landcover").join(F.broadcast(idx), "class").select("ix", "iy", "idx")  # a row a class


@query("top1_nearest_dates", duckdb("v_scenes", then=f"WITH {_NEAR} SELECT acq_date, rank::BIGINT AS rank FROM n WHERE rank <= 8"))
def top1(spark: SparkSession, d: str) -> DataFrame:
    return C.nearest_dates(scenes(spark, d), "acq_date", F.lit(ANCHOR).cast("date"), 8).select("acq_date", F.col("rank").cast("long").alias("rank"))


@query("top2_first_items", duckdb("v_scenes", then="SELECT scene_id FROM v_scenes WHERE cloud_cover < 40 ORDER BY scene_id LIMIT 100"))
def top2(spark: SparkSession, d: str) -> DataFrame:
    return scenes(spark, d).where("cloud_cover < 40").orderBy("scene_id").limit(100).select("scene_id")


@query("src9_catalog_search", duckdb("v_scenes", then=f"SELECT scene_id, acq_date FROM v_scenes WHERE acq_date BETWEEN DATE '{ANCHOR}' - 10 AND DATE '{ANCHOR}' + 10 AND cloud_cover < 30 ORDER BY scene_id LIMIT 100"))
def src9(spark: SparkSession, d: str) -> DataFrame:
    return C.catalog_search(scenes(spark, d), F.lit(ANCHOR).cast("date"), 10, 30.0).select("scene_id", "acq_date")


@query("src9_catalog_search_aoi", duckdb("v_scenes", then=f"SELECT scene_id, acq_date FROM v_scenes WHERE acq_date BETWEEN DATE '{ANCHOR}' - 10 AND DATE '{ANCHOR}' + 10 AND cloud_cover < 30 AND tile_id % 64 <= 40 AND tile_id % 64 + 4 >= 20 AND tile_id * 7 % 64 <= 30 AND tile_id * 7 % 64 + 4 >= 10 ORDER BY scene_id LIMIT 100"))
def src9_aoi(spark: SparkSession, d: str) -> DataFrame:
    """Scenes whose tile's box meets an area."""
    x, y = F.col("tile_id") % 64, F.col("tile_id") * 7 % 64
    boxed = scenes(spark, d).withColumns({"xmin": x, "ymin": y, "xmax": x + 4, "ymax": y + 4})
    return C.catalog_search(boxed, F.lit(ANCHOR).cast("date"), 10, 30.0, aoi=(20.0, 10.0, 40.0, 30.0)).select("scene_id", "acq_date")


@query("src9_catalog_search_ring", duckdb("v_scenes", then=f"""WITH c AS (SELECT *, tile_id % 64 AS x, tile_id * 7 % 64 AS y FROM v_scenes) SELECT scene_id, acq_date FROM c WHERE scene_id % 5 <> 0 AND acq_date BETWEEN DATE '{ANCHOR}' - 10 AND DATE '{ANCHOR}' + 10 AND cloud_cover < 90
  AND abs(greatest(x, least(32, x + 4)) - 32) + abs(greatest(y, least(32, y + 4)) - 32) <= 20.005 ORDER BY scene_id LIMIT 100"""))
def src9_ring(spark: SparkSession, d: str) -> DataFrame:
    """Scenes of one collection whose tile meets an area with slanting edges."""
    at = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    x, y = F.col("tile_id") % 64, F.col("tile_id") * 7 % 64
    ringed = scenes(spark, d).withColumns({"ring": F.array(at(x, y), at(x + 4, y), at(x + 4, y + 4), at(x, y + 4)), "collection": F.when(F.col("scene_id") % 5 == 0, "other").otherwise("main")})
    return C.catalog_search(ringed, F.lit(ANCHOR).cast("date"), 10, 90.0, aoi=polygon(*DIAMOND), collection="main", must_hit=True).select("scene_id", "acq_date")


@query("top3_argmin", duckdb("v_points", "v_zones", then="SELECT floor(y)::BIGINT AS row_id, arg_min(pid, (x, pid)) AS pid FROM v_points GROUP BY 1"))
def top3(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "v_points").groupBy(F.floor("y").alias("row_id")).agg(F.min_by("pid", F.struct("x", "pid")).alias("pid"))


@query("set1_concat_footprints", duckdb("v_buildings", then="SELECT building_id, x FROM v_buildings WHERE x < 30 UNION ALL SELECT building_id, x FROM v_buildings WHERE x > 20"))
def set1(spark: SparkSession, d: str) -> DataFrame:
    b = view(spark, d, "v_buildings").select("building_id", "x")
    return b.where("x < 30").unionByName(b.where("x > 20"))


@query("set2_distinct_paths", duckdb("v_zones", then="SELECT DISTINCT 'tile_' || (zone_id % 7) AS path FROM v_zones"))
def set2(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "v_zones").select(F.concat(F.lit("tile_"), F.col("zone_id") % 7).alias("path")).distinct()


@query("set3_overlay_names", "SELECT DISTINCT p_type AS name FROM part UNION SELECT n_name FROM nation WHERE n_regionkey <> 1 EXCEPT SELECT n_name FROM nation WHERE n_nationkey % 2 = 0")
def set3(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    named = table(spark, d, "part").select(F.col("p_type").alias("name")).unionByName(n.where("n_regionkey <> 1").select(F.col("n_name").alias("name")))
    return A.overlay_names(named, n.where("n_nationkey % 2 = 0").select(F.col("n_name").alias("name")))


_SERIES = "SELECT sensor_id AS series, w, round(avg(radiance), 5) AS radiance, cx AS zenith FROM v_radiance JOIN v_zones ON zone_id = sensor_id GROUP BY 1, 2, 4"


@query("set4_combine_series", duckdb("v_radiance", "v_zones", then=_SERIES))
def set4(spark: SparkSession, d: str) -> DataFrame:
    """Every series, simulated in three parts."""
    r = view(spark, d, "v_radiance").withColumnRenamed("sensor_id", "series")
    parts = [A.spatial_mean(r.where(f"series % 3 = {k}"), ["series", "w"], "radiance") for k in range(3)]
    ref = view(spark, d, "v_zones").select(F.col("zone_id").alias("series"), F.col("cx").alias("zenith"))
    return combine_series(parts, ref)[0].select("series", "w", F.round("radiance", 5).alias("radiance"), "zenith")


@query("set5_zones_union", duckdb("v_landcover", then="""SELECT 'target' AS zone, ix, iy, CASE WHEN ix % 5 = 0 THEN 'road' WHEN iy < 8 THEN 'snow' ELSE 'base' END AS material FROM v_landcover WHERE ix BETWEEN 24 AND 39 AND iy BETWEEN 24 AND 39
UNION ALL SELECT 'buffer', ix, iy, CASE WHEN iy < 8 THEN 'snow' ELSE 'base' END FROM v_landcover WHERE NOT (ix BETWEEN 24 AND 39 AND iy BETWEEN 24 AND 39) UNION ALL SELECT DISTINCT 'background', ix // 8, iy // 8, 'base' FROM v_landcover"""))
def set5(spark: SparkSession, d: str) -> DataFrame:
    lc = view(spark, d, "v_landcover").select("ix", "iy")
    inner = F.col("ix").between(24, 39) & F.col("iy").between(24, 39)
    snow = F.when(F.col("iy") < 8, "snow").otherwise("base")
    target = lc.where(inner).select(F.lit("target").alias("zone"), "ix", "iy", F.when(F.col("ix") % 5 == 0, "road").otherwise(snow).alias("material"))
    buffer = lc.where(~inner).select(F.lit("buffer").alias("zone"), "ix", "iy", snow.alias("material"))
    far = lc.select(F.lit("background").alias("zone"), F.floor(F.col("ix") / 8).alias("ix"), F.floor(F.col("iy") / 8).alias("iy"), F.lit("base").alias("material")).distinct()
    return target.unionByName(buffer).unionByName(far)


_T = "26 - 0.62 * 45.0 + (3.0 + 35.0 * (15.0 / 50.0)) * cos((355 - 172) * (2 * pi() / 365)) - 0.0095 * (elevation - 1900)"


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Winter material of each pixel, with counts and mean temperature by material."""
    t = P.season_temperature(F.lit(45.0), F.col("elevation") - 1900, P.MONTH_DAYS["December"])
    both = dem_at(spark, d).join(view(spark, d, "v_landcover"), ["ix", "iy"]).withColumn("t", t)
    snow = P.snow_probability(F.col("t")) > draw(7, "ix", "iy")
    return both.groupBy(F.when(snow, 6).otherwise(S.material_index(F.col("class"))).cast("long").alias("idx")).agg(F.count("*").alias("pixels"), F.round(F.avg("t"), 5).alias("mean_t"))


query(
    "flagship_winter_materials",
    duckdb(
        "v_dem",
        "v_landcover",
        then=f"""WITH c AS (SELECT ix, iy, class, {_T} AS t FROM v_dem JOIN v_landcover USING (ix, iy))
SELECT CAST(CASE WHEN (CASE WHEN t <= 0.3 THEN 1 / (1 + exp(t / 0.15)) ELSE 0 END) > {_U.format(seed=7, key="ix || ':' || iy")} THEN 6 WHEN class IN (10, 20, 30, 40, 50, 60) THEN class / 10 - 1 ELSE 7 END AS BIGINT) AS idx, count(*) AS pixels, round(avg(t), 5) AS mean_t FROM c GROUP BY 1""",
    ),
)(flagship)
