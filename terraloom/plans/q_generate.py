"""Queries of generators, terrain cells, sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.operators import generate as N
from terraloom.operators import matching as M
from terraloom.operators import terrain as T
from terraloom.operators import vegetation as V
from terraloom.operators.roads import with_next
from terraloom.plans.q_filters import DIAMOND, _DIAMOND, boxes, centres, dem_at, r6
from terraloom.plans.q_functions import _U
from terraloom.plans.registry import query
from terraloom.plans.views import duckdb, table, view
from terraloom.session import shared_path
from terraloom.sources import tables as S

SPECIES = [(10, "oak", 400.0), (10, "pine", 250.0), (30, "grass", 900.0), (20, "juniper", 120.0)]
SPILL = {20: 0.8, 30: 0.7, 40: 0.3, 90: 0.4, 60: 0.1}  # fixed values: scores by class
_SPECIES = "m(class, species, dens) AS (VALUES (10, 'oak', 400.0::DOUBLE), (10, 'pine', 250.0), (30, 'grass', 900.0), (20, 'juniper', 120.0))"


def species(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SPECIES, "class int, species string, density_per_hectare double")


@query("gen1_scene_grid", duckdb("v_landcover", then="SELECT i AS ix, j AS iy, (i + 0.5) * 10 - 320 AS x, (j + 0.5) * 10 - 320 AS y, class IS NOT NULL AS covered FROM range(64) a(i) CROSS JOIN range(64) b(j) LEFT JOIN v_landcover ON ix = i AND iy = j"))
def gen1(spark: SparkSession, d: str) -> DataFrame:
    g = N.scene_grid(spark, 64, 10.0)
    return g.join(view(spark, d, "v_landcover"), ["ix", "iy"], "left").select("ix", "iy", "x", "y", F.col("class").isNotNull().alias("covered"))


_COUNT = f"""{_SPECIES}, w AS (SELECT ix, iy, species, least(greatest(0, dens * 0.04 * (1 + 0.3 * ({_U.format(seed='9v', key="ix || ':' || iy || ':' || species")} * 2 - 1))), floor(greatest(1, trunc(20 / 3.0)) ** 2 * 0.75)) AS w FROM v_landcover JOIN m USING (class)),
n AS (SELECT ix, iy, species, CAST(floor(w) + CASE WHEN {_U.format(seed='9b', key="ix || ':' || iy || ':' || species")} < w - floor(w) THEN 1 ELSE 0 END AS BIGINT) AS n FROM w)"""


@query("gen2_plants_per_pixel", duckdb("v_landcover", then=f"WITH {_COUNT} SELECT ix, iy, species, n FROM n"))
def gen2(spark: SparkSession, d: str) -> DataFrame:
    return V.plants_per_pixel(view(spark, d, "v_landcover"), species(spark), 20.0, 3.0, 0.3, 9).select("ix", "iy", "species", "n")


def placed(spark: SparkSession, d: str) -> DataFrame:
    pixels = view(spark, d, "v_landcover").withColumns({"x": F.col("ix") * 20.0 + 10, "y": F.col("iy") * 20.0 + 10})
    counts = V.plants_per_pixel(pixels, species(spark), 20.0, 3.0, 0.3, 9)
    return V.place_in_pixel(counts, 20.0, 3.0, 9, [("a.xml", 3.0), ("b.xml", 1.0)])


_HEX = "CAST(CAST('0x' || substr(h, {at}, 8) AS UBIGINT) AS DOUBLE) / 4294967296"
_PLACED = f"""{_COUNT}, h AS (SELECT ix, iy, species, n, t, md5('9:' || ix || ':' || iy || ':' || species || ':' || t) AS h FROM n, range(1, 101) r(t) WHERE n > 0 AND t <= 5 * n),
p AS (SELECT ix, iy, species, n, list([{{'x': ix * 20.0 + 10 + ({_HEX.format(at=1)} - 0.5) * 20, 'y': iy * 20.0 + 10 + ({_HEX.format(at=9)} - 0.5) * 20, 'u': {_HEX.format(at=17)}}}] ORDER BY t) AS tries FROM h GROUP BY 1, 2, 3, 4),
k AS (SELECT ix, iy, species, list_reduce(list_prepend(tries[1][1:0], tries), lambda s, o: CASE WHEN len(s) < n AND len(list_filter(s, lambda q: (q.x - o[1].x) ** 2 + (q.y - o[1].y) ** 2 < 9)) = 0 THEN list_concat(s, o) ELSE s END) AS kept FROM p)"""


@query("gen3_place_in_pixel", duckdb("v_landcover", then=f"""WITH {_PLACED}, e AS (SELECT ix, iy, species, unnest(range(len(kept))) AS k, unnest(kept) AS q FROM k)
SELECT ix, iy, species, k, round(q.x, 6) AS x, round(q.y, 6) AS y, CASE WHEN q.u >= 0.75 THEN 'b.xml' ELSE 'a.xml' END AS asset FROM e"""))
def gen3(spark: SparkSession, d: str) -> DataFrame:
    return placed(spark, d).select("ix", "iy", "species", "k", *r6(x=F.col("x"), y=F.col("y")), "asset")


@query("gen4_spillover", duckdb("v_landcover", then=f"""WITH t AS (SELECT ix, iy, class, CASE class WHEN 30 THEN 0.8 ELSE 0.4 END::DOUBLE AS score FROM v_landcover WHERE class IN (30, 60)),
n AS (SELECT t.ix, t.iy, t.class, score, min(sqrt((t.ix - p.ix) ** 2 + (t.iy - p.iy) ** 2)) AS distance FROM t JOIN v_landcover p ON p.class = 10 AND abs(p.ix - t.ix) <= 3 AND abs(p.iy - t.iy) <= 3 WHERE (t.ix - p.ix) ** 2 + (t.iy - p.iy) ** 2 <= 9 GROUP BY 1, 2, 3, 4),
l AS (SELECT *, 200.0 * score * (1 - distance / 3.0) * 0.01 AS lam, {_U.format(seed='4p', key="ix || ':' || iy")} AS u FROM n)
SELECT ix, iy, class, round(distance, 6) AS distance, round(lam, 6) AS lam, (SELECT count(*) FROM range(9) r(k) WHERE (SELECT sum(exp(-lam) * pow(lam, i) / gamma(i + 1)) FROM range(9) s(i) WHERE i <= k) < u) AS n FROM l"""))
def gen4(spark: SparkSession, d: str) -> DataFrame:
    out = V.spillover(view(spark, d, "v_landcover"), 10, {30: 0.8, 60: 0.4}, 200.0, 10.0, 30.0, 9, 4)
    return out.select("ix", "iy", "class", *r6(distance=F.col("distance"), lam=F.col("lam")), "n")


@query("gen5_instance_attributes", duckdb("v_points", then=f"SELECT pid, round({_U.format(seed='3r', key='pid')} * 360, 6) AS rotation, round(0.8 + {_U.format(seed='3s', key='pid')} * (1.2 - 0.8), 6) AS scale, round(({_U.format(seed='3x', key='pid')} * 2 - 1) * 5, 6) AS tilt_x FROM v_points"))
def gen5(spark: SparkSession, d: str) -> DataFrame:
    return V.instance_attributes(view(spark, d, "v_points"), 3, "pid").select("pid", *r6(rotation=F.col("rotation"), scale=F.col("scale"), tilt_x=F.col("tilt_x")))


_SPACED = f"""WITH RECURSIVE p AS (SELECT pid, x, y, {_U.format(seed=6, key='pid')} AS u, floor(x / 0.4) AS cx, floor(y / 0.4) AS cy FROM v_points),
e AS (SELECT a.pid AS p, b.pid AS q FROM p a JOIN p b ON b.cx BETWEEN a.cx - 1 AND a.cx + 1 AND b.cy BETWEEN a.cy - 1 AND a.cy + 1 WHERE (a.x - b.x) ** 2 + (a.y - b.y) ** 2 < 0.4 ** 2 AND (b.u, b.pid) < (a.u, a.pid)),
n AS (SELECT p, count(*) AS n FROM e GROUP BY p),
s(pid, kept) USING KEY (pid) AS (SELECT pid, true AS kept FROM p WHERE pid NOT IN (SELECT p FROM e)
 UNION ALL SELECT e.p, NOT bool_or(r.kept) FROM e JOIN recurring.s r ON r.pid = e.q JOIN n ON n.p = e.p WHERE e.p NOT IN (SELECT pid FROM recurring.s) GROUP BY e.p, n.n HAVING count(*) = n.n)
SELECT pid, x, y FROM p JOIN s USING (pid) WHERE kept"""


@query("gen6_min_spacing", duckdb("v_points", then=_SPACED))
def gen6(spark: SparkSession, d: str) -> DataFrame:
    return V.min_spacing(view(spark, d, "v_points"), 0.4, 6).select("pid", "x", "y")


_SEGS = "s AS (SELECT way_id, 0 AS seg, x1, y1, x1 + 4 AS x2, y1 + 20 AS y2 FROM v_ways UNION ALL SELECT way_id, 1, x1 + 4, y1 + 20, x2, y2 FROM v_ways)"


def _clip() -> str:
    sides = [("-(x2 - x1)", "x1 - 10"), ("(x2 - x1)", "50 - x1"), ("-(y2 - y1)", "y1 - 10"), ("(y2 - y1)", "50 - y1")]
    out = " OR ".join(f"({p} = 0 AND {q} < 0)" for p, q in sides)
    t0 = ", ".join(f"CASE WHEN {p} < 0 THEN ({q}) / ({p}) END" for p, q in sides)
    t1 = ", ".join(f"CASE WHEN {p} > 0 THEN ({q}) / ({p}) END" for p, q in sides)
    return f"c AS (SELECT *, greatest(0, {t0}) AS t0, least(1, {t1}) AS t1 FROM s WHERE NOT ({out}))"


@query("gen7_split_roads", duckdb("v_ways", then=f"""WITH {_SEGS}, {_clip()}, k AS (SELECT * FROM c WHERE t0 < t1), n AS (SELECT *, CASE WHEN lag(seg) OVER w = seg - 1 AND lag(t1) OVER w = 1 AND t0 = 0 THEN 0 ELSE 1 END AS new FROM k WINDOW w AS (PARTITION BY way_id ORDER BY seg))
SELECT way_id, sum(new) OVER (PARTITION BY way_id ORDER BY seg)::BIGINT AS piece, seg, round(x1 + t0 * (x2 - x1), 6) AS cx1, round(y1 + t0 * (y2 - y1), 6) AS cy1, round(x1 + t1 * (x2 - x1), 6) AS cx2, round(y1 + t1 * (y2 - y1), 6) AS cy2 FROM n"""))
def gen7(spark: SparkSession, d: str) -> DataFrame:
    at = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    lines = view(spark, d, "v_ways").select("way_id", F.array(at(F.col("x1"), F.col("y1")), at(F.col("x1") + 4, F.col("y1") + 20), at(F.col("x2"), F.col("y2"))).alias("nodes"))
    out = T.split_roads(lines, (10.0, 10.0, 50.0, 50.0))
    return out.select("way_id", "piece", "seg", *r6(**{c: F.col(c) for c in ("cx1", "cy1", "cx2", "cy2")}))


_ROADS = """WITH r AS (SELECT way_id % 5 AS layer, x1, y1, x2, y2, sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2) AS n, 0.1501 AS h FROM v_ways),
s AS (SELECT *, (x2 - x1) / n AS ux, (y2 - y1) / n AS uy, n / 2 AS l, (x1 + x2) / 2 AS mx, (y1 + y2) / 2 AS my FROM r), p AS (SELECT *, i + 0.5 - mx AS qx, j + 0.5 - my AS qy FROM s, range(64) a(i), range(64) b(j))
SELECT i AS ix, j AS iy, max(layer) AS layer FROM p WHERE abs(qx * ux + qy * uy) <= l + 0.5 * (abs(ux) + abs(uy)) AND abs(qy * ux - qx * uy) <= h + 0.5 * (abs(ux) + abs(uy)) AND abs(qx) <= l * abs(ux) + h * abs(uy) + 0.5 AND abs(qy) <= l * abs(uy) + h * abs(ux) + 0.5 GROUP BY 1, 2"""


@query("gen8_rasterize_roads", duckdb("v_ways", then=_ROADS))
def gen8(spark: SparkSession, d: str) -> DataFrame:
    w = view(spark, d, "v_ways").select("x1", "y1", "x2", "y2", F.lit(0.3002).alias("width_m"), (F.col("way_id") % 5).alias("layer"))
    return T.rasterize_roads(w, 64, 64).select("ix", "iy", "layer")


def bent(spark: SparkSession, d: str) -> DataFrame:
    """Segments of roads with two bends each, with the direction in which the road goes on."""
    return with_next(view(spark, d, "v_bends"), "way_id")


_TURNS = """b AS (SELECT way_id, seg, x1, y1, x2, y2, sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2) AS n, lead(x2 - x1) OVER w AS nx, lead(y2 - y1) OVER w AS ny FROM v_bends WINDOW w AS (PARTITION BY way_id ORDER BY seg))"""


@query("gen8_rasterize_roads_bends", duckdb("v_bends", then=f"""WITH {_TURNS}, s AS (SELECT *, way_id % 5 AS layer, 0.6301 AS h, (x2 - x1) / n AS ux, (y2 - y1) / n AS uy, n / 2 AS l, (x1 + x2) / 2 AS mx, (y1 + y2) / 2 AS my FROM b),
p AS (SELECT *, i + 0.5 - mx AS qx, j + 0.5 - my AS qy, greatest(i, least(i + 1, x2)) - x2 AS gx, greatest(j, least(j + 1, y2)) - y2 AS gy FROM s, range(64) a(i), range(64) c(j) WHERE i + 1 >= least(x1, x2) - 1 AND i <= greatest(x1, x2) + 1 AND j + 1 >= least(y1, y2) - 1 AND j <= greatest(y1, y2) + 1)
SELECT i AS ix, j AS iy, max(layer) AS layer FROM p WHERE (abs(qx * ux + qy * uy) <= l + 0.5 * (abs(ux) + abs(uy)) AND abs(qy * ux - qx * uy) <= h + 0.5 * (abs(ux) + abs(uy)) AND abs(qx) <= l * abs(ux) + h * abs(uy) + 0.5 AND abs(qy) <= l * abs(uy) + h * abs(ux) + 0.5)
  OR (nx IS NOT NULL AND gx * gx + gy * gy <= h * h AND gx * ux + gy * uy >= 0 AND gx * nx + gy * ny <= 0) GROUP BY 1, 2"""))
def gen8_bends(spark: SparkSession, d: str) -> DataFrame:
    """Roads with bends, rounded outside them."""
    w = bent(spark, d).withColumns({"width_m": F.lit(1.2602), "layer": F.col("way_id") % 5})
    return T.rasterize_roads(w, 64, 64).select("ix", "iy", "layer")


@query("gen9_apply_regions", duckdb("v_landcover", then=f"SELECT ix, iy, CASE WHEN {_DIAMOND.format(x='(ix + 0.5)', y='(iy + 0.5)')} AND class IN (10, 30) THEN 'park' WHEN sqrt((ix + 0.5 - 10) ** 2 + (iy + 0.5 - 10) ** 2) <= 8.01 THEN 'pond' WHEN ix + 0.5 BETWEEN 5 AND 40 AND iy + 0.5 BETWEEN 5 AND 12 THEN 'field' END AS region FROM v_landcover"))
def gen9(spark: SparkSession, d: str) -> DataFrame:
    ring = [{"x": x, "y": y} for x, y in DIAMOND]
    rows = [(0, "rectangle", 5.0, 5.0, 40.0, 12.0, None, None, None, None, None, "field"), (1, "circle", None, None, None, None, 10.0, 10.0, 8.01, None, None, "pond"), (2, "polygon", None, None, None, None, None, None, None, ring, [10, 30], "park")]
    regions = spark.createDataFrame(rows, "pos int, kind string, x0 double, y0 double, x1 double, y1 double, cx double, cy double, r double, ring array<struct<x:double,y:double>>, classes array<int>, material string")
    return T.apply_regions(centres(spark, d), regions).select("ix", "iy", "region")


def reflectances(spark: SparkSession, d: str) -> DataFrame:
    r = view(spark, d, "v_refl")
    return r.withColumn("class", F.when(F.col("label") % 2 == 0, 10).otherwise(30)).withColumn("idx", F.lit(0).cast("long"))


BANDS = ["b02", "b03", "b04", "b08"]


def _kmeans(k: int, seed: int, rounds: int, classes: str) -> str:
    """CTEs of k-means by class: scores ``s``, starts ``p0`` on, centres ``c0`` on, and ``lab`` (pixel_id, class, cluster, bands)."""
    f = [f"f_{b}" for b in BANDS]
    away = lambda c: " + ".join(f"(s.{x} - {c}.{x}) ** 2" for x in f)
    own = ", ".join(f"s.{x}" for x in f)
    out = [
        f"m AS (SELECT pixel_id, CASE WHEN label % 2 = 0 THEN 10 ELSE 30 END AS class, {', '.join(f'{b}::DOUBLE AS {b}' for b in BANDS)} FROM v_refl), mm AS (SELECT * FROM m WHERE class IN ({classes}))",
        f"st AS (SELECT class, {', '.join(f'avg({b}) AS a_{b}, stddev_pop({b}) AS d_{b}' for b in BANDS)} FROM mm GROUP BY class)",
        f"s AS (SELECT pixel_id, class, {', '.join(BANDS)}, {', '.join(f'({b} - a_{b}) / CASE WHEN d_{b} > 0 THEN d_{b} ELSE 1 END AS f_{b}' for b in BANDS)} FROM mm JOIN st USING (class))",
    ]
    pack = ", ".join(f"'{x}': {x}" for x in f)
    for j in range(k):
        u = f"ln({_U.format(seed=f'{seed}:{j}', key='pixel_id')} + pow(2.0, -33))"
        rows = f"(SELECT s.*, 1.0 AS w FROM s)" if j == 0 else f"(SELECT * FROM (SELECT s.pixel_id, s.class, {own}, min({away('p')}) AS w FROM s JOIN p{j - 1} p ON p.class = s.class GROUP BY s.pixel_id, s.class, {own}) WHERE w > 0)"
        before = "" if j == 0 else f"SELECT * FROM p{j - 1} UNION ALL "
        out.append(f"p{j} AS ({before}SELECT class, {j} AS cluster, {', '.join(f'q.{x} AS {x}' for x in f)} FROM (SELECT class, arg_max({{{pack}}}, ({u} / w, pixel_id)) AS q FROM {rows} r GROUP BY class))")
    label = lambda c: f"SELECT s.pixel_id, s.class, arg_min(c.cluster, ({away('c')}, c.cluster)) AS cluster FROM s JOIN {c} c ON c.class = s.class GROUP BY s.pixel_id, s.class"
    for r in range(rounds):
        last = f"p{k - 1}" if r == 0 else f"c{r - 1}"
        out.append(f"l{r} AS ({label(last)}), n{r} AS (SELECT s.class, cluster, {', '.join(f'avg({x}) AS {x}' for x in f)} FROM s JOIN l{r} USING (pixel_id) GROUP BY s.class, cluster)")
        out.append(f"c{r} AS (SELECT o.class, o.cluster, {', '.join(f'coalesce(n.{x}, o.{x}) AS {x}' for x in f)} FROM {last} o LEFT JOIN n{r} n ON n.class = o.class AND n.cluster = o.cluster)")
    out.append(f"lab AS ({label(f'c{rounds - 1}')})")
    return ", ".join(out)


@query("agg6_cluster_class", duckdb("v_refl", then=f"WITH {_kmeans(4, 11, 10, '10')} SELECT m.pixel_id, coalesce(cluster, -1) AS cluster FROM m LEFT JOIN lab USING (pixel_id)"))
def agg6(spark: SparkSession, d: str) -> DataFrame:
    return M.cluster_class(reflectances(spark, d), 10, BANDS, 4, 11)[0]


_ANGLE = "degrees(acos(greatest(-1.0, least(1.0, (c.b02 * l.b02 + c.b03 * l.b03 + c.b04 * l.b04 + c.b08 * l.b08) / (sqrt(c.b02 ** 2 + c.b03 ** 2 + c.b04 ** 2 + c.b08 ** 2) * sqrt(l.b02 ** 2 + l.b03 ** 2 + l.b04 ** 2 + l.b08 ** 2))))))"
_MEANS = ", ".join(f"avg({b}) AS {b}" for b in BANDS)


@query("gen10_diversify", duckdb("v_refl", then=f"""WITH {_kmeans(3, 11, 10, '10, 30')}, c AS (SELECT m.class, cluster, {_MEANS} FROM m JOIN lab USING (pixel_id) GROUP BY m.class, cluster), lib AS (SELECT pixel_id % 12 AS lib_pos, {_MEANS} FROM m GROUP BY 1),
a AS (SELECT c.class, cluster, lib_pos, {_ANGLE} AS angle FROM c, lib l), b AS (SELECT class, cluster, arg_min(lib_pos, (angle, lib_pos)) AS lib_pos FROM a WHERE angle <= 20 GROUP BY 1, 2),
f AS (SELECT pixel_id, 'm' || lib_pos AS name FROM lab JOIN b USING (class, cluster)), i AS (SELECT name, 1 + row_number() OVER (ORDER BY name) AS idx FROM (SELECT DISTINCT name FROM f))
SELECT m.pixel_id, m.class, coalesce(i.idx, 0)::BIGINT AS idx FROM m LEFT JOIN f USING (pixel_id) LEFT JOIN i USING (name)"""))
def gen10(spark: SparkSession, d: str) -> DataFrame:
    r = reflectances(spark, d)
    lib = r.groupBy((F.col("pixel_id") % 12).alias("lib_pos")).agg(F.array(*(F.avg(F.col(b).cast("double")) for b in BANDS)).alias("vector")).withColumn("material_id", F.concat(F.lit("m"), F.col("lib_pos")))
    base = spark.createDataFrame([("grass", 0), ("trees", 1)], "name string, idx long")
    return M.diversify(r, [10, 30], lib, base, BANDS, 3, 11, 20.0)[0].select("pixel_id", "class", "idx")


_BOX = "b AS (SELECT cx - radius / 8 AS xmin, cy - radius / 8 AS ymin, cx + radius / 8 AS xmax, cy + radius / 8 AS ymax FROM v_zones)"


_CELLS = f"""WITH {_BOX}, c AS (SELECT l, i, j, 64.0 / (1 << l) AS e FROM range(6) a(l), range(32) p(i), range(32) q(j) WHERE i < (1 << l) AND j < (1 << l)),
h AS (SELECT l, i, j, EXISTS (SELECT 1 FROM b WHERE i * e <= xmax AND xmin <= (i + 1) * e AND j * e <= ymax AND ymin <= (j + 1) * e) AS hit FROM c)
SELECT h.l AS level, h.i, h.j FROM h LEFT JOIN h p ON p.l = h.l - 1 AND p.i = h.i // 2 AND p.j = h.j // 2 WHERE coalesce(p.hit, true) AND (h.l = 5 OR NOT h.hit)"""


def refined(spark: SparkSession, d: str) -> DataFrame:
    """Cells about every zone."""
    r = F.col("radius") / 8
    zones = view(spark, d, "v_zones").select((F.col("cx") - r).alias("xmin"), (F.col("cy") - r).alias("ymin"), (F.col("cx") + r).alias("xmax"), (F.col("cy") + r).alias("ymax"))
    root = spark.createDataFrame([(0, 0, 0)], "level long, i long, j long")
    return T.refine_cells(root, T.meeting_zones(64.0, zones, 4.0), 5)


@query("gen11_refine_cells", duckdb("v_zones", then=_CELLS))
def gen11(spark: SparkSession, d: str) -> DataFrame:
    return refined(spark, d).select("level", "i", "j")


def _balanced(depth: int = 5) -> str:
    """Cells of every level, from the finest up: a cell asks for itself and its four neighbours one level up, and cells come in fours."""
    out = [f"o AS (SELECT h.l, h.i, h.j FROM h LEFT JOIN h p ON p.l = h.l - 1 AND p.i = h.i // 2 AND p.j = h.j // 2 WHERE coalesce(p.hit, true))", f"n{depth} AS (SELECT i, j FROM o WHERE l = {depth})"]
    for m in range(depth, 0, -1):
        asked = f"SELECT DISTINCT (i + a) // 2 AS i, (j + b) // 2 AS j FROM n{m}, (VALUES (0, 0), (1, 0), (-1, 0), (0, 1), (0, -1)) s(a, b) WHERE i + a BETWEEN 0 AND {(1 << m) - 1} AND j + b BETWEEN 0 AND {(1 << m) - 1}"
        fours = f"SELECT i // 2 * 2 + a AS i, j // 2 * 2 + b AS j FROM ({asked}) q, (VALUES (0, 0), (1, 0), (0, 1), (1, 1)) f(a, b)" if m > 1 else asked
        out.append(f"n{m - 1} AS (SELECT i, j FROM o WHERE l = {m - 1} UNION {fours})")
    leaves = " UNION ALL ".join(f"SELECT {m} AS level, n.i, n.j FROM n{m} n" + (f" WHERE NOT EXISTS (SELECT 1 FROM n{m + 1} c WHERE c.i // 2 = n.i AND c.j // 2 = n.j)" if m < depth else "") for m in range(depth + 1))
    return _CELLS[: _CELLS.rindex("SELECT h.l AS level")].rstrip() + f", {', '.join(out)} {leaves}"


@query("gen12_balance_cells", duckdb("v_zones", then=_balanced()))
def gen12(spark: SparkSession, d: str) -> DataFrame:
    return T.balance_cells(refined(spark, d)).select("level", "i", "j")


@query("gen13_vegetation")
def gen13(spark: SparkSession, d: str) -> DataFrame:
    """On a grid of 20 m pixels scaled to the elevation grid's units; every species spills 30 m into compatible classes."""
    pixels = view(spark, d, "v_landcover").withColumns({"x": F.col("ix") + 0.5, "y": F.col("iy") + 0.5})
    dense = species(spark).withColumn("density_per_hectare", F.col("density_per_hectare") * 50)
    r = F.col("radius")
    zones = view(spark, d, "v_zones").select(F.lit("circle").alias("kind"), "cx", "cy", r.alias("r"), r.alias("w"), r.alias("h"), F.lit(None).cast("array<struct<x:double,y:double>>").alias("ring")).where(r > 0)
    segments = view(spark, d, "v_ways").select("x1", "y1", "x2", "y2", F.lit(0.2).alias("width_m"))
    return V.vegetation(pixels, dem_at(spark, d), dense, zones, segments, 1.0, 0.3, 5, [("a.xml", 1.0), ("b.xml", 1.0)], {k: SPILL for _, k, _ in SPECIES}, 1.5).select("pid", "species", "asset", "x", "y", "z", "rotation", "scale")


_OPS = """r AS (SELECT way_id AS pos, x1, y1, x2, y2, 100.0 + way_id % 50 AS z1, 120.0 - way_id % 30 AS z2 FROM v_ways),
p AS (SELECT pid, x, y, elevation AS z FROM v_points JOIN v_dem ON ix = floor(x) AND iy = floor(y)),
t AS (SELECT *, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / ((x2 - x1) ** 2 + (y2 - y1) ** 2) AS t FROM p, r),
u AS (SELECT *, sqrt((x - x1 - t * (x2 - x1)) ** 2 + (y - y1 - t * (y2 - y1)) ** 2) AS dist FROM t WHERE t BETWEEN 0 AND 1),
o AS (SELECT pid, list({'a': CASE WHEN dist <= 0.2501 THEN 1.0 ELSE 1 - (dist - 0.2501) / 0.5 END, 'z': z1 + t * (z2 - z1)} ORDER BY pos) AS ops FROM u WHERE dist <= 0.7501 GROUP BY pid)"""


_FLAT = f"""WITH {_OPS} SELECT pid, round(CASE WHEN ops IS NULL THEN z ELSE list_reduce(list_prepend({{'a': 1.0::DOUBLE, 'z': z}}, ops), lambda s, o: {{'a': 1.0::DOUBLE, 'z': o.a * o.z + (1 - o.a) * s.z}}).z END, 6) AS z FROM p LEFT JOIN o USING (pid)"""


@query("prj25_flatten_under_roads", duckdb("v_points", "v_ways", "v_dem", then=_FLAT))
def prj25(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("way_id")
    roads = view(spark, d, "v_ways").select(k.alias("pos"), "x1", "y1", "x2", "y2", (100.0 + k % 50).alias("z1"), (120.0 - k % 30).alias("z2"))
    return flattened(spark, d, roads)


def flattened(spark: SparkSession, d: str, roads: DataFrame) -> DataFrame:
    pts = view(spark, d, "v_points").withColumns({"ix": F.floor("x"), "iy": F.floor("y")}).join(dem_at(spark, d), ["ix", "iy"]).select("pid", "x", "y", F.col("elevation").alias("z"))
    out = T.flatten_under_roads(pts, roads, F.lit(0.2501), 0.5, F.col("z1") + F.col("t") * (F.col("z2") - F.col("z1")), 2.0)
    return out.select("pid", *r6(z=F.col("z")))


_BENT_OPS = f"""{_TURNS}, r AS (SELECT *, 100.0 + (way_id + 7 * seg) % 50 AS z1, 100.0 + (way_id + 7 * seg + 7) % 50 AS z2 FROM b),
p AS (SELECT pid, x, y, elevation AS z FROM v_points JOIN v_dem ON ix = floor(x) AND iy = floor(y)),
t AS (SELECT *, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / (n * n) AS t FROM p JOIN r ON x BETWEEN least(x1, x2) - 1 AND greatest(x1, x2) + 1 AND y BETWEEN least(y1, y2) - 1 AND greatest(y1, y2) + 1),
u AS (SELECT *, greatest(0, least(1, t)) AS c, (t BETWEEN 0 AND 1) OR coalesce(t >= 1 AND (x - x2) * nx + (y - y2) * ny <= 0, false) AS held FROM t),
v AS (SELECT *, sqrt((x - x1 - c * (x2 - x1)) ** 2 + (y - y1 - c * (y2 - y1)) ** 2) AS dist FROM u),
m AS (SELECT pid, way_id AS pos, min(dist) AS dist, arg_min(z1 + c * (z2 - z1), dist) AS z, bool_or(held) AS held FROM v WHERE dist <= 0.7501 GROUP BY 1, 2),
o AS (SELECT pid, list({{'a': CASE WHEN dist <= 0.2501 THEN 1.0 ELSE 1 - (dist - 0.2501) / 0.5 END, 'z': z}} ORDER BY pos) AS ops FROM m WHERE held GROUP BY pid)"""


@query("prj25_flatten_under_roads_bends", duckdb("v_points", "v_bends", "v_dem", then=_FLAT.replace(_OPS, _BENT_OPS)))
def prj25_bends(spark: SparkSession, d: str) -> DataFrame:
    """Under roads with bends: each road blends a point once, from the nearest place of its whole centreline."""
    k = F.col("way_id") + 7 * F.col("seg")
    roads = bent(spark, d).withColumns({"pos": F.col("way_id"), "z1": 100.0 + k % 50, "z2": 100.0 + (k + 7) % 50})
    return flattened(spark, d, roads)


# sources and sinks: what is written is read again


@query("src1_tile_index", duckdb("v_zones", then="SELECT zone_id AS tile_id, 'tile_' || zone_id || '.tif' AS rel_path FROM v_zones"))
def src1(spark: SparkSession, d: str) -> DataFrame:
    path = shared_path(spark, "tiles")
    boxes(spark, d).select(F.col("zone_id").alias("tile_id"), "xmin", "ymin", "xmax", "ymax", F.concat(F.lit("tile_"), F.col("zone_id"), F.lit(".tif")).alias("file_path")).write.parquet(path)
    return S.tile_index(spark, path).select("tile_id", "rel_path")


@query("src2_tile_scan", duckdb("v_landcover", then="SELECT (ix // 16) * 4 + iy // 16 AS tile_id, ix AS lon, iy AS lat, class::BIGINT AS value FROM v_landcover WHERE ((ix // 16) * 4 + iy // 16) % 3 = 0"))
def src2(spark: SparkSession, d: str) -> DataFrame:
    path = shared_path(spark, "pixels")
    tile = (F.floor(F.col("ix") / 16) * 4 + F.floor(F.col("iy") / 16)).alias("tile_id")
    pixels = view(spark, d, "v_landcover").select(tile, F.col("ix").alias("lon"), F.col("iy").alias("lat"), F.col("class").cast("double").alias("value"))
    pixels.write.partitionBy("tile_id").parquet(path)
    tiles = pixels.select("tile_id").distinct().where("tile_id % 3 = 0")
    return S.tile_scan(spark, path, tiles, "long").select(F.col("tile_id").cast("long").alias("tile_id"), "lon", "lat", "value")


@query("src2_tile_scan_box", duckdb("v_landcover", then="SELECT (ix // 16) * 4 + iy // 16 AS tile_id, ix AS lon, iy AS lat, class::BIGINT AS value FROM v_landcover WHERE ix BETWEEN 5 AND 40 AND iy BETWEEN 30 AND 33"))
def src2_box(spark: SparkSession, d: str) -> DataFrame:
    """Pixels within an area, whatever tile they lie in."""
    path = shared_path(spark, "pixels")
    tile = (F.floor(F.col("ix") / 16) * 4 + F.floor(F.col("iy") / 16)).alias("tile_id")
    view(spark, d, "v_landcover").select(tile, F.col("ix").alias("lon"), F.col("iy").alias("lat"), F.col("class").cast("double").alias("value")).write.partitionBy("tile_id").parquet(path)
    return S.tile_scan(spark, path, None, "long", (5.0, 30.0, 40.0, 33.0)).select(F.col("tile_id").cast("long").alias("tile_id"), "lon", "lat", "value")


@query("snk1_grid_area", duckdb("v_dem", then="SELECT ix, iy, elevation FROM v_dem WHERE ix BETWEEN 10 AND 40 AND iy BETWEEN 20 AND 21"))
def snk1_area(spark: SparkSession, d: str) -> DataFrame:
    """An area of a written grid: folders off it are not read."""
    path = shared_path(spark, "grid")
    S.write_grid(dem_at(spark, d), path, 16)
    return S.grid_area(spark, path, (10, 20, 40, 21), 16).select("ix", "iy", "elevation")


@query("src3_grid_scan", duckdb("v_dem", then="SELECT ix, iy, elevation AS value FROM v_dem"))
def src3(spark: SparkSession, d: str) -> DataFrame:
    path = shared_path(spark, "grid")
    dem_at(spark, d).write.parquet(path)
    return S.grid_scan(spark, path, "elevation").select("ix", "iy", "value")


@query("src5_spectra_scan", duckdb("v_spectra", then="SELECT material_id, w, round(value, 9) AS value FROM v_spectra"))
def src5(spark: SparkSession, d: str) -> DataFrame:
    path = f"{shared_path(spark, 'spectra')}.csv"
    view(spark, d, "v_spectra").withColumnRenamed("value", "reflectance").write.csv(path, header=True)
    return S.spectra_scan(spark, path, "reflectance").select(F.col("material_id").cast("long").alias("material_id"), F.col("w").cast("double").alias("w"), F.round("value", 9).alias("value"))


@query("src6_material_library_scan", "SELECT p_brand AS material_id, CASE WHEN p_brand < 'Brand#3' THEN 'diffuse' ELSE 'dielectric' END AS type, CAST(max(p_size) AS VARCHAR) AS size FROM part GROUP BY p_brand")
def src6(spark: SparkSession, d: str) -> DataFrame:
    path = shared_path(spark, "library")
    m = table(spark, d, "part").groupBy("p_brand").agg(F.max("p_size").cast("string").alias("size"))
    params = F.create_map(F.lit("type"), F.when(F.col("p_brand") < "Brand#3", "diffuse").otherwise("dielectric"), F.lit("size"), F.col("size"))
    m.groupBy().agg(F.map_from_entries(F.collect_list(F.struct("p_brand", params))).alias("materials")).write.json(path)  # a configuration: a row a brand
    return S.material_library_scan(spark, path)[0].select("material_id", "type", F.try_element_at("params", F.lit("size")).alias("size"))


@query("src7_ways_scan", duckdb("v_ways", then="SELECT way_id, highway, 2::BIGINT AS nodes FROM v_ways"))
def src7(spark: SparkSession, d: str) -> DataFrame:
    path = shared_path(spark, "ways")
    node = lambda x, y: F.struct(F.col(y).alias("lat"), F.col(x).alias("lon"))
    w = view(spark, d, "v_ways")
    way = [F.lit("way").alias("type"), F.col("way_id").alias("id"), F.create_map(F.lit("highway"), F.col("highway")).alias("tags"), F.array(node("x1", "y1"), node("x2", "y2")).alias("geometry")]
    w.select(*way).write.json(path)
    return S.ways_scan(spark, path, lines=True).select("way_id", F.try_element_at("tags", F.lit("highway")).alias("highway"), F.size("geometry").cast("long").alias("nodes"))


@query("src8_footprints_scan", duckdb("v_buildings", then="SELECT building_id FROM v_buildings WHERE x <= 40 AND x + 1 >= 20 AND y <= 30 AND y + 1 >= 10"))
def src8(spark: SparkSession, d: str) -> DataFrame:
    b = view(spark, d, "v_buildings").select("building_id", F.col("x").alias("xmin"), F.col("y").alias("ymin"), (F.col("x") + 1).alias("xmax"), (F.col("y") + 1).alias("ymax"))
    paths = [shared_path(spark, "footprints") for _ in range(2)]
    for k, p in enumerate(paths):
        b.where(f"building_id % 2 = {k}").write.parquet(p)
    return S.footprints_scan(spark, paths, (20.0, 10.0, 40.0, 30.0)).select("building_id")


@query("src10_reference_series_scan", duckdb("v_points", then="SELECT pid AS series, round(180 - x, 6) AS zenith, round(((90 - y * 5) % 360 + 360) % 360, 6) AS azimuth, make_timestamp(CAST(1600000000 + pid AS BIGINT) * 1000000) AS time FROM v_points"))
def src10(spark: SparkSession, d: str) -> DataFrame:
    path = shared_path(spark, "series")
    view(spark, d, "v_points").select(F.col("pid").alias("series"), F.col("x").alias("viewing_zenith"), (F.col("y") * 5).alias("viewing_azimuth"), (F.lit(1600000000) + F.col("pid")).alias("acquisition_time")).write.parquet(path)
    return S.reference_series_scan(spark, path).select("series", *r6(zenith=F.col("zenith"), azimuth=F.col("azimuth")), F.col("time").cast("timestamp_ntz").alias("time"))


@query("snk1_write_grid", duckdb("v_dem", then="SELECT ix, iy, elevation, (iy // 16) || '_' || (ix // 16) AS chunk FROM v_dem"))
def snk1(spark: SparkSession, d: str) -> DataFrame:
    path = shared_path(spark, "grid")
    S.write_grid(dem_at(spark, d), path, 16)
    return spark.read.parquet(path).select("ix", "iy", "elevation", F.col("chunk").cast("string").alias("chunk"))


def instances(spark: SparkSession, d: str) -> DataFrame:
    p = view(spark, d, "v_points").withColumns({"z": F.lit(0.0), "rotation": F.lit(90.0), "scale": F.lit(1.0), "tilt_x": F.lit(0.0), "tilt_y": F.lit(0.0), "asset": F.concat(F.lit("a"), F.col("pid") % 2)})
    return p.select("x", "y", "z", "rotation", "scale", "tilt_x", "tilt_y", "species", "asset")


@query("snk2_write_instances", duckdb("v_points", then="SELECT species, 'a' || (pid % 2) AS asset, x, y FROM v_points"))
def snk2(spark: SparkSession, d: str) -> DataFrame:
    path = shared_path(spark, "instances")
    S.write_instances(instances(spark, d), path)
    return S.read_instances(spark, path).select("species", "asset", "x", "y")


@query("snk3_instances_metadata", duckdb("v_points", then='SELECT count(*) AS "count", min(x) AS min_x, max(y) AS max_y FROM v_points'))
def snk3(spark: SparkSession, d: str) -> DataFrame:
    path = shared_path(spark, "instances")
    S.write_instances(instances(spark, d), path)
    return S.instances_metadata(S.read_instances(spark, path)).select("count", "min_x", "max_y")


@query("snk4_roads_round_trip", duckdb("v_ways", then="SELECT way_id AS road_id, x1, y2, highway AS material FROM v_ways"))
def snk4(spark: SparkSession, d: str) -> DataFrame:
    path = shared_path(spark, "roads")
    S.write_roads(view(spark, d, "v_ways").select(F.col("way_id").alias("road_id"), F.lit(0).alias("seg"), "x1", "y1", "x2", "y2", F.lit(3.0).alias("width"), F.col("highway").alias("material")), path)
    return S.read_roads(spark, path).select("road_id", "x1", "y2", "material")


@query("snk5_matches_round_trip", duckdb("v_refl", then="SELECT 'c' || label AS cluster, 'm' || (label % 3) AS material, (label + 20)::BIGINT AS idx FROM v_refl GROUP BY label"))
def snk5(spark: SparkSession, d: str) -> DataFrame:
    path = shared_path(spark, "matches")
    m = view(spark, d, "v_refl").select("label").distinct()
    S.write_matches(m.select(F.concat(F.lit("c"), "label").alias("cluster"), F.concat(F.lit("m"), F.col("label") % 3).alias("material"), (F.col("label") + 20).cast("long").alias("idx"), F.lit(10).cast("long").alias("class")), path)
    return S.read_matches(spark, path)


@query("snk6_write_result", duckdb("v_radiance", then="SELECT sensor_id, w, x_index, y_index, radiance, 'r1' AS result_id, 'brf' AS result_type FROM v_radiance"))
def snk6(spark: SparkSession, d: str) -> DataFrame:
    path = shared_path(spark, "result")
    S.write_result(view(spark, d, "v_radiance"), path, "r1", "brf", {"name": "scene", "sensors": "100"})
    return spark.read.parquet(f"{path}/data").select("sensor_id", "w", "x_index", "y_index", "radiance", "result_id", "result_type")
