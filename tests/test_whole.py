"""Registered queries run on whole tables, not on a choice of their ids."""

import pytest

from terraloom.operators import vegetation as V
from terraloom.plans import ORACLES, QUERIES
from terraloom.plans.views import view

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["flt11_circular_fov", "gen8_rasterize_roads", "gen11_refine_cells", "prj25_flatten_under_roads", "set4_combine_series", "jon10_nearest_cell"])
def test_sql_of_the_whole_keeps_no_id_filter(name):
    whole = ORACLES[name]
    for part in ("sensor_id <= 20", "way_id % 11 = 0", "zone_id % 10 = 0", "way_id % 9 = 0", "sensor_id % 3 <> 0", "ix % 4 = 0", "iy % 4 = 0"):
        assert part not in whole
    assert f"{name}_whole" not in ORACLES


def test_balanced_cells_are_finest_at_every_zone(spark):
    cells = {(r.i, r.j) for r in QUERIES["gen12_balance_cells"](spark, FOLDER).where("level = 5").collect()}
    zones = view(spark, FOLDER, "v_zones").where("cx < 64 and cy < 64").collect()
    assert len(zones) > 1 and all((int(z.cx // 2), int(z.cy // 2)) in cells for z in zones)


def test_vegetation_grows_every_species_off_every_road(spark):
    plants = QUERIES["gen13_vegetation"](spark, FOLDER).toPandas()
    assert set(plants.species) == {"oak", "pine", "grass", "juniper"}
    for w in view(spark, FOLDER, "v_ways").collect():
        dx, dy = w.x2 - w.x1, w.y2 - w.y1
        t = ((plants.x - w.x1) * dx + (plants.y - w.y1) * dy) / (dx * dx + dy * dy)  # roads end flat
        off = ((plants.x - w.x1 - t * dx) ** 2 + (plants.y - w.y1 - t * dy) ** 2) ** 0.5
        assert not (t.between(0, 1) & (off <= 0.1 - 1e-9)).any()


def test_vegetation_spills_into_compatible_classes_alone(spark):
    rows = [(i, j, {0: 10, 1: 30, 2: 80}[i // 8], i + 0.5, j + 0.5) for i in range(24) for j in range(24)]
    pixels = spark.createDataFrame(rows, "ix long, iy long, class int, x double, y double")
    dem = pixels.selectExpr("ix", "iy", "100.0D as elevation")
    oak = spark.createDataFrame([(10, "oak", 40_000.0)], "class int, species string, density_per_hectare double")
    zones = spark.createDataFrame([], "kind string, cx double, cy double, r double, w double, h double, ring array<struct<x:double,y:double>>")
    roads = spark.createDataFrame([], "x1 double, y1 double, x2 double, y2 double, width_m double")
    grow = lambda *spill: V.vegetation(pixels, dem, oak, zones, roads, 1.0, 0.3, 5, [("a.xml", 1.0)], *spill).toPandas()
    plants, alone = grow({"oak": {30: 0.9}}, 3.0), grow()
    assert plants.pid.is_unique and alone.ix.max() < 8
    over = plants[plants.ix >= 8]
    # within three pixels of the wood's last column; none at the full distance, where the rate is 0
    assert len(over) > 20 and set(over.ix) <= {8, 9} and over.pid.str.startswith("spill_10_").all()
    assert over.z.notna().any()
    p = plants[["x", "y"]].to_numpy()
    d = ((p[:, None] - p[None]) ** 2).sum(2)
    assert (d + (d == 0)).min() >= 0.3**2 - 1e-12


def test_registered_vegetation_has_spilled_plants(spark):
    pids = {r.pid.split("_")[1] for r in QUERIES["gen13_vegetation"](spark, FOLDER).where("pid like 'spill%'").collect()}
    assert pids == {"10", "20", "30"}
