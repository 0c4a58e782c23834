"""Views of the driver's tables that stand for rasters, vectors and spectra, in Spark's and DuckDB's SQL."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings")

VIEWS: dict[str, str] = {
    "v_dem": """
SELECT CAST(l_orderkey % 64 AS BIGINT) AS ix, CAST(l_partkey % 64 AS BIGINT) AS iy, ROUND(AVG(l_quantity) * 10.0, 6) AS elevation FROM lineitem GROUP BY 1, 2
""",
    "v_landcover": """
SELECT CAST(o_orderkey % 64 AS BIGINT) AS ix, CAST(o_custkey % 64 AS BIGINT) AS iy, CASE CAST(floor(MIN(o_orderkey) / 64.0) AS BIGINT) % 6 WHEN 0 THEN 10 WHEN 1 THEN 30 WHEN 2 THEN 60 WHEN 3 THEN 80 WHEN 4 THEN 50 ELSE 20 END AS class FROM orders GROUP BY 1, 2
""",
    "v_refl": """
SELECT vec_id AS pixel_id, label, ABS(embedding[0]) AS b02, ABS(embedding[1]) AS b03, ABS(embedding[2]) AS b04, ABS(embedding[3]) AS b08 FROM embeddings
""",
    "v_points": """
SELECT event_id AS pid, event_type AS species, CAST((event_id * 7919) % 6400 AS DOUBLE) / 100.0 AS x, CAST((event_id * 104729) % 6400 AS DOUBLE) / 100.0 AS y, value FROM events
""",
    "v_draw": """
SELECT event_id, CAST(conv(substr(md5(concat('7:', CAST(event_id AS STRING))), 1, 8), 16, 10) AS DOUBLE) / 4294967296 AS u FROM events
""",
    "v_scenes": """
SELECT event_id AS scene_id, CAST(ts AS DATE) AS acq_date, user_id AS tile_id, LEAST(value, 100.0) AS cloud_cover FROM events
""",
    "v_spectra": """
SELECT CAST(p_partkey % 20 AS BIGINT) AS material_id, 400 + 10 * CAST(floor(p_partkey / 20.0) % 60 AS DOUBLE) AS w, AVG(p_size) / 50 AS value FROM part GROUP BY 1, 2
""",
    "v_ways": """
SELECT c_custkey AS way_id, CASE c_mktsegment WHEN 'BUILDING' THEN 'residential' WHEN 'AUTOMOBILE' THEN 'motorway' WHEN 'MACHINERY' THEN 'track' WHEN 'HOUSEHOLD' THEN 'service' ELSE 'unknown_type' END AS highway, CASE CAST(c_custkey % 5 AS INT) WHEN 0 THEN '5.5' WHEN 1 THEN '5 m' WHEN 2 THEN 'wide' WHEN 3 THEN '' ELSE NULL END AS width, CASE CAST(c_custkey % 4 AS INT) WHEN 0 THEN '2' WHEN 1 THEN 'abc' ELSE NULL END AS lanes, CASE CAST(c_custkey % 6 AS INT) WHEN 0 THEN 'gravel' WHEN 1 THEN 'dirt' WHEN 2 THEN 'moonrock' ELSE NULL END AS surface, CASE WHEN c_custkey % 3 = 0 THEN 'yes' ELSE NULL END AS oneway, CAST((c_custkey * 613) % 6400 AS DOUBLE) / 100 AS x1, CAST((c_custkey * 977) % 6400 AS DOUBLE) / 100 AS y1, CAST((c_custkey * 613) % 6400 AS DOUBLE) / 100 + 8 AS x2, CAST((c_custkey * 977) % 6400 AS DOUBLE) / 100 + CAST(c_custkey % 7 AS DOUBLE) AS y2 FROM customer
""",
    "v_bends": """
SELECT way_id, CAST(seg AS BIGINT) AS seg, CASE seg WHEN 0 THEN x WHEN 1 THEN x + 5 ELSE x + 3 END AS x1, CASE seg WHEN 0 THEN y WHEN 1 THEN y + k ELSE y + k + 4 END AS y1, CASE seg WHEN 0 THEN x + 5 WHEN 1 THEN x + 3 ELSE x + 8 END AS x2, CASE seg WHEN 0 THEN y + k WHEN 1 THEN y + k + 4 ELSE y + k + 5 END AS y2 FROM (SELECT c_custkey AS way_id, CAST((c_custkey * 613) % 5600 AS DOUBLE) / 100 AS x, CAST((c_custkey * 977) % 5200 AS DOUBLE) / 100 AS y, CAST(c_custkey % 7 AS DOUBLE) / 2 AS k FROM customer) w CROSS JOIN (SELECT 0 AS seg UNION ALL SELECT 1 UNION ALL SELECT 2) s
""",
    "v_zones": """
SELECT s_suppkey AS zone_id, CAST((s_suppkey * 1301) % 6400 AS DOUBLE) / 100 AS cx, CAST((s_suppkey * 2477) % 6400 AS DOUBLE) / 100 AS cy, CAST(s_suppkey % 5 + 1 AS DOUBLE) / 4 AS radius FROM supplier
""",
    "v_buildings": """
SELECT p_partkey AS building_id, CAST((p_partkey * 739) % 6300 AS DOUBLE) / 100 AS x, CAST((p_partkey * 1511) % 6300 AS DOUBLE) / 100 AS y, CAST(p_size AS DOUBLE) * 10 AS area_m2, CASE CAST(p_partkey % 8 AS INT) WHEN 0 THEN 'HHT:21.0' WHEN 1 THEN 'H:4' WHEN 2 THEN 'HAPP:3' WHEN 3 THEN 'HBET:2-4' WHEN 4 THEN 'HHT:30+H:4' WHEN 5 THEN 'HHT:abc' WHEN 6 THEN '' ELSE NULL END AS height FROM part
""",
    "v_radiance": """
SELECT l_suppkey AS sensor_id, 400 + 10 * CAST(l_linenumber % 7 AS DOUBLE) AS w, CAST(l_orderkey % 8 AS BIGINT) AS x_index, CAST(l_partkey % 8 AS BIGINT) AS y_index, MAX(l_extendedprice) / 100000 AS radiance FROM lineitem GROUP BY 1, 2, 3, 4
""",
    "v_irradiance": """
SELECT s_suppkey AS irradiance_id, 390 + 20 * CAST(n_nationkey AS DOUBLE) AS w, ROUND(1 + CAST(n_nationkey AS DOUBLE) / 25 + ABS(s_acctbal) / 10000, 6) AS irradiance FROM supplier CROSS JOIN nation WHERE n_nationkey < 6
""",
}

#: Where DuckDB needs another text.
DUCKDB_VIEWS: dict[str, str] = {
    "v_refl": """
SELECT vec_id AS pixel_id, label, ABS(embedding[1]) AS b02, ABS(embedding[2]) AS b03, ABS(embedding[3]) AS b04, ABS(embedding[4]) AS b08 FROM embeddings
""",
    "v_draw": """
SELECT event_id, CAST(CAST('0x' || substr(md5('7:' || CAST(event_id AS VARCHAR)), 1, 8) AS UBIGINT) AS DOUBLE) / 4294967296 AS u FROM events
""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view over the tables of a folder; the tables it names are read from there."""
    text = VIEWS[name]
    frames = {t: table(spark, sf_dir, t) for t in TABLES if re.search(rf"\b{t}\b", text)}
    text = re.sub(r"\b(FROM|JOIN) (\w+)", r"\1 {\2}", text)
    return spark.sql(text, **frames)


def duckdb(*views: str, then: str) -> str:
    """DuckDB text with the named views in front of it."""
    heads = ", ".join(f"{v} AS ({DUCKDB_VIEWS.get(v, VIEWS[v]).strip()})" for v in views)
    rest = then.strip()
    if rest.startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {heads}, {rest[15:]}"
    if rest.upper().startswith("WITH "):
        return f"WITH {heads}, {rest[5:]}"
    return f"WITH {heads} {rest}"
