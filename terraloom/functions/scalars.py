"""Text, name, date and lookup functions over columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.functions.keyed import draw

# Highway type, lanes, lane width in metres, material.
ROAD_TYPES = [
    ("motorway", 3, 3.5, "asphalt"),
    ("motorway_link", 3, 3.5, "asphalt"),
    ("trunk", 2, 3.5, "asphalt"),
    ("primary", 2, 3.2, "asphalt"),
    ("primary_link", 1, 3.2, "asphalt"),
    ("secondary", 2, 3.1, "asphalt"),
    ("secondary_link", 1, 3.1, "asphalt"),
    ("tertiary", 2, 3.1, "asphalt"),
    ("tertiary_link", 1, 3.1, "asphalt"),
    ("residential", 2, 3.0, "asphalt"),
    ("unclassified", 2, 3.0, "asphalt"),
    ("living_street", 1, 3.0, "asphalt"),
    ("service", 1, 2.5, "asphalt"),
    ("pedestrian", 1, 2.0, "concrete"),
    ("track", 1, 2.5, "gravel_road"),
    ("footway", 1, 1.5, "gravel_road"),
    ("cycleway", 1, 1.5, "asphalt"),
    ("path", 1, 1.5, "gravel_road"),
    ("bridleway", 1, 2.0, "gravel_road"),
    ("busway", 2, 3.25, "asphalt"),
]

# Material of each surface tag.
SURFACES = [
    ("asphalt", "asphalt"),
    ("paved", "asphalt"),
    ("chipseal", "asphalt"),
    ("concrete", "concrete"),
    ("concrete:plates", "concrete"),
    ("cement", "concrete"),
    ("sett", "concrete"),
    ("cobblestone", "concrete"),
    ("unhewn_cobblestone", "concrete"),
    ("paving_stones", "concrete"),
    ("gravel", "gravel_road"),
    ("fine_gravel", "gravel_road"),
    ("compacted", "gravel_road"),
    ("pebblestone", "gravel_road"),
    ("dirt", "baresoil"),
    ("earth", "baresoil"),
    ("ground", "baresoil"),
    ("mud", "baresoil"),
    ("sand", "baresoil"),
    ("unpaved", "baresoil"),
    ("grass", "grassland"),
    ("grass_paver", "grassland"),
]

# Land-cover class, red, green, blue; a class's material index is its place.
LAND_COVER = [
    (10, 40, 75, 30),
    (20, 185, 170, 130),
    (30, 140, 155, 95),
    (40, 240, 150, 255),
    (50, 150, 150, 150),
    (60, 220, 140, 90),
    (70, 240, 240, 240),
    (80, 0, 100, 200),
    (90, 80, 120, 90),
    (95, 0, 207, 117),
    (100, 250, 230, 160),
]
WATER_INDEX = 7
GREY = 128


def parse_height(value: Column, story: float = 3.0, default: float = 3.0) -> tuple[Column, Column]:
    """Metres and whether the value told them. A number above 0 is metres; of a text HHT metres, else H or HAPP stories, else
    the middle of HBET's range of stories. Numbers in a text column are texts: they tell nothing."""
    metres = value.try_cast("double")
    number = F.when(F.typeof(value).isin("string", "boolean"), None).when((metres > 0) & (metres < float("inf")), metres)  # NaN is above all numbers
    parts = F.split(value.cast("string"), r"\+")

    def first(prefix: str) -> Column:
        numbers = F.transform(parts, lambda p: F.when(p.startswith(prefix), F.split(p, ":")[1].try_cast("double")))
        return F.get(F.filter(numbers, lambda x: x.isNotNull()), F.lit(0))

    def middle(p: Column) -> Column:
        ends = F.split(F.split(p, ":")[1], "-")
        return F.when(p.startswith("HBET:") & (F.size(ends) == 2), (F.get(ends, F.lit(0)).try_cast("double") + F.get(ends, F.lit(1)).try_cast("double")) / 2.0)

    between = F.get(F.filter(F.transform(parts, middle), lambda x: x.isNotNull()), F.lit(0))
    found = F.coalesce(number, first("HHT:"), first("H:") * story, first("HAPP:") * story, between * story)
    return F.coalesce(found, F.lit(default)), found.isNotNull()


def parse_width(text: Column) -> Column:
    """Metres of '5.5', '5 m' or '5.5m'; else null."""
    return F.regexp_replace(F.lower(F.trim(text)), r"\s*m$", "").try_cast("double")


def road_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ROAD_TYPES, "highway string, type_lanes int, type_lane_width double, type_material string")


def road_attributes(ways: DataFrame, overrides: DataFrame | None = None, lane_width: float = 3.0, shoulder: float = 0.5, material: str = "asphalt") -> DataFrame:
    """Ways with ``width_m`` and ``material``.

    Width: an override's total, the width tag, or lanes times lane width and two shoulders; lanes by tag, override, type, else 1 on
    one-way roads and 2 otherwise. Material: a surface tag decides alone (an unknown one gives the default); else override, type, default.
    overrides: (highway, total_width_m, lane_count, lane_width_m, default_material), any null.
    """
    spark = ways.sparkSession
    kinds = road_types(spark)
    surfaces = spark.createDataFrame(SURFACES, "surface string, surface_material string")
    if overrides is None:
        overrides = spark.createDataFrame([], "highway string, total_width_m double, lane_count int, lane_width_m double, default_material string")
    # the type and surface tables hold some twenty rows each; overrides a row a type
    joined = ways.join(F.broadcast(kinds), "highway", "left").join(F.broadcast(overrides), "highway", "left").join(F.broadcast(surfaces), "surface", "left")
    lanes = F.coalesce(
        F.col("lanes").try_cast("int"),
        F.nullif(F.col("lane_count"), F.lit(0)),
        F.nullif(F.col("type_lanes"), F.lit(0)),
        F.when(F.col("oneway") == "yes", 1).otherwise(2),
    )
    each = F.coalesce(F.nullif(F.col("lane_width_m"), F.lit(0.0)), F.col("type_lane_width"), F.lit(lane_width))
    width = F.coalesce("total_width_m", F.when(F.col("width") != "", parse_width(F.col("width"))), lanes * each + 2 * shoulder)
    tagged = F.col("surface").isNotNull() & (F.col("surface") != "")
    stuff = F.when(tagged, F.coalesce("surface_material", F.lit(material))).otherwise(F.coalesce("default_material", "type_material", F.lit(material)))
    return joined.select(*ways.columns, width.alias("width_m"), stuff.alias("material"))


def safe_name(name: Column) -> Column:
    return F.regexp_replace(name, "[^A-Za-z0-9_.-]+", "_")


def clean_id(name: Column) -> Column:
    return F.translate(name, ".-", "__")


def date_window(anchor: Column, days: int) -> Column:
    return F.struct(F.date_sub(anchor, days).alias("first"), F.date_add(anchor, days).alias("last"))


def band_suffix(band: Column) -> Column:
    return F.concat(F.lit("B"), F.lpad(band.cast("string"), 2, "0"))


def instance_id(collection: Column, i: Column) -> Column:
    return F.concat_ws("_", F.lit("vegetation_instance"), collection, i.cast("string"))


def result_name(*parts: Column) -> Column:
    return F.concat_ws("_", *parts)


def weighted_choice(weights: dict[str, float], seed: int | str, *key: Column | str) -> Column:
    """A name by normalised weights and one keyed draw."""
    total, at, bounds = sum(weights.values()), 0.0, []
    for name, w in weights.items():
        at += w / total
        bounds.append((name, at))
    u = draw(seed, *key)
    out = F.lit(bounds[-1][0])
    for name, bound in reversed(bounds[:-1]):
        out = F.when(u < bound, name).otherwise(out)
    return out


def material_index(cover: Column) -> Column:
    """Place of a land-cover class; null and unknown ones count as water."""
    table = F.create_map(*(F.lit(x) for i, row in enumerate(LAND_COVER) for x in (row[0], i)))
    return F.coalesce(F.try_element_at(table, cover.cast("int")), F.lit(WATER_INDEX))


def preview_colour(cover: Column) -> Column:
    """Red, green and blue of a class, grey where unknown."""
    rgb = F.lit(None).cast("array<int>")
    for code, *colour in LAND_COVER:
        rgb = F.when(cover == code, F.array(*map(F.lit, colour))).otherwise(rgb)
    return F.coalesce(rgb, F.array(F.lit(GREY), F.lit(GREY), F.lit(GREY)))
