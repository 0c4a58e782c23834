"""Readers and writers of grids, tiles, spectra, ways, instances and results; all over Spark's own formats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

INSTANCES = "x double, y double, z double, rotation float, scale float, tilt_x float, tilt_y float, species string, asset string"
VERSION = 1


def there(spark: SparkSession, path: str) -> bool:
    """Whether a path (or a pattern) of any file system that Spark knows has files."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    return found is not None and len(found) > 0


def tile_index(spark: SparkSession, path: str, path_column: str | None = None) -> DataFrame:
    """(tile_id, footprint columns, rel_path): the path column is the first whose name holds ``path``, unless given."""
    index = spark.read.parquet(path)
    column = path_column or next((c for c in index.columns if "path" in c.lower()), None)
    if column is None:
        raise ValueError("no column of the tile index holds a path")
    return index.withColumnRenamed(column, "rel_path")


def tile_scan(spark: SparkSession, path: str, tiles: DataFrame | None = None, kind: str = "double", box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Pixels (tile_id, lon, lat, value) of a table partitioned by tile; with ``tiles``, of those alone, pruned at run time; with ``box`` (west, south,
    east, north) those within it, by comparisons that reach the scan and skip row groups."""
    pixels = spark.read.parquet(path)
    if box is not None:
        pixels = pixels.where(F.col("lon").between(box[0], box[2]) & F.col("lat").between(box[1], box[3]))
    pixels = pixels.withColumn("value", F.col("value").cast(kind))
    return pixels if tiles is None else pixels.join(tiles.select("tile_id").distinct(), "tile_id", "left_semi")


def grid_scan(spark: SparkSession, path: str, variable: str = "value") -> DataFrame:
    return spark.read.parquet(path).select("iy", "ix", F.col(variable).alias("value"))


def grid_area(spark: SparkSession, path: str, box: tuple[int, int, int, int], chunk: int = 512) -> DataFrame:
    """The cells of a grid of ``write_grid`` with ix, iy within a closed box (ix0, iy0, ix1, iy1); only folders of chunks that meet it are read."""
    part = lambda i: F.split("chunk", "_")[i].cast("int")
    near = part(0).between(box[1] // chunk, box[3] // chunk) & part(1).between(box[0] // chunk, box[2] // chunk)
    return spark.read.parquet(path).where(near & F.col("ix").between(box[0], box[2]) & F.col("iy").between(box[1], box[3])).drop("chunk")


def spectra_scan(spark: SparkSession, path: str, variable: str = "value") -> DataFrame:
    """(material_id, w, value) from parquet, or from csv with a header."""
    raw = spark.read.csv(path, header=True, inferSchema=True) if path.endswith(".csv") else spark.read.parquet(path)
    return raw.select("material_id", "w", F.col(variable).alias("value"))


def material_library_scan(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Materials (material_id, type, params) and the ordered land-cover mapping (pos, class, material) of a JSON configuration."""
    text = spark.read.text(path, wholetext=True)
    config = text.select(F.from_json("value", "materials map<string, map<string, string>>, landcover_mapping map<string, string>").alias("c"))
    materials = config.select(F.explode("c.materials").alias("material_id", "params")).select("material_id", F.try_element_at("params", F.lit("type")).alias("type"), F.map_filter("params", lambda k, v: k != "type").alias("params"))
    mapping = config.select(F.posexplode(F.map_entries("c.landcover_mapping")).alias("pos", "e")).select("pos", F.col("e.key").alias("class"), F.col("e.value").alias("material"))
    return materials, mapping


def ways_scan(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """(way_id, tags, geometry) of a road dump's ``elements``; what is malformed gives no rows.

    A dump is one JSON object and is parsed by one task a file; with ``lines`` each line is an element, and Spark splits the files. A missing path gives none.
    """
    if not there(spark, path):
        return spark.createDataFrame([], "way_id bigint, tags map<string,string>, geometry array<struct<lat:double,lon:double>>")
    element = "type string, id bigint, tags map<string,string>, geometry array<struct<lat:double,lon:double>>"
    if lines:
        e = spark.read.schema(element).json(path, mode="PERMISSIVE")
    else:
        schema = "elements array<struct<type:string, id:bigint, tags:map<string,string>, geometry:array<struct<lat:double,lon:double>>>>"
        e = spark.read.schema(schema).json(path, multiLine=True, mode="PERMISSIVE").select(F.explode("elements").alias("e")).select("e.*")
    return e.where("type = 'way'").select(F.col("id").alias("way_id"), "tags", "geometry")


def footprints_scan(spark: SparkSession, paths: list[str], box: tuple[float, float, float, float], epsg: int = 4326) -> DataFrame:
    """Footprints of all files whose bounds meet the box; the comparison reaches the scan. Missing files are left out; none at all gives no rows.

    The box is in degrees, so footprints of a projected system (EPSG codes outside those of the geographic ones) are an error.
    """
    if not 4000 < epsg < 5000:
        raise ValueError(f"footprints must be in degrees, not in EPSG:{epsg}")
    paths = [p for p in paths if there(spark, p)]
    if not paths:
        return spark.createDataFrame([], "building_id bigint, xmin double, ymin double, xmax double, ymax double")
    return spark.read.parquet(*paths).where((F.col("xmin") <= box[2]) & (F.col("xmax") >= box[0]) & (F.col("ymin") <= box[3]) & (F.col("ymax") >= box[1]))


def reference_series_scan(spark: SparkSession, path: str) -> DataFrame:
    """Series with their angles turned to scene angles and their unix time as a UTC timestamp."""
    from terraloom.functions.projection import angle_convention

    zenith, azimuth = angle_convention(F.col("viewing_zenith"), F.col("viewing_azimuth"))
    return spark.read.parquet(path).select("series", zenith.alias("zenith"), azimuth.alias("azimuth"), F.timestamp_seconds("acquisition_time").alias("time"))


def write_grid(grid: DataFrame, path: str, chunk: int = 512) -> None:
    """Overwrites a grid, partitioned by chunks of rows and columns and sorted within, so that scans of an area skip the rest."""
    keyed = grid.withColumn("chunk", F.concat_ws("_", F.floor(F.col("iy") / chunk), F.floor(F.col("ix") / chunk)))
    keyed.repartition("chunk").sortWithinPartitions("chunk", "iy", "ix").write.mode("overwrite").partitionBy("chunk").parquet(path)


def write_instances(df: DataFrame, path: str) -> None:
    """Plant instances by species and asset; an empty table writes no data files."""
    kinds = [p.strip().rsplit(" ", 1) for p in INSTANCES.split(",")]
    df.select(*(F.col(n).cast(t) for n, t in kinds)).write.mode("overwrite").partitionBy("species", "asset").parquet(path)


def read_instances(spark: SparkSession, path: str) -> DataFrame:
    """Instances again; a missing path has none."""
    if not there(spark, path):
        return spark.createDataFrame([], INSTANCES)
    return spark.read.schema(INSTANCES).parquet(path)


def instances_metadata(instances: DataFrame) -> DataFrame:
    """One row of count and bounds; count 0 and null bounds where there are none."""
    return instances.agg(F.count("*").alias("count"), *(f(c).alias(f"{n}_{c}") for n, f in (("min", F.min), ("max", F.max)) for c in ("x", "y", "z")))


def write_roads(segments: DataFrame, path: str) -> None:
    """A JSON line a segment under a version, in folders by material (``layer``): no row or task grows with a material."""
    columns = ["road_id", "seg", "x1", "y1", "x2", "y2", "width", "material"]
    segments.select(*columns, F.lit(VERSION).alias("version"), F.col("material").alias("layer")).write.mode("overwrite").partitionBy("layer").json(path)


def read_roads(spark: SparkSession, path: str) -> DataFrame:
    """Segments again; another version or a missing path gives no rows. Files of a JSON line a material with its nested segments are read as well."""
    one = "road_id bigint, seg int, x1 double, y1 double, x2 double, y2 double, width double"
    if not there(spark, path):
        return spark.createDataFrame([], f"{one}, material string")
    nested = f"segments array<struct<{one.replace(' ', ':').replace(',:', ', ')}>>"
    rows = spark.read.schema(f"material string, version int, {one}, {nested}").json(path).where(F.col("version") == VERSION)
    own = F.array(F.struct("road_id", "seg", "x1", "y1", "x2", "y2", "width"))
    return rows.select("material", F.explode(F.coalesce("segments", own)).alias("s")).select("s.*", "material")


def write_matches(matches: DataFrame, path: str) -> None:
    """One record of cluster materials, indices and source classes, under a version."""
    one = matches.groupBy().agg(
        F.map_from_entries(F.collect_list(F.struct("cluster", "material"))).alias("materials"),
        F.map_from_entries(F.collect_list(F.struct("cluster", "idx"))).alias("indices"),
        F.sort_array(F.collect_set("class")).alias("classes"),
    )
    one.withColumn("version", F.lit(VERSION)).write.mode("overwrite").json(path)


def read_matches(spark: SparkSession, path: str) -> DataFrame:
    schema = "materials map<string,string>, indices map<string,bigint>, classes array<bigint>, version int"
    m = spark.read.schema(schema).json(path).where(F.col("version") == VERSION)
    return m.select(F.explode("materials").alias("cluster", "material"), "indices").select("cluster", "material", F.try_element_at("indices", F.col("cluster")).alias("idx"))


def write_result(df: DataFrame, path: str, result_id: str, kind: str, meta: dict[str, str], sensors: DataFrame | None = None, measurements: DataFrame | None = None) -> None:
    """A result with its id and type in every row, and its metadata (result_id, key, value) as a table beside it.

    Metadata are the given ones, ``created_at`` where they lack it and, of tables with a column ``type``, the number of sensors and
    measurements and their types, a row each.
    """
    spark = df.sparkSession
    df.withColumns({"result_id": F.lit(result_id), "result_type": F.lit(kind)}).write.mode("overwrite").partitionBy("result_type").parquet(f"{path}/data")
    rows = spark.createDataFrame([(k, str(v)) for k, v in meta.items()], "key string, value string")
    if "created_at" not in meta:
        rows = rows.unionByName(spark.range(1).select(F.lit("created_at").alias("key"), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("value")))
    for name, one in (("sensor", sensors), ("measurement", measurements)):
        if one is not None:
            rows = rows.unionByName(one.agg(F.count("*").cast("string").alias("value")).select(F.lit(f"num_{name}s").alias("key"), "value"))
            rows = rows.unionByName(one.select(F.lit(f"{name}_types").alias("key"), F.col("type").cast("string").alias("value")))
    rows.select(F.lit(result_id).alias("result_id"), "key", "value").write.mode("overwrite").parquet(f"{path}/meta")
