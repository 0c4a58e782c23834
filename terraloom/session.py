"""Session settings and the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int = 8, partitions: int | None = None) -> SparkSession:
    """A local session for tests and benchmarks."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("terraloom")
        .config("spark.sql.shuffle.partitions", str(partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_path(spark: SparkSession, name: str) -> str:
    """A path that no other run uses, in the folder of spark.checkpoint.dir; a folder of our own only where none is set."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("terraloom.shared", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("terraloom.shared", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: ends its lineage, and lost executors lose nothing."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Deletes tables of ``cut`` that nothing reads any more; others stay."""
    for table in tables:
        spark = table.sparkSession
        for folder in {name.rpartition("/")[0] for name in table.inputFiles()}:
            if re.search(r"/[a-z-]+-[0-9a-f]{32}$", folder):
                at = spark._jvm.org.apache.hadoop.fs.Path(folder)
                at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
