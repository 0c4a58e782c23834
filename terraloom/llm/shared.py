"""Helpers that the text operators share: saved tables, word hashes, connected components."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Word caches of a task are emptied beyond so many entries; the results do not depend on it.
CACHE_WORDS = 400_000
OWN_DIR, WORKSPACE = "terraloom.shared", "terraloom.workspace"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (spark.checkpoint.dir); one of our own only where none is set, as in tests."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(OWN_DIR, None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set(OWN_DIR, path)
    return path.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder, or in the workspace that is open, that no other run uses."""
    return f"{spark.conf.get(WORKSPACE, None) or shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str = "table", at: str | None = None) -> DataFrame:
    """``df`` written to the shared folder (or to the path ``at``) and read again: cuts the lineage and survives lost executors.

    The shuffle files of the write go as soon as it has ended, by Spark's own setting: nothing reads them again.
    """
    spark = df.sparkSession
    path = at or fresh_path(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def drop(*tables: DataFrame) -> None:
    """Deletes saved tables that nothing reads any more: those of ``saved`` alone, in the shared folder."""
    for table in tables:
        spark = table.sparkSession
        roots = [f"{x.removeprefix('file://')}/" for x in (shared_dir(spark), spark.conf.get(WORKSPACE, None)) if x]
        for folder in {name.rpartition("/")[0] for name in table.inputFiles()}:
            if any(root in folder for root in roots) and re.search(r"/[a-z-]+-[0-9a-f]{32}$", folder):
                remove(spark, folder)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a path of any file system that Spark knows."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def workspace(spark: SparkSession) -> Iterator[None]:
    """What is saved within goes to a folder of its own, which is deleted at the end."""
    before = spark.conf.get(WORKSPACE, None)
    path = fresh_path(spark, "workspace")
    spark.conf.set(WORKSPACE, path)
    try:
        yield
    finally:
        spark.conf.unset(WORKSPACE) if before is None else spark.conf.set(WORKSPACE, before)
        remove(spark, path)


def ranked(rows: DataFrame, by: str, order: list[str]) -> DataFrame:
    """``rows`` with ``line`` (a number that ascends by ``by``, then ``order``), ``rank`` (place within its value of ``by``) and ``total`` (rows of the value).

    Rows are sorted over ranges of (by, order), nulls first, so a value of any number of rows spreads over tasks; what stands before a range comes
    from one row a range and value. ``by`` has no nulls.
    """
    keys = [F.col(c).asc_nulls_first() for c in [by, *order]]
    line = saved(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("line", F.monotonically_increasing_id()), "line")
    part = F.shiftright("line", 33)
    sizes = line.groupBy(by, part.alias("part")).agg(F.min("line").alias("first"), F.count("*").alias("n"))
    whole = Window.partitionBy(by)
    before = F.coalesce(F.sum("n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    sizes = sizes.select(by, "part", "first", before.alias("before"), F.sum("n").over(whole).alias("total"))
    out = line.withColumn("part", part).join(sizes, [by, "part"])
    numbered = saved(out.select(*rows.columns, "line", (F.col("before") + F.col("line") - F.col("first")).alias("rank"), "total"), "ranked")
    drop(line)
    return numbered


def texts_by_id(docs: DataFrame, id_: Column, text: Column) -> DataFrame | None:
    """The different texts (id, print, line, rank) of each id that repeats; None if none does.

    ``print`` is ``text_print`` of the text, ``rank`` numbers the texts of an id from 0, ``line`` ascends over all of them.
    """
    seen = docs.select(id_.alias("id"), text_print(text).alias("print"))
    ids = saved(seen.groupBy("id").count().where("count > 1").select("id"), "ids")
    if ids.isEmpty():
        drop(ids)
        return None
    return ranked(seen.join(ids, "id", "left_semi").distinct(), "id", ["print"])


def row_keys(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each pair of id (a whole number or null) and text, with a whole number of its own in the column ``key``.

    Where no id repeats and none is null that is the id. The others get numbers below all ids (above, where there is no room below): those of null ids and of
    ids that repeat. Of rows with equal id and text one stays. Only those ids are joined and shuffled.
    """
    id_, text = F.col(id_col).cast("long"), F.col(text_col)
    known = F.coalesce(id_, F.lit((1 << 63) - 1))
    texts = texts_by_id(docs, known, text)
    if texts is None and docs.where(id_.isNull()).isEmpty():
        return docs.withColumn(key, id_)
    low, high = docs.agg(F.min(id_), F.max(id_)).first()
    low, high = low or 0, high or 0
    span = (texts.agg(F.max("line")).first()[0] if texts is not None else 0) + 2
    first = low - span if low > -(1 << 63) + span else high + 1
    if first + span >= 1 << 63:
        raise ValueError("ids leave no room for the keys of those that repeat")
    if texts is None:  # a single row without an id
        return docs.withColumn(key, F.coalesce(id_, F.lit(first).cast("long")))
    again = texts.select("id").distinct()
    rows = docs.withColumns({key: known, f"{key}_print": text_print(text)})
    same = F.col(key) == F.col("id")
    plain = rows.join(again, same, "left_anti").withColumn(key, F.coalesce(id_, F.lit(first).cast("long"))).drop(f"{key}_print")
    once = rows.join(again, same, "left_semi").dropDuplicates([key, f"{key}_print"])
    odd = once.join(texts.select("id", "print", "line"), same & (F.col(f"{key}_print") == F.col("print")))
    return plain.unionByName(odd.withColumn(key, F.col("line") + F.lit(first + 1).cast("long")).select(*plain.columns))


def text_print(text: Column) -> Column:
    """A 64-bit hash of a text; that of an empty one for null."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


class WordHashes(dict):
    """64-bit hash by word (bytes), filled as words come."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > CACHE_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: a bijection that spreads every input bit (wraps on purpose)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive word hashes; fewer words make one run, none none."""
    n = len(hashes)
    if n == 0:
        return hashes
    size = min(n, k)
    out = np.full(n - size + 1, size, np.uint64)
    for i in range(size):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : n - size + 1 + i])
    return out


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an edge table: rows ``(node, component)``, component the smallest node id.

    Alternating large-star and small-star rounds (Kiveris et al. 2014): a number of rounds logarithmic in the size
    of a component, each two aggregates and joins over the edges. Only a row count and a checksum reach the driver.
    """

    def lowest(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.min("v").alias("m"))

    e = edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).where("u != v").distinct()
    e, last = saved(e, "edges"), None
    while True:
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first()
        if state == last:
            break
        last = state
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = lowest(both).withColumn("m", F.least("u", "m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        small = large.join(lowest(large), "u")
        small = small.select(F.inline(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))))
        before, e = e, saved(small.where("u != v").distinct(), "edges")
        drop(before)
    roots = e.groupBy(F.col("v").alias("node")).agg(F.min("v").alias("component"))
    return e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(roots)
