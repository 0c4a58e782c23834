"""Mixing sources to target weights (operator 6), on DataFrame functions only."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraloom.llm.shared import saved

BROADCAST_SOURCES = 100_000  # rows of (source, sizes), some 10 MB
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """Targets of sources ``(source, source_size)``: ``share`` times all sizes dealt by weight, none above ``most`` times its size.

    Weights repeat along the sources in code-point order, null last. What goes beyond a source's limit is dealt again to
    the others by weight until none is above: the level L at which the sum of min(limit, L * weight) is the total, found by
    running sums over the sources in the order in which they fill. A row a source: both windows see nothing larger.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    n = F.row_number().over(by_name) - 1
    placed = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, map(float, weights))), (n % len(weights) + 1).cast("int")))
    limited = placed.withColumn("limit", F.col("source_size") * most).withColumn("fill", F.col("limit") / F.col("weight"))
    by_fill = Window.orderBy("fill", F.col("source").asc_nulls_last())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    after = by_fill.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = (F.sum("source_size").over(whole) * share - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    leveled = limited.withColumn("level", level)
    # the first source that its level does not fill, and all after it, share what is left
    cut = F.min(F.when(F.col("level") <= F.col("fill"), F.struct("fill", F.col("level").alias("at")))).over(whole)["at"]
    return leveled.select("source", "source_size", F.least(F.col("limit"), F.coalesce(cut * F.col("weight"), F.col("limit"))).alias("target"))


def mixed(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 0) -> DataFrame:
    """The input rows with ``size``, ``source_size``, ``target``, ``rate`` and ``copies`` beside them.

    A document is taken floor(rate) times, rate = target / source size, and once more with probability of the fraction: a
    draw hashed from seed and id, so that reruns agree. Null texts have size 0; a null source is one source; sources of
    size 0 have rate 0. Repeated rows draw alike. Columns of the same names as the new ones are replaced.
    """
    sized = docs.withColumn("size", word_count(F.col("text").cast("string")))
    per = sized.groupBy(F.col("source").cast("string").alias("source")).agg(F.sum("size").alias("source_size"))
    name = f"source_{uuid.uuid4().hex}"  # that no column of the input has
    targets = saved(source_targets(per, weights, share, most).withColumnRenamed("source", name), "targets")
    if targets.count() <= BROADCAST_SOURCES:  # a checked size; more sources are joined by shuffle
        targets = F.broadcast(targets)
    base = sized.drop("source_size", "target", "rate", "copies")
    joined = base.join(targets, base["source"].cast("string").eqNullSafe(F.col(name))).drop(name)
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    draw = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / float(1 << 32)
    rate = F.least(F.lit(float(most)), F.coalesce(F.try_divide("target", F.col("source_size").cast("double")), F.lit(0.0)))
    rated = joined.withColumn("rate", rate)
    return rated.withColumn("copies", (F.floor("rate") + (draw < F.col("rate") - F.floor("rate")).cast("long")).cast("int"))


def emitted(mix: DataFrame, columns: list[str]) -> DataFrame:
    """Each document of a mix as many times as it is taken."""
    turn = f"copy_{uuid.uuid4().hex}"  # that no column of the input has
    return mix.where("copies > 0").withColumn(turn, F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*columns)
