"""Merkle manifest of a dataset with a witness for every row (operator 12)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraloom.llm.shared import drop, ranked, saved

FAN = 16  # children of a node
BLOCK = 2  # levels that one task builds at once: FAN ** BLOCK leaves
_WITNESS = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
_NODE = "tree string, rank long, total long, digest string"


def leaf_digest(*columns: Column) -> Column:
    """Hex SHA-256 of the columns in turn, each ``-`` if null, else its UTF-8 byte count, a colon and the value as text."""
    parts = [F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string"))) for c in columns]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def siblings(witness: Column) -> Column:
    """All sibling digests of a witness, level by level, left to right, as one text."""
    return F.array_join(F.transform(witness, lambda w: F.concat(w["before"], w["after"])), "")


def folded(leaf: Column, witness: Column) -> Column:
    """The root that a leaf digest leads to with the siblings of a witness."""
    return F.aggregate(witness, leaf, lambda x, w: F.sha2(F.concat(w["before"], x, w["after"]).cast("binary"), 256))


class Appender:
    """A tree of so many levels that grows by aligned appends.

    A subtree is open until it has FAN children or the append ends. When it closes, the partial witness of every leaf below it is
    extended by the siblings at that level, and its digest is appended one level up.
    """

    def __init__(self, levels: int):
        self.levels, self.root = levels, ""
        self.open: list[list[tuple[str, int, int]]] = [[] for _ in range(levels)]
        self.witnesses: list[list[tuple[str, str]]] = []

    def append(self, digest: str) -> None:
        self.witnesses.append([])
        self._push(0, digest, len(self.witnesses) - 1, len(self.witnesses))

    def _push(self, level: int, digest: str, first: int, end: int) -> None:
        if level == self.levels:
            self.root = digest
            return
        self.open[level].append((digest, first, end))
        if len(self.open[level]) == FAN:
            self._close(level)

    def _close(self, level: int) -> None:
        row, self.open[level] = self.open[level], []
        joined = "".join(digest for digest, _, _ in row)
        for i, (_, first, end) in enumerate(row):
            step = joined[: 64 * i], joined[64 * (i + 1) :]
            for witness in self.witnesses[first:end]:
                witness.append(step)
        self._push(level + 1, hashlib.sha256(joined.encode()).hexdigest(), row[0][1], row[-1][2])

    def finish(self) -> str:
        for level in range(self.levels):
            if self.open[level]:
                self._close(level)
        return self.root


def _levels(total: int) -> int:
    """Levels that a block adds: those up to the root of a tree that it holds whole, else all."""
    size, levels = 1, 0
    while size < total and levels < BLOCK:
        size, levels = size * FAN, levels + 1
    return levels


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, pa.Table]]:
    """Runs of rows of one (tree, block) from sorted batches: tree, block, total and the rows. A run never exceeds a block and its head."""
    waiting: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        trees, blocks = batch.column("tree").to_pylist(), batch.column("block").to_pylist()
        at = 0
        while at < len(batch):
            key, end = (trees[at], blocks[at]), at + 1
            while end < len(batch) and (trees[end], blocks[end]) == key:
                end += 1
            if now is not None and key != now:
                yield *now, pa.Table.from_batches(waiting)
                waiting = []
            now = key
            waiting.append(batch.slice(at, end - at))
            at = end
    if now is not None:
        yield *now, pa.Table.from_batches(waiting)


def _dealt(nodes: DataFrame) -> DataFrame:
    """Whole blocks of consecutive nodes, in order."""
    return nodes.repartition("tree", "block").sortWithinPartitions("tree", "block", "rank")


def _roots(nodes: DataFrame) -> DataFrame:
    """The root of each block, as a node of the next round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tree, block, rows in _blocks(batches):
            total = rows.column("total")[0].as_py()
            tip = Appender(_levels(total))
            for digest in rows.column("digest").to_pylist():
                tip.append(digest)
            yield pa.record_batch([pa.array([tree]), pa.array([block]), pa.array([-(-total // FAN**BLOCK)]), pa.array([tip.finish()])], ["tree", "rank", "total", "digest"])

    return _dealt(nodes.select("tree", "rank", "total", "digest", _block())).mapInArrow(run, _NODE)


def _block() -> Column:
    return F.floor(F.col("rank") / F.lit(FAN**BLOCK)).alias("block")


def _witnessed(nodes: DataFrame, above: DataFrame | None) -> DataFrame:
    """Nodes with ``root`` and ``witness``: what their block gives, then what ``above`` has for the block's root.

    ``above`` reaches a block as one row before its nodes, so a long witness is shuffled once a block.
    """
    rows = nodes.withColumns({"block": _block(), "root": F.lit(None).cast("string"), "witness": F.lit(None).cast("array<struct<before:string,after:string>>")})
    if above is not None:
        head = {c: F.lit(None).cast(nodes.schema[c].dataType) for c in nodes.columns if c not in ("tree", "rank")}
        heads = above.select("tree", F.lit(-1).cast("long").alias("rank"), *(v.alias(c) for c, v in head.items()), F.col("rank").alias("block"), "root", "witness")
        rows = rows.unionByName(heads)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, table in _blocks(batches):
            root, upper = None, []
            if table.column("rank")[0].as_py() == -1:
                root, upper = table.column("root")[0].as_py(), [(w["before"], w["after"]) for w in table.column("witness")[0].as_py()]
                table = table.slice(1)
            tip = Appender(_levels(table.column("total")[0].as_py()))
            for digest in table.column("digest").to_pylist():
                tip.append(digest)
            own_root = tip.finish()
            steps = [step for w in tip.witnesses for step in (*w, *upper)]
            ends = [0]
            for w in tip.witnesses:
                ends.append(ends[-1] + len(w) + len(upper))
            pairs = pa.StructArray.from_arrays([pa.array([b for b, _ in steps], pa.string()), pa.array([a for _, a in steps], pa.string())], ["before", "after"])
            out = table.drop_columns(["block", "root", "witness"])
            out = out.append_column("root", pa.array([root or own_root] * len(out), pa.string())).append_column("witness", pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs).cast(_WITNESS))
            yield from out.combine_chunks().to_batches()

    kept = [f for f in rows.schema if f.name != "block"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*(f for f in kept if f.name not in ("root", "witness")), rows.schema["root"], rows.schema["witness"]])
    return _dealt(rows).mapInArrow(run, schema)


def _grown(nodes: DataFrame) -> list[DataFrame]:
    """Rounds of appends: the roots of all blocks, the roots of blocks of these, and so on, until each tree is one node."""
    rounds = [nodes]
    while (rounds[-1].agg(F.max("total")).first()[0] or 0) > 1:
        rounds.append(saved(_roots(rounds[-1]), "roots"))
    return rounds


def merkle_manifest(rows: DataFrame, leaf: str, tree: str, order: str) -> DataFrame:
    """``rows`` with ``subroot``, ``root`` and ``witness`` beside the hex digest in column ``leaf``.

    The leaves of each value of ``tree``, ascending by ``order`` (null first, ties by digest), make a tree in which every FAN consecutive nodes
    (the last run: fewer, even one) have the SHA-256 of their joined hex digests as parent, until one is left: the subroot. The subroots,
    by ``tree`` (null first, else UTF-8 bytewise), make ``root`` likewise. ``witness`` lists, level by level from the leaf to the root,
    the digests ``before`` and ``after`` the node: ``folded`` leads from the leaf to the root by it, ``siblings`` joins it.

    Trees grow by aligned appends of blocks of FAN ** BLOCK nodes; block roots are appended to the next round in the same way, so no task sees more
    than a block. Repeated rows and ids are leaves of their own; a lone leaf is its subroot, a lone subroot the root, with an empty
    witness. Other columns pass through, those of the new names are replaced; an empty table gives no rows.
    """
    other = rows.drop("subroot", "root", "witness")
    packed = other.select(
        F.coalesce(F.concat(F.lit("="), F.col(tree).cast("string")), F.lit("-")).alias("tree"),  # sorts as null first, else bytewise
        F.col(order).alias("place"),
        F.col(leaf).alias("digest"),
        F.struct(*(F.col(c) for c in other.columns)).alias("row"),
    )
    first = saved(packed, "leaves")
    leaves = ranked(first, "tree", ["place", "digest"]).drop("place", "line")
    drop(first)
    rounds = _grown(leaves)
    tips = rounds[-1].select("tree", "digest")
    if len(rounds) == 1:  # every tree is a lone leaf
        tips = leaves.select("tree", "digest")
    crowns = _grown(ranked(tips.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), "tree", ["name"]).drop("line"))
    top = None
    for nodes in reversed(crowns):
        top = saved(_witnessed(nodes, top), "crown")
    above = top.select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("rank"), "root", "witness", F.col("digest").alias("subroot"))
    for nodes in reversed(rounds[1:-1]):  # those of the last round are the tips themselves: their witness is the crown's
        above = saved(_below(nodes, above), "above")
    return _below(leaves, above).select("row.*", "subroot", "root", "witness")


def _below(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """Witnesses of a round from those of the round above, with the subroot of the tree carried along in the root's column."""
    packed = above.withColumn("root", F.concat("root", "subroot"))
    found = _witnessed(nodes, packed.select("tree", "rank", "root", "witness"))
    return found.withColumns({"subroot": F.substring("root", 65, 64), "root": F.substring("root", 1, 64)})
