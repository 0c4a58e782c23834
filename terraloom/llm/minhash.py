"""MinHash near-dedup by min-max hashing (operator 10)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraloom.llm.shared import WordHashes, connected, drop, mix, saved, windows

BANDS, ROWS = 32, 5  # 160 signature values: at similarity 0.8 a pair misses all bands with probability 3e-6
PERMUTATIONS = BANDS * ROWS // 2  # each gives its minimum and its maximum
SMALL_BUCKET = 64  # larger buckets are linked as stars and compared on full sets
BLOCK = 96  # documents of a group that meet in one comparison unit
_RNG = np.random.default_rng(20240607)
_A = _RNG.integers(0, 2**31, PERMUTATIONS, np.uint32) * np.uint32(2) + np.uint32(1)
_B = _RNG.integers(0, 2**32, PERMUTATIONS, np.uint32)
_BAND = _RNG.integers(0, 2**63, (BANDS, ROWS), np.uint64) | np.uint64(1)
_SALT = _RNG.integers(0, 2**63, BANDS, np.uint64)


def shingles(text: bytes | None, k: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's k-word shingles (A-Z lowered, ASCII white space splits)."""
    return np.unique(windows(hashes.of(text.lower().split()), k)) if text else np.empty(0, np.uint64)


def min_max(sets: list[np.ndarray]) -> np.ndarray:
    """One row of 160 values a set: minimum and maximum under each permutation, side by side."""
    out = np.empty((len(sets), PERMUTATIONS, 2), np.uint32)
    for i, s in enumerate(sets):
        low, high = np.full(PERMUTATIONS, 2**32 - 1, np.uint32), np.zeros(PERMUTATIONS, np.uint32)
        short = (s >> np.uint64(32)).astype(np.uint32)
        for j in range(0, len(short), 4096):
            values = _A[:, None] * short[None, j : j + 4096] + _B[:, None]
            np.minimum(low, values.min(1), out=low)
            np.maximum(high, values.max(1), out=high)
        out[i, :, 0], out[i, :, 1] = low, high
    return out.reshape(len(sets), -1)


def _signatures(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for whole in batches:
            for at in range(0, len(whole), 1024):
                batch = whole.slice(at, 1024)
                sets = [shingles(t, k, hashes) for t in batch.column(1).cast(pa.binary()).to_pylist()]
                digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
                prints = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                values = min_max(sets)
                with np.errstate(over="ignore"):
                    keys = (mix(values.astype(np.uint64)).reshape(-1, BANDS, ROWS) * _BAND).sum(2, dtype=np.uint64)
                    keys = mix(keys + _SALT).view(np.int64)
                bits = np.packbits((values * np.uint32(0x9E3779B1)) >> np.uint32(31), axis=1).astype(np.uint8)
                yield pa.record_batch(
                    {
                        "doc_id": batch.column(0),
                        "n": pa.array([len(s) for s in sets], pa.int64()),
                        "f1": pa.array(prints[:, 0]),
                        "f2": pa.array(prints[:, 1]),
                        "bands": pa.ListArray.from_arrays(np.arange(0, keys.size + 1, BANDS, dtype=np.int32), pa.array(keys.ravel())),
                        "sketch": pa.array([r.tobytes() for r in bits], pa.binary()),
                    }
                )

    return run


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest position reachable from each of ``n`` positions over the links (i, j)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _groups(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[dict]:
    """Rows sorted by their first column, in pieces that never part a key: {column: numpy or list}."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]) if rest is not None else table
        key = table.column(columns[0]).to_numpy()
        cut = int(np.searchsorted(key, key[-1])) if len(key) else 0
        if cut:
            yield table.slice(0, cut)
        rest = table.slice(cut).combine_chunks()
    if rest is not None and len(rest):
        yield rest


def _bucket_links(limit: int):
    """Within each small bucket, links between rows whose sketches agree enough; one link a row at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _groups(batches, ["key", "rep", "sketch"]):
            key, rep = piece.column("key").to_numpy(), piece.column("rep").to_numpy()
            sketch = np.frombuffer(b"".join(piece.column("sketch").to_pylist()), np.uint32).reshape(len(key), -1)
            left, right, d = [], [], 1
            while d < len(key) and (same := np.flatnonzero(key[:-d] == key[d:])).size:
                near = np.bitwise_count(sketch[same] ^ sketch[same + d]).sum(1) <= limit
                left.append(same[near])
                right.append(same[near] + d)
                d += 1
            if left:
                root = _roots(len(key), np.concatenate(left), np.concatenate(right))
                a, b = rep, rep[root]
                moved = a != b
                yield pa.record_batch({"a": pa.array(a[moved]), "b": pa.array(b[moved])})

    return run


def _exact_links(percent: int):
    """Within each comparison unit, pairs with 100 * intersection >= percent * union on full sets, as a spanning forest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _groups(batches, ["unit", "rep", "side", "shingles"]):
            unit = piece.column("unit").to_numpy()
            for at in np.split(np.arange(len(unit)), np.flatnonzero(np.diff(unit)) + 1):
                rep = piece.column("rep").to_numpy()[at]
                side = piece.column("side").to_numpy()[at]
                sets = [np.frombuffer(s, np.uint64) for s in piece.column("shingles").slice(at[0], len(at)).to_pylist()]
                i, j = overlapping(sets, percent)
                across = (side[i] != side[j]) | (side[i] == 0)
                root = _roots(len(at), i[across], j[across])
                moved = rep != rep[root]
                yield pa.record_batch({"a": pa.array(rep[moved]), "b": pa.array(rep[root][moved])})

    return run


def overlapping(sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions i < j of sets with 100 * intersection >= percent * union, exactly, by sums over shared elements."""
    n = np.array([len(s) for s in sets])
    row, flat = np.repeat(np.arange(len(sets)), n), np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    flat, row = flat[order], row[order]
    start = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
    size = np.diff(np.r_[start, len(flat)])
    shared = np.repeat(size > 1, size)
    column = np.repeat(np.cumsum(size > 1) - 1, size)[shared]
    row, width = row[shared], int((size > 1).sum())
    both = np.zeros((len(sets), len(sets)), np.float32)
    for c in range(0, width, 8192):  # dense pieces: at most 192 x 8192 values
        here = (column >= c) & (column < c + 8192)
        dense = np.zeros((len(sets), min(8192, width - c)), np.float32)
        dense[row[here], column[here] - c] = 1
        both += dense @ dense.T
    union = n[:, None] + n[None, :] - both
    return np.nonzero(np.triu((100 * both >= percent * union) & (union > 0), 1))


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = [shingles(t, k, hashes).tobytes() for t in batch.column(2).cast(pa.binary()).to_pylist()]
            yield pa.record_batch({"rep": batch.column(0), "grp": batch.column(1), "shingles": pa.array(sets, pa.binary())})

    return run


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups of documents that are linked by a Jaccard similarity of at least ``percent``/100 on k-word shingles.

    Rows ``(doc_id, n_shingles, component_id, kept)``, one for each input row. Texts without words (or null) have an
    empty set and are linked with nothing; fewer than k words make one shingle. A null id is linked with nothing
    and kept. Repeated rows share a component; an id that stands for several texts joins what any of them links.
    Other columns are ignored; an empty table gives no rows.

    Equal sets collapse to one representative. Signatures hold the minimum and the maximum under each of 80
    permutations, cut in 32 bands of 5. Small buckets are thinned by one-bit sketches; large ones are linked
    whole. What that connects is compared on full sets in bounded blocks, each of which returns a spanning forest, so
    no group of copies is expanded into pairs, and every bucket is checked, whatever its size.
    """
    one = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sig = saved(one.mapInArrow(_signatures(k), "doc_id long, n long, f1 long, f2 long, bands array<long>, sketch binary"), "minhash")
    real = sig.where("n > 0 and doc_id is not null")
    classes = saved(real.groupBy("f1", "f2").agg(F.min("doc_id").alias("rep")), "classes")
    reps = saved(real.join(classes.withColumnRenamed("rep", "doc_id"), ["f1", "f2", "doc_id"]).dropDuplicates(["f1", "f2"]).select(F.col("doc_id").alias("rep"), "bands", "sketch"), "reps")
    cells = reps.select("rep", F.explode("bands").alias("key"))
    buckets = cells.groupBy("key").agg(F.count("*").alias("size"), F.min("rep").alias("first")).where("size > 1")
    member = saved(cells.join(buckets, "key"), "buckets")
    small = member.where(f"size <= {SMALL_BUCKET}").select("key", "rep").join(reps.select("rep", "sketch"), "rep")
    # a pair at the threshold differs in 10 % of its 160 bits; this lets pass five deviations more
    share = (100 - percent) / 200
    limit = round(160 * share + 5 * (160 * share * (1 - share)) ** 0.5)
    near = small.select("key", "rep", "sketch").repartition("key").sortWithinPartitions("key").mapInArrow(_bucket_links(limit), "a long, b long")
    stars = member.where(f"size > {SMALL_BUCKET} and rep != first").select(F.col("rep").alias("a"), F.col("first").alias("b"))
    group = connected(near.unionByName(stars)).withColumnsRenamed({"node": "rep", "component": "grp"})
    group = saved(group, "groups")
    drop(member, reps)
    # groups grow with the corpus: their texts come by a shuffle at every size, never by a broadcast that only small inputs allow
    text = one.withColumnRenamed("doc_id", "rep").hint("merge").join(group, "rep").select("rep", "grp", "text")
    sets = saved(text.mapInArrow(_sets(k), "rep long, grp long, shingles binary"), "sets")
    links = _compared(sets, group, percent)
    labels = saved(connected(links), "labels")
    drop(sets, group, links)
    labels = labels.withColumnsRenamed({"node": "rep", "component": "component_id"})
    return (
        sig.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("f1")).alias("f1"), F.when(F.col("n") > 0, F.col("f2")).alias("f2"))
        .join(classes, ["f1", "f2"], "left")
        .join(labels, "rep", "left")
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "rep", "doc_id")))
        .select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
    )


def _compared(sets: DataFrame, group: DataFrame, percent: int) -> DataFrame:
    """Exact links within candidate groups, enough of them to connect what all links connect.

    A group is cut in blocks, and each block is compared within itself and with one member of the group, its pivot. Whatever that links to the pivot, the
    core, is connected; so only the rest is compared with all others, in units of two blocks. A group of copies near one text thus costs some passes over it,
    not the square of its size. Sets are fetched once for each unit that they take part in.
    """
    sizes = group.groupBy("grp").agg(F.count("*").alias("n"), F.min("rep").alias("pivot"))
    placed = group.join(sizes, "grp").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    all_ = F.sequence(F.lit(0), F.col("blocks") - 1)
    block = F.explode(F.when(F.col("rep") == F.col("pivot"), all_).otherwise(F.array(F.pmod(F.xxhash64("rep"), "blocks").cast("int")))).alias("block")
    own = placed.select("rep", "grp", "pivot", block).select("rep", F.xxhash64("grp", "block").alias("unit"), F.lit(0).alias("side"), (F.col("rep") != F.col("pivot")).alias("turn"))
    first = saved(_linked_units(own, sets, percent), "links")
    large = placed.where(f"n > {BLOCK}")
    if large.isEmpty():
        return first
    core = first.join(large.select(F.col("pivot").alias("b")).distinct(), "b", "left_semi").select(F.col("a").alias("rep"), F.lit(True).alias("core")).distinct()
    marked = saved(large.where("rep != pivot").select("rep", "grp").join(core, "rep", "left").withColumn("core", F.coalesce("core", F.lit(False))), "marked")
    parts = marked.groupBy("grp").agg(F.ceil(F.count_if("core") / BLOCK).cast("int").alias("cb"), F.ceil(F.count_if(~F.col("core")) / BLOCK).cast("int").alias("rb")).where("rb > 0")
    dealt = marked.join(parts, "grp").withColumn("block", F.pmod(F.xxhash64("rep", F.lit(1)), F.when(F.col("core"), F.col("cb")).otherwise(F.col("rb"))).cast("int"))
    upto = lambda n: F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(F.array().cast("array<int>"))
    # a block of the rest meets every block of the core, and every block of the rest that is no smaller, itself among them
    across = dealt.select("rep", "grp", "core", "block", F.explode(F.when(F.col("core"), upto("rb")).otherwise(upto("cb"))).alias("other"))
    low, high = (F.when(F.col("core"), x).otherwise(y) for x, y in ((F.col("block"), F.col("other")), (F.col("other"), F.col("block"))))
    across = across.select("rep", F.xxhash64("grp", F.lit("core"), low, high).alias("unit"), F.when(F.col("core"), 1).otherwise(2).alias("side"))
    within = dealt.where("not core").select("rep", "grp", "block", F.explode(upto("rb")).alias("other"))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    within = within.select("rep", F.xxhash64("grp", F.lit("rest"), low, high).alias("unit"), F.when(low == high, 0).when(F.col("block") == low, 1).otherwise(2).alias("side"))
    second = saved(_linked_units(across.unionByName(within).withColumn("turn", F.lit(True)), sets, percent), "links")
    drop(marked)
    return first.unionByName(second)


def _linked_units(units: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of rows (rep, unit, side, turn) whose full sets reach the limit, as a spanning forest of each unit from its first row on."""
    rows = units.join(sets.select("rep", "shingles"), "rep").select("unit", "rep", "side", "shingles", "turn")
    return rows.repartitionByRange("unit").sortWithinPartitions("unit", "turn").mapInArrow(_exact_links(percent), "a long, b long").distinct()
