"""Token files of directly addressable codes (operator 5)."""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terraloom.llm.bpe import Cutter

#: A task's word cache is emptied beyond so many entries; the results do not depend on it.
CACHE_WORDS = 1_000_000
SEGMENT_DOCS, SEGMENT_IDS = 256, 1 << 20  # a segment ends with so many documents, or beyond so many ids
RANK_BITS = 512  # one directory entry for so many bitmap bits
_HEAD = struct.Struct("<4sIIQ")


class Dac:
    """Ids as 8-bit chunks in levels: level k holds the k-th chunk of every id that has one, a bitmap marks which ids go
    on to the next level, and a directory counts the marks before each block, so id i is reached by one rank a level."""

    def __init__(self, levels: list[np.ndarray], bitmaps: list[np.ndarray], ranks: list[np.ndarray], ends: np.ndarray):
        self.levels, self.bitmaps, self.ranks, self.ends = levels, bitmaps, ranks, ends

    @classmethod
    def of(cls, ids: np.ndarray, ends: np.ndarray) -> Dac:
        levels, bitmaps, ranks, rest = [], [], [], ids.astype(np.uint32)
        while True:
            levels.append((rest & np.uint32(255)).astype(np.uint8))
            more = rest > 255
            bits = np.packbits(more, bitorder="little")
            bitmaps.append(np.append(bits, np.zeros(-len(bits) % (RANK_BITS // 8), np.uint8)))
            marks = np.bitwise_count(bitmaps[-1].reshape(-1, RANK_BITS // 8)).sum(1, dtype=np.uint32)
            ranks.append(np.r_[np.uint32(0), np.cumsum(marks, dtype=np.uint32)])
            if not more.any():
                return cls(levels, bitmaps, ranks, ends.astype(np.uint64))
            rest = rest[more] >> np.uint32(8)

    def dump(self) -> bytes:
        out = [_HEAD.pack(b"DAC1", len(self.levels), len(self.ends), len(self.levels[0])), self.ends.astype("<u8").tobytes()]
        for level, bitmap, rank in zip(self.levels, self.bitmaps, self.ranks, strict=True):
            out += [struct.pack("<QQQ", len(level), len(bitmap), len(rank)), level.tobytes(), bitmap.tobytes(), rank.astype("<u4").tobytes()]
        return b"".join(out)

    @classmethod
    def load(cls, data: bytes) -> Dac:
        magic, n_levels, n_docs, _ = _HEAD.unpack_from(data)
        if magic != b"DAC1":
            raise ValueError("not a DAC1 segment")
        at = _HEAD.size + 8 * n_docs
        ends, parts = np.frombuffer(data, "<u8", n_docs, _HEAD.size), []
        for _ in range(n_levels):
            sizes, at = struct.unpack_from("<QQQ", data, at), at + 24
            for kind, size in zip(("u1", "u1", "<u4"), sizes, strict=True):
                parts.append(np.frombuffer(data, kind, size, at))
                at += parts[-1].nbytes
        return cls(parts[0::3], parts[1::3], parts[2::3], ends)

    def __getitem__(self, i: int) -> int:
        """Id i, without decoding any other."""
        value = 0
        for k, (level, bitmap, rank) in enumerate(zip(self.levels, self.bitmaps, self.ranks, strict=True)):
            value |= int(level[i]) << 8 * k
            if not bitmap[i >> 3] >> (i & 7) & 1:
                break
            block = i // RANK_BITS
            inside = bitmap[block * RANK_BITS // 8 : (i >> 3) + 1].copy()
            inside[-1] &= (1 << (i & 7)) - 1
            i = int(rank[block]) + int(np.bitwise_count(inside).sum())
        return value

    def ids(self) -> np.ndarray:
        out = np.zeros(len(self.levels[0]), np.uint32)
        where = np.arange(len(out))
        for k, (level, bitmap) in enumerate(zip(self.levels, self.bitmaps, strict=True)):
            out[where] |= level.astype(np.uint32) << np.uint32(8 * k)
            where = where[np.unpackbits(bitmap, count=len(level), bitorder="little").astype(bool)]
        return out


@lru_cache(2)
def library_encoder(path: str):
    """Encoder of texts to little-endian 32-bit ids by the tokenizers library, to which each pre-token is handed once: a text's
    ids are those of its pre-tokens, or of its words, in turn. The cache stays with the Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    cutter, tok, have = Cutter(path), Tokenizer.from_file(path), {}
    tok.no_truncation()
    tok.no_padding()

    def learn(new: list[str]) -> None:
        # one call for many: white space parts them again, and each token tells the pre-token that it is of
        whole = tok.encode(" ".join(new), add_special_tokens=False)
        count = np.bincount(np.array(whole.word_ids, np.int64), minlength=len(new))
        if len(count) != len(new) or not count.all():
            raise ValueError("the library parts pre-tokens otherwise")
        flat, ends = np.array(whole.ids, "<u4").tobytes(), np.cumsum(4 * count).tolist()
        have.update((p, flat[a:b]) for p, a, b in zip(new, [0, *ends], ends, strict=False))

    def encode(texts: list[str | None]) -> list[bytes]:
        """Latin texts by pre-tokens; others by white-space words, which the library normalises and cuts itself."""
        plain = [not t or cutter.plain(t) for t in texts]
        cut = [(cutter.pieces(t) if p else cutter.words(t)) for t, p in zip(texts, plain, strict=True)]
        if len(have) > CACHE_WORDS:
            have.clear()
        new = list(set().union(*(c for c, p in zip(cut, plain, strict=True) if p)).difference(have))
        for at in range(0, len(new), 4096):
            learn(new[at : at + 4096])
        new = list(set().union(*(c for c, p in zip(cut, plain, strict=True) if not p)).difference(have))
        for w, e in zip(new, tok.encode_batch_fast(new, add_special_tokens=False), strict=True):
            have[w] = np.array(e.ids, "<u4").tobytes()
        return [b"".join(map(have.__getitem__, units)) for units in cut]

    return encode


SEGMENT = "part int, seq long, before long, n_ids long, docs array<long>, segment binary"


def _cuts(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Runs of documents that end beyond SEGMENT_IDS ids."""
    low, total = 0, 0
    for at, size in enumerate(sizes):
        total += size
        if total > SEGMENT_IDS or at == len(sizes) - 1:
            yield low, at + 1
            low, total = at + 1, 0


def write_token_files(docs: DataFrame, tokenizer: str, path: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes the ids of every whole text, an end id after each document, in ascending document order.

    The table at ``path`` holds one row a segment of up to 256 documents, which ends beyond a million ids: ``part`` and ``seq`` (its place), ``before`` (ids of
    the part before it), ``n_ids``, ``docs`` (document ids) and ``segment`` (a self-contained DAC1 block). Parts are ranges
    of ids; equal ids stay together, in no set order; null ids come first; null texts are empty. Other columns are ignored; an
    empty table gives an empty one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, seq, before = library_encoder(tokenizer), TaskContext.get().partitionId(), 0, 0
        end = end_id.to_bytes(4, "little")
        for batch in batches:
            for at in range(0, len(batch), SEGMENT_DOCS):
                piece = batch.slice(at, SEGMENT_DOCS)
                data = [d + end for d in encode(piece.column(1).to_pylist())]
                for low, high in _cuts([len(d) // 4 for d in data]):
                    flat = np.frombuffer(b"".join(data[low:high]), "<u4")
                    segment = Dac.of(flat, np.cumsum([len(d) // 4 for d in data[low:high]])).dump()
                    ids = pa.ListArray.from_arrays(pa.array([0, high - low], pa.int32()), piece.column(0).slice(low, high - low))
                    yield pa.record_batch([pa.array([part], pa.int32()), pa.array([seq], pa.int64()), pa.array([before], pa.int64()), pa.array([len(flat)], pa.int64()), ids, pa.array([segment], pa.binary())], names=["part", "seq", "before", "n_ids", "docs", "segment"])
                    seq, before = seq + 1, before + len(flat)

    one = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ordered = one.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    # not compressed: an id is reached in a segment as it lies in the file
    ordered.mapInArrow(run, SEGMENT).write.option("compression", "uncompressed").parquet(path)


def _bases(table: DataFrame) -> DataFrame:
    """Ids before each part, and its own: a row a part."""
    sizes = table.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    return sizes.select("part", "ids", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("base"))


def tokens_at(spark: SparkSession, path: str, positions: DataFrame) -> DataFrame:
    """Ids at places among all ids of a token table: ``(position, token_id)`` for the distinct ``position`` of the input that exist.

    The place tells part and segment, and the segment's codes give the id by a rank a level: no other id is decoded. Null
    places and those outside give no rows.
    """
    table = spark.read.schema(SEGMENT).parquet(path)
    asked = positions.select(F.col("position").cast("long").alias("position")).where("position >= 0").distinct()
    inside = asked.join(F.broadcast(_bases(table)), F.expr("position >= base and position < base + ids")).select("part", (F.col("position") - F.col("base")).alias("at"), "base", F.lit(None).cast("long").alias("seq"))
    starts = table.select("part", F.col("before").alias("at"), F.lit(None).cast("long").alias("base"), "seq")
    # the last segment that begins at or before the place, part by part
    found = F.last("seq", ignorenulls=True).over(Window.partitionBy("part").orderBy("at", F.col("seq").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0))
    placed = inside.unionByName(starts).withColumn("seq", found).where("base is not null")
    wanted = placed.groupBy("part", "seq").agg(F.collect_list(F.struct("at", "base")).alias("wanted"))  # at most a segment's ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for before, want, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                dac = Dac.load(data.as_py())
                yield pa.record_batch({"position": pa.array([w["base"] + w["at"] for w in want], pa.int64()), "token_id": pa.array([dac[w["at"] - before] for w in want], pa.int64())})

    return table.join(wanted, ["part", "seq"]).select("before", "wanted", "segment").mapInArrow(run, "position long, token_id long")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document of a token table: ``(doc_id, start, n_tokens, ids_crc32)``, start counting the ids of all documents before it.

    Each segment is decoded where it is read. Only the parts' sizes are brought together: a row for each part that the
    writer's shuffle had, which is what the broadcast is bounded by.
    """
    table = spark.read.schema(SEGMENT).parquet(path)
    base = _bases(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, docs, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                dac = Dac.load(data.as_py())
                raw, ends = memoryview(dac.ids().astype("<u4").tobytes()), dac.ends.astype(np.int64)
                begins = np.r_[0, ends[:-1]]
                crc = [zlib.crc32(raw[4 * b : 4 * e]) for b, e in zip(begins.tolist(), ends.tolist(), strict=True)]
                yield pa.record_batch({"doc_id": pa.array(docs, pa.int64()), "start": pa.array(begins + start), "n_tokens": pa.array(ends - begins), "ids_crc32": pa.array(crc, pa.int64())})

    placed = table.join(F.broadcast(base), "part").select((F.col("base") + F.col("before")).alias("start"), "docs", "segment")
    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
