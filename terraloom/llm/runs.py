"""Periodic runs of words by a dictionary of basic factors (operator 11)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST, TIMES = 24, 3  # words of a run, and its length in periods, at least
CHUNK = 1 << 17  # words whose factors are named together; a longer text makes a chunk of its own
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class _Ids(dict):
    """A number by word, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def _common(names: list[np.ndarray], i: np.ndarray, j: np.ndarray, back: bool) -> np.ndarray:
    """Words that the texts from places i and j on (or up to them, going back) have in common, by the names of their factors."""
    length, size = np.zeros(len(i), np.int64), len(names[0])
    for level in range(len(names) - 1, -1, -1):
        step = 1 << level
        a, b = (i - length - step + 1, j - length - step + 1) if back else (i + length, j + length)
        inside = (a >= 0) & (b >= 0) & (a < size) & (b < size)
        na, nb = names[level][np.where(inside, a, 0)], names[level][np.where(inside, b, 0)]
        length += np.where(inside & (na >= 0) & (na == nb), step, 0)
    return length


def find_runs(words: np.ndarray, ends: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Runs of several texts at once: rows (start, end, period) by start, then period, in places of ``words``.

    ``words`` has a number for each word, text after text, and ``ends`` where each text ends. For each power of two L the factors of L words
    are named by the pair of names of their halves; a factor that occurs once in its text is dropped there and above. Occurrences
    that follow each other within 2 L words at equal distance form arithmetic progressions. The first pair of each proposes its distance as a period,
    which is extended both ways by the names and kept if long enough; of equal stretches the least period stays, which is the smallest.
    A period q <= L < 2 q recurs at distance q and no less, as 3 q words hold it, so none is missed.
    """
    n = len(words)
    text = np.repeat(np.arange(len(ends)), np.diff(np.r_[0, ends]))
    until = ends[text] if n else text
    names: list[np.ndarray] = []
    found = []
    at, key, size = np.arange(n), text * (int(words.max(initial=0)) + 1) + words, 1
    while len(at):
        _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
        again = count[inverse] > 1
        at, name = at[again], inverse[again].astype(np.int32)
        if not len(at):
            break
        full = np.full(n, -1, np.int32)
        full[at] = name
        names.append(full)
        order = np.argsort(name, kind="stable")
        place, kind = at[order], name[order]
        gap = np.where(kind[1:] == kind[:-1], place[1:] - place[:-1], 0)
        head = (gap > 0) & (gap <= 2 * size) & (gap != np.r_[0, gap[:-1]])
        found.append(np.stack([place[:-1][head], gap[head]], 1))
        on = at + 2 * size <= until[at]
        at = at[on]
        at = at[full[at + size] >= 0]
        key, size = full[at].astype(np.int64) * (int(name.max()) + 1) + full[at + size], 2 * size
    if not found:
        return np.empty((0, 3), np.int64)
    pairs = np.unique(np.concatenate(found), axis=0)
    pairs = pairs[np.lexsort((pairs[:, 0], pairs[:, 1]))]
    if not len(pairs):
        return pairs
    first = np.r_[True, (pairs[1:, 0] != pairs[:-1, 0] + 1) | (pairs[1:, 1] != pairs[:-1, 1])]  # neighbours at one distance lie in one stretch
    i, gap = pairs[first].T
    start = i - _common(names, i - 1, i + gap - 1, True)
    end = i + gap + _common(names, i, i + gap, False)
    keep = end - start >= np.maximum(least, times * gap)
    rows = np.stack([start[keep], end[keep], gap[keep]], 1)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    rows = rows[np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(1)]] if len(rows) else rows
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _answers(texts: list[list[bytes]], least: int, times: int) -> Iterator[tuple[np.ndarray, bytes]]:
    """Runs (start, length, period) and the collapsed text of each list of words."""
    ids = _Ids()
    long = [w if len(w) >= least else [] for w in texts]  # no run lies in fewer words
    ends = np.cumsum([len(w) for w in long])
    flat = np.fromiter((ids[w] for words in long for w in words), np.int64, int(ends[-1]) if len(ends) else 0)
    runs = find_runs(flat, ends, least, times)
    owner = np.searchsorted(ends, runs[:, 0], "right")
    for k, words in enumerate(texts):
        own = runs[owner == k] - np.array([ends[k] - len(long[k])] * 2 + [0]) if len(runs) else runs
        if len(own):
            depth = np.zeros(len(words) + 1, np.int64)
            np.add.at(depth, own[:, 0] + own[:, 2], 1)
            np.add.at(depth, own[:, 1], -1)
            words = [w for w, covered in zip(words, np.cumsum(depth[:-1]) > 0, strict=True) if not covered]
            own = np.stack([own[:, 0], own[:, 1] - own[:, 0], own[:, 2]], 1)
        yield own, b" ".join(words)


def _rows(ids: list[pa.Array], texts: list[list[bytes]], id_col: str, least: int, times: int) -> pa.RecordBatch:
    answers = list(_answers(texts, least, times))
    flat = np.concatenate([r for r, _ in answers])
    runs = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, i])) for i in range(3)], fields=list(RUN))
    ends = np.cumsum([0, *(len(r) for r, _ in answers)]).astype(np.int32)
    columns = [pa.concat_arrays(ids), pa.array([len(t) for t in texts], pa.int64()), pa.ListArray.from_arrays(pa.array(ends), runs), pa.array([c for _, c in answers], pa.binary()).cast(pa.string())]
    return pa.record_batch(columns, [id_col, "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """Rows ``(doc_id, n_words, runs, collapsed)``, one for each input row.

    ``runs`` has, by start and then period, every maximal stretch of words with smallest period q and a length of at least ``least`` words
    and ``times`` (3 or more) periods. ``collapsed`` is the text without the words that a run contains after its first q, joined by single spaces.
    Words are split at ASCII white space. Null and empty texts have no words, no runs and an empty ``collapsed``; ids may be null or
    repeat, each row counts for itself; other columns are ignored; an empty table gives no rows. No shuffle; memory grows with the longest text alone.
    """
    if times < 3:
        raise ValueError("a run needs at least three periods")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids: list[pa.Array] = []
            texts: list[list[bytes]] = []
            size = 0
            for k in range(len(batch)):
                words = (batch.column(1)[k].as_py() or b"").split()
                if texts and size + len(words) > CHUNK:
                    yield _rows(ids, texts, id_col, least, times)
                    ids, texts, size = [], [], 0
                ids.append(batch.column(0).slice(k, 1))
                texts.append(words)
                size += len(words)
            if texts:
                yield _rows(ids, texts, id_col, least, times)

    one = docs.select(F.col(id_col), F.col(text_col).cast("string").cast("binary").alias("_text"))
    kind = one.schema[0].dataType.simpleString()
    return one.mapInArrow(run, f"`{id_col}` {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def highest(runs: Column) -> Column:
    """The run of greatest length in periods, compared exactly; of equal ones the first by start, then period. Null without runs."""
    return F.aggregate(runs, F.get(runs, F.lit(0)), lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best))


def looped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, with the words of every tenth by hash of its id turned into a loop from some word on: planted runs of known period.

    With h the CRC-32 of the id as text, where h % 10 is 0 and there are n > 0 words, word i >= a becomes word a + (i - a) % p, with g = floor(h / 10),
    a = g % n and p = 1 + floor((n - a) / (3 + g % 8)). Rows with a null id stay as they are.
    """
    words = F.filter(F.split(F.col(text_col).cast("string"), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    h = F.crc32(F.col(id_col).cast("string"))
    some = docs.withColumns({"_h": h, "_words": F.when(h % 10 == 0, words)})
    n, g = F.size("_words").cast("long"), F.floor(F.col("_h") / 10)
    some = some.withColumn("_a", F.when(F.size("_words") > 0, g % n))
    some = some.withColumn("_p", 1 + F.floor((n - F.col("_a")) / (3 + g % 8)))
    place = lambda i: F.when(i >= F.col("_a"), F.col("_a") + (i - F.col("_a")) % F.col("_p")).otherwise(i).cast("int")
    loop = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get("_words", place(i))), " ")
    return some.withColumn(text_col, F.when(F.size("_words") > 0, loop).otherwise(F.col(text_col))).select(*docs.columns)
