"""Quality classifier by votes of nearest labelled neighbours in a latent-semantic space (operator 13)."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraloom.llm.shared import CACHE_WORDS

WORDS, SHAPES, BINS = 6144, 1536, 64  # hash buckets of words and of word shapes, bins of repetition
TERMS = WORDS + SHAPES + BINS
SAMPLE = 2_000  # labelled documents that the space is fitted on and that vote, half of them of each label
RANK = 48  # dimensions of the space
VOTERS = 15  # nearest labelled documents that vote
SLICE = 256  # documents handled together
_CLASSES = bytes(65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 or c >= 128 else 48 if 48 <= c <= 57 else c for c in range(256))
_REPEATED = re.compile(rb"(.)\1+", re.S)


class TermCodes(dict):
    """Two term numbers by word, packed: of the word itself in lower case, and of its shape, as ``Aa.`` for ``Then.``"""

    def __missing__(self, word: bytes) -> int:
        shape = _REPEATED.sub(rb"\1", word.translate(_CLASSES))
        own = xxhash.xxh3_64_intdigest(word.lower()) % WORDS
        value = self[word] = own * TERMS + WORDS + xxhash.xxh3_64_intdigest(shape) % SHAPES
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > CACHE_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def repetition(codes: np.ndarray, text: bytes) -> list[int]:
    """Bins of two shares, in 31 steps each: of words like the one before, and of lines like an earlier one. Two for a text with words."""
    if not len(codes):
        return []
    lines = [x for x in text.split(b"\n") if x.strip()]
    shares = float(np.mean(codes[1:] == codes[:-1])) if len(codes) > 1 else 0.0, 1 - len(set(lines)) / len(lines)
    return [WORDS + SHAPES + 32 * k + int(np.ceil(31 * share**0.5)) for k, share in enumerate(shares)]


def term_counts(texts: list[bytes], codes: TermCodes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place in ``texts``, term number and count of every term of every text, by place, then term."""
    parts = []
    for text in texts:
        found = codes.of(text.split())
        parts.append(np.r_[found // TERMS, found % TERMS, np.array(repetition(found, text), np.int64)])
    owner = np.repeat(np.arange(len(texts)), [len(x) for x in parts])
    keys, counts = np.unique(owner * TERMS + np.concatenate([np.empty(0, np.int64), *parts]), return_counts=True)
    return keys // TERMS, keys % TERMS, counts


def weighted(owner: np.ndarray, terms: np.ndarray, counts: np.ndarray, idf: np.ndarray, n: int) -> np.ndarray:
    """TF-IDF weights; words, shapes and bins of a text have unit length each, so that each kind counts alike."""
    w = (1 + np.log(counts)) * idf[terms]
    view = 3 * owner + np.searchsorted([WORDS, WORDS + SHAPES], terms, "right")
    return w / np.maximum(np.sqrt(np.bincount(view, w * w, 3 * n)), 1e-30)[view]


class LatentVotes:
    """A latent space with labelled vectors in it."""

    def __init__(self, idf: np.ndarray, axes: np.ndarray, vectors: np.ndarray, labels: np.ndarray):
        self.idf, self.axes, self.vectors, self.labels = idf, axes, vectors, labels

    @classmethod
    def fit(cls, idf: np.ndarray, docs: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, rank: int = RANK) -> LatentVotes:
        """Leading right singular vectors of the TF-IDF matrix of labelled documents (terms, counts), and their places on them."""
        x = np.zeros((len(docs), TERMS), np.float32)
        for i, (terms, counts) in enumerate(docs):
            x[i, terms] = weighted(np.zeros(len(terms), np.int64), terms, counts, idf, 1)
        values, left = np.linalg.eigh((x @ x.T).astype(np.float64)) if len(docs) else (np.empty(0), np.empty((0, 0)))
        top = np.argsort(-values)[:rank]
        top = top[values[top] > 1e-9]
        axes = (x.T @ left[:, top] / np.sqrt(values[top])).astype(np.float32)
        return cls(idf, axes, unit(x @ axes), labels)

    def places(self, texts: list[bytes], codes: TermCodes) -> np.ndarray:
        """Unit vectors of texts; zero for texts without words or with no share in the space."""
        owner, terms, counts = term_counts(texts, codes)
        w = weighted(owner, terms, counts, self.idf, len(texts)).astype(np.float32)
        out = np.zeros((len(texts), self.axes.shape[1]), np.float32)
        if len(owner):
            firsts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            out[owner[firsts]] = np.add.reduceat(w[:, None] * self.axes[terms], firsts, axis=0)
        return unit(out)

    def scores(self, vectors: np.ndarray, voters: int = VOTERS) -> np.ndarray:
        """Share of label 1 among the votes of the nearest labelled vectors, weighted by cosine; without any, that of all labelled ones."""
        prior = float(self.labels.mean()) if len(self.labels) else 0.5
        if not len(self.labels) or not self.axes.shape[1]:
            return np.full(len(vectors), prior)
        cosine = vectors @ self.vectors.T
        k = min(voters, len(self.labels))
        # ties at the last place go to the earlier labelled vector
        near = np.argsort(-cosine, axis=1, kind="stable")[:, :k] if k == len(self.labels) else _nearest(cosine, k)
        w = np.maximum(np.take_along_axis(cosine, near, 1).astype(np.float64), 0)
        total = w.sum(1)
        return np.where(total > 0, np.clip((w * self.labels[near]).sum(1) / np.where(total > 0, total, 1), 0, 1), prior)


def _nearest(cosine: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest of each row, those of equal value by place."""
    last = -np.partition(-cosine, k - 1, axis=1)[:, k - 1 : k]
    above, equal = cosine > last, cosine == last
    take = above | (equal & (np.cumsum(equal, 1) <= k - above.sum(1, keepdims=True)))
    return np.nonzero(take)[1].reshape(len(cosine), k)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; zero rows stay."""
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return (x / np.where(norm > 0, norm, 1)).astype(np.float32)


def inverse_frequencies(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """log((1 + documents) / (1 + documents with the term)) + 1 by term, counted over all documents; the table has a fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, seen, n = TermCodes(), np.zeros(TERMS + 1, np.int64), 0
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                texts = [t or b"" for t in batch.column(0).slice(at, SLICE).to_pylist()]
                seen[:TERMS] += np.bincount(term_counts(texts, codes)[1], minlength=TERMS)
                n += len(texts)
        seen[TERMS] = n
        some = np.flatnonzero(seen)
        yield pa.record_batch({"term": pa.array(some), "n": pa.array(seen[some])})

    rows = docs.select(F.col(text_col).cast("string").cast("binary").alias("text")).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    seen = np.zeros(TERMS + 1)
    for row in rows:  # one a bucket at most
        seen[row["term"]] = row["n"]
    return np.log((1 + seen[TERMS]) / (1 + seen[:TERMS])) + 1


def fit_votes(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, rank: int = RANK) -> LatentVotes:
    """A voting space from labelled documents: at most ``sample`` of them, half of each label (0 and 1), those of smallest hash of the id.

    An id that is labelled twice counts with its lower label, one with several texts with the greatest text. The term weights come
    from all documents. Only term counts of the sample (at most TERMS a document) and a table of TERMS rows reach the driver.
    """
    idf = inverse_frequencies(docs, text_col)
    marked = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).cast("int").alias("label"))
    picked = None
    for value in (0, 1):
        part = marked.where(F.col("label") == value).orderBy(F.xxhash64("id"), "id").limit(sample // 2)
        picked = part if picked is None else picked.unionByName(part)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text")).where("text is not null")
    chosen = texts.join(F.broadcast(picked), "id").groupBy("id").agg(F.max("text").alias("text"), F.first("label").alias("label"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = TermCodes()
        for batch in batches:
            for k in range(len(batch)):
                _, terms, counts = term_counts([batch.column(2)[k].as_py()], codes)
                one = pa.array([terms.astype("<i4").tobytes()], pa.binary()), pa.array([counts.astype("<i4").tobytes()], pa.binary())
                yield pa.record_batch({"place": batch.column(0).slice(k, 1), "label": batch.column(1).slice(k, 1), "terms": one[0], "counts": one[1]})

    rows = chosen.select(F.xxhash64("id").alias("place"), "label", "text").mapInArrow(run, "place long, label int, terms binary, counts binary").collect()
    rows = sorted(rows, key=lambda r: (r["place"], bytes(r["terms"])))
    counted = [(np.frombuffer(r["terms"], "<i4"), np.frombuffer(r["counts"], "<i4")) for r in rows]
    return LatentVotes.fit(idf, counted, np.array([r["label"] for r in rows], np.float64), rank)


def vote_scores(docs: DataFrame, votes: LatentVotes, id_col: str = "doc_id", text_col: str = "text", voters: int = VOTERS) -> DataFrame:
    """Rows ``(doc_id, score)``, one for each input row: how likely its whole text has label 1, from 0 to 1.

    Each text takes its place in the latent space (broadcast, of fixed size), its exact cosines to all labelled vectors are computed in blocks,
    and the nearest vote with their cosines as weights. Texts that are null, empty or share nothing with the space get the share of
    label 1 in the fitted sample. Ids may be null or repeat, other columns are ignored, an empty table gives no rows. No shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(votes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = TermCodes()
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                part = batch.slice(at, SLICE)
                texts = [t or b"" for t in part.column(1).to_pylist()]
                yield pa.record_batch({id_col: part.column(0), "score": pa.array(shared.value.scores(shared.value.places(texts, codes), voters))})

    one = docs.select(F.col(id_col), F.col(text_col).cast("string").cast("binary").alias("_text"))
    return one.mapInArrow(run, f"`{id_col}` {one.schema[0].dataType.simpleString()}, score double")
