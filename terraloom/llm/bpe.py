"""BPE encoding and decoding by batched numpy merge rounds (operator 4)."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A task's word cache is emptied beyond so many entries; the results do not depend on it.
CACHE_WORDS = 250_000
SLICE = 64  # documents encoded together
# Latin letters that stay as they are under NFC, digits, ASCII and common punctuation, ASCII white space
_LATIN = re.compile("[\x20\x09-\x0d!-~À-įı-ɏ‐-‧]*")
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ɏ]+|[0-9]|[^\x20\x09-\x0da-z0-9ß-öø-ɏ]+")
_SPLIT = re.compile("[\x20\x09-\x0d]+")


class Cutter:
    """Cuts texts to the pre-tokens of a vocabulary file: by the file's normaliser and pre-tokeniser, or a pattern that cuts Latin text alike."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            self.spec = json.load(f)
        self.special = {t["content"]: t["id"] for t in self.spec["added_tokens"]}
        self.parts = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        full = Tokenizer.from_file(path)
        self.normalizer, self.pre = full.normalizer, full.pre_tokenizer
        self.byte_of = {c: b for b, c in enumerate(byte_letters())}

    def pieces(self, text: str | None) -> list[str]:
        """Pre-tokens in turn, special tokens as their names (no pre-token is like them: it never mixes letters with signs)."""
        if not text:
            return []
        if self.plain(text):
            return _PIECES.findall(text.lower())
        # the file's pre-tokeniser parts words at white space, so each can be cut alone
        return [p for word in _SPLIT.split(text) for p in self._word(word)]

    @staticmethod
    def plain(text: str) -> bool:
        """Whether the pattern cuts the text as the file does."""
        return "<|" not in text and _LATIN.fullmatch(text) is not None

    @staticmethod
    def words(text: str) -> list[str]:
        return [w for w in _SPLIT.split(text) if w]

    def _word(self, word: str) -> list[str]:
        if "<|" in word:
            return [p for part in self.parts.split(word) for p in ([part] if part in self.special else self._plain(part))]
        return self._plain(word)

    def _plain(self, word: str) -> list[str]:
        if _LATIN.fullmatch(word):
            return _PIECES.findall(word.lower())
        found = self.pre.pre_tokenize_str(self.normalizer.normalize_str(word))
        return [bytes(self.byte_of[c] for c in piece).decode("utf-8", "surrogateescape") for piece, _ in found]


class WordBpe(Cutter):
    """Encoder and decoder of a word-end BPE vocabulary file of the tokenizers library.

    The merges are ours: the symbols of many words lie in one flat array, and each round finds every word's lowest-rank pair by
    binary search in the sorted pair keys and merges all its occurrences.
    """

    def __init__(self, path: str):
        super().__init__(path)
        model, vocab = self.spec["model"], self.spec["model"]["vocab"]
        self.suffix = model["end_of_word_suffix"]
        self.names = [""] * (1 + max([*vocab.values(), *self.special.values()]))
        for name, i in [*vocab.items(), *self.special.items()]:
            self.names[i] = name
        letters = byte_letters()
        self.inner = np.array([vocab[letters[b]] for b in range(256)], np.int64)
        self.last = np.array([vocab[letters[b] + self.suffix] for b in range(256)], np.int64)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        left, right = (np.array([vocab[p[i]] for p in pairs], np.int64) for i in (0, 1))
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = left << 32 | right
        order = np.argsort(keys)
        self.keys, self.rank, self.made = keys[order], order, made[order]
        # a symbol that two pairs make could enter a pair of lower rank; then only the first occurrence may merge
        born = np.full(len(self.names), -1)
        born[made] = np.arange(len(made))
        self.together = len(set(made.tolist())) == len(made) and bool((np.maximum(born[left], born[right]) < np.arange(len(made))).all())
        self.cache: dict[str, bytes] = {}

    def merge(self, words: list[str]) -> list[bytes]:
        """Token ids of each pre-token, as little-endian 32-bit integers."""
        data = [w.encode("utf-8", "surrogateescape") for w in words]
        size = np.array([len(d) for d in data], np.int64)
        raw = np.frombuffer(b"".join(data), np.uint8)
        symbols = self.inner[raw]
        ends = np.cumsum(size)
        symbols[ends - 1] = self.last[raw[ends - 1]]
        word = np.repeat(np.arange(len(words)), size)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            key = symbols[:-1] << 32 | symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = (self.keys[at] == key) & (word[:-1] == word[1:])
            rank = np.append(np.where(hit, self.rank[at], len(self.keys)), len(self.keys))
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            low = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.r_[starts, len(word)])
            open_ = np.repeat(low < len(self.keys), sizes)
            if not open_.all():  # finished words leave
                done.append((word[~open_], symbols[~open_]))
                word, symbols, rank, at = word[open_], symbols[open_], rank[open_], np.append(at, 0)[open_]
                sizes, low = sizes[low < len(self.keys)], low[low < len(self.keys)]
                if not len(word):
                    break
            else:
                at = np.append(at, 0)
            chosen = rank == np.repeat(low, sizes)
            if self.together:  # of overlapping occurrences (aaa) every other one, from the left
                where = np.flatnonzero(chosen)
                run = np.r_[True, np.diff(where) != 1]
                first = np.maximum.accumulate(np.where(run, np.arange(len(where)), 0))
                where = where[(np.arange(len(where)) - first) % 2 == 0]
            else:
                where = np.flatnonzero(chosen)
                where = where[np.r_[True, word[where[1:]] != word[where[:-1]]]]
            symbols[where] = self.made[at[where]]
            stay = np.ones(len(symbols), bool)
            stay[where + 1] = False
            symbols, word = symbols[stay], word[stay]
        if not done:
            return []
        word, symbols = (np.concatenate([d[i] for d in done]) for i in (0, 1))
        flat = symbols[np.argsort(word, kind="stable")].astype("<u4").tobytes()
        ends = np.cumsum(4 * np.bincount(word, minlength=len(words))).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def encode_bytes(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        cut = [self.pieces(t) for t in texts]
        have = self.cache
        if len(have) > CACHE_WORDS:
            have.clear()
        if not have:
            have.update((name, i.to_bytes(4, "little")) for name, i in self.special.items())
        if new := list(set().union(*cut).difference(have)):
            have.update(zip(new, self.merge(new), strict=True))
        return [b"".join(map(have.__getitem__, pieces)) for pieces in cut]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        return [np.frombuffer(b, "<u4") for b in self.encode_bytes(texts)]

    def decode(self, ids: Iterable[int]) -> str:
        """Token names joined by one space: the file names no decoder."""
        return " ".join(map(self.names.__getitem__, ids))


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + others.index(b)) for b in range(256)]


@lru_cache(2)
def codec(path: str) -> WordBpe:
    return WordBpe(path)


def _tokens(batches: Iterator[pa.RecordBatch], path: str, id_col: str, ids_col: str, decoded_col: str | None) -> Iterator[pa.RecordBatch]:
    bpe = codec(path)
    for batch in batches:
        for at in range(0, len(batch), SLICE):
            part = batch.slice(at, SLICE)
            data = bpe.encode_bytes(part.column(1).to_pylist())
            ends = np.cumsum([0, *(len(d) // 4 for d in data)]).astype(np.int32)
            flat = np.frombuffer(b"".join(data), "<i4")
            out = {id_col: part.column(0), ids_col: pa.ListArray.from_arrays(ends, pa.array(flat, pa.int32()))}
            if decoded_col:
                out[decoded_col] = pa.array([bpe.decode(flat[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.string())
            yield pa.record_batch(out)


def bpe_encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", ids_col: str = "token_ids", decoded_col: str | None = None) -> DataFrame:
    """Token ids of every whole text, as the tokenizers library encodes it without added special tokens.

    Rows ``(doc_id, token_ids array<int>)``, one for each input row, and the text that the ids decode to where ``decoded_col`` names a
    column for it. A null or empty text has no ids. Ids of documents may be null or repeat; other columns are ignored; an
    empty table gives no rows. No shuffle: each task keeps a bounded word cache.
    """
    one = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    more = f", `{decoded_col}` string" if decoded_col else ""
    schema = f"`{id_col}` {one.schema[0].dataType.simpleString()}, `{ids_col}` array<int>{more}"
    return one.mapInArrow(lambda batches: _tokens(batches, path, id_col, ids_col, decoded_col), schema)


def bpe_decode(encoded: DataFrame, path: str, ids_col: str = "token_ids", text_col: str = "decoded") -> DataFrame:
    """The input rows with the decoded text of their ids beside them (null ids: empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                part = batch.slice(at, SLICE)
                texts = [bpe.decode(x or []) for x in part.column(part.schema.get_field_index(ids_col)).to_pylist()]
                yield part.append_column(text_col, pa.array(texts, pa.string()))

    base = encoded.drop(text_col)
    return base.mapInArrow(run, T.StructType([*base.schema.fields, T.StructField(text_col, T.StringType())]))
