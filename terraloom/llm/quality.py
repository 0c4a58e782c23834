"""Quality rules with line labels from a linear-chain CRF (operator 3)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraloom.llm.shared import WordHashes, windows

SYMBOLS = b"#*$%&|<>"
FEATURES = 13
TRAIN_DOCS = 2_000  # bound of the labelled sample that the CRF is fitted on
TRAIN_LINES = 2_000  # of one of these documents, evenly spaced ones beyond that; with TRAIN_DOCS it bounds what the fit brings to the driver
PIECE = 40  # lines of one training sequence; longer documents give several
SLICE = 256  # documents handled together
_SPACE = b" \t\n\x0b\x0c\r"
_UPPER, _CUT = bytes(range(65, 91)), bytes(range(48, 58))


def _some(share: float) -> float:
    """A share that may exceed 1, levelled off, so that half and all of a line's words weigh nearly alike."""
    return share / (share + 0.2)


def line_features(line: bytes, words: list[bytes], seen: bool) -> list[float]:
    """Constant, and shares of a line that tell running text from boilerplate."""
    n = max(1, len(words))
    letters = max(1, len(line) - n)
    most = n - len(set(words))
    return [
        1.0,
        min(n, 60) / 20.0,
        float(n < 5),
        _some(sum(map(line.count, (b"#", b"*", b"$", b"%", b"&", b"<", b">"))) / n),
        _some(line.count(b"!") / n),
        _some(line.count(b"|") / n),
        (letters - len(line.translate(None, _UPPER)) + n) / letters,
        most / n,
        _some(sum(map(bytes.__eq__, words, words[1:])) / n),
        line.count(b".") / n,
        line.count(b",") / n,
        (len(line) - len(line.translate(None, _CUT))) / letters,
        float(seen),
    ]


def lines_of(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Features and word counts of the lines of a text that have words."""
    rows, counts, seen = [], [], set()
    for line in text.split(b"\n"):
        words = line.split()
        if words:
            rows.append(line_features(line, words, line in seen))
            counts.append(len(words))
            seen.add(line)
    return np.array(rows, np.float64).reshape(-1, FEATURES), np.array(counts, np.int64)


def base_counts(text: bytes, hashes: WordHashes, window: int = 5) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, lines equal to an earlier one, words in windows that come twice or more."""
    words = text.split()
    joined = b"".join(words)
    chars = len(joined) - int(np.count_nonzero(np.frombuffer(joined, np.uint8) & 0xC0 == 0x80))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    seen: set[bytes] = set()
    repeated = 0
    for line in text.split(b"\n"):
        if line in seen:
            repeated += 1
        elif line.strip(_SPACE):
            seen.add(line)
    covered = 0
    if len(words) >= window:
        h = windows(hashes.of(words), window)
        _, at, size = np.unique(h, return_inverse=True, return_counts=True)
        again = (size[at] > 1).astype(np.int64)
        if again.any():
            depth = np.zeros(len(words) + 1, np.int64)
            depth[: len(again)] += again
            depth[window : window + len(again)] -= again
            covered = int(np.count_nonzero(np.cumsum(depth[:-1]) > 0))
    return len(words), chars, symbols, repeated, covered


class _Chains:
    """Sequences of lines laid out for forward-backward passes of all at once: longest first, so step k holds the first ``live[k]``."""

    def __init__(self, pieces: list[np.ndarray], weight: np.ndarray):
        size = np.array([len(p) for p in pieces])
        self.order = np.argsort(-size, kind="stable")
        self.size, self.weight = size[self.order], weight[self.order]
        self.steps = int(self.size[0])
        self.live = np.searchsorted(-self.size, -np.arange(self.steps), "left")
        self.x = np.zeros((self.steps, len(pieces), FEATURES))
        for at, i in enumerate(self.order):
            self.x[: self.size[at], at] = pieces[i]
        self.mask = np.arange(self.steps)[:, None] < self.size

    def expect(self, score: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Node marginals (step, chain, state), weighted sum of edge marginals, weighted sum of log partitions."""
        top = score.max(2, keepdims=True)
        psi, hop = np.exp(score - top), np.exp(move - move.max())
        ahead, back = np.zeros_like(psi), np.ones_like(psi)
        norm = np.ones(psi.shape[:2])
        for k in range(self.steps):
            n = self.live[k]
            now = psi[k, :n] * (ahead[k - 1, :n] @ hop if k else 1.0)
            norm[k, :n] = now.sum(1)
            ahead[k, :n] = now / norm[k, :n, None]
        edges = np.zeros((2, 2))
        for k in range(self.steps - 1, 0, -1):
            n = self.live[k]
            on = psi[k, :n] * back[k, :n] / norm[k, :n, None]
            back[k - 1, :n] = on @ hop.T
            edges += np.einsum("n,ni,nj->ij", self.weight[:n], ahead[k - 1, :n], on) * hop
        total = (self.weight * (np.log(norm) + (top[..., 0] * self.mask) + move.max() * (self.mask & (np.arange(self.steps)[:, None] > 0))).sum(0)).sum()
        return ahead * back * self.mask[..., None], edges, float(total)


def _held(chains: _Chains, score: np.ndarray, move: np.ndarray, owner: np.ndarray, bad: np.ndarray, words: np.ndarray, least: float, trust: float) -> tuple[np.ndarray, np.ndarray]:
    """Expected states of lines given their document's label: node and edge expectations.

    Every line of a good document is content with log odds ``trust`` beforehand. The lines of a bad one are boilerplate with log odds of as
    little as brings their expected share of its words to ``least``, found by bisection document by document (pieces of one count together).
    """
    low, high = np.zeros(len(bad)), np.full(len(bad), 16.0)
    all_words = np.maximum(np.bincount(owner, (words * chains.mask).sum(0), len(bad)), 1)
    lean = np.zeros_like(score)
    for _ in range(9):
        odds = (low + high) / 2
        lean[..., 0], lean[..., 1] = np.where(bad, odds, 0.0)[owner], np.where(bad, 0.0, trust)[owner]
        node, edges, _ = chains.expect(score + lean, move)
        share = np.bincount(owner, (node[..., 0] * words).sum(0), len(bad)) / all_words
        low, high = np.where(share < least, odds, low), np.where(share < least, high, odds)
    return node, edges


class LineCrf:
    """Two-state chain: 1 content, 0 boilerplate. State scores are linear in the features; transitions are free."""

    def __init__(self, state: np.ndarray, move: np.ndarray):
        self.state, self.move = state, move

    @classmethod
    def fit(cls, sequences: list[tuple[np.ndarray, np.ndarray, int]], turns: int = 8, apart: int = 6, rounds: int = 30, rate: float = 0.1, decay: float = 1e-4, least: float = 0.6, trust: float = 4.0) -> LineCrf:
        """Expectation-maximisation over latent line states, from documents (line features, words a line, quality label).

        Labels are of documents, so line states are latent. They start as the label of their document; then each of ``turns`` turns fits the chain to the
        expected states by ``rounds`` steps of Adam and expects them anew (in the first ``apart`` turns without transitions, each line for itself), given that a good document's lines are mostly content and that
        at least a share ``least`` of a bad one's words is boilerplate. Lines of a bad document that look like content elsewhere so become
        content, and a chain sees changes of state. Documents are cut into pieces of PIECE lines to bound the padding.
        """
        w, m = np.zeros((FEATURES, 2)), np.zeros((2, 2))
        sequences = [s for s in sequences if len(s[0])]
        if len({y for _, _, y in sequences}) < 2:
            w[0, 1] = 1.0  # nothing to learn from: all lines are content
            return cls(w, m)
        pieces = [(d, i) for d, (x, _, _) in enumerate(sequences) for i in range(0, len(x), PIECE)]
        owner = np.array([d for d, _ in pieces])
        bad = np.array([y == 0 for _, _, y in sequences])
        # both labels weigh alike, however often each occurs
        weight = np.where(bad[owner], 0.5 / bad[owner].sum(), 0.5 / (~bad[owner]).sum())
        chains = _Chains([sequences[d][0][i : i + PIECE] for d, i in pieces], weight)
        owner = owner[chains.order]
        words = np.zeros(chains.mask.shape)
        for at, i in enumerate(chains.order):
            d, first = pieces[i]
            words[: chains.size[at], at] = sequences[d][1][first : first + PIECE]
        node = np.zeros((*chains.mask.shape, 2))
        node[..., 0], node[..., 1] = chains.mask & bad[owner], chains.mask & ~bad[owner]
        edges = np.zeros((2, 2))
        for turn in range(turns):
            seen = np.einsum("n,tnf,tns->fs", chains.weight, chains.x, node)
            first = second = np.zeros(w.size + m.size)
            for step in range(1, rounds + 1):
                _, gap_w, gap_m = likelihood(chains, w, m, seen, edges, decay)
                gap = np.r_[gap_w.ravel(), gap_m.ravel()]
                if turn < apart:
                    gap[w.size :] = 0
                first, second = 0.9 * first + 0.1 * gap, 0.999 * second + 0.001 * gap**2
                move = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
                w, m = w + move[: w.size].reshape(w.shape), m + move[w.size :].reshape(2, 2)
            if turn + 1 < turns:
                node, edges = _held(chains, chains.x @ w, m, owner, bad, words, least, trust)
        return cls(w, m)

    def labels(self, rows: list[np.ndarray]) -> list[np.ndarray]:
        """Viterbi paths of many documents at once; ties go to content."""
        if not rows:
            return []
        size = np.array([len(r) for r in rows])
        order = np.argsort(-size, kind="stable")
        score, m = [rows[i] @ self.state for i in order], self.move
        best = np.array([s[0] if len(s) else np.zeros(2) for s in score])
        steps: list[np.ndarray] = []
        live = size[order]
        for k in range(1, int(size.max(initial=0))):
            n = int(np.searchsorted(-live, -k))  # documents with more than k lines
            here = np.array([s[k] for s in score[:n]])
            via = best[:n, :, None] + m
            come = (via[:, 1] >= via[:, 0]).astype(np.int8)
            best[:n] = np.maximum(via[:, 0], via[:, 1]) + here
            steps.append(come)
        out: list[np.ndarray] = [np.empty(0, np.int8)] * len(rows)
        for at, i in enumerate(order):
            path = np.empty(size[i], np.int8)
            if size[i]:
                path[-1] = best[at, 1] >= best[at, 0]
                for k in range(int(size[i]) - 1, 0, -1):
                    path[k - 1] = steps[k - 1][at, path[k]]
            out[i] = path
        return out


def likelihood(chains: _Chains, w: np.ndarray, m: np.ndarray, seen: np.ndarray, edges: np.ndarray, decay: float) -> tuple[float, np.ndarray, np.ndarray]:
    """Penalised expected log likelihood of the chain for expected features by state and expected moves, and its gradients."""
    node, held, total = chains.expect(chains.x @ w, m)
    value = (seen * w).sum() + (edges * m).sum() - total - decay / 2 * ((w**2).sum() + (m**2).sum())
    return float(value), seen - np.einsum("n,tnf,tns->fs", chains.weight, chains.x, node) - decay * w, edges - held - decay * m


def fit_crf(docs: DataFrame, labels: DataFrame, sample: int = TRAIN_DOCS, most_lines: int = TRAIN_LINES) -> LineCrf:
    """A CRF from labelled documents: at most ``sample`` of them, those of smallest hash, one text an id, and of each at most
    ``most_lines`` lines, evenly spaced; their features alone reach the driver. Both bounds concern the fit alone: every line of every document is labelled.
    Ids may be of any type."""
    good = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    # rare bad documents get half of the sample
    picked = None
    for value in (0, 1):
        part = good.where(f"quality = {value}").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample // 2)
        picked = part if picked is None else picked.unionByName(part)
    text = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text is not null").join(F.broadcast(picked), "doc_id")
    text = text.groupBy("doc_id").agg(F.max("text").alias("text"), F.first("quality").alias("quality"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [lines_of(t) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            rows = [(x[at], n[at]) if len(x) > most_lines and (at := np.linspace(0, len(x) - 1, most_lines).astype(int)) is not None else (x, n) for x, n in rows]
            x, n = (pa.array([r[i].astype(kind).tobytes() for r in rows], pa.binary()) for i, kind in enumerate(("<f4", "<i4")))
            yield pa.record_batch({"place": batch.column(0), "quality": batch.column(2), "x": x, "n": n})

    found = text.select(F.xxhash64("doc_id").alias("place"), "text", F.col("quality").cast("long")).mapInArrow(run, "place long, quality long, x binary, n binary")
    found = sorted(found.collect(), key=lambda r: (r["place"], bytes(r["x"])))
    return LineCrf.fit([(np.frombuffer(r["x"], "<f4").reshape(-1, FEATURES).astype(np.float64), np.frombuffer(r["n"], "<i4"), int(r["quality"])) for r in found])


VERDICT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, content_share double, kept boolean"


def _judged(texts: list[bytes], crf: LineCrf, least: float, hashes: WordHashes) -> dict[str, pa.Array]:
    base = np.array([base_counts(t, hashes) for t in texts], np.int64).reshape(-1, 5)
    lines = [lines_of(t) for t in texts]
    paths = crf.labels([x for x, _ in lines])
    share = np.array([float(n[p == 1].sum()) / max(1, int(n.sum())) for (_, n), p in zip(lines, paths, strict=True)])
    failed = (base[:, 0] < 10) | (100 * base[:, 4] > 20 * base[:, 0])
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return {k: pa.array(base[:, i]) for i, k in enumerate(names)} | {"base_failed": pa.array(failed), "content_share": pa.array(share), "kept": pa.array(~failed & (share >= least))}


def quality_rules(docs: DataFrame, crf: LineCrf, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of the base rules, the content share by the CRF's line labels, and the verdict of every whole text.

    Rows ``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, content_share, kept)``, one
    for each input row. The base fails with fewer than 10 words or over 20 % of words in repeated 5-word windows; what
    passes is kept if at least ``least`` of its words lie on content lines. Null or empty texts have no words and
    fail. Ids may be null or repeat; other columns are ignored; an empty table gives no rows. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                part = batch.slice(at, SLICE)
                texts = [t or b"" for t in part.column(1).cast(pa.binary()).to_pylist()]
                yield pa.record_batch({id_col: part.column(0)} | _judged(texts, crf, least, hashes))

    one = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    return one.mapInArrow(run, f"`{id_col}` {one.schema[0].dataType.simpleString()}, {VERDICT}")


def good_documents(docs: DataFrame, crf: LineCrf, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The input rows, whole, whose text the quality rules keep."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            at_text = batch.schema.get_field_index(text_col)
            for at in range(0, len(batch), SLICE):
                part = batch.slice(at, SLICE)
                texts = [t or b"" for t in part.column(at_text).cast(pa.binary()).to_pylist()]
                yield part.filter(_judged(texts, crf, least, hashes)["kept"])

    return docs.mapInArrow(run, docs.schema)


def labelled_lines(docs: DataFrame, crf: LineCrf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``(doc_id, content)``, one for each input row: for every line with words of its text, in order, whether it is content.

    Null and empty texts have an empty list. Ids may be null or repeat; other columns are ignored; an empty table gives no rows. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                part = batch.slice(at, SLICE)
                paths = crf.labels([lines_of(t or b"")[0] for t in part.column(1).cast(pa.binary()).to_pylist()])
                yield pa.record_batch({id_col: part.column(0), "content": pa.array([[bool(y) for y in path] for path in paths], pa.list_(pa.bool_()))})

    one = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    return one.mapInArrow(run, f"`{id_col}` {one.schema[0].dataType.simpleString()}, content array<boolean>")
