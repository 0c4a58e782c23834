"""Periodic runs, Merkle manifests and quality votes against brute force, on whole small tables and made cases."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from terraloom.llm import merkle, neighbours, runs
from terraloom.llm.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, root string, runs string, score string, rank long"
ROWS = [
    (1, "the same text here", "en", "a", 1, "r", "s", "t", 1),
    (1, "the same text here", "en", "a", 1, "r", "s", "t", 1),
    (2, "", "en", None, 0, None, None, None, None),
    (3, None, None, None, None, None, None, None, None),
    (4, "ab ab " * 40_000, "en", "b", None, "r", "s", "t", 1),
    (None, "no id but nine other words in this one line", "en", "b", None, "r", "s", "t", 1),
    (6, " \n\t\r\n ", "en", "b", None, "r", "s", "t", 1),
    (7, "x" * 50_000, "en", "b", None, "r", "s", "t", 1),
]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_runs(words, least=24, times=3):
    """Every period in turn, by comparing all words with those so far away."""
    n, best = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            end = i
            while end + q < n and words[end] == words[end + q]:
                end += 1
            if end + q - i >= max(least, times * q):
                best.setdefault((i, end + q), q)  # periods ascend
            i = end + 1
    return sorted((a, b - a, q) for (a, b), q in best.items())


def found_runs(texts, least=24):
    ids = {}
    flat = np.array([ids.setdefault(w, len(ids)) for t in texts for w in t], np.int64)
    ends = np.cumsum([len(t) for t in texts])
    out = [[] for _ in texts]
    for a, b, q in runs.find_runs(flat, ends, least).tolist():
        k = int(np.searchsorted(ends, a, "right"))
        out[k].append((a - int(ends[k]) + len(texts[k]), b - a, q))
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), min_size=1, max_size=4), st.sampled_from([3, 6, 24]))
def test_runs_of_small_alphabets(texts, least):
    assert found_runs(texts, least) == [plain_runs(t, least) for t in texts]


def test_runs_of_planted_loops():
    rng = random.Random(5)
    texts = []
    for _ in range(60):
        words = [rng.randrange(50) for _ in range(rng.randrange(10, 200))]
        for _ in range(rng.randrange(3)):
            block = [rng.randrange(4) for _ in range(rng.randrange(1, 40))]
            block *= rng.randrange(2, 6)
            at = rng.randrange(len(words))
            words[at:at] = block + block[: rng.randrange(len(block))]
        texts.append(words)
    want = [plain_runs(t) for t in texts]
    assert found_runs(texts) == want and sum(map(len, want)) > 20


def test_op11(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, FOLDER).collect()}
    assert got.keys() == docs.keys()
    some = 0
    for i, text in docs.items():
        words = [w.decode() for w in (text or "").encode().split()]
        n, h = len(words), zlib.crc32(str(i).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[j if j < a else a + (j - a) % p] for j in range(n)]
        found = plain_runs(words)
        some += len(found) > 0
        r, top = got[i], max(found, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=(None,) * 3)
        assert (r.n_runs, r.start, r.length, r.period) == (len(found), *top)
        assert r.exponent_milli == (None if not found else 1000 * top[1] // top[2])
        gone = {j for a, m, q in found for j in range(a + q, a + m)}
        assert r.runs_sha256 == sha("".join(f"{a},{m},{q}\n" for a, m, q in found))
        assert r.collapsed_sha256 == sha(" ".join(w for j, w in enumerate(words) if j not in gone))
    assert some > 5


def test_runs_edges(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    out = runs.periodic_runs(docs)
    by = {}
    for r in out.collect():
        by.setdefault(r.doc_id, []).append((r.n_words, [tuple(x) for x in r.runs], r.collapsed[:12]))
    assert by[1] == [(4, [], "the same tex")] * 2 and by[2] == by[3] == by[6] == [(0, [], "")]
    assert by[4] == [(80_000, [(0, 80_000, 2)], "ab")] or by[4] == [(80_000, [(0, 80_000, 1)], "ab")]
    assert by[None][0][0] == 10 and by[7] == [(1, [], "x" * 12)]
    assert runs.looped(docs).columns == docs.columns and runs.looped(docs).count() == len(ROWS)
    assert runs.periodic_runs(docs.limit(0)).count() == 0 and runs.looped(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        runs.periodic_runs(docs, times=2)


def test_highest_takes_exact_ratios(spark):
    many = spark.sql("select array(named_struct('start', 5L, 'length', 2147483642L, 'period', 715827880L), named_struct('start', 7L, 'length', 2147483639L, 'period', 715827879L)) as runs")
    assert 2147483642 / 715827880 == 2147483639 / 715827879  # as doubles
    want = max(((5, 2147483642, 715827880), (7, 2147483639, 715827879)), key=lambda x: Fraction(x[1], x[2]))
    assert many.select(runs.highest(many["runs"])).first()[0].start == want[0]
    tied = spark.sql("select array(named_struct('start', 5L, 'length', 30L, 'period', 3L), named_struct('start', 7L, 'length', 40L, 'period', 4L)) as runs")
    assert tied.select(runs.highest(tied["runs"])).first()[0].start == 5


def plain_tree(nodes):
    """Root and witness (siblings by level) of every leaf, by whole levels."""
    at, paths = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for k, place in enumerate(at):
            run = nodes[place // 16 * 16 : place // 16 * 16 + 16]
            paths[k].append(("".join(run[: place % 16]), "".join(run[place % 16 + 1 :])))
        nodes = [sha("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]
        at = [place // 16 for place in at]
    return nodes[0] if nodes else None, paths


def plain_manifest(leaves):
    """By (source, id, leaf): subroot, root, witness."""
    groups = {}
    for source, i, leaf in sorted(leaves, key=lambda x: ((x[0] is not None, (x[0] or "").encode()), (x[1] is not None, x[1] or 0), x[2])):
        groups.setdefault(source, []).append((i, leaf))
    trees = {s: plain_tree([leaf for _, leaf in rows]) for s, rows in groups.items()}
    root, crown = plain_tree([r for r, _ in trees.values()])
    out = []
    for (s, (subroot, paths)), upper in zip(trees.items(), crown, strict=True):
        out += [(s, i, leaf, subroot, root, path + upper) for (i, leaf), path in zip(groups[s], paths, strict=True)]
    return out


def rows_of(found):
    return sorted(((r.source, r.doc_id, r.leaf, r.subroot, r.root, [(w.before, w.after) for w in r.witness]) for r in found.collect()), key=str)


@pytest.mark.parametrize("sizes", [[1], [2], [16, 17], [255, 256, 257, 1], [1, 1, 1], [5000, 3]])
def test_merkle_of_many_sizes(spark, sizes):
    leaves = [(None if s == 1 else f"s{s}é", i, sha(f"{s}/{i}")) for s, n in enumerate(sizes) for i in range(n)]
    random.Random(1).shuffle(leaves)
    got = merkle.merkle_manifest(spark.createDataFrame(leaves, "source string, doc_id long, leaf string"), leaf="leaf", tree="source", order="doc_id")
    assert rows_of(got) == sorted(plain_manifest(leaves), key=str)


def test_merkle_of_many_trees(spark):
    leaves = [(f"s{s}", i, sha(f"{s}/{i}")) for s in range(300) for i in range(1 + s % 3)]
    got = merkle.merkle_manifest(spark.createDataFrame(leaves, "source string, doc_id long, leaf string"), leaf="leaf", tree="source", order="doc_id")
    assert rows_of(got) == sorted(plain_manifest(leaves), key=str)


def test_merkle_edges(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    leaves = docs.withColumn("leaf", merkle.leaf_digest(docs["doc_id"], docs["text"]))
    out = merkle.merkle_manifest(leaves, leaf="leaf", tree="source", order="doc_id")
    assert {*out.columns} == {*leaves.columns, "subroot", "witness"} and "rank" in out.columns
    found = out.collect()
    assert sorted((r.source or "", r.doc_id or 0) for r in found) == sorted((r[3] or "", r[0] or 0) for r in ROWS)
    plain = {(r[0], r[1]): sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r[:2])) for r in ROWS}
    assert all(r.leaf == plain[r.doc_id, r.text] for r in found)
    assert out.where(merkle.folded(out["leaf"], out["witness"]) != out["root"]).count() == 0
    assert merkle.merkle_manifest(leaves.limit(0), leaf="leaf", tree="source", order="doc_id").count() == 0


def test_op12(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    enc = lambda *vs: sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in vs))
    leaf = {r.doc_id: enc(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs}
    by = {r.doc_id: r for r in docs}
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    got = {r.doc_id: r for r in QUERIES["op12_merkle"](spark, FOLDER).collect()}
    assert got.keys() == by.keys()
    failed = 0
    for _, i, own, subroot, root, path in plain_manifest([(r.source, r.doc_id, leaf[r.doc_id]) for r in docs]):
        r, node = by[i], own
        if zlib.crc32(str(i).encode()) % 5 == 0 and r.text is not None:
            node = enc(r.doc_id, r.source, r.lang, r.n_chars, r.text.translate(lower))
        for before, after in path:
            node = sha(before + node + after)
        failed += node != root
        assert got[i].asDict() == {"doc_id": i, "leaf": own, "subroot": subroot, "root": root, "proof_sha256": sha("".join(b + a for b, a in path)), "folded_root": node, "verified": node == root}
    assert 0 < failed < len(by)


def test_op13_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op13_quality_votes"](spark, folder).collect()}
    assert len(got) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for i, r in got.items())
    held = [(got[i].predicted, q) for i, q in labels.items() if got[i].held_out]
    assert np.mean([p == q for p, q in held]) >= 0.95
    for value in (0, 1):
        assert np.mean([p == q for p, q in held if q == value]) >= 0.9


def test_votes_against_plain_ones(spark):
    texts = ["the cat sat", "the dog sat ###", "SALE!! SALE!!", "a cat and a dog", "", "zz## zz##", "the the the cat"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    marks = spark.createDataFrame([(0, 1), (1, 1), (2, 0), (5, 0), (3, 1)], "doc_id long, quality int")
    votes = neighbours.fit_votes(docs, marks, rank=4)
    # plain: document frequencies, weights, singular vectors and votes one by one
    codes = neighbours.TermCodes()
    kinds = (range(neighbours.WORDS), range(neighbours.WORDS, neighbours.WORDS + neighbours.SHAPES), range(neighbours.WORDS + neighbours.SHAPES, neighbours.TERMS))
    count = [{} for _ in texts]
    for c, t in zip(count, texts, strict=True):
        words = t.split()
        for code in (codes[w.encode()] for w in words):
            for term in (code // neighbours.TERMS, code % neighbours.TERMS):
                c[term] = c.get(term, 0) + 1
        if words:
            share = sum(a == b for a, b in zip(words, words[1:], strict=False)) / max(1, len(words) - 1)
            c[kinds[2][0] + int(np.ceil(31 * share**0.5))] = c[kinds[2][0] + 32] = 1  # no text has two lines
    idf = lambda t: np.log((1 + len(texts)) / (1 + sum(t in c for c in count))) + 1
    x = np.zeros((len(texts), neighbours.TERMS))
    for row, c in zip(x, count, strict=True):
        for t, n in c.items():
            row[t] = (1 + np.log(n)) * idf(t)
        for kind in kinds:
            row[kind] /= max(np.linalg.norm(row[kind]), 1e-30)
    marked = {r.doc_id: r.quality for r in marks.collect()}
    u, s, vt = np.linalg.svd(x[sorted(marked)], full_matrices=False)
    y = x @ vt[:4].T
    y /= np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-30)
    for r in neighbours.vote_scores(docs, votes, voters=3).collect():
        sims = sorted(((float(y[r.doc_id] @ y[i]), q) for i, q in marked.items()), reverse=True)[:3]
        total = sum(max(s, 0) for s, _ in sims)
        want = sum(max(s, 0) * q for s, q in sims) / total if total > 1e-6 else 3 / 5
        assert abs(r.score - want) < 1e-3


def test_votes_edges(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    marks = spark.createDataFrame([(1, 1), (1, 0), (4, 1), (9, 0), (None, 1), (7, None)], "doc_id long, quality int")
    got = neighbours.vote_scores(docs, neighbours.fit_votes(docs, marks)).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in got if r.doc_id in (2, 3, 6)} == {0.5}  # ids 1 (label 0) and 4 (label 1) vote
    none = neighbours.fit_votes(docs, marks.limit(0))
    assert {r.score for r in neighbours.vote_scores(docs, none).collect()} == {0.5}
    assert neighbours.vote_scores(docs.limit(0), neighbours.fit_votes(docs.limit(0), marks)).count() == 0


def test_nearest_breaks_ties_by_place():
    cosine = np.array([[0.5, 0.9, 0.5, 0.5], [1.0, 1.0, 1.0, 1.0]])
    assert neighbours._nearest(cosine, 2).tolist() == [[0, 1], [0, 1]]
