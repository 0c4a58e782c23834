"""Line labels of the CRF: planted boilerplate inside clean text, gradients, bounds of the fit."""

import random

import numpy as np
import pytest

from terraloom.llm import quality

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def crf(spark):
    return quality.fit_crf(spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet"))


def test_lines_of_one_document_differ(spark, crf):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = quality.quality_rules(docs, crf).collect()
    mixed = {r.doc_id for r in rows if 0 < r.content_share < 1}
    assert len(mixed) >= 0.04 * len(rows)
    bad = [i for i, q in labels.items() if q == 0]
    assert sum(i in mixed for i in bad) >= 0.3 * len(bad)  # junk under natural first lines
    lines = {r.doc_id: r.content for r in quality.labelled_lines(docs, crf).collect()}
    assert all(any(lines[i]) and not all(lines[i]) for i in mixed)


def test_planted_boilerplate_is_found_by_line(spark, crf):
    """Junk lines of every kind among clean ones of good documents."""
    rng = random.Random(3)
    labels = {r.doc_id for r in spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality = 1").collect()}
    clean = [r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect() if r.doc_id in labels and r.text.count("\n") >= 4][:100]
    kinds = (lambda w: f"{w}###", lambda w: f"{w.upper()}!!", lambda w: f"{w} |", lambda w: " ".join([w] * 8))
    rows, want = [], {}
    for i, text in enumerate(clean):
        lines = [x for x in text.split("\n") if x.strip()]
        flags = [True] * len(lines)
        for _ in range(2):
            words = rng.choice(clean).split()[:12]
            at = rng.randrange(len(lines) + 1)
            lines.insert(at, " ".join(map(rng.choice(kinds), words)))
            flags.insert(at, False)
        rows.append((i, "\n".join(lines)))
        want[i] = flags
    got = {r.doc_id: r.content for r in quality.labelled_lines(spark.createDataFrame(rows, "doc_id long, text string"), crf).collect()}
    planted = [y for i, flags in want.items() for y, flag in zip(got[i], flags, strict=True) if not flag]
    others = [y for i, flags in want.items() for y, flag in zip(got[i], flags, strict=True) if flag]
    assert sum(planted) <= 0.1 * len(planted) and sum(others) >= 0.97 * len(others)


def test_gradient_equals_finite_differences():
    rng = np.random.default_rng(1)
    pieces = [rng.standard_normal((n, quality.FEATURES)) for n in (1, 5, 3, 5)]
    chains = quality._Chains(pieces, np.array([0.3, 0.1, 0.4, 0.2]))
    w, m = rng.standard_normal((quality.FEATURES, 2)), rng.standard_normal((2, 2))
    seen, edges = rng.random((quality.FEATURES, 2)), rng.random((2, 2))
    value, gap_w, gap_m = quality.likelihood(chains, w, m, seen, edges, 0.01)
    for params, gap in ((w, gap_w), (m, gap_m)):
        for at in np.ndindex(params.shape):
            params[at] += 1e-5
            up = quality.likelihood(chains, w, m, seen, edges, 0.01)[0]
            params[at] -= 2e-5
            down = quality.likelihood(chains, w, m, seen, edges, 0.01)[0]
            params[at] += 1e-5
            assert abs((up - down) / 2e-5 - gap[at]) < 1e-6


def test_marginals_equal_all_paths():
    from itertools import product

    rng = np.random.default_rng(2)
    x, w, m = rng.standard_normal((4, quality.FEATURES)), rng.standard_normal((quality.FEATURES, 2)), rng.standard_normal((2, 2))
    chains = quality._Chains([x[:2], x], np.array([0.0, 1.0]))
    node, edges, total = chains.expect(chains.x @ w, m)
    score = {p: np.exp(sum(x[i] @ w[:, s] for i, s in enumerate(p)) + sum(m[a, b] for a, b in zip(p, p[1:], strict=False))) for p in product((0, 1), repeat=4)}
    z = sum(score.values())
    assert abs(np.log(z) - total) < 1e-9
    for i in range(4):
        assert abs(sum(s for p, s in score.items() if p[i] == 1) / z - node[i, 0, 1]) < 1e-9
    for a, b in product((0, 1), repeat=2):
        assert abs(sum(s * sum(p[i : i + 2] == (a, b) for i in range(3)) for p, s in score.items()) / z - edges[a, b]) < 1e-9


def test_bad_documents_meet_their_share():
    """A bad document of plain lines alone still gets boilerplate for the asked share of its words; a good one stays content."""
    x = np.zeros((6, quality.FEATURES))
    x[:, 0] = 1
    chains = quality._Chains([x, x], np.array([0.5, 0.5]))
    node, _ = quality._held(chains, np.zeros((6, 2, 2)), np.zeros((2, 2)), np.array([0, 1]), np.array([True, False]), np.full((6, 2), 3.0), 0.6, 4.0)
    assert abs(node[:, 0, 0].mean() - 0.6) < 0.02 and node[:, 1, 1].min() > 0.95


def test_bounds_of_the_fit_are_parameters(spark):
    docs = spark.createDataFrame([("a", "one two\n" * 50), ("b", "x## y##\n" * 50), (None, "z")], "doc_id string, text string")
    labels = spark.createDataFrame([("a", 1), ("b", 0), (None, 1)], "doc_id string, quality int")
    crf = quality.fit_crf(docs, labels, sample=2, most_lines=5)
    got = {r.doc_id: r.content for r in quality.labelled_lines(docs, crf).collect()}
    assert got["a"] == [True] * 50 and got["b"] == [False] * 50 and len(got[None]) == 1
    assert quality.labelled_lines(docs.limit(0), crf).count() == 0
