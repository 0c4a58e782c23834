"""Rounded vectors lose no link."""

import numpy as np

from terraloom.llm import embeddings


def test_bound_holds_for_every_pair():
    rng = np.random.default_rng(1)
    base = rng.normal(size=(40, 24))
    x = np.r_[base, base + rng.normal(0, 0.45, base.shape), base * 3, np.eye(24)[:5], -base[:3]]
    data = [v.astype("<f8").tobytes() for v in x]
    unit = embeddings.unit_vectors(data)
    import pyarrow as pa

    out = pa.Table.from_batches(embeddings._coarse(iter([pa.record_batch({"rep": pa.array(range(len(x))), "vec": pa.array(data)})])))
    q = np.array([np.frombuffer(b, np.int8) * s for b, s in zip(out.column("coarse").to_pylist(), out.column("step").to_pylist(), strict=True)])
    rest = out.column("rest").to_numpy()
    assert np.allclose(np.sqrt(((unit - q) ** 2).sum(1)), rest) and out.column("coarse").type == pa.binary()
    every = np.arange(len(x))
    for least in (0.5, 0.9, 0.999999):
        may, is_ = embeddings.may_reach(q, rest, every, every, least), unit @ unit.T >= least
        assert not (is_ & ~may).any() and may.sum() < len(x) ** 2 / 2


def test_links_equal_those_of_whole_vectors(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 16))
    x = np.r_[base, base + rng.normal(0, 0.3, base.shape), base[:20] * 2.0]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.9) & ~np.eye(len(x), dtype=bool)
    got = {r.vec_id: r.n_links for r in embeddings.near_vectors(frame).collect()}
    total = int(near.sum())
    assert all(got[i] <= near[i].sum() for i in got) and sum(got.values()) >= 0.95 * total > 50


def test_large_groups_through_pivots_equal_brute_force(spark, monkeypatch):
    """Groups of several blocks: copies near one text, chains that reach far from it, and texts that one bucket throws together."""
    from terraloom.llm import minhash

    monkeypatch.setattr(minhash, "BLOCK", 8)
    monkeypatch.setattr(minhash, "SMALL_BUCKET", 3)
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for i in range(60):  # near the first
        words = list(base)
        for k in rng.choice(60, rng.integers(0, 3), replace=False):
            words[k] = f"x{rng.integers(1e9)}"
        texts.append(words)
    words = list(base)
    for i in range(40):  # a chain: each near the one before, the last far from the first
        words = list(words)
        words[i] = f"c{i}"
        texts.append(words)
    for i in range(40):  # far from all, but for a shared half
        texts.append(base[:30] + [f"f{i}_{k}" for k in range(30)])
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    sets = [{tuple(t[j : j + 2]) for j in range(len(t) - 1)} for t in texts]
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                label[b] = a
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=2).collect()}
    want = {i: root(i) for i in range(len(rows))}
    assert got == want and len(set(want.values())) > 30
