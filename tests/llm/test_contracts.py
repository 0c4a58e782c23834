"""Registered queries of the text operators against brute force, the tokenizers library and DuckDB, on whole small tables."""

import glob
import hashlib
import os
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from terraloom.llm.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def rows(spark, name, key="doc_id"):
    return {r[key]: r for r in QUERIES[name](spark, FOLDER).collect()}


def components(ids, linked):
    label = {i: i for i in ids}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in linked:
        a, b = sorted((root(a), root(b)))
        label[b] = a
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    got, want = QUERIES[name](spark, FOLDER).toPandas(), con.execute(ORACLES[name]).df()
    columns = sorted(got.columns)
    plain = lambda v: "~" if v is None or str(v) in ("<NA>", "nan", "None") else f"{float(v):.9g}" if isinstance(v, (int, float, np.number)) else str(v)
    table = lambda f: sorted(tuple(map(plain, r)) for r in f[columns].itertuples(index=False))
    assert columns == sorted(want.columns) and table(got) == table(want)


def test_line_dedup(spark, docs):
    seen, want = [], {}
    for i in sorted(docs):
        gone = []
        for p, line in enumerate((docs[i] or "").split("\n")):
            s = set(WORD.findall(line))
            if s and any(100 * len(s & o) >= 80 * len(s | o) for o in seen):
                gone.append(p)
            if s:
                seen.append(s)
        want[i] = ",".join(map(str, gone))
    assert {k: r.removed for k, r in rows(spark, "op1_line_dedup").items()} == want


def test_licences(spark, docs):
    got = rows(spark, "op2_licences")
    notices = {"Released under the MIT License.": "MIT", "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0"}
    for i, text in docs.items():
        want = sorted({notices[x] for x in (text or "").split("\n") if x in notices})
        assert got[i].licences == ",".join(want) and got[i].n_matches == sum(x in notices for x in (text or "").split("\n"))


def test_quality_base(spark, docs):
    got = rows(spark, "op3_quality")
    for i, text in docs.items():
        text = text or ""
        words = WORD.findall(text)
        runs = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
        twice = {r for r, n in Counter(runs).items() if n > 1}
        repeat = len({k + j for k, r in enumerate(runs) if r in twice for j in range(5)})
        lines = [x for x in text.split("\n") if WORD.search(x)]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), repeat)
        assert r.base_failed == (len(words) < 10 or 100 * repeat > 20 * len(words)) and not (r.base_failed and r.kept)


def test_quality_verdict_on_labels_held_out(spark):
    from terraloom.llm.quality import fit_crf, quality_rules

    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    half = labels.where("pmod(xxhash64(doc_id, 5), 2) = 0")
    judged = quality_rules(docs, fit_crf(docs, half)).join(labels.join(half, "doc_id", "left_anti"), "doc_id").collect()
    good = [r for r in judged if r.quality == 1 and not r.base_failed]
    bad = [r for r in judged if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.97 * len(good)
    assert sum(r.kept for r in bad) <= 0.1 * len(bad)


def test_bpe_and_token_files(spark, docs):
    coded = {i: TOKENIZER.encode(t or "", add_special_tokens=False).ids for i, t in docs.items()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got, files, start = rows(spark, "op4_bpe"), rows(spark, "op5_token_files"), 0
    for i in sorted(docs):
        ids = coded[i]
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(TOKENIZER.decode(ids, skip_special_tokens=False)))
        assert (files[i].start, files[i].n_tokens, files[i].ids_crc32) == (start, len(ids) + 1, zlib.crc32(np.array([*ids, 1], "<u4").tobytes()))
        start += len(ids) + 1


def test_tokens_at_equals_the_stream(spark, docs, tmp_path, monkeypatch):
    import terraloom.llm.token_files as files

    monkeypatch.setattr(files, "SEGMENT_IDS", 3_000)  # several segments a part
    path = f"file://{tmp_path}/tokens"
    files.write_token_files(spark.read.parquet(f"{FOLDER}/documents.parquet").repartition(5), public_tokenizers.path("word_bpe_49k.json"), path)
    stream = [t for i in sorted(docs) for t in [*TOKENIZER.encode(docs[i] or "", add_special_tokens=False).ids, 1]]
    asked = [*range(0, len(stream), 97), len(stream) - 1]
    frame = spark.createDataFrame([(p,) for p in [*asked, 0, -1, len(stream), None]], "position long")
    got = files.tokens_at(spark, path, frame).collect()
    assert sorted((r.position, r.token_id) for r in got) == sorted({(p, stream[p]) for p in asked})


def test_own_tables_go(spark, tmp_path):
    from terraloom.llm.line_dedup import line_dedup
    from terraloom.llm.shared import WORKSPACE, saved, workspace

    text = spark.createDataFrame([(1, "a b c d e f\nx y z u v w"), (2, "a b c d e f g\nother words stand here now")], "doc_id long, text string")
    spark.conf.set(WORKSPACE, f"file://{tmp_path}")
    try:
        kept = {r.doc_id: (r.n_lines, r.removed) for r in line_dedup(text).collect()}
        assert kept == {1: (2, []), 2: (2, [0])}
        assert [x.split("-")[0] for x in os.listdir(tmp_path)] == ["removed"]  # what the result reads
        with workspace(spark):
            saved(text, "table")
            assert any(x.startswith("workspace") for x in os.listdir(tmp_path))
        assert [x.split("-")[0] for x in os.listdir(tmp_path)] == ["removed"]
    finally:
        spark.conf.unset(WORKSPACE)


def test_names_of_their_own(spark):
    import corpus_pipeline
    from terraloom.llm.line_dedup import line_dedup
    from terraloom.llm.mixing import emitted, mixed

    columns = "doc_id long, text string, source string, _doc int, _gone int, _source string, _copy int, _turn int"
    rows_ = [(1, "one two three four five six", "a", 7, 7, "s", 7, 7), (2, "one two three four five six", "b", 7, 7, "s", 7, 7), (3, "other words that stand alone here", None, 7, 7, None, 7, 7)]
    frame = spark.createDataFrame(rows_, columns)
    assert {r.doc_id: (r.n_removed, r._doc, r._gone) for r in line_dedup(frame).collect()} == {1: (0, 7, 7), 2: (1, 7, 7), 3: (0, 7, 7)}
    assert {(r._copy, r._source) for r in emitted(mixed(frame), frame.columns).collect()} <= {(7, "s"), (7, None)}
    twice = frame.unionByName(spark.createDataFrame([(1, "a wholly different text under one id", "a", 7, 7, "s", 7, 7), rows_[0]], columns))
    left = sorted((r.doc_id, r.text, r._turn) for r in corpus_pipeline.near(spark, twice, FOLDER).collect())
    assert left == [(1, "a wholly different text under one id", 7), (1, rows_[0][1], 7), (3, rows_[2][1], 7)]


@pytest.mark.parametrize("percent", [80, 60])
def test_lines_against_brute_force(spark, percent):
    """Common and rare words, near copies of near copies, short and long lines, more than 64 in a group."""
    from terraloom.llm.line_dedup import repeated_lines

    rng = np.random.default_rng(11)
    words = [f"w{i}" for i in range(400)]
    base = [list(rng.choice(words, n)) for n in (3, 4, 5, 8, 12, 30, 40, 90, 200)]
    lines = []
    for _ in range(120):
        for b in base:
            line = list(b)
            for k in rng.choice(len(line), rng.integers(0, max(1, len(line) // 4) + 1), replace=False):
                line[k] = str(rng.choice(words)) if rng.random() < 0.7 else f"new{rng.integers(1e6)}"
            lines.append(" ".join(line))
    docs_ = [(i, "\n".join(lines[4 * i : 4 * i + 4])) for i in range(len(lines) // 4)]
    seen, want = [], set()
    for i, text in docs_:
        for p, line in enumerate(text.split("\n")):
            s = set(line.split())
            if any(100 * len(s & o) >= percent * len(s | o) for o in seen):
                want.add((i, p))
            seen.append(s)
    got = [(r.doc_id, r.pos) for r in repeated_lines(spark.createDataFrame(docs_, "doc_id long, text string"), percent).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 300


def test_mixing_comes_near_its_targets(spark):
    out = QUERIES["op6_mixing"](spark, "/root/testdata/sf0.1").toPandas()
    for _, g in out.groupby("source_size"):
        rate = g.target.iloc[0] / g["size"].sum()
        spread = float((g["size"] ** 2).sum() * (rate % 1) * (1 - rate % 1)) ** 0.5  # deviation of independent draws
        assert abs(g.taken.sum() - g.target.iloc[0]) <= 4 * spread + 1
    assert (out.taken <= 2 * out["size"]).all()
    sources = out.drop_duplicates("source_size")
    assert sources.target.sum() == pytest.approx(1.5 * sources.source_size.sum())
    assert (sources.target <= 2 * sources.source_size + 1e-6).all()


def test_personal_data_base(spark, docs):
    def found(text):
        def luhn(s):
            d = [int(c) for c in s[::-1]]
            return (sum(d[0::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0

        digits = lambda s: re.sub("[^0-9]", "", s)
        rules = [
            ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
            ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
            ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 14 <= len(digits(s)) <= 19 and luhn(digits(s))),
            ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 10 <= len(digits(s)) <= 15),
        ]
        return [(m.start(), k, kind, m.end()) for k, (kind, rule, ok) in enumerate(rules) for m in re.finditer(rule, text) if ok(m[0])]

    got = rows(spark, "op9_pii")
    odd = {0: "a@b.c@d.e x.y@z", 1: "1.2.3.4.5.6.7.8 999.1.1.1 1.2.3", 2: "+1 (555) 123-4567. +12 ++1-222-333-4444", 3: "4111 1111 1111 1111-4111111111111111 " + "9" * 40, 4: "é@b.co a..b@c-.d-.e @x.y u@v 😀+1 5551234567", 5: "x@" * 50 + "y.z"}
    from terraloom.llm.pii import KINDS, scan

    frame = spark.createDataFrame(list(odd.items()), "doc_id long, text string")
    for r in scan(frame).collect():
        assert [(s.start, s.kind, KINDS[s.kind], s.end) for s in r.spans if s.base] == sorted(found(odd[r.doc_id]))
    for i, text in docs.items():
        spans = sorted(found(text or ""))
        assert got[i].base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, k, b in spans).encode()).hexdigest()
        assert (got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone) == tuple(sum(s[2] == k for s in spans) for k in KINDS[:4])
        assert {f"{k}:{a}:{b}" for a, _, k, b in spans} <= set(got[i].spans.split(","))


def test_minhash(spark, docs):
    sets = {}
    for i, text in docs.items():
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(w[k : k + 2]) for k in range(max(1, len(w) - 1))} if w else set()
    ids = sorted(sets)
    linked = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = components(ids, linked)
    got = rows(spark, "op10_minhash")
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {i: (len(sets[i]), want[i], want[i] == i) for i in ids}


def test_near_vectors(spark):
    from terraloom.llm.embeddings import near_vectors

    rng = np.random.default_rng(3)
    base = rng.standard_normal((60, 64))
    made = np.vstack([rng.standard_normal((300, 64)), *(b + rng.uniform(0.05, 0.4) * rng.standard_normal((9, 64)) for b in base), base[:5], base[:5]])
    data = [(i, [float(x) for x in v]) for i, v in enumerate(made.astype(np.float32))]
    n = len(data)
    data += [(n, None), (n + 1, [0.0] * 64), (n + 2, [float("nan")] * 64), (n + 3, [1.0] * 8), (n + 4, [])]
    x = np.array([v for _, v in data[:n]])
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = np.argwhere(np.triu(x @ x.T >= 0.9, 1))
    degree = Counter(near.ravel().tolist())
    got = {r.vec_id: r for r in near_vectors(spark.createDataFrame(data, "vec_id long, embedding array<double>")).collect()}
    assert len(got) == n + 5 and len(near) > 500
    assert all(got[i].n_links <= degree[i] for i in range(n))
    assert sum(got[i].n_links for i in range(n)) >= 0.97 * 2 * len(near)
    assert all(got[n + k].n_links == 0 and got[n + k].component_id == n + k for k in range(5))
    true = components(range(n), map(tuple, near.tolist()))
    assert sum(got[i].component_id == true[i] for i in range(n)) >= 0.97 * n


def test_pipeline(spark, docs):
    import corpus_pipeline
    from terraloom.llm.quality import fit_crf, quality_rules

    out = corpus_pipeline.run(spark, FOLDER).collect()
    d, labels = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    kept = {r.doc_id for r in quality_rules(d, fit_crf(d, labels)).where("kept").collect()}
    seen, texts = [], {}
    for i in sorted(kept):
        left, words = [], False
        for line in docs[i].split("\n"):
            s = set(WORD.findall(line))
            if not (s and any(100 * len(s & o) >= 80 * len(s | o) for o in seen)):
                left.append(line)
                words |= bool(s)
            if s:
                seen.append(s)
        if words:
            texts[i] = "\n".join(left)
    sets = {i: (lambda w: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))})(WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t))) for i, t in texts.items()}
    ids = sorted(sets)
    groups = components(ids, [(a, b) for k, a in enumerate(ids) for b in ids[:k] if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])])
    alone = {i for i in ids if groups[i] == i}
    copies = Counter(r.doc_id for r in out)
    assert set(copies) <= alone and max(copies.values()) <= 2
    assert len(alone) > 50 and len(copies) >= 0.5 * len(alone)
    for r in out:
        assert list(r.token_ids) == TOKENIZER.encode(texts[r.doc_id], add_special_tokens=False).ids
