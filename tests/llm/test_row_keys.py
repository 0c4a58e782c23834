"""Repeated and null ids in line dedup and the pipeline's near stage, against brute force."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from terraloom.llm.line_dedup import line_dedup, repeated_lines
from terraloom.llm.shared import ranked, row_keys, text_print


def test_only_lines_that_an_earlier_one_matches_go(spark):
    known = "alpha beta gamma delta epsilon zeta"
    rows = [(1, known), (2, f"{known}\nunique one two three"), (2, "wholly other words of text b\nsecond line kept"), (None, f"{known}\nnobody else has this"), (None, "nobody else has this\nnor that one here")]
    out = sorted((r.doc_id or 9, r.text, r.n_lines, tuple(r.removed)) for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    nulls = [x for x in out if x[0] == 9]
    assert [x for x in out if x[0] != 9] == [(1, known, 1, ()), (2, "unique one two three", 2, (0,)), (2, "wholly other words of text b\nsecond line kept", 2, ())]
    # of the two texts without id the one that comes first by hash keeps the line they share
    assert sorted(x[1] for x in nulls) in (["nobody else has this", "nor that one here"], ["", "nobody else has this\nnor that one here"])


def test_line_dedup_of_repeated_ids_against_brute_force(spark):
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(60)]
    base = [list(rng.choice(words, n)) for n in (4, 6, 9, 14, 30)]

    def line():
        b = list(base[rng.integers(len(base))])
        for k in rng.choice(len(b), rng.integers(0, 3), replace=False):
            b[k] = str(rng.choice(words))
        return " ".join(b)

    rows = [(None if rng.random() < 0.2 else int(rng.integers(0, 25)), "\n".join(line() for _ in range(rng.integers(1, 5)))) for _ in range(80)]
    rows += rows[:10]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    order = {(r.doc_id, r.text): (r.doc_id is None, r.doc_id or 0, r.p) for r in frame.withColumn("p", text_print(F.col("text"))).collect()}
    seen, gone = [], {}
    for key in sorted(order, key=order.get):
        for p, text in enumerate(key[1].split("\n")):
            s = set(text.split())
            if any(100 * len(s & o) >= 80 * len(s | o) for o in seen):
                gone.setdefault(key, set()).add(p)
            seen.append(s)
    out = line_dedup(frame).collect()
    want = sorted(((i, "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone.get((i, t), ()))) for i, t in rows), key=str)
    assert sorted(((r.doc_id, r.text) for r in out), key=str) == want and len(gone) > 20
    assert sum(r.n_removed for r in repeated_lines(frame).groupBy("doc_id", "nth").agg(F.count("*").alias("n_removed")).collect()) == sum(map(len, gone.values()))


def test_near_stage_compares_texts_of_repeated_and_null_ids(spark):
    rng = np.random.default_rng(5)
    text = lambda: " ".join(f"x{rng.integers(10_000)}" for _ in range(60))
    one, two, three = text(), text(), text()
    near_one = f"{one} tail"
    rows = [(1, one), (1, one), (1, two), (2, near_one), (None, f"{two} end"), (None, three), (3, text()), (None, three)]
    frame = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.near(spark, frame, "")
    assert out.columns == frame.columns
    left = [r.text for r in out.collect()]
    assert len(left) == 4
    assert sum(t in (one, near_one) for t in left) == sum(t in (two, f"{two} end") for t in left) == sum(t == three for t in left) == sum(t == rows[6][1] for t in left) == 1


def test_row_keys(spark):
    schema = "doc_id long, text string, more int"
    plain = spark.createDataFrame([(5, "a", 1), (7, None, 2)], schema)
    assert sorted((r.key, r.doc_id) for r in row_keys(plain, "key").collect()) == [(5, 5), (7, 7)]
    low, high = -(1 << 63), (1 << 63) - 1
    for ids in ((5, 5, 7, None), (low, low, 3, None), (None, None, None, 2), (high - 2**40, 1, 1, None)):
        rows = [(i, t, 0) for i in ids for t in ("a", "b", None, "a")]
        found = row_keys(spark.createDataFrame(rows, schema), "key").collect()
        assert len({r.key for r in found}) == len(found)
        assert {(r.doc_id, r.text) for r in found} == {(i, t) for i, t, _ in rows} and len(found) == len({(i, t) for i, t, _ in rows})
    assert row_keys(plain.limit(0), "key").count() == 0


def test_ranked(spark):
    rows = [(f"k{i % 3}", i * 37 % 101) for i in range(100)] + [("k0", None)]
    got = ranked(spark.createDataFrame(rows, "by string, at long"), "by", ["at"]).collect()
    for k in ("k0", "k1", "k2"):
        own = sorted((r["rank"], r.at, r.total) for r in got if r.by == k)
        assert [x[0] for x in own] == list(range(len(own))) and {x[2] for x in own} == {len(own)}
        assert [x[1] for x in own] == sorted((a for b, a in rows if b == k), key=lambda a: (a is not None, a))


def test_line_dedup_moves_the_text_only_for_those_who_want_it(spark):
    rows = [(1, "a b c d e f g h i j\nk l m n o p"), (2, "a b c d e f g h i j\nq"), (3, None), (4, "")]
    out = line_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: (r.n_lines, r.n_removed, r.removed, r.text) for r in out.collect()}
    assert got == {1: (2, 0, [], rows[0][1]), 2: (2, 1, [0], "q"), 3: (0, 0, [], None), 4: (0, 0, [], "")}
    plan = out.drop("text")._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(plan) if "Join LeftOuter" in line)
    assert not re.search(r"[\[ ]text#\d+[,\]]", plan[at + 1])  # the side of the documents


def test_line_dedup_finds_near_lines_of_rare_and_of_common_words(spark):
    """Against brute force where all words are common, where none is, and where they mix."""
    draw = random.Random(5)
    words = [[f"c{i}" for i in range(60)], [f"r{i}" for i in range(4000)]]
    lines = []
    for share in (0, 0.5, 1):
        for _ in range(40):
            first = [draw.choice(words[draw.random() < share]) for _ in range(draw.choice((4, 9, 20, 45, 90)))]
            lines.append(first)
            for _ in range(2):
                lines.append([draw.choice(words[1]) if draw.random() < 0.08 else w for w in first])
    draw.shuffle(lines)
    sets, want = [set(x) for x in lines], {}
    for i, s in enumerate(sets):
        want[i] = [0] if any(len(s & o) * 100 >= 80 * len(s | o) for o in sets[:i]) else []
    frame = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(lines)], "doc_id long, text string")
    assert sum(map(len, want.values())) > 40
    assert {r.doc_id: r.removed for r in line_dedup(frame).collect()} == want
