"""Licences inside longer texts, over several lines and inside long lines."""

import pytest

from terraloom.llm import licences as L

TEXTS = L.full_texts()
PROSE = "\n".join(f"Plain prose number {i} tells of rivers, hills and the {i * 7} mills beside them." for i in range(60))
BODIES = [(k, t) for k, ts in TEXTS.items() for t in ts]


def found(spark, texts, **kw):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: [(m.line, m.licence) for m in r.matches] for r in L.licences(df, **kw).collect()}


def test_full_texts_inside_longer_documents(spark):
    got = found(spark, [f"{PROSE}\n{t}\n{PROSE}" for _, t in BODIES])
    for i, (name, _) in enumerate(BODIES):
        assert name in {x for _, x in got[i]}, name
    # bodies name no other licence of their own size
    short = [i for i, (_, t) in enumerate(BODIES) if len(t) < 2000]
    assert all({x for _, x in got[i]} == {BODIES[i][0]} for i in short)
    assert found(spark, [PROSE])[0] == []


def test_comment_headers(spark):
    header = "".join(f" * {x}\n" for x in TEXTS["MIT"][0].split("\n"))
    assert found(spark, [f"/*\n * Copyright (c) 2020 Somebody\n{header} */\n{PROSE}"])[0] == [(2, "MIT")]


def test_wrapped_and_undelimited_notices(spark):
    wrapped = f"{PROSE}\nThis work is licensed under the GNU General\nPublic License, version 3.\n{PROSE}"
    inside = "rivers and hills " * 60 + "released under the MIT License " + "mills and fields " * 60
    two = f"{wrapped}\n{inside}"
    got = found(spark, [wrapped, inside, two])
    assert got[0] == [(60, "GPL-3.0")] and got[1] == [(0, "MIT")] and got[2] == [(60, "GPL-3.0"), (122, "MIT")]


def test_spaces_do_not_count(spark):
    padded = " " * 40_000 + "Released under the MIT License."
    many = " ".join(["Released under the MIT License"] * 500)
    got = found(spark, [padded, many], templates={"MIT": ("Released under the MIT License.",)})
    assert got[0] == [(-1, "MIT"), (0, "MIT")] and (0, "MIT") in got[1]


def test_templates_of_callers(spark):
    own = "Use it as you like.\nName us where you show it.\nSell none of it to strangers who ask."
    assert found(spark, [f"{PROSE}\n{own}\n{PROSE}"], templates={"own": (own,)})[0] == [(60, "own")]


@pytest.mark.parametrize("noise", [0, 3, 9])
def test_windows_equal_brute_force(noise):
    t = L.Templates({"a": ("one two three four five six seven",)}, 0.8)
    words = ["x", "one", "two", "one", "two", "three", *["y"] * noise, "four", "five", "six", "seven", "one", "z", "three", "four"] * 2
    pairs = list(zip(words, words[1:]))
    grams = t.sets[0][1]
    dice = lambda a, b: 2 * len(grams & set(pairs[a:b])) / (len(grams) + len(set(pairs[a:b])))
    best = max(dice(a, b) for a in range(len(pairs)) for b in range(a + 1, len(pairs) + 1))
    got = [d for *_, d in t.windows(pairs, 0)]
    assert bool(got) == (best >= 0.8) and (not got or abs(max(got) - best) < 0.1)


def test_spelling_marks_and_copyright_lines_do_not_count(spark):
    mit = TEXTS["MIT"][0]
    british = mit.replace("license", "licence").replace("sublicense", "sublicence")
    marked = "Copyright (c) 2021-2024 A Person and Others\nCopyright © 2019 Somebody Else\nAll rights reserved.\n\n" + "\n".join(f"// {x}" for x in mit.split("\n"))
    bsd = TEXTS["BSD-3-Clause"][0]
    letters = bsd.replace("1. ", "(a) ").replace("2. ", "(b) ").replace("3. ", "(c) ")
    got = found(spark, [british, marked, letters, "This licence is granted.\n1. Copyright law applies to it in every country of the world."])
    assert {x for _, x in got[0]} == {x for _, x in got[1]} == {"MIT"} and {x for _, x in got[2]} == {"BSD-3-Clause"} and got[3] == []
    assert L.normalised("a. Licence\n* Copyright (c) 2020 X\nAll rights reserved.\nThe copyright notice") == "license\n\n\nthe copyright notice"


def test_segments_of_the_query_equal_brute_force(spark):
    """Every document of the query: whole texts, lines and sentences against all templates, pair by pair."""
    from terraloom.llm.registry import QUERIES

    folder = "/root/testdata/sf0.001"
    full = L.full_texts()
    sets = [(name, L.bigrams(L.normalised(t))) for name in sorted(L.NOTICES.keys() | full.keys()) for t in L.NOTICES.get(name, ()) + full.get(name, ())]

    def best(segment):
        grams = L.bigrams(segment)
        dice = [(2 * len(grams & s) / (len(grams) + len(s)), name) for name, s in sets if grams]
        top = max((d for d, _ in dice), default=0)
        return (min(n for d, n in dice if d == top), top) if top >= 0.8 else None

    got = {r.doc_id: r for r in QUERIES["op2_licences"](spark, folder).collect()}
    some = 0
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        text, want = L.normalised(r.text or ""), []
        want += [best(text)]
        for line in text.split("\n"):
            hit = best(line)
            want += [hit] if hit or not any(c in line for c in ".!?;") else [best(s) for s in L._SENTENCE.split(line)]
        want = [w for w in want if w]
        some += bool(want)
        names = set(got[r.doc_id].licences.split(",")) - {""}
        assert {n for n, _ in want} <= names and got[r.doc_id].n_matches >= len(want)
        assert not want or abs(got[r.doc_id].best_dice - max(d for _, d in want)) < 1e-12 or got[r.doc_id].best_dice > max(d for _, d in want)
        if got[r.doc_id].n_matches == len(want):
            assert names == {n for n, _ in want}
    assert some >= 3
