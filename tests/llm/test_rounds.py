"""What line dedup shuffles at once stays bounded where all words are common."""

import random

import numpy as np

from terraloom.llm.line_dedup import repeated_lines


def shuffled(spark, work):
    """Records of the stage that shuffles most while ``work`` runs, and its result."""
    store = spark.sparkContext._jsc.sc().statusStore()
    quantiles = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0)
    stages = lambda: {(s.stageId(), s.attemptId()): s.shuffleWriteRecords() for s in (seq.apply(i) for seq in [store.stageList(None, False, False, quantiles, None)] for i in range(seq.size()))}
    before = stages()
    out = work()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    return max(n for k, n in stages().items() if k not in before), out


def test_lines_of_common_words_take_part_in_rounds(spark):
    rng, words = random.Random(5), [f"word{i}" for i in range(60)]
    lines = []
    for i in range(1200):
        old = lines[rng.randrange(len(lines))] if i % 4 == 3 else None
        lines.append(rng.sample(words, 30) if old is None else rng.sample([*old[1:], rng.choice(words)], 30))
    docs = [(i, "\n".join(" ".join(line) for line in lines[5 * i : 5 * i + 5])) for i in range(240)]
    found = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as at size
    try:
        most, got = shuffled(spark, lambda: {(r.doc_id, r.pos) for r in repeated_lines(found).collect()})
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)
    has = np.array([[w in line for w in words] for line in map(set, lines)], np.int64)
    both, n = has @ has.T, has.sum(1)
    like = np.tril(5 * both >= 4 * (n[:, None] + n[None, :] - both), -1).any(1)
    assert got == {(i // 5, i % 5) for i in np.flatnonzero(like)} and 100 < len(got) < 600
    assert most < 18 * 1200  # each has 28 cells, one for each two of the eight words of its prefix
