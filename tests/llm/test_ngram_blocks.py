"""The comparison of families of sets in the n-gram join."""

import itertools

import numpy as np

from spotweave.llm import ngram_join


def test_ngram_join_copies_no_family_for_each_pair_of_blocks(spark):
    """What is shuffled to compare a family of sets in pairs stays a few times its size, in one turn or in several, and no pair is lost."""
    rng = np.random.default_rng(3)
    rows, copied = [], 0
    for k in range(1500):
        n = int(rng.choice([40, 44, 61, 90, 300]))
        near = rows and k % 10 == 0
        bits = bytes(rows[-1][4]) if near else rng.integers(0, 256, max(64, 1 << (4 * n - 1).bit_length()) // 8, dtype=np.uint8).tobytes()
        rows.append((k, k // 2 if k % 7 else k, 1 + k % 2 * (k > 1000), rows[-1][3] if near else n, bits))
        copied += len(bits)
    sets = ngram_join.stage(spark.createDataFrame(rows, "sig long, comp long, family long, n long, bits binary"), "test-family")

    def written() -> int:
        store = spark.sparkContext._jsc.sc()
        store.listenerBus().waitUntilEmpty()
        found = store.statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
        return sum(found.apply(i).shuffleWriteBytes() for i in range(found.size()))

    want = {(min(x[0], y[0]), max(x[0], y[0])) for x, y in itertools.combinations(rows, 2) if x[2] == y[2] and x[1] != y[1] and 5 * min(x[3], y[3]) >= 4 * max(x[3], y[3]) and ngram_join.may_link(x[4], y[4], x[3], y[3])}
    assert len(want) >= 100
    before = written()
    assert {tuple(r) for r in ngram_join.family_blocks(sets).collect()} == want
    assert written() - before < 4 * copied
    assert {tuple(r) for r in ngram_join.family_blocks(sets, 100, 1).collect()} == want
