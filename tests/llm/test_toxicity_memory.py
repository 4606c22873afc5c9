"""What fitting the toxicity model holds in the driver."""

import tracemalloc

import numpy as np

from spotweave.llm import toxicity


def test_fit_holds_no_index_of_every_feature():
    rng = np.random.default_rng(4)
    docs = [np.unique(np.concatenate([rng.integers(0, 1 << toxicity.BITS, 2500), np.arange(5) + 10 * (k < 60)])).astype(np.int32) for k in range(2000)]
    held = sum(d.nbytes for d in docs)
    tracemalloc.start()
    try:
        model = toxicity.fit_nnpu(docs[:60], docs[60:], 0.05)
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.reset_peak()
        before = tracemalloc.get_traced_memory()[0]
        assert len(toxicity.distinct_documents([*docs[:500], *docs[:500]])) == 500
        copied = tracemalloc.get_traced_memory()[1] - before
    finally:
        tracemalloc.stop()
    assert set(range(10, 15)) <= set(model.weights)
    assert most < 100_000_000, most  # about ten arrays of 8 MB for all hashed features, whatever the documents
    assert copied < held / 4
