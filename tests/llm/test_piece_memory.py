"""What a Python worker takes for a batch of texts, as it keeps that."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from codexlake.llm import kernels, neardup, quality_rules


def texts():
    rng = np.random.default_rng(1)
    return pa.array([" ".join(f"w{x}" for x in rng.integers(0, 5000, 600)) for _ in range(1500)])  # some 5 MB


@pytest.mark.parametrize("work", [quality_rules.measure, lambda t: [s.sum() for _, s in neardup.shingle_sets(t, 5)]])
def test_tables_of_a_batch_stay_small(work, monkeypatch):
    arr = texts()
    monkeypatch.setattr(kernels, "_powers", {})
    tracemalloc.start()
    work(arr)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50e6


def test_pieces_do_not_change_what_is_found(monkeypatch):
    arr = pa.array([None, "", *texts().to_pylist()[:300], "a b c d e " * 40_000, "x\nx\nx # $"])
    found = []
    for limit in (1 << 10, 1 << 18, 1 << 20):
        for module in (quality_rules, neardup):
            monkeypatch.setattr(module, "PIECE", limit)
        found.append((quality_rules.measure(arr).to_pylist(), [(i, s.tolist()) for i, s in neardup.shingle_sets(arr, 5)]))
    assert found[0] == found[1] == found[2]
