"""The index against a plain search."""

import numpy as np
import pytest

from laneflow.llm.fm_index import FmIndex, suffix_order


@pytest.mark.parametrize("seed", range(12))
def test_suffix_order(seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 1 + seed % 4, rng.integers(1, 200)).astype(np.int32)
    x = np.concatenate([x, x, x]) if seed % 2 else x
    expected = sorted(range(len(x)), key=lambda i: x[i:].tolist())
    for depth in (1, 3, 10):
        assert suffix_order(x, depth).tolist() == expected


@pytest.mark.parametrize("seed", range(12))
def test_search_and_locate(seed):
    rng = np.random.default_rng(seed)
    top, size = 5, 1 + seed % 4
    x = rng.integers(0, top + 1, 300).astype(np.int32)
    x = np.concatenate([x, x[50:120], x])
    phrases = np.unique(rng.integers(1, top + 1, (40, size)), axis=0)
    index = FmIndex(x, top, depth=4, sample=8)
    low, high = index.search(phrases)
    for p, a, b in zip(phrases, low, high):
        expected = [i for i in range(len(x) - size + 1) if (x[i : i + size] == p).all()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == expected
