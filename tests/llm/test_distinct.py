"""Distinct keys of the suffix tree's chunks, against np.unique."""

import numpy as np

from ledgerline.llm import suffix_tree_lm


def test_distinct_keys_and_pairs():
    r = np.random.default_rng(1)
    for n in (0, 1, 5000):
        a, b = r.integers(0, 90, n), r.integers(0, 70, n)
        mixed = lambda at: suffix_tree_lm._mixed((a[at] * 1000 + b[at]).astype(np.uint64))  # noqa: B023, E731
        alike = lambda at: mixed(at) % np.uint64(7)  # noqa: B023, E731 - pairs that share a key count as one
        for key in (mixed, alike):
            want = np.unique(key(np.arange(n)), return_index=True, return_inverse=True)
            for got in (suffix_tree_lm.distinct(key(np.arange(n))), suffix_tree_lm.distinct_pairs(a, b, 90, 70, key), suffix_tree_lm.distinct_pairs(a, b, 1 << 40, 1 << 30, key)):
                assert all(np.array_equal(x, y) for x, y in zip(got, want, strict=True))
