"""Bin counts bound intersections from above, and unlike sets are told by them alone."""

from __future__ import annotations

import numpy as np

from gaugeworks.llm import jaccard_join
from gaugeworks.llm.shingles import U64


def _set(rng, n):
    return np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64, endpoint=False))


def test_no_pair_in_reach_is_left_out():
    rng = np.random.default_rng(5)
    for n in (1, 2, 5, 30, 331, 4000):
        for lost in (0, 1, n // 30, n // 12):
            s = _set(rng, n)
            t = np.unique(np.concatenate([s[lost:], _set(rng, lost)])) if lost < n else s
            both = len(np.intersect1d(s, t))
            known = len(s), len(t), jaccard_join.bin_counts(s), jaccard_join.bin_counts(t)
            if 100 * both >= 90 * (len(s) + len(t) - both):
                assert jaccard_join.may_link(*known, 90, 100)
                assert jaccard_join.may_link(*known[1::-1], *known[:1:-1], 90, 100)


def test_unlike_sets_are_told_without_the_sets():
    rng = np.random.default_rng(6)
    for n in (100, 331, 2000):
        s, t = _set(rng, n), _set(rng, n + n // 20)
        assert not jaccard_join.may_link(len(s), len(t), jaccard_join.bin_counts(s), jaccard_join.bin_counts(t), 90, 100)


def test_counts_beyond_a_byte_bound_nothing():
    s = np.arange(1000, dtype=U64)
    assert jaccard_join.bin_counts(s) == b""
    assert jaccard_join.may_link(1000, 1000, b"", jaccard_join.bin_counts(s), 90, 100)
