"""The bound that spares common subsequences never lies below them."""

import random

import numpy as np

from gaugeworks.llm import decontaminate as d


def test_bounds_are_bounds():
    pick = random.Random(2)
    for width in (1, 2, 4):
        queries = [
            d.Passage(k, np.array(pick.choices(range(300), k=pick.randint(1, width * d.STRIDE)), np.int32), np.zeros(0, np.int32))
            for k in range(12)
        ]
        sketches = d.Sketches(queries, 300)
        for n in (0, 3, 16, 40, 64, 65, 300):
            words = np.array([pick.randint(-1, 299) for _ in range(n)], np.int32)
            if n > 30:
                part = queries[3].words
                words[10 : 10 + len(part)] = part[: len(words) - 10]
            held = sketches.places(words, width)
            windows = len(d._windows(d._blocks(words, np.zeros((301, 1))), width))
            assert len(held) >= windows
            for at in range(windows):
                low = at * d.STRIDE
                region = words[max(low - d.STRIDE, 0) : low + (width + 1) * d.STRIDE]
                region = region[region >= 0]
                bounds = sketches.bounds(held[[at] * len(queries)], np.arange(len(queries)))
                for q, bound in zip(queries, bounds.tolist(), strict=True):
                    assert d.common_subsequence(q.words, region) <= bound


def test_bounds_of_all_are_those_of_each():
    pick = random.Random(3)
    queries = [
        d.Passage(k, np.array(pick.choices(range(40), k=pick.randint(1, 64)), np.int32), np.zeros(0, np.int32))
        for k in range(9)
    ]
    sketches = d.Sketches(queries, 40)
    held = sketches.places(np.array([pick.randint(-1, 39) for _ in range(400)], np.int32), 2)
    chosen = np.array([0, 3, 4, 8])
    every = sketches.all_bounds(held, chosen)
    for k in range(len(held)):
        assert every[k].tolist() == sketches.bounds(held[[k] * len(chosen)], chosen).tolist()
