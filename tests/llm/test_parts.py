"""Linked sets always share a part signature, however few parts each of them sends."""

import numpy as np
import pytest

from lanewatch.llm.jaccard_join import describe_sets
from lanewatch.llm.words import mixed


def token_set(numbers):
    return np.unique(mixed(np.array(sorted(numbers), np.uint64)))


@pytest.mark.parametrize("percent", [50, 80, 90, 100])
def test_linked_sets_share_a_signature(percent):
    random = np.random.default_rng(percent)
    for _ in range(400):
        n = int(random.integers(1, 120))
        base = set(range(n))
        gone = int(random.integers(0, n // 3 + 1))
        more = int(random.integers(0, n // 3 + 2))
        other = set(random.choice(n, n - gone, replace=False).tolist()) | set(range(1000, 1000 + more))
        if not other or 100 * len(base & other) < percent * len(base | other):
            continue
        shared = [set(s) for s in describe_sets(
            [token_set(base), token_set(other)], percent)["sigs"].to_pylist()]
        assert shared[0] & shared[1], (n, gone, more)


def test_sets_apart_share_none_by_empty_parts():
    sets = [token_set(range(1000 * k, 1000 * k + 200)) for k in range(1, 40)]
    found = describe_sets(sets, 80)["sigs"].to_pylist()
    every = [s for sigs in found for s in set(sigs)]
    assert len(every) == len(set(every))
