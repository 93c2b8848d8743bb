"""Suffix order, common prefixes and longest previous factors against plain definitions."""

import numpy as np
import pytest

from salesmart.llm import suffixes


def shared(a, b, most):
    k = 0
    while k < most and a[k] == b[k]:
        k += 1
    return k


@pytest.mark.parametrize("kind,length,letters", [(np.uint8, 11, 3), (np.uint8, 400, 200), (np.uint64, 7, 3), (np.uint8, 5, 2), (np.uint8, 8, 2),
                                                 (np.uint64, 51, 2), (np.uint8, 9, 1), (np.uint64, 1, 4)])
def test_orders_prefixes_and_factors(kind, length, letters):
    rng = np.random.default_rng(length)
    s = rng.integers(0, letters, 1500).astype(kind)
    s = np.concatenate([s, s[200:900], s[:600], np.zeros(40, kind)])
    starts = np.flatnonzero(rng.random(len(s) - length + 1) < 0.4)
    place = rng.permutation(len(starts))
    order, common = suffixes.suffix_order(s, starts, place, length)
    w = [s[i:i + length].tolist() for i in starts.tolist()]
    assert order.tolist() == sorted(range(len(w)), key=lambda i: (w[i], place[i]))
    assert common[0] == 0 and all(shared(w[order[i - 1]], w[order[i]], length) == common[i] for i in range(1, len(order)))
    factor = suffixes.previous_factors(place[order], common)
    for i in rng.choice(len(order), 60):
        own = order[i]
        assert factor[i] == max((shared(w[j], w[own], length) for j in range(len(w)) if place[j] < place[own]), default=0)


def test_nothing_and_one():
    none = np.zeros(0, np.int64)
    assert suffixes.previous_factors(none, none).tolist() == []
    order, common = suffixes.suffix_order(np.zeros(5, np.uint8), np.array([0]), np.array([0]), 5)
    assert order.tolist() == [0] and common.tolist() == [0]
    assert suffixes.previous_factors(np.array([2, 0, 1]), np.array([0, 4, 3])).tolist() == [4, 0, 3]
