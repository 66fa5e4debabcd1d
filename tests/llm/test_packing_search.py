"""The bin-completion search against brute force."""

import itertools

import numpy as np
import pytest

from shoptally.llm import packing


def fewest_by_hand(items, capacity):
    best = len(items)

    def put(at, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if at == len(items):
            best = len(rooms)
            return
        for k in {r: k for k, r in enumerate(rooms) if r >= items[at]}.values():
            put(at + 1, [*rooms[:k], rooms[k] - items[at], *rooms[k + 1 :]])
        put(at + 1, [*rooms, capacity - items[at]])

    put(0, [])
    return best


def _counts(items):
    return {s: items.count(s) for s in set(items)}


def test_a_triple_is_tried_beside_an_exact_pair():
    items = [2000, 1987, 1913, 1187, 1100, 1009, 996, 901, 702, 493]
    assert sum(n for _, n in packing.complete_bins(_counts(items))) == 3


@pytest.mark.parametrize("seed", range(60))
def test_fewest_sequences(seed):
    r = np.random.default_rng(seed)
    capacity = int(r.integers(12, 60))
    items = sorted(map(int, r.integers(2, capacity // 2 + 3, int(r.integers(6, 13)))), reverse=True)
    plan = packing.complete_bins(_counts(items), capacity)
    assert sorted((s for f, n in plan for s in f * n), reverse=True) == items
    assert sum(n for _, n in plan) == fewest_by_hand(items, capacity)


@pytest.mark.parametrize("seed", range(40))
def test_fillings_are_those_that_no_other_dominates(seed):
    r = np.random.default_rng(seed)
    room = int(r.integers(8, 25))
    items = list(map(int, r.integers(1, room, 7)))
    left = np.bincount(items, minlength=room + 1)

    def fits(a, b):
        """Whether the items of b fit, in groups, into those of a."""
        if not b:
            return True
        return any(fits([*a[:k], x - b[0], *a[k + 1 :]], b[1:]) for k, x in enumerate(a) if x >= b[0])

    every = {tuple(sorted(c, reverse=True)) for n in range(8) for c in itertools.combinations(items, n) if sum(c) <= room}
    wanted = {b for b in every if not any(a != b and fits(list(a), list(b)) for a in every)}
    found = list(packing.fillings(left, room, room, packing.Budget(10**6)))
    assert sorted(found) == sorted(wanted)
    assert [sum(f) for f in found] == sorted((sum(f) for f in found), reverse=True)
    assert found == sorted(found, key=lambda f: packing._order(f, room))
