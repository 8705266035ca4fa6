"""The search over packing plans, against trying every bin for each item."""

import numpy as np
import pytest

from corpusmill.llm.bin_completion import completion_plan, lower_bound


def fits(lengths, capacity, bins):
    """Whether so many bins are enough, by trying every bin for each item."""

    def put(k, rooms):
        if k == len(lengths):
            return True
        return any(put(k + 1, (*rooms[:b], rooms[b] - lengths[k], *rooms[b + 1 :])) for b in {r: b for b, r in enumerate(rooms) if r >= lengths[k]}.values())

    return put(0, (capacity,) * bins)


def used_by(plan, capacity):
    used = {}
    for times, items in plan:
        assert times > 0 and sum(x * n for x, n in items) <= capacity
        for x, n in items:
            used[x] = used.get(x, 0) + times * n
    return used


def test_choices_are_taken_back():
    counts = {57: 2, 52: 1, 36: 2, 26: 4, 19: 2}
    plan = completion_plan(counts, 100)
    assert used_by(plan, 100) == counts and sum(t for t, _ in plan) == 4


@pytest.mark.parametrize("seed", range(3))
def test_small_plans_are_optimal(seed):
    random = np.random.default_rng(seed)
    for _ in range(100):
        lengths = sorted(random.integers(5, 60, random.integers(5, 13)).tolist(), reverse=True)
        counts = {x: lengths.count(x) for x in lengths}
        plan = completion_plan(counts, 100)
        bins = sum(t for t, _ in plan)
        assert used_by(plan, 100) == counts
        assert bins == lower_bound(counts, 100) or not fits(lengths, 100, bins - 1)


def test_search_ends_after_its_steps():
    counts = {x: 40 for x in range(101, 1000, 3)}
    assert used_by(completion_plan(counts, 1000, steps=1000), 1000) == counts
