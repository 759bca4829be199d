"""Packing plans: exact cover, few sequences, and by the program rather than by best fit."""

import random
from collections import Counter

import pytest

from plumbline.llm import packing as P


def total(plan):
    return sum(n for _, n in plan)


def realistic(seed, pieces=6000, capacity=4096):
    """Lengths as of documents: few short ones, a long tail that is cut at the capacity."""
    r, out = random.Random(seed), Counter()
    for _ in range(pieces):
        n = int(r.lognormvariate(6.3, 0.9)) + 1
        out[capacity] += n // capacity
        out[n % capacity] += n % capacity > 0
    return +out


@pytest.mark.parametrize("times", [1, 10, 100])
def test_the_program_packs_and_no_worse_than_best_fit(times):
    h = {k: v * times for k, v in realistic(1).items()}
    plan = P.solve(h, 4096)
    covered = Counter()
    for config, n in plan:
        assert sum(config) <= 4096 and n > 0
        for x in config:
            covered[x] += n
    assert covered == Counter(h)
    short = Counter({k: v for k, v in h.items() if k < 4096})
    alone = sum(P.best_fit(short.copy(), 4096).values()) + h.get(4096, 0)
    assert total(plan) <= alone
    least = -(-sum(k * v for k, v in h.items()) // 4096)
    assert total(plan) - least <= max(1, total(plan) // 10_000)
    of_program = sum(P.priced(short.copy(), 4096, P.ROUNDS).values()) + h.get(4096, 0)
    assert of_program >= 0.9 * total(plan)


def test_best_values_against_all_multisets():
    r = random.Random(2)
    import numpy as np

    for _ in range(50):
        sizes = sorted(r.sample(range(1, 15), r.randrange(1, 5)))
        prices = [r.random() for _ in sizes]
        value, choice = P.best_values(np.array(sizes), np.array(prices), 20)
        best = [0.0] * 21
        for room in range(1, 21):
            best[room] = max([best[room - 1]] + [best[room - s] + p for s, p in zip(sizes, prices, strict=True) if s <= room])
        assert value.tolist() == pytest.approx(best)


@pytest.mark.parametrize(
    "h,want",
    [({}, 0), ({4096: 7}, 7), ({1: 1}, 1), ({3000: 10}, 10), ({2048: 9}, 5), ({1: 4096 * 3}, 3), ({2000: 10, 2096: 10}, 10), ({1500: 4, 2500: 4, 1596: 4}, 6), ({1366: 30}, 15), ({4095: 5, 1: 5}, 5)],
)
def test_small_histograms(h, want):
    plan = P.solve(h, 4096)
    assert total(plan) == want
    assert sum((Counter({x: n}) for c, n in plan for x in c), Counter()) == Counter(h)
