"""The seating of op5 against customers that move one by one."""

from math import lgamma

import numpy as np
import pytest

from starloom.llm import hpylm
from starloom.llm.hpylm import D, D0, S0, S, Seating

HERE, WORD, EVERYONE = 50.0, 40, 300.0


def one_by_one(c, sweeps, seed=0):
    """Mean tables of one pair if every customer stands up and sits down in every sweep."""
    random, at, seen = np.random.default_rng(seed), [c], []
    for sweep in range(sweeps):
        for _ in range(c):
            k = random.choice(len(at), p=np.array(at) / c)
            at[k] -= 1
            at = [n for n in at if n]
            t = len(at)
            opening = (S + D * (HERE + t)) * (WORD + t - D0) / (S0 + EVERYONE + t) if t else 1.0
            weights = np.array([n - D for n in at] + [opening])
            k = random.choice(t + 1, p=weights / weights.sum())
            at = [*at, 1] if k == t else [*at[:k], at[k] + 1, *at[k + 1 :]]
        if sweep >= 20:
            seen.append(len(at))
    return np.mean(seen)


def drawn(c, sweeps, here=HERE, word=WORD, everyone=EVERYONE):
    """The same by sweeps of ``Seating``; a second pair holds the word's other tables."""
    seats = Seating(np.array([7, 7], np.uint64), np.array([3, 4]), np.array([c, word]), 1, np.array([1, word]))
    seen = []
    for _ in range(sweeps):
        seats.tables[1] = word  # what the parent has besides stays the same
        own = seats.tables.copy()
        seats.sweep(np.array([0, 0, 0, here + own[0], word]), everyone + own[0], own)
        seen.append(int(seats.tables[0]))
    return seen


@pytest.mark.parametrize("whole", [2048, 20])
def test_tables_are_those_of_moves_one_by_one(monkeypatch, whole):
    monkeypatch.setattr(hpylm, "WHOLE_ROWS", whole)
    assert abs(np.mean(drawn(60, 3000)[20:]) - one_by_one(60, 400)) < 0.5


def test_all_customers_of_a_frequent_pair_move():
    c, here, word, everyone = 10_000, 2000.0, 1000, 5000.0
    seen = drawn(c, 60, here, word, everyone)[10:]
    t = np.arange(1, c + 1)
    weight = np.concatenate([hpylm.log_stirling(c, t[k : k + 500]) for k in range(0, c, 500)])
    gamma = np.vectorize(lgamma)
    weight += gamma(S / D + here + t) + t * np.log(D) + gamma(word + t - D0) - gamma(S0 + everyone + t)
    weight = np.exp(weight - weight.max())
    assert min(seen) > 169  # tables that 7 sweeps of 24 moves could reach
    assert abs(np.mean(seen) / np.average(t, weights=weight) - 1) < 0.05


def test_weights_of_seatings():
    for c in (2100, 3000):
        t = np.array([1, 2, 3, 50, 300, 1000, c - 60, c - 1, c])
        assert np.allclose(hpylm.log_stirling(c, t), hpylm.stirling_row(c)[t - 1], atol=1e-7)


def test_places_of_runs_in_order():
    random = np.random.default_rng(5)
    known = np.unique(random.integers(0, 4000, 1000).astype(np.uint64))
    runs = np.concatenate([np.sort(random.integers(0, 4000, 500)) for _ in range(5)]).astype(np.uint64)
    for asked in (runs, runs[:0]):
        found = hpylm._places_in_order(known, asked)
        assert found.tolist() == hpylm._places(known, asked).tolist()
        place = {number: k for k, number in enumerate(known.tolist())}
        assert found.tolist() == [place.get(number, len(known)) for number in asked.tolist()]
