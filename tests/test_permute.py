import numpy as np
import pytest

from tokenloom.functions.permute import permuted


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 10, 99, 1000, 4097])
def test_every_place_is_taken_once(n):
    for key in range(5):
        assert sorted(permuted(np.arange(n), np.full(n, key), n, 42).tolist()) == list(range(n))


def test_orders_differ_and_spread():
    n = 20_000
    orders = [permuted(np.arange(n), np.full(n, key), n, seed) for key, seed in ((0, 42), (1, 42), (0, 43))]
    for a, b in ((0, 1), (0, 2), (1, 2)):
        assert abs(np.corrcoef(orders[a], orders[b])[0, 1]) < 0.05
    # Neighbours don't stay neighbours, and each tenth of the numbers is spread over all places.
    assert np.mean(np.abs(np.diff(orders[0])) < n / 100) < 0.05
    counts = np.histogram2d(np.arange(n), orders[0], bins=10)[0]
    assert counts.min() > n / 100 * 0.7


def test_very_large_tables():
    n = 10**15 + 7
    number = np.array([0, 1, n // 2, n - 1])
    place = permuted(number, np.zeros(4, np.int64), n, 1)
    assert (place >= 0).all() and (place < n).all() and len(set(place.tolist())) == 4
