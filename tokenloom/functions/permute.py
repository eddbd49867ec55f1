"""A keyed permutation of 0 ... n-1, computed value by value."""

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A prime and one of its primitive roots, as in public multiplicative generators, and weights of the key.
PRIME = 2**31 - 1
ROOT = 48271
KEY = (7919, 104729, 1299709)
ROUNDS = 4


def mixed(x: np.ndarray, key: np.ndarray, size: int) -> np.ndarray:
    """A third power, so that two keys don't give shifted copies of one another."""
    y = (x + key) % PRIME
    return y * y % PRIME * y % PRIME * ROOT % PRIME % size


def permuted(number: np.ndarray, key: np.ndarray, n: int, seed: int) -> np.ndarray:
    """The place of each number in the order that its key names: a Feistel network over a rectangle of at least n cells.

    Both halves are moved by sums modulo their side, so a round can be undone and no two numbers meet. The few places past
    the end, less than a side, are sent on until they fall inside (cycle walking). n may be up to 2^60.
    """
    high = max(1, math.isqrt(max(n - 1, 0)) + 1)
    low = max(1, -(-n // high))
    out, going = number.copy(), np.arange(len(number))
    while len(going):
        left, right = out[going] // low, out[going] % low
        for turn in range(ROUNDS):
            name = (KEY[0] * seed + KEY[1] * key[going] + KEY[2] * (turn + 1)) % PRIME
            if turn % 2:
                right = (right + mixed(left, name, low)) % low
            else:
                left = (left + mixed(right, name, high)) % high
        out[going] = left * low + right
        going = going[out[going] >= n]
    return out


def places(n: int, seed: int):
    """(number, key) -> place."""

    def run(number: pa.Array, key: pa.Array) -> pa.Array:
        return pa.array(permuted(number.to_numpy(zero_copy_only=False).astype(np.int64), key.to_numpy(zero_copy_only=False).astype(np.int64), n, seed))

    return run
