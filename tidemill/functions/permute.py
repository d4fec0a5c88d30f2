"""A keyed order of ``0 .. n - 1`` by arithmetic alone: nothing is sorted or looked up.

Numbers are split in two halves that change each other by turns, which any function of a half
and the key can do without losing a number; those that come out at ``n`` or beyond go through
again until they do not. Any engine can repeat it: the function is a polynomial over
a prime, its coefficients are digits of an md5 of the key.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

PRIME = 2**31 - 1  # products of two numbers below it fit in 64 bits
ROUNDS = 6
DEGREE = 3
_DIGITS = 7  # hex digits of a coefficient


def halves(total: int) -> tuple[int, int]:
    """Sizes of the two halves: their product is at least ``total``, by less than the first."""
    first = max(1, math.isqrt(max(0, total - 1)) + 1)
    return first, max(1, -(-total // first))


def coefficients(*key: int | str) -> list[list[int]]:
    """For each round those of its polynomial, the highest power first."""
    name = ":".join(map(str, key))
    digests = [hashlib.md5(f"{name}:{k}".encode()).hexdigest() for k in range(ROUNDS)]
    return [
        [int(d[_DIGITS * i : _DIGITS * (i + 1)], 16) for i in range(DEGREE + 1)] for d in digests
    ]


def permuted(numbers: np.ndarray, total: int, *key: int | str) -> np.ndarray:
    """Where each number from 0 to ``total - 1`` goes."""
    first, second = halves(total)
    if first > PRIME:
        raise ValueError("halves must stay below the prime")
    rounds = coefficients(*key)

    def mixed(x: np.ndarray, powers: list[int]) -> np.ndarray:
        y = np.full_like(x, powers[0])
        for c in powers[1:]:
            y = (y * x + c) % PRIME
        return y

    out = np.array(numbers, np.int64)
    todo = np.arange(len(out))
    while len(todo):
        high, low = np.divmod(out[todo], second)
        for k, powers in enumerate(rounds):
            if k % 2:
                low = (low + mixed(high, powers)) % second
            else:
                high = (high + mixed(low, powers)) % first
        out[todo] = high * second + low
        todo = todo[out[todo] >= total]
    return out


def permute(position: Column, total: int, *key: int | str) -> Column:
    """``permuted`` as a column; ``position`` must be from 0 to ``total - 1``."""

    @F.arrow_udf("long")
    def place(numbers):
        import pyarrow as pa

        found = numbers.to_numpy(zero_copy_only=False)
        if len(found) and not (found.min() >= 0 and found.max() < total):
            raise ValueError(f"positions must be from 0 to {total - 1}")
        return pa.array(permuted(found, total, *key))

    return place(position.cast("long"))
