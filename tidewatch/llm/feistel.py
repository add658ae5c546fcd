"""A keyed permutation of 0 .. n-1: a Feistel network on the next even number of bits, with cycle walking."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROUNDS = 6
# The multipliers of a well-known 64-bit finaliser.
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def round_keys(seed: str) -> list[np.uint64]:
    return [np.uint64(int.from_bytes(hashlib.sha256(f"{seed}:{i}".encode()).digest()[:8], "little")) for i in range(ROUNDS)]


def _scramble(x: np.ndarray, key: np.uint64) -> np.ndarray:
    x = x + key
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _network(x: np.ndarray, half: int, keys) -> np.ndarray:
    bits, mask = np.uint64(half), np.uint64((1 << half) - 1)
    left, right = x >> bits, x & mask
    for key in keys:
        left, right = right, left ^ (_scramble(right, key) & mask)
    return (right << bits) | left  # swapped, so that the reversed keys undo it


def permute(x: np.ndarray, n: int, seed: str, inverse: bool = False) -> np.ndarray:
    """Where each of 0 .. n-1 goes.  A place outside the range is sent on until it falls inside; fewer than four steps are
    expected, and the walk ends because it stays on the cycle it began on."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    keys = round_keys(seed)[::-1] if inverse else round_keys(seed)
    out = _network(np.asarray(x, dtype=np.uint64), half, keys)
    while (far := out >= np.uint64(n)).any():
        out[far] = _network(out[far], half, keys)
    return out.astype(np.int64)


def permuted(col: Column, n: int, seed: str, inverse: bool = False) -> Column:
    @F.pandas_udf(T.LongType())
    def place(x: pd.Series) -> pd.Series:
        return pd.Series(permute(x.to_numpy(), n, seed, inverse))
    return place(col)
