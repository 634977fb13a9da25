"""Keyed permutations of ``range(n)``: a balanced Feistel network on the next even number of bits, walked until it falls inside."""

from __future__ import annotations

import hashlib

import numpy as np

ROUNDS = 6


def _half_bits(n: int) -> int:
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def permute(value: int, n: int, key: bytes, tweak: bytes = b"") -> int:
    """The image of ``value`` under the permutation of ``range(n)`` that ``key`` and ``tweak`` name; any size of ``n``."""
    half = _half_bits(n)
    mask, width = (1 << half) - 1, (half + 7) // 8
    while True:
        left, right = value >> half, value & mask
        for r in range(ROUNDS):
            digest = hashlib.shake_256(key + bytes([r]) + tweak + b"\0" + right.to_bytes(width, "big")).digest(width)
            left, right = right, left ^ (int.from_bytes(digest, "big") & mask)
        value = left << half | right
        if value < n:
            return value


def permute_array(values: np.ndarray, n: int, key: int) -> np.ndarray:
    """The same construction on arrays, for ``n`` up to 2**62, with 64-bit mixing as the round function."""
    half = np.uint64(_half_bits(n))
    mask = np.uint64((1 << int(half)) - 1)
    keys = [np.uint64(int.from_bytes(hashlib.blake2b(f"{key}:{r}".encode(), digest_size=8).digest(), "big")) for r in range(ROUNDS)]
    out = values.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & mask
        for k in keys:
            mixed = (right ^ k) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ mixed >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
            left, right = right, left ^ (mixed ^ mixed >> np.uint64(32)) & mask
        out[todo] = left << half | right
        todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)
