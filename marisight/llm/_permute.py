"""Pseudorandom permutations of [0, n), evaluated at single points, vectorised over many (n, seed)."""

from __future__ import annotations

import numpy as np

from marisight.llm._words import mix

_ROUNDS = 4


def _half_bits(n: np.ndarray) -> np.ndarray:
    bits = np.ceil(np.log2(np.maximum(n, 2).astype(np.float64)) - 1e-12)
    return np.maximum(1, (bits.astype(np.int64) + 1) // 2).astype(np.uint64)


def _rounds(x: np.ndarray, half: np.ndarray, seed: np.ndarray, backward: bool) -> np.ndarray:
    mask = (np.uint64(1) << half) - np.uint64(1)
    left, right = x >> half, x & mask
    for i in range(_ROUNDS):
        key = np.uint64((_ROUNDS - 1 - i if backward else i) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        if backward:
            left, right = right ^ (mix(left ^ mix(seed + key)) & mask), left
        else:
            left, right = right, left ^ (mix(right ^ mix(seed + key)) & mask)
    return (left << half) | right


def permute(x: np.ndarray, n: np.ndarray, seed: np.ndarray, backward: bool = False) -> np.ndarray:
    """Where index x of [0, n) goes (or, backward, comes from): a Feistel network walked until it is inside."""
    x, n, seed = (np.broadcast_arrays(x, n, seed)[i].astype(np.uint64) for i in range(3))
    half = _half_bits(n.astype(np.int64))
    out = x.copy()
    todo = np.arange(len(out))
    while len(todo):
        out[todo] = _rounds(out[todo], half[todo], seed[todo], backward)
        todo = todo[out[todo] >= n[todo]]
    return out.astype(np.int64)
