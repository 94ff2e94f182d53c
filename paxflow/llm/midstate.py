"""SHA-256 over many messages at once, with its chaining value in the open.

A state is eight 32-bit words. After whole 64-byte blocks it is all that is
needed to go on with a message, so it can be stored, copied and resumed.
Arrays are words by lanes: a state is (8, n), a block (16, n).
"""

from __future__ import annotations

import math

import numpy as np

LANES = 4096  # lanes handled at once, so that the working set stays in cache

_HEX = np.array([[ord(c) for c in f"{b:02x}"] for b in range(256)], np.uint8)


def _primes(n: int) -> list[int]:
    found: list[int] = []
    k = 2
    while len(found) < n:
        if all(k % p for p in found):
            found.append(k)
        k += 1
    return found


def _cube_root(x: int) -> int:
    root = 1 << -(-x.bit_length() // 3)
    while (better := (2 * root + x // (root * root)) // 3) < root:
        root = better
    return root


# First 32 bits of the fractional parts of square and cube roots of primes.
INITIAL = np.array([math.isqrt(p << 64) & 0xFFFFFFFF for p in _primes(8)], np.uint32)
ROUND = np.array([_cube_root(p << 96) & 0xFFFFFFFF for p in _primes(64)], np.uint32)


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x >> np.uint32(by)) | (x << np.uint32(32 - by))


def initial(n: int) -> np.ndarray:
    """The state before the first block, ``n`` times."""
    return np.repeat(INITIAL[:, None], n, axis=1)


def absorb(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """The states after one more block each."""
    n = state.shape[1]
    if n > LANES:
        return np.concatenate([absorb(state[:, i : i + LANES], block[:, i : i + LANES]) for i in range(0, n, LANES)], axis=1)
    w = list(block)
    for t in range(16, 64):
        x, y = w[t - 15], w[t - 2]
        small = _turn(x, 7) ^ _turn(x, 18) ^ (x >> np.uint32(3))
        large = _turn(y, 17) ^ _turn(y, 19) ^ (y >> np.uint32(10))
        w.append(w[t - 16] + small + w[t - 7] + large)
    a, b, c, d, e, f, g, h = state
    for t in range(64):
        first = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + ((e & f) ^ (~e & g)) + ROUND[t] + w[t]
        second = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) ^ (a & c) ^ (b & c))
        a, b, c, d, e, f, g, h = first + second, a, b, c, d + first, e, f, g
    return state + np.stack([a, b, c, d, e, f, g, h])


def finish(state: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The digests of messages of ``blocks`` whole blocks whose states are given."""
    end = np.zeros((16, state.shape[1]), np.uint32)
    end[0] = 0x80000000
    bits = blocks.astype(np.uint64) * np.uint64(512)
    end[14] = (bits >> np.uint64(32)).astype(np.uint32)
    end[15] = (bits & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return absorb(state, end)


def to_bytes(digests: np.ndarray) -> np.ndarray:
    """(n, 8) words as (n, 32) bytes, big endian."""
    return np.ascontiguousarray(digests).astype(">u4").view(np.uint8).reshape(-1, 32)


def from_bytes(raw: bytes | np.ndarray) -> np.ndarray:
    """Bytes of whole digests or states as (n, 8) words."""
    return np.frombuffer(raw, ">u4").astype(np.uint32).reshape(-1, 8)


def hex_text(digests: np.ndarray) -> np.ndarray:
    """(n, 8) words as (n, 64) bytes of lowercase hex."""
    return _HEX[to_bytes(digests)].reshape(-1, 64)


def hex_block(digests: np.ndarray) -> np.ndarray:
    """The hex text of each digest as one block: (16, n)."""
    return np.ascontiguousarray(hex_text(digests)).view(">u4").astype(np.uint32).T
