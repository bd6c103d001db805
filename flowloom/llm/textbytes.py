"""Numpy helpers inside tasks: batches of whole texts as bytes, word tables, hashes of words and windows.

Hashes are polynomials modulo 2**64 over random byte values, finished by an
avalanche step. With N compared strings the expected number of wrong equalities is
N * N / 2**65.
"""

from __future__ import annotations

import numpy as np

SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BATCH_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE_VALUES = np.random.default_rng(20240607).integers(1, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_COEFFICIENTS = np.random.default_rng(7).integers(1, 2**64, 64, dtype=np.uint64) | np.uint64(1)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, kept for the next batch of the task."""
    if len(_powers["up"]) < n:
        size = max(n, BATCH_BYTES + 4096)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Avalanche of 64-bit values; a permutation, so different inputs stay different."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def batches(texts, limit: int = BATCH_BYTES):
    """(first, last, bytes) of runs of texts of about ``limit`` bytes; a longer text is a run of its own.

    Every text is followed by one space, so words end with their text; offsets come from ``offsets_of``.
    """
    first, size, parts = 0, 0, []
    for i, text in enumerate(texts):
        text = b"" if text is None else bytes(text)
        if parts and size + len(text) > limit:
            yield first, i, parts
            first, size, parts = i, 0, []
        parts.append(text)
        size += len(text) + 1
    if parts:
        yield first, first + len(parts), parts


def joined(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes with one space after each text, and where each text starts (one more entry for the end)."""
    starts = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) + 1 for p in parts], out=starts[1:])
    return np.frombuffer(b" ".join(parts) + b" ", np.uint8), starts


def prefix_hash(data: np.ndarray) -> np.ndarray:
    up, _ = powers(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * up, out=out[1:])
    return out


def stretch_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the bytes [start, end), length included."""
    _, down = powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_edges(data: np.ndarray, between: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word; ``between`` tells for each byte value whether it parts words."""
    space = np.ones(len(data) + 1, bool)
    space[1:] = between[data]
    edges = np.flatnonzero(space[1:] != space[:-1])
    return edges[::2], edges[1::2]


def window_hash(words: np.ndarray, size: int) -> np.ndarray:
    """One hash per run of ``size`` consecutive word hashes."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(size):
        out += words[j:j + n] * _COEFFICIENTS[j]
    return mix(out + np.uint64(size))


def unique_sorted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(unique keys, stable order, first of each run in that order, run lengths)."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return ordered[first], order, first, np.diff(np.append(first, len(keys)))


def spread_back(values: np.ndarray, order: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Values of the unique keys at the places the keys came from."""
    out = np.empty(len(order), values.dtype)
    out[order] = np.repeat(values, counts)
    return out


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of ``n`` places lie in [s, s + length) for some start s."""
    steps = np.bincount(starts, minlength=n + 1) - np.bincount(np.minimum(starts + length, n), minlength=n + 1)
    return np.cumsum(steps[:n]) > 0


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of True."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    return edges[::2], edges[1::2]
