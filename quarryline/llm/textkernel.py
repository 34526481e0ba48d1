"""Vectorised hashing of words and of windows over bytes or words, in numpy."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
_RNG = np.random.default_rng(20240229)
BYTE = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
BASE = int(_RNG.integers(0, 2**63, dtype=np.int64)) * 2 + 1
INVERSE = pow(BASE, -1, 2**64)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Powers that stay between tasks at most, for each base.
KEPT = 1 << 18
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= KEPT:
            _powers[base] = have
    return have[:n]


def rest() -> None:
    """Give freed memory back to the machine at the end of a task: idle Python workers stay beside the JVM's heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def resting(run):
    """A function over batches that rests when its task ends."""

    def rested(batches):
        try:
            yield from run(batches)
        finally:
            rest()

    return rested


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(32))


def mix_once(h: np.ndarray) -> np.ndarray:
    """A cheaper spread, enough to compare hashes and to take their least."""
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(29))


def span_hash(units: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The hash of units[start:end] for each pair; equal runs have equal hashes wherever they stand."""
    n = len(units)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(units * powers(BASE, n), out=total[1:])
    return mix((total[end] - total[start]) * powers(INVERSE, n + 1)[start])


def window_hash(units: np.ndarray, length: int, spread=mix) -> np.ndarray:
    """The hash of each window of that many units."""
    n = len(units)
    if n < length:
        return np.empty(0, np.uint64)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(units * powers(BASE, n), out=total[1:])
    return spread((total[length:] - total[:-length]) * powers(INVERSE, n - length + 1))


def word_spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a byte array start and end."""
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~SPACE[raw]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of each word."""
    start, end = word_spans(raw)
    return span_hash(BYTE[raw], start, end), start, end


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each window of that many values, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = np.minimum(x[: len(x) - step], x[step:])
        done += step
    return x


def slices(texts: list, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Consecutive slices of texts with at most that many bytes each, or one text."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t is not None else 0
        if size and size + n > limit:
            yield at, i
            at, size = i, 0
        size += n
    if at < len(texts):
        yield at, len(texts)


def joined(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """The texts in one byte array, each followed by a space, and where each starts (one more for the end)."""
    parts = [b"" if t is None else t for t in texts]
    raw = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
    starts = np.zeros(len(parts) + 1, np.int64)
    np.cumsum(np.fromiter((len(p) + 1 for p in parts), np.int64, len(parts)), out=starts[1:])
    return raw, starts
