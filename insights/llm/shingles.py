"""Word shingles and MinHash values of a text, computed inside tasks with numpy.

Words are the runs between ASCII white space of the lower-cased text.  A
shingle is five words in a row; a text of one to four words has one shingle,
all its words; a text without words has none.  A shingle is held as a 64-bit
hash of its words, so sets of shingles are sorted arrays of distinct numbers.
"""

from __future__ import annotations

import numpy as np

WORDS_PER_SHINGLE = 5

_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit number over all of them (a fixed bijection)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    if n:
        out[0] = 1
        out[1:] = base
        np.multiply.accumulate(out, out=out)
    return out


_POW = _powers(int(_BASE), 1 << 12)


def word_hashes(text: str | None) -> np.ndarray:
    """One 64-bit hash for each word, in order: a polynomial in a fixed random
    number per byte, with the lowest power at the word's start."""
    data = np.frombuffer((text or "").lower().encode("utf-8", "surrogatepass"), dtype=np.uint8)
    if not len(data):
        return np.empty(0, dtype=np.uint64)
    inside = ~_SPACE[data]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.empty(0, dtype=np.uint64)
    at = np.flatnonzero(inside)
    length = end - start
    offset = np.arange(len(at)) - np.repeat(np.cumsum(length) - length, length)
    longest = int(length.max())
    power = _POW if longest <= len(_POW) else _powers(int(_BASE), longest)
    value = _BYTE[data[at]] * power[offset]
    return _mix(np.add.reduceat(value, np.cumsum(length) - length) + length.astype(np.uint64))


def shingles(text: str | None, k: int = WORDS_PER_SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes of the whole text."""
    w = word_hashes(text)
    if not len(w):
        return w
    n = max(1, len(w) - k + 1)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(min(k, len(w))):
        out = out * _BASE + w[j : j + n]
    return np.unique(_mix(out))


def seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and offsets of ``n`` MinHash functions."""
    rng = np.random.Generator(np.random.PCG64(77))
    return (rng.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1),
            rng.integers(0, 1 << 32, n, dtype=np.uint32))


def minhash(values: np.ndarray, mul: np.ndarray, add: np.ndarray, step: int = 256) -> np.ndarray:
    """MinHash values (32 bits each) of a set of shingle hashes; the set is
    gone through in slices, so a very long text needs no more memory."""
    high = (values >> np.uint64(32)).astype(np.uint32)
    best = np.full(len(mul), np.iinfo(np.uint32).max, dtype=np.uint32)
    for i in range(0, len(high), step):
        np.minimum(best, (high[i : i + step, None] * mul + add).min(axis=0), out=best)
    return best
