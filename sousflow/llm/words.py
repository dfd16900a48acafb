"""Words and shingles of whole batches of texts as numpy arrays.

Everything works on the UTF-8 bytes of an Arrow string column at once: no Python string
is made and no loop runs over words. A word is a run of bytes other than space and
0x09-0x0D; A-Z may be lower-cased. A word's 64-bit hash does not depend on where it stands.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_RNG = np.random.default_rng(20240229)
_EXACT = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = _EXACT.copy()
_LOWER[65:91] = _EXACT[97:123]
_STEP = int(_RNG.integers(1, 2**61)) * 8 + 5
#: One odd factor for each place in a shingle of at most 64 words.
_PLACES = [int(x) * 2 + 1 for x in _RNG.integers(1, 2**62, 64)]
_SEGMENT = 1 << 16

def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the step and of its inverse modulo 2**64."""
    out = []
    for base in (_STEP, pow(_STEP, -1, 2**64)):
        x = np.full(n, base, dtype=np.uint64)
        x[:1] = 1
        out.append(np.cumprod(x, dtype=np.uint64))
    return out[0], out[1]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a finaliser of xor-shifts and multiplications)."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, and where each text begins in them (one more entry than texts)."""
    column = column.cast(pa.large_string()) if column.null_count == 0 else column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if len(at) == 0:
        at = np.zeros(1, dtype=np.int64)
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8))[at[0] : at[-1]], at - at[0]


def word_bounds(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (exclusive) of every word; no word runs over the end of its text."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~SEPARATOR[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = at[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def hashed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hashes of the given spans of ``data``, which must not overlap and must be in order."""
    out = np.empty(len(starts), dtype=np.uint64)
    codes, i = (_LOWER if lower else _EXACT), 0
    up = down = np.zeros(0, np.uint64)
    while i < len(starts):
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + _SEGMENT, side="right")))
        n = int(ends[j - 1] - base)
        if len(up) <= n:
            up, down = _power(min(n, _SEGMENT) + n // 8 + 1)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(codes[data[base : base + n]] * up[:n], out=sums[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = (sums[e] - sums[s]) * down[s]
        i = j
    return mixed(out)


def words(column: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in order, and where each text's words begin among them."""
    data, at = raw(column)
    starts, ends = word_bounds(data, at)
    return hashed(data, starts, ends, lower), np.searchsorted(starts, at)


def _distinct(sorted_values: np.ndarray) -> np.ndarray:
    keep = np.ones(len(sorted_values), dtype=bool)
    np.not_equal(sorted_values[1:], sorted_values[:-1], out=keep[1:])
    return sorted_values[keep]


def _run_hash(hashes: np.ndarray, size: int) -> np.ndarray:
    n = len(hashes) - size + 1
    total = np.full(max(n, 0), size, dtype=np.uint64)
    for k in range(size if n > 0 else 0):
        total += hashes[k : n + k] * np.uint64(_PLACES[k])
    return mixed(total)


def shingle_sets(hashes: np.ndarray, at: np.ndarray, size: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its runs of ``size`` words.

    A shorter text's whole word sequence is one shingle; a text without words has none.
    """
    runs = _run_hash(hashes, size)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        out.append(_distinct(np.sort(runs[a : b - size + 1])) if b - a >= size else _run_hash(hashes[a:b], b - a) if b > a else hashes[:0])
    return out
