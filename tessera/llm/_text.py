"""Words and 64-bit hashes of whole Arrow string columns, by NumPy over the UTF-8 bytes.

All patterns used by the operators only tell ASCII characters apart, so every byte of a
multi-byte character is a word byte and no decoding is needed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

#: Bytes handled at once by the word hash: bounds its scratch arrays to a few MB.
CHUNK = 1 << 20

#: Longest word that the polynomial hash is used for.
LONG = 256

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]`, after lower-casing.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True

#: `[^\x20\x09-\x0D]`.
NON_SPACE = np.ones(256, bool)
NON_SPACE[[32, 9, 10, 11, 12, 13]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser: a bijection on uint64 that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def seeds(n: int, salt: int) -> np.ndarray:
    """n fixed pseudo-random odd uint64 values."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt)) | np.uint64(1)


_BYTE = seeds(256, 11)
_BASE = 0x5851F42D4C957F2D
_BASE_INV = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POW: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n > CHUNK:
        return _powers(_BASE, n), _powers(_BASE_INV, n)
    if CHUNK not in _POW:
        _POW[CHUNK] = _powers(_BASE, CHUNK), _powers(_BASE_INV, CHUNK)
    return _POW[CHUNK]


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows and the n + 1 row bounds; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    column = column.cast(pa.large_binary())
    n = len(column)
    _, bounds, data = column.buffers()
    at = np.frombuffer(bounds, np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def slices(bounds: np.ndarray, limit: int):
    """Row ranges of at most `limit` bytes each; a longer row is a range of its own."""
    lo, n = 0, len(bounds) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + limit, "right")) - 1)
        yield lo, hi
        lo = hi


def words(data: np.ndarray, bounds: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start byte, end byte) of every word and, per row, the bounds of its words."""
    inside = kind[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    at = bounds[:-1][bounds[:-1] < len(data)]
    first[at] = inside[at]
    at = bounds[1:][bounds[1:] > 0] - 1
    last[at] = inside[at]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, bounds)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial over random byte values, from prefix sums.

    The polynomial is modulo 2^64, where words of 1,024 letters and more can be made to collide whatever
    the values are, so words of over LONG bytes have XXH3 of their bytes instead.
    """
    out = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        base = starts[lo]
        hi = max(lo + 1, int(np.searchsorted(ends, base + CHUNK, "right")))
        n = int(ends[hi - 1] - base)
        up, down = _power_tables(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[data[base : base + n]] * up[:n], out=sums[1:])
        s, e = starts[lo:hi] - base, ends[lo:hi] - base
        out[lo:hi] = (sums[e] - sums[s]) * down[s]
        lo = hi
    out = mix(out)
    for i in np.flatnonzero(ends - starts > LONG).tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]])
    return out


_STEP = seeds(64, 77)


def shingle_hashes(hashes: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every row's k-word shingles, rows in order, and the n + 1 bounds of the rows.

    A row of fewer words, but not none, has its whole sequence as its one shingle.
    """
    n = np.diff(bounds)
    counts = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    out_bounds = np.concatenate([[0], np.cumsum(counts)])
    row = np.repeat(np.arange(len(n)), counts)
    first = bounds[:-1][row] + np.arange(out_bounds[-1]) - out_bounds[:-1][row]
    size = np.minimum(n[row], k)
    padded = np.concatenate([hashes, np.zeros(k, np.uint64)])
    out = size.astype(np.uint64)
    for j in range(k):
        out += np.where(j < size, padded[first + j], np.uint64(0)) * _STEP[j]
    return mix(out), out_bounds


def row_sets(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each row, and the rows' bounds."""
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((hashes, row))
    h, row = hashes[order], row[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    row = row[keep]
    return h[keep], np.searchsorted(row, np.arange(len(bounds)))
