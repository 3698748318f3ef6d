"""Numpy kernels over UTF-8 bytes, used inside Spark tasks.

A word is a run of bytes other than space and 0x09-0x0D; A-Z count as a-z.
"""

from __future__ import annotations

import numpy as np

from .shared import row_chunks

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _fold_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[ord("A") : ord("Z") + 1] += 32
    t[9:14] = 32
    return t


_FOLD = _fold_table()
#: As _FOLD, with every ASCII character but letters and digits as a space.
LETTERS = np.where((_FOLD < 128) & ~np.isin(_FOLD, np.frombuffer(b"abcdefghijklmnopqrstuvwxyz0123456789", np.uint8)), 32, _FOLD).astype(np.uint8)
_BYTE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers = [np.ones(1, _U), np.ones(1, _U)]


#: Powers that a worker keeps; those for a longer text are made for it alone.
KEPT_POWERS = 1 << 20


def power(which: int, n: int) -> np.ndarray:
    """The first n powers of the base (0) or its inverse (1), modulo 2^64."""
    if len(_powers[which]) >= n:
        return _powers[which][:n]
    steps = np.full(max(n, KEPT_POWERS), (_BASE, _INVERSE)[which], dtype=_U)
    steps[0] = 1
    made = np.cumprod(steps, dtype=_U)
    if len(made) == KEPT_POWERS:
        _powers[which] = made
    return made[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: each input bit reaches each output bit."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def words(data: np.ndarray, offsets: np.ndarray, fold: np.ndarray = _FOLD) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A 64-bit hash of each word, where each row's words begin (rows + 1 values), and the
    words' first and past-the-last bytes."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return np.zeros(0, _U), np.zeros(len(offsets), np.int64), none, none
    folded = fold[data]
    solid = folded != 32
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    starts = solid.copy()
    starts[1:] &= ~solid[:-1] | first[1:n]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | first[1:n]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    prefix = np.zeros(n + 1, _U)
    np.cumsum(_BYTE[folded] * power(0, n), dtype=_U, out=prefix[1:])
    h = (prefix[e] - prefix[s]) * power(1, n)[s]
    h = mix(h + (e - s).astype(_U) * _U(0xD6E8FEB86659FD93))
    return h, np.searchsorted(s, offsets).astype(np.int64), s, e


def word_hashes(data: np.ndarray, offsets: np.ndarray, fold: np.ndarray = _FOLD) -> tuple[np.ndarray, np.ndarray]:
    return words(data, offsets, fold)[:2]


def shingles(words: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's runs of k words, repeats included, and where each row begins.

    A row of fewer words has its whole sequence as one; a row without words has none.
    """
    n = np.diff(at)
    counts = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    out_at = np.concatenate([[0], np.cumsum(counts)])
    if out_at[-1] == 0:
        return np.zeros(0, _U), out_at
    row = np.repeat(np.arange(len(n)), counts)
    pos = at[row] + np.arange(out_at[-1]) - out_at[row]
    length = np.minimum(n[row], k)
    h = length.astype(_U)
    padded = np.concatenate([words, np.zeros(k, _U)])
    for i in range(k):
        here = np.where(length > i, padded[pos + i], _U(0))
        h = mix(h * _U(0x9FB21C651E98DF25) + here + _U(i + 1))
    return h, out_at


def distinct_in_rows(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's values sorted, without repeats."""
    out, counts = [], np.zeros(len(at) - 1, np.int64)
    for i in range(len(at) - 1):
        if at[i + 1] > at[i]:
            v = np.sort(values[at[i] : at[i + 1]])
            v = v[np.concatenate([[True], v[1:] != v[:-1]])]
            out.append(v)
            counts[i] = len(v)
    return (np.concatenate(out) if out else values[:0]), np.concatenate([[0], np.cumsum(counts)])


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's set of k-word shingles as sorted 64-bit hashes; some rows at a time."""
    values, counts = [np.zeros(0, _U)], [np.zeros(1, np.int64)]
    for lo, hi in row_chunks(offsets, 1 << 19):
        o = offsets[lo : hi + 1]
        v, at = distinct_in_rows(*shingles(*word_hashes(data[o[0] : o[-1]], o - o[0]), k))
        values.append(v)
        counts.append(np.diff(at))
    return np.concatenate(values), np.cumsum(np.concatenate(counts))


def sum_rows(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums by row (of the first axis); an empty row gives 0."""
    full = np.flatnonzero(np.diff(at) > 0)
    out = np.zeros((len(at) - 1, *values.shape[1:]), values.dtype)
    if len(full):
        out[full] = np.add.reduceat(values, at[full], axis=0)
    return out
