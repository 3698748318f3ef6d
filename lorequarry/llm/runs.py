"""Maximal periodic runs of words, by suffix trees of a stretch and of its reversal.

A run has a smallest period q, at least 4 q words and at least 6, and no neighbour goes on with it.
Each of its three-word windows stands again q words away, so runs lie inside stretches whose
windows recur at no more than a quarter of the stretch; numpy cuts texts down to those (`stretches`).
There, the longest Lyndon words under the order of the words and under its reverse are candidates
for a root: by the runs theorem each run has one. Both ends are extended by longest common
extensions, which a tree answers from the lowest common ancestor of two leaves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .kernels import words
from .repetition import SPACES, grouped, pieces, rolled
from .shared import lean, row_chunks, small_batches, text_bytes

#: Fewest words of a run, and fewest of its periods.
LEAST, TIMES = 6, 4
_WINDOW = 3
_BLOCK = 16


class SuffixTree:
    """Ukkonen's suffix tree of positive numbers, ended by a zero, and its leaves' common ancestors."""

    def __init__(self, numbers: list[int]):
        self.n = len(numbers)
        self._text = [*numbers, 0]
        self._grow()
        self._tour()

    def _grow(self) -> None:
        """Adds one number after another; edges are (node, first number) in one table."""
        s, size = self._text, max(self._text) + 1
        n, edge = len(s), {}
        start, end, link, suffix = [0], [0], [0], [-1]
        node, at, length, due = 0, 0, 0, 0
        for pos, c in enumerate(s):
            due += 1
            last = 0
            while due:
                if not length:
                    at = pos
                key = node * size + s[at]
                to = edge.get(key)
                if to is None:
                    edge[key] = len(start)
                    start.append(pos)
                    end.append(n)
                    link.append(0)
                    suffix.append(pos - due + 1)
                    if last:
                        link[last] = node
                        last = 0
                else:
                    has = end[to] - start[to]
                    if length >= has:
                        at += has
                        length -= has
                        node = to
                        continue
                    if s[start[to] + length] == c:
                        length += 1
                        if last:
                            link[last] = node
                        break
                    fork, cut = len(start), start[to] + length
                    edge[key] = fork
                    start += (start[to], pos)
                    end += (cut, n)
                    link += (0, 0)
                    suffix += (-1, pos - due + 1)
                    start[to] = cut
                    edge[fork * size + s[cut]] = to
                    edge[fork * size + c] = fork + 1
                    if last:
                        link[last] = fork
                    last = fork
                due -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    at = pos - due + 1
        keys = np.fromiter(edge.keys(), np.int64, len(edge))
        order = np.argsort(keys)
        self._children = np.fromiter(edge.values(), np.int64, len(edge))[order].tolist()
        self._first = np.searchsorted(keys[order], np.arange(len(start) + 1) * size).tolist()
        self._length = (np.array(end) - np.array(start)).tolist()
        self._suffix = suffix

    def _tour(self) -> None:
        """The Euler tour's depths in numbers, each leaf's place there, and minima over its blocks."""
        children, first, length, suffix = self._children, self._first, self._length, self._suffix
        to, place, rank, tour = first[:-1].copy(), [0] * (self.n + 1), [0] * (self.n + 1), []
        path, depths, leaves = [0], [0], 0
        while path:
            v, d = path[-1], depths[-1]
            tour.append(d)
            if to[v] == first[v + 1]:
                path.pop()
                depths.pop()
                continue
            c = children[to[v]]
            to[v] += 1
            if suffix[c] < 0:
                path.append(c)
                depths.append(d + length[c])
            else:
                place[suffix[c]], rank[suffix[c]] = len(tour), leaves
                leaves += 1
                tour.append(d + length[c])
        self._place, self.rank = np.array(place), rank
        blocks = -(-len(tour) // _BLOCK)
        t = np.full((blocks, _BLOCK), self.n + 1, np.int32)
        t.reshape(-1)[: len(tour)] = tour
        self._depths = t.reshape(-1)
        self._before, self._after = np.minimum.accumulate(t, axis=1).reshape(-1), np.minimum.accumulate(t[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        self._sparse = [t.min(axis=1)]
        while (step := 1 << (len(self._sparse) - 1)) * 2 <= blocks:
            self._sparse.append(np.minimum(self._sparse[-1][:-step], self._sparse[-1][step:]))

    def reverse_rank(self) -> list[int]:
        """The suffixes' ranks when numbers are ordered the other way; a suffix still follows its prefixes."""
        children, first, suffix = self._children, self._first, self._suffix
        rank, stack, leaves = [0] * (self.n + 1), [0], 0
        while stack:
            v = stack.pop()
            if suffix[v] >= 0:
                rank[suffix[v]] = leaves
                leaves += 1
                continue
            below = children[first[v] : first[v + 1]]
            # the end of the text, if it is there, is the least number and stays first
            ends = suffix[below[0]] >= 0 and self._text[suffix[below[0]] + self._depth_of(v, below[0])] == 0
            stack += [*below[1:], below[0]] if ends else below
        return rank

    def _depth_of(self, v: int, leaf: int) -> int:
        return self.n + 1 - self._suffix[leaf] - self._length[leaf]

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many numbers the suffixes from i and from j have in common, for different i and j."""
        a, b = self._place[i], self._place[j]
        a, b = np.minimum(a, b), np.maximum(a, b)
        x, y = a // _BLOCK, b // _BLOCK
        out = np.minimum(self._after[a], self._before[b])
        between = np.flatnonzero(y - x > 1)
        lo, n = x[between] + 1, (y - x)[between] - 1
        level = np.frexp(n)[1] - 1
        for k in np.unique(level):
            on = level == k
            table = self._sparse[k]
            out[between[on]] = np.minimum(out[between[on]], np.minimum(table[lo[on]], table[lo[on] + n[on] - (1 << k)]))
        inside = np.flatnonzero(x == y)
        if len(inside):
            out[inside] = self._depths[a[inside]]
            for k in range(1, _BLOCK):
                more = inside[a[inside] + k <= b[inside]]
                out[more] = np.minimum(out[more], self._depths[a[more] + k])
        return out


def _lyndon(rank: list[int], n: int) -> np.ndarray:
    """The length of the longest Lyndon word from each place: up to the next lesser suffix."""
    out, later = [0] * n, []
    for i in range(n - 1, -1, -1):
        while later and rank[later[-1]] > rank[i]:
            later.pop()
        out[i] = (later[-1] if later else n) - i
        later.append(i)
    return np.array(out, np.int64)


def runs(ids: np.ndarray) -> np.ndarray:
    """All runs of the numbers as rows (start, length, period), by start, then period."""
    n = len(ids)
    if n < LEAST:
        return np.zeros((0, 3), np.int64)
    dense = (np.unique(ids, return_inverse=True)[1] + 1).tolist()
    forward, backward = SuffixTree(dense), SuffixTree(dense[::-1])
    i = np.tile(np.arange(n), 2)
    p = np.concatenate([_lyndon(forward.rank, n), _lyndon(forward.reverse_rank(), n)])
    fits = i + p < n  # a root at the very end is met by the same run's root before it
    i, p = i[fits], p[fits]
    right = forward.common(i, i + p)
    left = np.zeros(len(i), np.int64)
    inner = np.flatnonzero(i > 0)
    left[inner] = backward.common(n - i[inner], n - i[inner] - p[inner])
    found = np.stack([i - left, left + p + right, p], axis=1)
    found = np.unique(found[found[:, 1] >= np.maximum(LEAST, TIMES * p)], axis=0)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def stretches(ids: np.ndarray, row: np.ndarray) -> list[tuple[int, int]]:
    """(from, to) of the stretches of the rows' numbers that can hold runs; `row` never falls.

    A window that does not recur in its stretch, within a quarter of its length, lies in no run.
    """
    at = np.arange(len(ids))
    while len(at):
        last = np.concatenate([np.flatnonzero(np.diff(row)) + 1, [len(row)]])
        first = np.concatenate([[0], last[:-1]])
        quarter = np.repeat((last - first) // TIMES, last - first)
        m = max(len(ids) - _WINDOW + 1, 0)
        own = np.flatnonzero(row[:m] == row[_WINDOW - 1 :])
        order, same = grouped(rolled(ids, _WINDOW)[own]) if len(own) else (own, np.zeros(0, bool))
        order = own[order]
        again = np.flatnonzero(same)
        near = (row[order[again]] == row[order[again - 1]]) & (order[again] - order[again - 1] <= quarter[order[again]])
        edge = np.zeros(len(ids) + 1, np.int64)
        for w in (order[again - 1][near], order[again][near]):
            np.add.at(edge, w, 1)
            np.add.at(edge, w + _WINDOW, -1)
        kept = np.cumsum(edge[:-1]) > 0
        begins = kept & np.concatenate([[True], ~kept[:-1] | (row[1:] != row[:-1])])
        row_of = np.cumsum(begins)[kept]
        long = np.bincount(row_of)[row_of] >= LEAST if len(row_of) else np.zeros(0, bool)
        if len(long) == len(ids) and long.all() and np.array_equal(np.diff(row_of) != 0, np.diff(row) != 0):
            return list(zip(at[first].tolist(), (at[last - 1] + 1).tolist()))
        ids, at, row = ids[kept][long], at[kept][long], row_of[long]
    return []


def _described(text: bytes, found: list[tuple[int, int, int]]) -> tuple:
    """A text's columns from its runs."""
    kept = text.split()  # the same white space, as all bytes of 0x80 and above are letters
    if found:
        gone = np.zeros(len(kept) + 1, np.int64)
        for s, n, q in found:
            gone[s + q] += 1
            gone[s + n] -= 1
        kept = [kept[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0)]
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    return (len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, hashlib.sha256(listed.encode()).hexdigest(), b" ".join(kept).decode(), [{"start": s, "length": n, "period": q} for s, n, q in found])


_OUT = pa.schema([("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()), ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed", pa.string()), ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])))])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Of each whole text of `docs` (doc_id, text): n_runs, the run of greatest exponent (start,
    length, period, exponent_milli; ties: least start, then period), the digest of all runs, the
    text `collapsed` to each run's first period, its words joined by one space, and `runs`.

    Null, empty and wordless texts have no run, four nulls and an empty collapsed text. Repeated
    rows are searched each; a null doc_id stays; an empty table gives an empty table; other
    columns are not read. doc_id is a long. A task holds the trees of one stretch at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for lo, hi in row_chunks(offsets):
                part, own = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                h, at, s, e = words(part, own, SPACES)
                row = np.repeat(np.arange(hi - lo), np.diff(at))
                ids = pieces(part, h, s, e)
                found: list[list] = [[] for _ in range(hi - lo)]
                for x, y in stretches(ids, row):
                    base = x - at[row[x]]
                    found[row[x]] += [(int(a + base), int(n), int(q)) for a, n, q in runs(ids[x:y])]
                raw = part.tobytes()
                rows = [_described(raw[own[k] : own[k + 1]], found[k]) for k in range(hi - lo)]
                columns = [batch.column("doc_id").slice(lo, hi - lo), *(pa.array(c, f.type) for c, f in zip(zip(*rows), list(_OUT)[1:]))]
                yield pa.RecordBatch.from_arrays(columns, schema=_OUT)

    schema = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed string, runs array<struct<start: long, length: long, period: long>>"
    return small_batches(docs).select("doc_id", "text").mapInArrow(lean(run), schema)
