"""Whitening of vectors by a covariance that is exact up to its last division.

Entries become whole numbers x. Two passes of sums give every number that is needed: first the
rows and the sums S of each dimension, then, with n x - S as centred values, the sums of squares of
every dimension and of every sum of two dimensions. Var(a + b) - Var(a) - Var(b) is twice the
covariance of a and b, so differences of these squares recover all of it. Sums are whole numbers
in tasks and in Spark; only a table of d (d + 1) / 2 of them, whatever the rows, reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import lean

#: An entry c counts as floor(SCALE c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Rows whose squares are summed at a time, and the bits of a centred value's low half.
_ROWS, _HALF = 1024, 26
#: Longer vectors are an error: the driver holds the square of it.
MOST_DIMENSIONS = 4096


class Whitener(NamedTuple):
    """A fit to vectors of one dimension: rows, sums, components (columns), eigenvalues, trace."""

    n: int
    sums: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float


def sound(df: DataFrame, id_: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, x): the whole numbers of the rows whose vector is there, with finite entries alone.

    Entries beyond 2^40, whose numbers could not be squared exactly, count as not finite.
    """
    v = F.col("_v")
    whole = F.transform(v, lambda c: F.floor(c * SCALE) + SHIFT)
    good = v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & (F.abs(c) < float(1 << 40)))  # NaN is above all
    return df.select(F.col(id_).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("_v")).where(F.coalesce(good, F.lit(False))).select("id", whole.alias("x"))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(d, places in the batch and their numbers) of some rows of dimension d, batch by batch; then (-1, ...)."""
    for batch in batches:
        x = batch.column("x")
        sizes = np.asarray(x.value_lengths())
        starts = np.asarray(x.offsets)[:-1] - x.offsets[0].as_py()
        flat = np.asarray(x.flatten())
        for d in np.unique(sizes[sizes > 0]):
            at = np.flatnonzero(sizes == d)
            for lo in range(0, len(at), _ROWS):
                some = at[lo : lo + _ROWS]
                yield int(d), batch.column("id").take(pa.array(some)) if "id" in batch.schema.names else None, flat[starts[some][:, None] + np.arange(d)]


def _firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's rows and sums of each dimension: (d, i, n, s)."""
    n: dict[int, int] = {}
    sums: dict[int, np.ndarray] = {}
    for d, _, x in _blocks(batches):
        n[d] = n.get(d, 0) + len(x)
        sums[d] = sums.get(d, 0) + x.sum(axis=0)
    for d in n:
        yield pa.RecordBatch.from_arrays([pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([n[d]] * d, pa.int64()), pa.array(sums[d], pa.int64())], ["d", "i", "n", "s"])


def squares(y: np.ndarray) -> np.ndarray:
    """For all i <= j in the order of their rows: the exact sum of (y_i + y_j)^2 over at most
    _ROWS rows, or of y_i^2 where i = j, as Python's whole numbers. Entries are below 2^50."""
    if len(y) and np.abs(y).max() >= 1 << 50:
        raise OverflowError("rows times the spread of a dimension must stay below 2^50")
    d, out = y.shape[1], []
    for i in range(d):
        z = y[:, i:] + y[:, i : i + 1]
        z[:, 0] = y[:, i]
        high, low = z >> _HALF, z & ((1 << _HALF) - 1)
        parts = [(a * b).sum(axis=0).tolist() for a, b in ((high, high), (high, low), (low, low))]
        out += [(hh << 2 * _HALF) + (hl << _HALF + 1) + ll for hh, hl, ll in zip(*parts)]
    return np.array(out, object)


def _seconds(fits: dict[int, tuple[int, np.ndarray]]):
    """A task's sums of squares: (d, k, q), k counting the pairs i <= j."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for d, _, x in _blocks(batches):
            n, sums = fits[d]
            total[d] = total.get(d, 0) + squares(n * x - sums)
        for d, q in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([d] * len(q), pa.int32()), pa.array(range(len(q)), pa.int32()), pa.array([str(v) for v in q])], ["d", "k", "q"])

    return run


def covariance(n: int, q: np.ndarray, d: int) -> np.ndarray:
    """The covariance, divisor n, from the sums of squares of n x - S by pairs; correctly rounded."""
    v, at = np.zeros((d, d)), 0
    own = {}
    for i in range(d):  # the places of the dimensions themselves
        own[i] = q[at]
        at += d - i
    at = 0
    for i in range(d):
        for j in range(i, d):
            twice = 2 * own[i] if i == j else q[at] - own[i] - own[j]
            v[i, j] = v[j, i] = twice / (2 * n**3)
            at += 1
    return v


def fit(rows: DataFrame, most: int = 32) -> dict[int, Whitener]:
    """A Whitener for each dimension of `rows` (x), from all of them.

    Components of no variance (below rounding of the largest) are left out, as nothing scales
    them to one. Vectors of more than MOST_DIMENSIONS entries are an error. n times the largest
    distance of a value from its mean must stay below 2^50, and squares summed below 10^38.
    """
    firsts = rows.mapInArrow(lean(_firsts), "d int, i int, n long, s long").groupBy("d", "i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    sums: dict[int, tuple[int, dict]] = {}
    for r in firsts.collect():  # a row for each dimension
        if r["d"] > MOST_DIMENSIONS:
            raise ValueError(f"vectors of more than {MOST_DIMENSIONS} entries")
        sums.setdefault(r["d"], (r["n"], {}))[1][r["i"]] = int(r["s"])
    fits = {d: (n, np.array([s[i] for i in range(d)], np.int64)) for d, (n, s) in sums.items()}
    seconds = rows.mapInArrow(lean(_seconds(fits)), "d int, k int, q string").groupBy("d", "k").agg(F.sum(F.col("q").cast("decimal(38,0)")).alias("q"))
    squared: dict[int, dict] = {}
    for r in seconds.collect():  # one for each pair of dimensions
        squared.setdefault(r["d"], {})[r["k"]] = int(r["q"])
    out = {}
    for d, (n, s) in fits.items():
        v = covariance(n, np.array([squared[d][k] for k in range(d * (d + 1) // 2)], object), d)
        values, vectors = np.linalg.eigh(v)
        order = np.argsort(-values, kind="stable")[:most]
        order = order[values[order] > values.max(initial=0) * d * np.finfo(float).eps]
        out[d] = Whitener(n, s, vectors[:, order], values[order], float(np.trace(v)))
    return out


def _white(m: Whitener, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows' centred whole numbers, and their whitened components."""
    y = m.n * x - m.sums
    return y, (y / m.n) @ m.vectors / np.sqrt(m.values)


def _crossed(models: dict[int, Whitener]):
    """A task's rows, sums and cross products of whitened components: (d, n, s, g)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for d, _, x in _blocks(batches):
            _, w = _white(models[d], x)
            one = total.setdefault(d, [0, 0.0, 0.0])
            one[0] += len(w)
            one[1] += w.sum(axis=0)
            one[2] += w.T @ w
        for d, (n, s, g) in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([n], pa.int64()), pa.array([s.tolist()], pa.list_(pa.float64())), pa.array([g.ravel().tolist()], pa.list_(pa.float64()))], ["d", "n", "s", "g"])

    return run


def identity_error(rows: DataFrame, models: dict[int, Whitener]) -> float:
    """The largest entry of the whitened rows' covariance minus the identity, measured on the rows.

    Whitened rows are centred but for rounding; what is left of their mean is taken off.
    """
    tasks = rows.mapInArrow(lean(_crossed(models)), "d int, n long, s array<double>, g array<double>")
    pos = tasks.select("d", "n", F.posexplode(F.concat("s", "g")).alias("k", "v")).groupBy("d", "k").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    found: dict[int, dict] = {}
    for r in pos.collect():  # one for each pair of components
        found.setdefault(r["d"], {})[r["k"]] = r["v"] / r["n"]
    worst = 0.0
    for d, v in found.items():
        k = len(models[d].values)
        mean = np.array([v[i] for i in range(k)])
        cross = np.array([v[k + i] for i in range(k * k)]).reshape(k, k) - np.outer(mean, mean)
        worst = max(worst, float(np.abs(cross - np.eye(k)).max(initial=0)))
    return worst


_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(df: DataFrame, id_: str = "vec_id", vector: str = "embedding", most: int = 32) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): each sound row's first
    `most` components, numbered from 1 by falling eigenvalue.

    Null vectors and those with null or non-finite entries are dropped; repeated rows and null ids
    count and stay. Vectors of another length are whitened among themselves; one without entries
    has no component. A deviation past 64 bits is an error. An empty table, or one of equal
    vectors, gives no row. Other columns are not read.
    """
    rows = sound(df, id_, vector)
    models = fit(rows, most)
    error = identity_error(rows, models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for d, ids, x in _blocks(batches):
            m = models[d]
            y, w = _white(m, x)
            k = len(m.values)
            if len(y) and d * float(np.abs(y).max()) ** 2 >= 2**63:
                raise OverflowError("a deviation needs more than 64 bits")
            each = np.repeat(np.arange(len(x)), k)
            columns = [ids.take(pa.array(each)), np.tile(np.arange(1, k + 1, dtype=np.int32), len(x)), np.full(len(each), m.n), (y * y).sum(axis=1)[each], w.ravel(), np.tile(m.values / m.trace, len(x)), np.full(len(each), error)]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(lean(run), _OUT)
