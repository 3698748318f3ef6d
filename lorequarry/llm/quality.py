"""Quality by naive Bayes support vectors.

Features are indicators of hashed n-grams: of four bytes, and of one to three neighbouring
words' shapes (case, digits, closing marks, repetition of the word before). Each indicator is
scaled by its class log-count ratio; a linear hinge-loss model on the scaled, unit-length
vectors is fitted by dual coordinate descent; a sigmoid on margins of set-aside rows gives
scores from 0 to 1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .shared import cut, lean, row_chunks, small_batches, text_bytes

_U = np.uint64
#: Labelled documents that a model is fitted on, those of the least hash of doc_id, and the bytes
#: of their features.
MAX_ROWS, MAX_BYTES = 12_000, 256 << 20


def _shapes(data: np.ndarray, h: np.ndarray, at: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """A number for each word's shape."""
    wide = np.concatenate([[False], data[:-1] == 0xC3])
    upper = ((data >= 65) & (data <= 90)) | (wide & (data >= 0x80) & (data <= 0x9E))
    lower = ((data >= 97) & (data <= 122)) | (wide & (data >= 0xA0) & (data != 0xB7))
    digit = (data >= 48) & (data <= 57)
    mark = (data < 128) & ~upper & ~lower & ~digit

    def some(flags):
        c = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return c[e] - c[s]

    up, low, dig, marks = some(upper), some(lower), some(digit), some(mark)
    again = np.zeros(len(h), bool)
    again[1:] = h[1:] == h[:-1]
    again[at[:-1][at[:-1] < len(h)]] = False
    last = np.where(mark[e - 1], data[e - 1], 0).astype(np.int64)
    case = np.minimum(up, 2) * 2 + (low > 0)
    return (((case * 2 + (dig > 0)) * 4 + np.minimum(marks, 3)) * 2 + again) * 256 + last


def features(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct feature numbers of each row, and where each row's begin."""
    mask = _U((1 << bits) - 1)
    h, at, s, e = K.words(data, offsets)
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    if len(h):
        shape = K.mix(_shapes(data, h, at, s, e).astype(_U) + _U(7))
        for n in (1, 2, 3):
            g, g_at = K.shingles(shape, at, n)
            parts.append(((g ^ _U(n)) & mask, g_at))
        d = data.astype(_U)
        m = max(0, len(d) - 3)
        four = K.mix(d[:m] | d[1 : m + 1] << _U(8) | d[2 : m + 2] << _U(16) | d[3 : m + 3] << _U(24)) & mask
        begin = np.minimum(offsets[:-1], m)
        end = np.maximum(begin, np.minimum(offsets[1:] - 3, m))
        inside = np.zeros(m + 1, np.int8)
        np.add.at(inside, begin, 1)
        np.add.at(inside, end, -1)
        parts.append((four[np.cumsum(inside[:m]) > 0], np.concatenate([[0], np.cumsum(end - begin)])))
    rows = len(offsets) - 1
    values, counts = [], np.zeros(rows, np.int64)
    for i in range(rows):
        own = [v[a[i] : a[i + 1]].astype(np.uint32) for v, a in parts]
        v = np.sort(np.concatenate(own)) if own else np.zeros(0, np.uint32)
        if len(v):
            v = v[np.concatenate([[True], v[1:] != v[:-1]])]
        values.append(v)
        counts[i] = len(v)
    return np.concatenate(values) if values else np.zeros(0, np.uint32), np.concatenate([[0], np.cumsum(counts)])


class QualityModel:
    """Ratios r and weights w by feature, bias, and the sigmoid's slope and offset."""

    def __init__(self, bits: int, r: np.ndarray, w: np.ndarray, bias: float, slope: float = 1.0, offset: float = 0.0):
        self.bits, self.r, self.w, self.bias, self.slope, self.offset = bits, r.astype(np.float32), w.astype(np.float32), bias, slope, offset

    def margins(self, idx: np.ndarray, at: np.ndarray) -> np.ndarray:
        r = self.r[idx].astype(np.float64)
        norm = np.sqrt(K.sum_rows(r * r, at))
        return K.sum_rows(r * self.w[idx], at) / np.where(norm > 0, norm, 1) + self.bias

    def scores(self, idx: np.ndarray, at: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(idx, at) + self.offset, -35, 35)))


def dual_descent(idx: np.ndarray, at: np.ndarray, y: np.ndarray, r: np.ndarray, cost: float, rounds: int, seed: int = 5) -> tuple[np.ndarray, float]:
    """The L1 hinge-loss weights over r-scaled unit vectors with a bias feature, by coordinates."""
    w, bias = np.zeros(len(r)), 0.0
    rows = [idx[a:b] for a, b in zip(at[:-1], at[1:])]
    x = []
    for i in rows:
        v = r[i]
        n = np.sqrt((v * v).sum())
        x.append(v / n if n > 0 else v)
    alpha, q = np.zeros(len(y)), np.array([(v * v).sum() + 1 for v in x])
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for k in rng.permutation(len(y)):
            g = y[k] * (w[rows[k]] @ x[k] + bias) - 1
            new = min(max(alpha[k] - g / q[k], 0.0), cost)
            if new != alpha[k]:
                d = (new - alpha[k]) * y[k]
                w[rows[k]] += d * x[k]
                bias += d
                moved = max(moved, abs(d))
                alpha[k] = new
        if moved < 1e-3:
            break
    return w, bias


def _sigmoid(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the likeliest sigmoid (Newton's method with smoothed targets)."""
    pos, neg = (y > 0).sum(), (y < 0).sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -35, 35)))
        g = np.array([((p - t) * margin).sum(), (p - t).sum()])
        s = p * (1 - p) + 1e-9
        hess = np.array([[(s * margin * margin).sum(), (s * margin).sum()], [(s * margin).sum(), s.sum()]]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(hess, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def train(docs: DataFrame, labels: DataFrame, bits: int = 18, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES, smoothing: float = 1.0, cost: float = 1.0, rounds: int = 12) -> QualityModel:
    """Fit on `docs` (doc_id, text) and `labels` (doc_id, quality), joined by doc_id.

    At most `max_rows` labelled documents are used (those of the least hash of doc_id), and of
    them, in that order, as many as have `max_bytes` of features: these come to the driver, about
    5 kB each. Of documents that repeat an id one is used, of labels that do the greatest. Null
    ids and null labels are left out; null and empty texts have no feature. Labels of one class or
    none, or of no document, give a model that scores every text alike. Other columns are not read.
    """
    chosen = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    joined = small_batches(docs).select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most max_rows rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for lo, hi in row_chunks(offsets, 1 << 19):
                o = offsets[lo : hi + 1]
                idx, at = features(data[o[0] : o[-1]], o - o[0], bits)
                rows = [idx[a:b].astype("<u4").tobytes() for a, b in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), batch.column("quality").slice(lo, hi - lo), pa.array(rows, pa.binary())], ["doc_id", "quality", "f"])

    one = joined.mapInArrow(lean(run), "doc_id long, quality int, f binary").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.min("f").alias("f"))
    one = cut(one.withColumn("h", F.xxhash64("doc_id")))
    sizes = one.select("h", "doc_id", F.octet_length("f").alias("n")).orderBy("h", "doc_id").toArrow()  # at most max_rows rows
    fits = int(np.searchsorted(np.cumsum(np.asarray(sizes["n"])), max_bytes, side="right"))
    if fits < sizes.num_rows:
        first_left = sizes.slice(fits, 1).to_pylist()[0]
        one = one.where(F.struct("h", "doc_id") < F.struct(*(F.lit(first_left[c]).cast("long").alias(c) for c in ("h", "doc_id"))))
    got = one.select("doc_id", "quality", "f").toArrow()
    order = np.argsort(np.asarray(got["doc_id"]), kind="stable")
    y = np.where(np.asarray(got["quality"])[order] > 0, 1, -1)
    raw = got["f"].to_pylist()
    rows = [np.frombuffer(raw[i], "<u4") for i in order]
    size = 1 << bits
    if len(set(y.tolist())) < 2:
        only = 0.0 if not len(y) else 4.0 * float(y[0])
        return QualityModel(bits, np.zeros(size), np.zeros(size), only)
    counts = [np.full(size, smoothing), np.full(size, smoothing)]
    for v, c in zip(rows, y):
        counts[int(c > 0)][v] += 1
    r = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    aside = np.arange(len(y)) % 5 == 0

    def flat(which):
        own = [rows[i] for i in np.flatnonzero(which)]
        return np.concatenate(own), np.concatenate([[0], np.cumsum([len(v) for v in own])])

    w, bias = dual_descent(*flat(~aside), y[~aside], r, cost, rounds)
    model = QualityModel(bits, r, w, bias)
    model.slope, model.offset = _sigmoid(model.margins(*flat(aside)), y[aside])
    return model


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, score) of every row of `docs` (doc_id, text): 0 to 1, higher likelier good.

    Null and empty texts have no feature and get the score of the bias alone. Repeated rows and
    null ids are scored each; an empty table gives an empty table; other columns are not read.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            got = [np.zeros(0)]
            for lo, hi in row_chunks(offsets, 1 << 19):
                o = offsets[lo : hi + 1]
                got.append(m.scores(*features(data[o[0] : o[-1]], o - o[0], m.bits)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(got))], ["doc_id", "score"])

    return small_batches(docs).select("doc_id", "text").mapInArrow(lean(run), "doc_id long, score double")
