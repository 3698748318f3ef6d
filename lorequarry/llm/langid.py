"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counting and scoring run in numpy on Arrow batches; the log-probability matrix
(2^bits buckets times the number of languages, 8 bytes each) is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import sum_rows
from .shared import lean, row_chunks, small_batches, text_bytes, unused

#: Languages that a model may have unless `max_languages` says otherwise: what the driver holds
#: and broadcasts is this many times 2^bits numbers.
MAX_LANGUAGES = 512


@cache
def _letters() -> np.ndarray:
    """The lower case of each code point that is a letter; 32 for all others."""
    t = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            t[c] = ord(low) if len(low) == 1 else c
    return t


def grams(texts: bytes, ends: np.ndarray, orders: tuple[int, ...], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: the bucket of every n-gram of letters, and where each row's begin.

    Words are padded with a space. `ends` are the rows' ends in code points.
    """
    c = _letters()[np.frombuffer(texts, "<u4")]
    # runs of anything but letters count as one space
    keep = np.ones(len(c), bool)
    keep[1:] = (c[1:] != 32) | (c[:-1] != 32)
    at = np.flatnonzero(keep)
    c = c[at].astype(np.uint64)
    stops = np.searchsorted(at, ends)
    for n in orders:
        m = max(0, len(c) - n + 1)
        h = np.full(m, n, np.uint64)
        for j in range(n):
            h = (h ^ c[j : j + m]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        good = np.ones(m, bool)
        for j in range(1, n - 1):  # a space stands at an end of a gram only
            good &= c[j : j + m] != 32
        if n == 1:
            good = c != 32
        before = np.concatenate([[0], np.cumsum(good)])
        # a gram belongs to the row of its last character; none that has letters crosses rows
        cuts = before[np.clip(stops - (n - 1), 0, m)]
        yield (h[good] >> np.uint64(64 - bits)).astype(np.int64), np.concatenate([[0], cuts])


def _joined(column: pa.Array) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """Row ranges with their texts as UTF-32, each led and followed by a space, and row ends."""
    _, offsets = text_bytes(column)
    for lo, hi in row_chunks(offsets, 1 << 18):
        texts = [f" {t or ''} " for t in column.slice(lo, hi - lo).to_pylist()]
        yield lo, hi, "".join(texts).encode("utf-32-le", "surrogatepass"), np.cumsum([len(t) for t in texts])


def _count(langs: list[str], orders, bits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 1 << bits
        total = np.zeros(len(langs) * size, np.int64)
        code = {v: i for i, v in enumerate(langs)}
        for batch in batches:
            own = np.array([code[v] for v in batch.column("lang").to_pylist()], np.int64)
            for lo, hi, joined, ends in _joined(batch.column("text")):
                for b, at in grams(joined, ends, orders, bits):
                    total += np.bincount(b + np.repeat(own[lo:hi], np.diff(at)) * size, minlength=len(total))
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(total[full])], ["cell", "n"])

    return run


class LanguageModel:
    """Languages, log probabilities by bucket, and log priors."""

    def __init__(self, langs: list[str], weights: np.ndarray, prior: np.ndarray, orders: tuple[int, ...], bits: int):
        self.langs, self.weights, self.prior, self.orders, self.bits = langs, weights, prior, orders, bits


def train(docs: DataFrame, orders: tuple[int, ...] = (1, 2, 3), bits: int = 16, smoothing: float = 0.5, max_languages: int | None = MAX_LANGUAGES) -> LanguageModel:
    """Fit on every row of `docs` (text, lang) with a lang; the counts are summed in Spark.

    Without any labelled row the model has no language and predicts `und`. More than
    `max_languages` values of lang are an error, as the matrix would outgrow what is broadcast;
    None lifts the bound. Null and empty texts count for their language's prior alone; repeated
    rows count each; other columns are not read.
    """
    docs = small_batches(docs).where("lang IS NOT NULL").select("text", "lang")
    per = sorted((r["lang"], r["n"]) for r in docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit((max_languages or (1 << 31) - 2) + 1).collect())
    if max_languages and len(per) > max_languages:
        raise ValueError(f"more than {max_languages} languages; max_languages raises the bound")
    langs, size = [k for k, _ in per], 1 << bits
    counts = np.zeros((len(langs), size))
    if langs:
        cells = docs.mapInArrow(lean(_count(langs, orders, bits)), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
        counts.reshape(-1)[np.asarray(cells["cell"])] = np.asarray(cells["n"])
    p = (counts + smoothing) / (counts.sum(axis=1, keepdims=True) + smoothing * size) if langs else counts
    prior = np.log(np.array([n for _, n in per], float) / max(1, sum(n for _, n in per)))
    return LanguageModel(langs, np.ascontiguousarray(np.log(p).T), prior, orders, bits)


def _scored(m: LanguageModel, column: pa.Array) -> pa.Array:
    """(lang, score) of each text."""
    found = []
    for lo, hi, joined, ends in _joined(column):
        n = hi - lo
        log, some = np.tile(m.prior if m.langs else np.zeros(1), (n, 1)), np.zeros(n, bool)
        for b, at in grams(joined, ends, m.orders, m.bits):
            some |= np.diff(at) > 0
            if m.langs:
                log += _summed(m.weights, b, at)
        p = np.exp(log - log.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        best = log.argmax(axis=1)
        und = ~some | (len(m.langs) == 0)
        lang = pa.array(["und" if u else m.langs[k] for u, k in zip(und, best)], pa.string())
        found.append(pa.StructArray.from_arrays([lang, pa.array(np.where(und, 0.0, p[np.arange(n), best]))], ["lang", "score"]))
    return pa.concat_arrays(found) if found else pa.array([], pa.struct([("lang", pa.string()), ("score", pa.float64())]))


def _summed(weights: np.ndarray, cells: np.ndarray, at: np.ndarray, some: int = 1 << 18) -> np.ndarray:
    """Each row's sum of its cells' weights, `some` cells at a time."""
    out = np.zeros((len(at) - 1, weights.shape[1]))
    for lo in range(0, len(cells), some):
        out += sum_rows(weights[cells[lo : lo + some]], np.clip(at - lo, 0, min(some, len(cells) - lo)))
    return out


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """`docs` with lang_pred and score (the posterior probability) added; the rest as it was.

    Only `text` goes to Python. `und` with score 0 for null texts, texts without a letter, and a
    model without languages. Languages of equal posterior: the first in alphabetical order.
    Columns named lang_pred or score are replaced. Repeated rows are scored each; an empty table
    gives an empty table.
    """
    docs = small_batches(docs).drop("lang_pred", "score")
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            yield _scored(held.value, column)

    (name,) = unused(docs, "found")
    # not deterministic for the optimizer, so that it is not run again in a filter on its result
    found = F.arrow_udf(lean(run), "lang string, score double").asNondeterministic()
    out = docs.withColumn(name, found("text"))
    return out.select(*docs.columns, out[name]["lang"].alias("lang_pred"), out[name]["score"].alias("score"))
