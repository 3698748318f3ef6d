"""Benchmark decontamination: a BM25 index of the test items, searched by block-max WAND.

Every training text is cut into passages of twice the longest item's words, half overlapping,
so that each item lies wholly in one; words are runs of letters and digits in lower case. A passage's distinct words are a query. An item's score
is divided by its score for its own words, so it is the part of the item's BM25 weight that
the passage holds, and one threshold serves all items. The index keeps, for each word, its
greatest weight in each block of neighbouring items; a passage and block whose greatest
weights sum to less than the threshold are passed over at once, in numpy for many passages;
the others are searched by WAND's pivots. All items at or above the threshold are retrieved,
and verified by the parts of the question's and of the answer's word runs that the passage
holds, each by its own threshold. All indexes are searched in one pass over the documents.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .shared import lean, row_chunks, small_batches, text_bytes

#: Words of items in one broadcast index (about 200 bytes each); more items make more indexes.
SHARD_WORDS = 200_000
_MARKS = re.compile(r"[^\w\x00-\x7f]+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def question_answer(text: str) -> tuple[str, str]:
    """An item's last sentence is its answer, what comes before its question.

    An item of one sentence is all question.
    """
    parts = [p for p in _SENTENCE.split(text) if p.strip()]
    return (" ".join(parts[:-1]), parts[-1]) if len(parts) > 1 else (" ".join(parts), "")


def plain_bytes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes in compatibility form and lower case, other alphabets' marks as spaces.

    ASCII is left to the word kernel, which folds case and parts words at every mark.
    """
    plain = [t if not t or t.isascii() else _MARKS.sub(" ", unicodedata.normalize("NFKC", t).lower()) for t in texts]
    return text_bytes(pa.array(plain, pa.large_string()))


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return K.word_hashes(data, offsets, K.LETTERS)


def _hashed(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return _words(*plain_bytes(texts))


def _runs(words: np.ndarray, k: int) -> np.ndarray:
    """The set of runs of k words, sorted; none if there are fewer words."""
    if len(words) < k or not k:
        return np.zeros(0, np.uint64)
    return K.distinct_in_rows(*K.shingles(words, np.array([0, len(words)]), k))[0]


class Index:
    """Postings with BM25 weights by word, greatest weights by word and block, item word runs."""

    def __init__(self, items: list[tuple[int, str]], df: dict[int, int], n_items: int, mean: float, size: int, answer_size: int, blocks: int = 128, k1: float = 1.2, b: float = 0.75):
        words, at = _hashed([t for _, t in items])
        self.ids = [i for i, _ in items]
        self.longest = max([1, *np.diff(at).tolist()])
        self.vocab, code = np.unique(words, return_inverse=True)
        item = np.repeat(np.arange(len(items)), np.diff(at))
        pair, tf = np.unique(code * len(items) + item, return_counts=True)  # by word, then item
        word, item = pair // len(items), pair % len(items)
        n = np.array([df[int(h)] for h in self.vocab.view(np.int64)], float)
        idf = np.log1p((n_items - n + 0.5) / (n + 0.5))
        w = idf[word] * tf * (k1 + 1) / (tf + k1 * (1 - b + b * np.diff(at)[item] / mean))
        w = w / np.bincount(item, w, len(items))[item]
        self.per_block = max(1, -(-len(items) // blocks))
        self.block_max = np.zeros((len(self.vocab), -(-len(items) // self.per_block)), np.float32)
        np.maximum.at(self.block_max, (word, item // self.per_block), np.nextafter(w.astype(np.float32), np.float32(2)))
        cuts = np.searchsorted(word, np.arange(len(self.vocab) + 1))
        self.postings = [(item[x:y].tolist(), w[x:y].tolist()) for x, y in zip(cuts[:-1], cuts[1:])]
        self.parts = []
        for _, t in items:
            own = []
            for part, most in zip(question_answer(t), (size, answer_size)):
                h, _ = _hashed([part])
                k = min(most, len(h))
                own.append((k, _runs(h, k)))
            self.parts.append(own)

    def wand(self, terms: list[int], block: int, threshold: float) -> list[tuple[int, float]]:
        """Items of the block that score `threshold` or more for the words, with their scores."""
        lo, hi = block * self.per_block, (block + 1) * self.per_block
        cursors = []
        for t in terms:
            items, weights = self.postings[t]
            i = bisect_left(items, lo)
            if i < len(items) and items[i] < hi:
                cursors.append([items[i], i, items, weights, float(self.block_max[t, block])])
        found = []
        while cursors:
            cursors.sort(key=lambda c: c[0])
            bound, pivot = 0.0, None
            for c in cursors:
                bound += c[4]
                if bound >= threshold:
                    pivot = c[0]
                    break
            if pivot is None:
                break
            if cursors[0][0] == pivot:
                score = sum(c[3][c[1]] for c in cursors if c[0] == pivot)
                if score >= threshold:
                    found.append((pivot, score))
                to = pivot + 1
            else:
                to = pivot
            for c in cursors:
                if c[0] < to:
                    c[1] = bisect_left(c[2], to, c[1])
                    c[0] = c[2][c[1]] if c[1] < len(c[2]) else hi
            cursors = [c for c in cursors if c[0] < hi]
        return found

    def search(self, data: np.ndarray, offsets: np.ndarray, threshold: float, overlap: float, answer_overlap: float) -> Iterator[tuple[int, int, float, float, float]]:
        """(row, item, score, question overlap, answer overlap) of the verified hits, best passage."""
        words, at = _words(data, offsets)
        if not len(words) or not len(self.vocab):
            return
        code = np.searchsorted(self.vocab, words)
        code[code == len(self.vocab)] = 0
        known = np.flatnonzero(self.vocab[code] == words)
        step = self.longest
        cells = -(-np.diff(at) // step)
        cell_at = np.concatenate([[0], np.cumsum(cells)])
        row = np.searchsorted(at, known, side="right") - 1
        cell = cell_at[row] + (known - at[row]) // step
        pair = np.unique(cell * len(self.vocab) + code[known])
        cell, term = pair // len(self.vocab), pair % len(self.vocab)
        bounds = np.concatenate([[0], np.searchsorted(cell, np.arange(cell_at[-1]), side="right")])
        best = np.zeros((cell_at[-1] + 1, self.block_max.shape[1]), np.float32)
        for a in range(0, int(cell_at[-1]), 2000):
            z = min(a + 2000, int(cell_at[-1]))
            best[a:z] = K.sum_rows(self.block_max[term[bounds[a] : bounds[z]]], bounds[a : z + 1] - bounds[a])
        # a passage is a cell and the next of the same row
        follows = np.ones(cell_at[-1], bool)
        follows[cell_at[1:][cells > 0] - 1] = False
        both = best[:-1] + np.where(follows[:, None], best[1:], 0)
        hits: dict[tuple[int, int], tuple[float, float, float]] = {}
        for c, block in zip(*np.nonzero(both >= threshold * 0.9999)):
            r = int(np.searchsorted(cell_at, c, side="right")) - 1
            end = c + (2 if follows[c] else 1)
            terms = np.unique(term[bounds[c] : bounds[end]]).tolist()
            for item, score in self.wand(terms, int(block), threshold):
                first = at[r] + (c - cell_at[r]) * step
                passage = words[first : min(at[r + 1], first + 2 * step)]
                seen = [(len(runs), int(np.isin(runs, _runs(passage, k)).sum())) for k, runs in self.parts[item]]
                (nq, q), (na, a) = seen
                if nq + na and q >= overlap * nq and a >= answer_overlap * na:
                    was = hits.get((r, item), (0.0, 0.0, 0.0))
                    shares = (q / nq if nq else a / na, a / na if na else q / nq)
                    hits[r, item] = tuple(max(x) for x in zip(was, (score, *shares)))
        for (r, item), values in sorted(hits.items()):
            yield (r, item, *values)


def indexes(benchmark: DataFrame, size: int = 5, answer_size: int = 3) -> list:
    """Broadcast indexes over all items of `benchmark` (item_id, text) that have words.

    One for every SHARD_WORDS words; document frequencies and mean length are of all items. An
    index takes about 200 bytes a word on the driver and in each worker, so a benchmark is
    bounded by that memory; test items are few beside the documents.
    """
    spark = benchmark.sparkSession

    def facts(batches):
        for batch in batches:
            words, at = K.distinct_in_rows(*_hashed(batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64))], ["word"])

    split = r"[^\x20\x09-\x0D]+"
    items = benchmark.select("item_id", "text").where(F.col("text").rlike(split))
    sizes = items.agg(F.count(F.lit(1)).alias("n"), F.sum(F.regexp_count("text", F.lit(split))).alias("words")).first()
    if not sizes["n"]:
        return []
    shards = -(-int(sizes["words"]) // SHARD_WORDS)
    freq = items.mapInArrow(lean(facts), "word long").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    items = items.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)))
    out = []
    for shard in range(shards):
        own = items.where(F.col("shard") == shard)
        rows = sorted(((r["item_id"], r["text"]) for r in own.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))  # SHARD_WORDS words
        if not rows:
            continue
        words = own.mapInArrow(lean(facts), "word long").distinct()
        df = {r["word"]: r["n"] for r in freq.join(words, "word", "left_semi").collect()}
        out.append(spark.sparkContext.broadcast(Index(rows, df, sizes["n"], sizes["words"] / sizes["n"], size, answer_size)))
    return out


def _hits(held: list, column: pa.Array, *limits: float) -> Iterator[tuple]:
    """(row, item_id, score, question overlap, answer overlap) of a batch's texts, of all indexes."""
    data, offsets = plain_bytes(column.to_pylist())
    for lo, hi in row_chunks(offsets, 1 << 20):
        o = offsets[lo : hi + 1]
        for index in held:
            for r, i, *values in index.value.search(data[o[0] : o[-1]], o - o[0], *limits):
                yield (lo + r, index.value.ids[i], *values)


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.4, overlap: float = 0.6, answer_overlap: float = 0.5, size: int = 5, answer_size: int = 3) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap) of every document and item
    where a passage of the document scores `threshold` or more for the item, holds at least
    `overlap` of its question's runs of `size` words and `answer_overlap` of its answer's runs
    of `answer_size` words (a shorter part is one run; a part without words asks nothing and
    gets the other's overlap).

    Items without words and texts without words match nothing; an item that repeats under
    several ids is reported for each; an item's score and overlaps are the greatest of the
    document's passages. Rows of equal doc_id and rows with a null doc_id are searched each.
    Texts are searched whole, however long. Empty tables give an empty table. Other columns of
    both tables are not read.
    """
    docs, held = small_batches(docs).select("doc_id", "text"), indexes(benchmark, size, answer_size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
        for batch in batches:
            doc = batch.column("doc_id")
            rows = [(doc[r].as_py(), *v) for r, *v in _hits(held, batch.column("text"), threshold, overlap, answer_overlap)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 5, kinds)], ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

    return docs.mapInArrow(lean(run), "doc_id long, item_id long, score double, question_overlap double, answer_overlap double")


def without_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.4, overlap: float = 0.6, answer_overlap: float = 0.5, size: int = 5, answer_size: int = 3) -> DataFrame:
    """The rows of `docs` whose text leaks no item (as `leaks` finds them), with all their columns.

    Only `text` goes to Python. Null and wordless texts stay; so do all rows where the benchmark
    is empty. Repeated rows are judged each.
    """
    held = indexes(benchmark, size, answer_size)

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            leaky = np.zeros(len(column), bool)
            leaky[[r for r, *_ in _hits(held, column, threshold, overlap, answer_overlap)]] = True
            yield pa.array(leaky)

    leaky = F.arrow_udf(lean(run), "boolean")
    return small_batches(docs).where(~leaky("text"))
