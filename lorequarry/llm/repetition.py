"""Quality rules on repetition: how much of a text stands in word windows and lines that it repeats.

Texts are read as UTF-8 bytes, many rows at a time. Words, lines and windows of words are met by
rolling hashes; equal hashes are then compared by what they stand for, so a collision changes no
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .kernels import mix, power, words
from .shared import lean, row_chunks, small_batches, text_bytes

#: Words are runs of anything but space and 0x09-0x0D, case kept.
SPACES = np.arange(256, dtype=np.uint8)
SPACES[9:14] = 32
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
#: The base rules: fewest words, and the percentage of words in repeated windows of BASE words.
LEAST_WORDS, BASE, MOST_REPEATED = 50, 3, 50
#: Most characters, as a percentage of all in words, in windows of n words that an earlier one equals.
WINDOWS = {5: 15, 7: 13, 10: 10}
#: Most characters, as that percentage, in lines that an earlier line equals.
LINE_CHARS = 20

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars", *(f"dup_{n}gram_chars" for n in WINDOWS)]


def _same_bytes(data: np.ndarray, s: np.ndarray, e: np.ndarray, a: np.ndarray, b: np.ndarray) -> bool:
    """Whether each piece a[i] of the data equals piece b[i]."""
    n = e[a] - s[a]
    if not np.array_equal(n, e[b] - s[b]):
        return False
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.array_equal(data[np.repeat(s[a], n) + within], data[np.repeat(s[b], n) + within])


def grouped(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of their hashes, ties in their own order; whether each has its predecessor's."""
    order = np.argsort(h, kind="stable")
    return order, np.concatenate([[False], h[order[1:]] == h[order[:-1]]]) if len(h) else np.zeros(0, bool)


def pieces(data: np.ndarray, h: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """A number for each piece of the data from s to e: equal for equal pieces, and only for them."""
    order, same = grouped(h)
    again = np.flatnonzero(same)
    out = np.empty(len(h), np.int64)
    if _same_bytes(data, s, e, order[again - 1], order[again]):
        out[order] = np.cumsum(~same)
    else:
        known: dict[bytes, int] = {}
        out[:] = [known.setdefault(data[x:y].tobytes(), len(known)) for x, y in zip(s, e)]
    return out


def rolled(ids: np.ndarray, n: int) -> np.ndarray:
    """A rolling hash of each n numbers in a row."""
    m = len(ids)
    prefix = np.zeros(m + 1, np.uint64)
    np.cumsum(mix(ids.astype(np.uint64) + np.uint64(1)) * power(0, m), dtype=np.uint64, out=prefix[1:])
    return mix((prefix[n:] - prefix[:-n]) * power(1, m)[: m - n + 1])


def repeats(ids: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of n numbers: whether its row has it before, and whether it has it elsewhere at all."""
    m = len(ids) - n + 1
    earlier, twice = np.zeros(max(m, 0), bool), np.zeros(max(m, 0), bool)
    if m <= 0:
        return earlier, twice
    at = np.flatnonzero(row[:m] == row[n - 1 :])  # in one row
    order, same = grouped(rolled(ids, n)[at])
    order = at[order]
    again = np.flatnonzero(same)
    if not all(np.array_equal(ids[order[again - 1] + k], ids[order[again] + k]) for k in range(n)):
        exact = ids[:m].copy()
        for k in range(1, n):
            exact = np.unique(exact * (ids.max() + 1) + ids[k : m + k], return_inverse=True)[1]
        order, same = grouped(exact[at])
        order = at[order]
    same[1:] &= row[order[1:]] == row[order[:-1]]
    earlier[order] = same
    twice[order] = same
    twice[order[:-1]] |= same[1:]
    return earlier, twice


def _covered(marked: np.ndarray, n: int, m: int) -> np.ndarray:
    """Which of m words stand in a marked window of n."""
    edge = np.zeros(m + 1, np.int64)
    at = np.flatnonzero(marked)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + n, -1)
    return np.cumsum(edge[:-1]) > 0


def measured(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """COUNTS of each row of UTF-8 texts."""
    rows = len(offsets) - 1
    letters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    h, at, s, e = words(data, offsets, SPACES)
    row = np.repeat(np.arange(rows), np.diff(at))
    chars = letters[e] - letters[s]
    per_row = lambda who, what: np.bincount(who, what, rows).astype(np.int64)
    out = {"n_words": np.diff(at), "word_chars": per_row(row, chars), "n_symbols": np.diff(np.concatenate([[0], np.cumsum(SYMBOLS[data])])[offsets])}

    ids = pieces(data, h, s, e)
    _, twice = repeats(ids, row, BASE)
    out["n_repeat_words"] = per_row(row, _covered(twice, BASE, len(ids)))
    for n in WINDOWS:
        earlier, _ = repeats(ids, row, n)
        out[f"dup_{n}gram_chars"] = per_row(row, chars * _covered(earlier, n, len(ids)))

    # a line is begun by a row or a line feed; those with a word count
    breaks = np.flatnonzero(data == 10)
    begins = np.unique(np.concatenate([offsets[:-1][np.diff(offsets) > 0], breaks + 1]))
    begins = begins[begins < len(data)]
    ends = np.minimum(np.concatenate([begins[1:], [len(data)]]), np.concatenate([breaks, [len(data)]])[np.searchsorted(breaks, begins)])
    spoken = np.searchsorted(s, ends) > np.searchsorted(s, begins)
    begins, ends = begins[spoken], ends[spoken]
    line_row = np.searchsorted(offsets, begins, side="right") - 1
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(mix(data.astype(np.uint64) + np.uint64(1)) * power(0, len(data)), dtype=np.uint64, out=prefix[1:])
    line_hash = mix((prefix[ends] - prefix[begins]) * power(1, len(data))[begins]) if len(begins) else np.zeros(0, np.uint64)
    earlier, _ = repeats(pieces(data, line_hash, begins, ends), line_row, 1)
    word_ends = np.concatenate([[0], np.cumsum(chars)])
    inside = word_ends[np.searchsorted(s, ends)] - word_ends[np.searchsorted(s, begins)]
    out["n_dup_lines"] = per_row(line_row, earlier)
    out["dup_line_chars"] = per_row(line_row, inside * earlier)
    return out


def verdicts(x: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Whether each text fails the base rules, and whether it is kept."""
    failed = (x["n_words"] < LEAST_WORDS) | (100 * x["n_repeat_words"] > MOST_REPEATED * x["n_words"])
    kept = ~failed & (100 * x["dup_line_chars"] <= LINE_CHARS * x["word_chars"])
    for n, most in WINDOWS.items():
        kept &= 100 * x[f"dup_{n}gram_chars"] <= most * x["word_chars"]
    return failed, kept


def coverage(docs: DataFrame) -> DataFrame:
    """(doc_id, COUNTS, base_failed, kept) of whole texts of `docs` (doc_id, text).

    Null, empty and wordless texts have no words: zeros, and they fail. Rows are judged one by
    one, those that repeat a doc_id or a text too; a null doc_id stays null; an empty table gives
    an empty table. Other columns are not read. A task holds about 1 MB of texts at a time, or one
    longer text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for lo, hi in row_chunks(offsets):
                x = measured(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                failed, kept = verdicts(x)
                columns = [batch.column("doc_id").slice(lo, hi - lo), *(pa.array(x[c]) for c in COUNTS), pa.array(failed), pa.array(kept)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *COUNTS, "base_failed", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return small_batches(docs).select("doc_id", "text").mapInArrow(lean(run), f"doc_id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, base_failed boolean, kept boolean")
