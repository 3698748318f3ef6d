"""Tokenizing inside Spark tasks with a public tokenizer file.

Texts are split into the tokenizer's pieces (runs of letters, single numbers, contractions, runs
of other marks) by numpy over code points, many texts at a time. Equal pieces have equal ids, so
each Python worker keeps the ids of the pieces it has met, by their 63-bit hashes, and gives only
new pieces to the library. The file's path is a parameter; it must exist on every executor.
"""

from __future__ import annotations

import os
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np

from .kernels import mix, power

END_ID = 1
_U = np.uint64
#: Pieces that a worker remembers (about 40 bytes each); then it starts anew.
REMEMBERED = 1 << 20
#: Code points handled at a time; a longer text is cut where a word ends.
CHUNK = 1 << 19
SPACE, LETTER, NUMBER, OTHER, UNSURE = range(5)
#: What begins a special token, what the library and Python take for white space differently,
#: and letters whose lower case depends on more than themselves (fixed values).
_UNUSUAL = ("<|", "\x1c", "\x1d", "\x1e", "\x1f")
_UNUSUAL_LETTERS = ("İ", "Σ")
#: Contractions after an apostrophe (fixed values).
_ONE, _TWO = "stmd", ("re", "ve", "ll")


@cache
def kinds() -> np.ndarray:
    """Each code point's kind; UNSURE where Unicode versions may differ, or far from all alphabets."""
    old = unicodedata.ucd_3_2_0
    out = np.full(0x110000, UNSURE, np.uint8)
    out[:0x20000] = OTHER
    for c in range(0x20000):
        s = chr(c)
        kind = unicodedata.category(s)
        if kind != old.category(s) or kind in ("Cn", "Cs"):
            out[c] = UNSURE
        elif s.isspace():
            out[c] = SPACE
        elif kind[0] in "LN":
            out[c] = LETTER if kind[0] == "L" else NUMBER
    return out


@cache
def _byte_letters() -> list[str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for 256 and on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, n = {b: chr(b) for b in plain}, 0
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + n)
            n += 1
    return [out[b] for b in range(256)]


def spans(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-last places of the pieces of code points that end with a space."""
    kind = kinds()[c]
    solid = kind != SPACE
    begins = solid.copy()
    begins[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
    marks = np.flatnonzero(begins & (c == 39))  # an apostrophe that begins a run of marks
    if len(marks):
        padded = np.concatenate([c, np.full(3, 32, c.dtype)])
        a, b = padded[marks + 1], padded[marks + 2]
        one = np.isin(a, [ord(x) for x in _ONE])
        two = np.zeros(len(marks), bool)
        for x, y in _TWO:
            two |= (a == ord(x)) & (b == ord(y))
        begins[marks[one | two] + 1] = False
        after = np.concatenate([marks[one] + 2, marks[two] + 3])
        after = after[after < len(c)]
        begins[after[solid[after]]] = True
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | begins[1:]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


class Pieces:
    """Known pieces: an open-addressing table from their hashes to places in a row of ids."""

    def __init__(self, dtype: np.dtype):
        self.dtype = dtype
        self.clear()

    def clear(self) -> None:
        self.mask = 2 * REMEMBERED - 1
        self.keys, self.place = np.zeros(self.mask + 1, _U), np.zeros(self.mask + 1, np.int32)
        self.start, self.n, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, self.dtype)

    def _slot(self, h: np.ndarray) -> np.ndarray:
        return (h >> _U(20)).astype(np.int64) & self.mask

    def find(self, h: np.ndarray) -> np.ndarray:
        """The piece of each hash, -1 where it is not known."""
        at = self._slot(h)
        key = self.keys[at]
        out = np.where(key == h, self.place[at], -1)
        left = np.flatnonzero((key != h) & (key != 0))
        while len(left):
            at[left] = (at[left] + 1) & self.mask
            key = self.keys[at[left]]
            hit = key == h[left]
            out[left[hit]] = self.place[at[left[hit]]]
            left = left[~hit & (key != 0)]
        return out

    def add(self, h: np.ndarray, ids: list[list[int]]) -> None:
        """Add pieces of distinct new hashes."""
        own = np.arange(len(self.n), len(self.n) + len(h), dtype=np.int32)
        n = np.array([len(x) for x in ids], np.int64)
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(n) - n])
        self.n = np.concatenate([self.n, n])
        self.ids = np.concatenate([self.ids, np.array([i for x in ids for i in x], self.dtype)])
        at = self._slot(h)
        while len(h):
            free = self.keys[at] == 0
            self.keys[at[free]] = h[free]  # of several for one slot, one stays
            put = free & (self.keys[at] == h)
            self.place[at[put]] = own[put]
            h, own, at = h[~put], own[~put], (at[~put] + 1) & self.mask

    def gather(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces in turn, and where each piece's end."""
        n = self.n[p]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.repeat(self.start[p] - ends + n, n) + np.arange(total)], ends


class WordTokenizer:
    """many([text]) equals the tokenizers library's encode(text, add_special_tokens=False).ids.

    Texts with unusual characters, or not in composed form, are given to the library whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.size = max(self.library.get_vocab(with_added_tokens=True).values()) + 1
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.known = Pieces(self.dtype)
        rng = np.random.default_rng(11)
        self.letter = rng.integers(1, 1 << 63, 0x110000, dtype=_U)

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _ids(self, piece: str) -> list[int]:
        """A lower-case piece's ids: its bytes in the byte-level alphabet, merged by the model."""
        if not piece.isascii() or not piece.isprintable():
            letters = _byte_letters()
            piece = "".join([letters[b] for b in piece.encode()])
        return [t.id for t in self.model.tokenize(piece)]

    def _plain(self, text: str) -> str | None:
        """The text in lower case, None if only the library can tell."""
        if any(u in text for u in _UNUSUAL):
            return None
        if not text.isascii() and (any(u in text for u in _UNUSUAL_LETTERS) or not unicodedata.is_normalized("NFC", text)):
            return None
        return text.lower()

    def _chunk(self, parts: list[str]) -> list[np.ndarray | None]:
        """The ids of each part; None for parts with code points of unsure kind."""
        joined = "".join([p + " " for p in parts])
        c = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        ends = np.cumsum([len(p) + 1 for p in parts])
        s, e = spans(c)
        prefix = np.zeros(len(c) + 1, _U)
        np.cumsum(self.letter[c] * power(0, len(c)), dtype=_U, out=prefix[1:])
        h = mix((prefix[e] - prefix[s]) * power(1, len(c))[s] + (e - s).astype(_U)) | _U(1)
        found = self.known.find(h)
        gaps = np.flatnonzero(found < 0)
        if len(gaps):
            if len(self.known.n) + len(gaps) > REMEMBERED:
                self.known.clear()
                gaps = np.arange(len(h))
            new, first = np.unique(h[gaps], return_index=True)
            at = gaps[first]
            self.known.add(new, [self._ids(joined[a:b]) for a, b in zip(s[at].tolist(), e[at].tolist())])
            found = self.known.find(h)
        ids, upto = self.known.gather(found)
        cuts = np.concatenate([[0], upto])[np.searchsorted(s, ends)].tolist()
        out: list[np.ndarray | None] = [ids[a:b] for a, b in zip([0, *cuts], cuts)]
        for i in np.unique(np.searchsorted(ends, np.flatnonzero(kinds()[c] == UNSURE), side="right")).tolist():
            out[i] = None
        return out

    def many(self, texts: list[str | None]) -> Iterator[bytes]:
        """Each text's ids as little-endian integers of `dtype`, without an end id; null: none."""
        held: list[tuple[str, list[str] | None]] = []
        size = 0
        for t in texts:
            low = self._plain(t or "")
            held.append((t or "", None if low is None else cut_at_spaces(low)))
            size += len(low or "")
            if size >= CHUNK:
                yield from self._turn(held)
                held, size = [], 0
        yield from self._turn(held)

    def _turn(self, held: list[tuple[str, list[str] | None]]) -> Iterator[bytes]:
        flat = [p for _, parts in held if parts for p in parts]
        ids: list[np.ndarray | None] = []
        lo, size = 0, 0
        for hi, p in enumerate(flat, 1):
            size += len(p)
            if size >= CHUNK or hi == len(flat):
                ids += self._chunk(flat[lo:hi])
                lo, size = hi, 0
        at = 0
        for text, parts in held:
            own = None if parts is None else ids[at : at + len(parts)]
            at += len(parts or ())
            yield self._whole(text) if own is None or any(x is None for x in own) else b"".join([x.tobytes() for x in own])


def cut_at_spaces(text: str) -> list[str]:
    """Parts of about CHUNK code points, cut at spaces; a longer word stands whole."""
    out, lo = [], 0
    while len(text) - lo > CHUNK:
        at = text.find(" ", lo + CHUNK)
        if at < 0:
            break
        out.append(text[lo:at])
        lo = at
    return [*out, text[lo:]]


@cache
def word_tokenizer(path: str) -> WordTokenizer:
    """One for each Python worker, kept over its tasks."""
    return WordTokenizer(path)
