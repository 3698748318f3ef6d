"""Packing documents' token pieces into sequences of fixed length.

Pieces are dealt to groups of bounded size by hash, so no group or task grows with the
input. A group is packed by local search: a move, a one-for-one or a two-for-one exchange is made
whenever it adds to the sum of squared fills at the cost of an underfull bin, until that bin is
empty or no exchange is left. It starts from best fit of the longest first, so it never needs
more bins than that, and where it does not reach the least number also from a plain deal, which
leaves more to exchange. What lies in bins that stay clearly underfull is dealt anew and packed
once more.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut, lean, small_batches
from .tokens import END_ID, word_tokenizer

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, path: str, capacity: int = 4096) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of `docs` (doc_id, text): ids, then END_ID.

    Documents of more than `capacity` ids are cut there. Null text: END_ID alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = word_tokenizer(path)
        end = np.array([END_ID], tok.dtype).tobytes()
        for batch in batches:
            rows: list[tuple] = []
            for doc, raw in zip(batch.column("doc_id").to_pylist(), tok.many(batch.column("text").to_pylist())):
                ids = np.frombuffer(raw + end, tok.dtype).astype("<u4")
                for p, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at : at + capacity]
                    rows.append((doc, p, at, len(part), zlib.crc32(part.tobytes())))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            cols = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "piece", "start", "length", "ids_crc32"])

    return small_batches(docs).select("doc_id", "text").mapInArrow(lean(run), _PIECES)


def best_fit(lengths: np.ndarray, capacity: int, order: np.ndarray) -> list[list[int]]:
    """Bins of indices: each piece, in the order given, goes where the least room stays."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0  # a bit for each room that some bin has
    for i in order.tolist():
        n = int(lengths[i])
        fits = rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        left = room - n
        if left:
            by_room.setdefault(left, []).append(b)
            rooms |= 1 << left
    return bins


class Search:
    """Bins under moves and exchanges; each one made adds to the sum of squared fills.

    A change that takes d net tokens from a bin of fill f to one of fill g adds 2d(g - f + d).
    """

    def __init__(self, lengths: np.ndarray, bins: list[list[int]], capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.bins = [set(b) for b in bins]
        self.owner = np.zeros(len(lengths), np.int64)
        for k, b in enumerate(bins):
            self.owner[b] = k
        self.fill = np.array([int(lengths[b].sum()) for b in bins], np.int64)
        self.made = {"move": 0, "one": 0, "two": 0}

    def _put(self, i: int, b: int) -> None:
        self.bins[self.owner[i]].remove(i)
        self.fill[self.owner[i]] -= self.lengths[i]
        self.bins[b].add(i)
        self.fill[b] += self.lengths[i]
        self.owner[i] = b

    def _move(self, a: int, n: int) -> int | None:
        """The fullest other bin that has room for n."""
        g = np.where((self.fill + n <= self.capacity) & (self.fill > 0), self.fill, -1)
        g[a] = -1
        b = int(g.argmax())
        return b if 2 * n * (g[b] - self.fill[a] + n) > 0 and g[b] >= 0 else None

    def _swap(self, a: int, n: int) -> int | None:
        """The piece to take from another bin for n tokens given to it, of greatest gain."""
        g = self.fill[self.owner]
        d = n - self.lengths
        gain = np.where((d > 0) & (g + d <= self.capacity) & (self.owner != a), 2 * d * (g - self.fill[a] + d), 0)
        i = int(gain.argmax())
        return i if gain[i] > 0 else None

    def improve(self, a: int) -> bool:
        """Make one change that takes tokens out of bin a: a move, else one for one, else two for one."""
        by_size = {int(self.lengths[i]): i for i in sorted(self.bins[a])}
        sizes = sorted(by_size, reverse=True)
        for n in sizes:
            if (b := self._move(a, n)) is not None:
                self._put(by_size[n], b)
                self.made["move"] += 1
                return True
        for n in sizes:
            if (i := self._swap(a, n)) is not None:
                b = int(self.owner[i])
                self._put(i, a)
                self._put(by_size[n], b)
                self.made["one"] += 1
                return True
        own = sorted(self.bins[a])
        pairs: dict[int, tuple[int, int]] = {}
        for x, i in enumerate(own):
            for j in own[:x]:
                pairs.setdefault(int(self.lengths[i] + self.lengths[j]), (i, j))
        for n in sorted(pairs, reverse=True):
            if (i := self._swap(a, n)) is not None:
                b = int(self.owner[i])
                self._put(i, a)
                for j in pairs[n]:
                    self._put(j, b)
                self.made["two"] += 1
                return True
        return False


def local_search(lengths: np.ndarray, bins: list[list[int]], capacity: int) -> tuple[list[list[int]], dict[str, int]]:
    """The bins after emptying underfull ones, emptiest first, and how many changes were made.

    It ends at the least number of bins that could hold all, or when no change is left that adds
    to the squared fills at the cost of a bin.
    """
    s = Search(lengths, bins, capacity)
    fewest = -(-int(lengths.sum()) // capacity)
    stuck, before = np.zeros(len(bins), bool), -1
    while np.count_nonzero(s.fill) > fewest:
        a = int(np.where((s.fill > 0) & (s.fill < capacity) & ~stuck, s.fill, capacity + 1).argmin())
        if stuck[a] or not 0 < s.fill[a] < capacity:
            if sum(s.made.values()) == before:
                break
            # what was changed since may have freed the bins that were stuck
            stuck[:], before = False, sum(s.made.values())
            continue
        while s.bins[a]:
            if not s.improve(a):
                stuck[a] = True
                break
    return [sorted(b) for b in s.bins if b], s.made


def fewest_bins(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """The better of two local searches: from best fit of the longest first, and, unless that
    reaches the least number that could hold all, from a plain deal in the order given."""
    starts = (np.argsort(-lengths, kind="stable"), np.arange(len(lengths)))
    best: list[list[int]] = []
    for order in starts:
        found, _ = local_search(lengths, best_fit(lengths, capacity, order), capacity)
        best = found if not best or len(found) < len(best) else best
        if len(best) <= -(-int(lengths.sum()) // capacity):
            break
    return best


def _pack_group(capacity: int):
    def run(table: pa.Table) -> pa.Table:
        # ids stay in Arrow: pandas would make doubles of those beside a null
        table = table.take(pc.sort_indices(table, [(c, "ascending") for c in ("doc_id", "piece", "length", "ids_crc32")]))
        lengths = np.asarray(table["length"])
        seq, offset, fill = (np.zeros(len(lengths), np.int64) for _ in range(3))
        for k, members in enumerate(fewest_bins(lengths, capacity)):
            n = lengths[members]
            seq[members], offset[members], fill[members] = k, np.cumsum(n) - n, n.sum()
        seq += np.asarray(table["grp"]) * (1 << 32)
        for name, column in (("sequence_id", seq), ("offset", offset), ("fill", fill)):
            table = table.append_column(name, pa.array(column))
        return table.drop_columns(["grp"])

    return run


def _deal(pieces: DataFrame, capacity: int, group: int, n: int, salt: int, base: int) -> DataFrame:
    groups = max(1, -(-n // group))
    dealt = pieces.withColumn("grp", (F.pmod(F.xxhash64(F.lit(salt), "doc_id", "piece", "ids_crc32"), F.lit(groups)) + base).cast("long"))
    return dealt.groupBy("grp").applyInArrow(_pack_group(capacity), f"{_PIECES}, sequence_id long, offset long, fill long")


def pack(pieces: DataFrame, capacity: int = 4096, group: int = 8192, underfull: float = 0.97) -> DataFrame:
    """Add sequence_id and offset to `pieces` (doc_id, piece, start, length, ids_crc32).

    Every sequence is gapless from 0 and holds at most `capacity` ids. Groups have about
    `group` pieces. Pieces in bins of less than `underfull` of the capacity are dealt anew
    once. An empty table gives an empty table; repeated rows and null ids are packed each; other
    columns are not read.
    """
    pieces = cut(pieces.select("doc_id", "piece", "start", "length", "ids_crc32"))
    first = cut(_deal(pieces, capacity, group, pieces.count(), 1, 0))
    low = F.col("fill") < underfull * capacity
    again = first.where(low).select(pieces.columns)
    n = again.count()
    base = 1 << 30
    out = first.where(~low).unionAll(_deal(again, capacity, group, n, 2, base)) if n else first
    return out.drop("fill")
