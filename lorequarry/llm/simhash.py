"""Document fingerprints by SimHash, and the search for those within a Hamming radius.

A document's terms are its runs of three words; a term's weight is its number of occurrences.
Each term's 128-bit hash votes, by weight, for 1 or 0 in each bit. A small radius is searched by
permuted block tables: the bits are cut into radius + k blocks, so that fingerprints within the
radius agree in some k of them; each choice of k blocks makes a table, whose keys are joined, and
what meets is compared in all bits. Near copies lie far apart in bits: of the 1290 pairs of sf0.1
with a Jaccard of 0.8 or more and unequal shingle sets, none is within 3 bits, 56 % within 16,
96 % within 22 and all within COPY_RADIUS. For so wide a radius the tables would be millions, so
the stated query set is compared with all rows, in blocks of ASKED fingerprints; nothing but the
counts found is shuffled.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kernels as K
from .shared import cut, lean, part_bounds, row_chunks, small_batches, text_bytes

BITS, RADIUS, TERM_WORDS = 128, 3, 3
#: Bits within which near copies (Jaccard 0.8 of three-word shingles) lie, as measured.
COPY_RADIUS = 28
#: Asked fingerprints compared at a time, so that numpy's working arrays stay in cache.
BLOCK = 16384
#: Asked fingerprints that are broadcast at once (16 bytes each); more make more passes.
ASKED = 1 << 21
#: Bits that a table's key should have and must have; tables at most.
KEY_BITS, LEAST_BITS, TABLES = 32, 12, 256


def fingerprints(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A (rows, 16) array of bytes; a text without words is all zero."""
    out = np.zeros((len(offsets) - 1, BITS // 8), np.uint8)
    for lo, hi in row_chunks(offsets, 1 << 17):
        o = offsets[lo : hi + 1]
        terms, at = K.shingles(*K.word_hashes(data[o[0] : o[-1]], o - o[0]), TERM_WORDS)
        if not len(terms):
            continue
        both = np.stack([K.mix(terms), K.mix(terms ^ np.uint64(0xA0761D6478BD642F))], 1)
        bits = np.unpackbits(both.view(np.uint8).reshape(len(terms), 16), axis=1)
        n = np.diff(at)
        full = np.flatnonzero(n)
        ones = np.add.reduceat(bits, at[full], axis=0, dtype=np.int32)
        out[lo + full] = np.packbits(2 * ones > n[full][:, None], axis=1)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The part of the bits that agree."""
    return 1 - np.bitwise_count(a ^ b).sum(axis=1) / BITS


def _squeezed(bounds: list, first: int | None):
    """Compressed texts with their range, and a copy for the range that each one follows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, edges = zstandard.ZstdCompressor(level=1), np.array(bounds, np.int64)
        for batch in batches:
            rows = []
            ids = batch.column("doc_id").to_pylist()
            part = np.searchsorted(edges, np.array([d or 0 for d in ids], np.int64), side="right").tolist()
            for d, p, t in zip(ids, part, batch.column("text").to_pylist()):
                z = pack.compress((t or "").encode())
                rows.append((d, p, False, z))
                if d is not None and p and d == bounds[p - 1]:
                    rows.append((d, p - 1, True, z))
                if d is not None and d == first:
                    rows.append((d, len(bounds), True, z))
            kinds = (pa.int64(), pa.int32(), pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 4, kinds)], ["doc_id", "part", "tail", "z"])

    return run


def with_next(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """(doc_id, z, next): each text and that of the next doc_id, compressed.

    The ids are cut into ranges; each range also gets a copy of the document that follows it,
    so that only ranges of bounded size are ordered, never the whole table at once. After the
    last document comes the first. Rows of equal doc_id are ordered by their texts' bytes as
    compressed. A null doc_id has no place in the order and an empty text after it.
    """
    parts = parts or 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = part_bounds(docs, "doc_id", parts)
    first = docs.agg(F.min("doc_id").alias("m")).first()["m"]
    z = docs.select("doc_id", "text").mapInArrow(lean(_squeezed(bounds, first)), "doc_id long, part int, tail boolean, z binary")
    order = Window.partitionBy("part").orderBy("tail", "doc_id", "z")
    dealt = z.repartitionById(len(bounds) + 1, F.col("part"))
    follow = F.when(F.col("doc_id").isNotNull(), F.lead("z").over(order))
    return dealt.withColumn("next", follow).where("NOT tail").select("doc_id", "z", "next")


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        for lo in range(0, batch.num_rows, 64):
            part = batch.slice(lo, 64)
            text = [unpack.decompress(z).decode() for z in part.column("z").to_pylist()]
            follow = [unpack.decompress(z).decode() if z else "" for z in part.column("next").to_pylist()]
            edited = [t[: len(t) - len(t) // 2] + f[: len(t) // 2] for t, f in zip(text, follow)]
            own, changed, after = (fingerprints(*text_bytes(pa.array(x, pa.large_string()))) for x in (text, edited, follow))
            word = [own[:, :8].copy().view(">i8")[:, 0], own[:, 8:].copy().view(">i8")[:, 0]]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array([len(t) for t in text], pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
                    *(pa.array(w.astype(np.int64)) for w in word),
                    pa.array([x.tobytes().hex() for x in changed]),
                    pa.array(likeness(own, changed)),
                    pa.array(likeness(own, after)),
                ],
                ["doc_id", "n_chars", "edited_sha256", "f1", "f2", "edited_fingerprint", "near_edited", "near_next"],
            )


def _counts(asked: np.ndarray, rows: np.ndarray, n: np.ndarray, radii: list[int], out: np.ndarray) -> None:
    """Add to `out` (radii, asked) how many of `rows`, each `n` times, lie within each radius."""
    for lo in range(0, asked.shape[1], BLOCK):
        q1, q2 = asked[:, lo : lo + BLOCK]
        word, apart, more = np.empty(len(q1), np.uint64), np.empty(len(q1), np.uint8), np.empty(len(q1), np.uint8)
        for (f1, f2), times in zip(rows, n):
            np.bitwise_count(np.bitwise_xor(q1, f1, out=word), out=apart)
            np.bitwise_count(np.bitwise_xor(q2, f2, out=word), out=more)
            apart += more
            if apart.min() <= max(radii):
                for k, radius in enumerate(radii):
                    out[k, lo + np.flatnonzero(apart <= radius)] += times


def block_masks(radius: int, bits: int = BITS) -> list[int]:
    """The bits of each table's key: all choices of k of radius + k blocks.

    k is the least for which keys have KEY_BITS bits, or the greatest that takes TABLES tables.
    """
    k = 1
    while bits * k // (radius + k) < KEY_BITS and math.comb(radius + k + 1, k + 1) <= TABLES:
        k += 1
    n = radius + k
    if bits * k // n < LEAST_BITS:
        raise ValueError(f"a radius of {radius} takes too many tables; compare all instead")
    edges = [bits * i // n for i in range(n + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in itertools.combinations(blocks, k)]


def _half(mask: int, high: bool) -> int:
    word = mask >> 64 if high else mask & ((1 << 64) - 1)
    return word - (1 << 64) if word >> 63 else word


def by_tables(queries: DataFrame, all_: DataFrame, radius: int) -> DataFrame:
    """(f1, f2, near): for each distinct fingerprint of `queries`, how many rows of `all_` lie
    within `radius` bits, by permuted block tables. Equal fingerprints enter the tables once."""
    masks = block_masks(radius)
    keys = F.array(*(F.xxhash64(F.lit(i), F.col("f1").bitwiseAND(F.lit(_half(m, True))), F.col("f2").bitwiseAND(F.lit(_half(m, False)))) for i, m in enumerate(masks)))
    asked = queries.select("f1", "f2").distinct().select(F.col("f1").alias("q1"), F.col("f2").alias("q2"), F.explode(keys).alias("key"))
    rows = all_.groupBy("f1", "f2").agg(F.count(F.lit(1)).alias("n")).select("f1", "f2", "n", F.explode(keys).alias("key"))
    apart = F.bit_count(F.col("f1").bitwiseXOR(F.col("q1"))) + F.bit_count(F.col("f2").bitwiseXOR(F.col("q2")))
    pairs = rows.join(asked, "key").where(apart <= radius).select("q1", "q2", "f1", "f2", "n").distinct()
    return pairs.groupBy(F.col("q1").alias("f1"), F.col("q2").alias("f2")).agg(F.sum("n").alias("near"))


def within_radius(queries: DataFrame, all_: DataFrame, *radii: int) -> DataFrame:
    """(f1, f2, near): for each distinct fingerprint of `queries` (f1, f2), how many rows of `all_`
    (f1, f2) lie within each of `radii` bits.

    Every pair is compared, in as many passes over `all_` as ASKED fits into the queries.
    """
    spark = queries.sparkSession
    asked = cut(queries.select("f1", "f2").distinct())
    passes = -(-asked.count() // ASKED)
    names = ["f1", "f2", *(f"n{k}" for k in range(len(radii)))]
    schema = ", ".join(f"{c} long" for c in names)
    out = spark.createDataFrame([], schema)
    for i in range(passes):
        found = asked.where(F.pmod(F.xxhash64("f1", "f2"), F.lit(passes)) == i).toArrow()
        held = spark.sparkContext.broadcast(np.stack([found.column(c).to_numpy().astype(np.int64) for c in ("f1", "f2")]).view(np.uint64))

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            q = held.value
            out = np.zeros((len(radii), q.shape[1]), np.int64)
            for batch in batches:
                rows, n = np.unique(np.stack([np.asarray(batch.column(c)) for c in ("f1", "f2")], 1), axis=0, return_counts=True)
                _counts(q, rows.view(np.uint64), n, list(radii), out)
            some = np.flatnonzero(out.any(axis=0))
            for lo in range(0, len(some), BLOCK):
                at = some[lo : lo + BLOCK]
                words = q[:, at].view(np.int64)
                yield pa.RecordBatch.from_arrays([*(pa.array(w) for w in words), *(pa.array(x) for x in out[:, at])], names)

        out = out.unionAll(all_.select("f1", "f2").mapInArrow(lean(run), schema))
    return out.groupBy("f1", "f2").agg(F.array(*(F.sum(c) for c in names[2:])).alias("near"))


def fingerprint_table(docs: DataFrame, every: int = 50, radius: int = RADIUS, copy_radius: int = COPY_RADIUS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    n_near, n_near_copies; one row per row of `docs` (doc_id, text).

    Null text counts as empty; texts without words have the fingerprint of zeros. n_near and
    n_near_copies are given for documents whose id is divisible by `every` (else null): how many
    other rows have a fingerprint within `radius` bits (little but equal texts), and within
    `copy_radius` bits (near copies). Texts are read whole, however long. Rows that repeat a
    doc_id are fingerprinted each; asked ones with several texts are given once for each of
    their texts' counts. Other columns are not read. An empty table gives an empty table.
    """
    rows = cut(with_next(small_batches(docs).select("doc_id", "text")).mapInArrow(lean(_marked), "doc_id long, n_chars long, edited_sha256 string, f1 long, f2 long, edited_fingerprint string, near_edited double, near_next double"))
    asked = F.col("doc_id") % every == 0
    tables, compared = by_tables(rows.where(asked), rows, radius), within_radius(rows.where(asked), rows, copy_radius)
    near = tables.join(compared.withColumnRenamed("near", "copies"), ["f1", "f2"], "left")
    counts = rows.where(asked).join(near, ["f1", "f2"]).select("doc_id", F.col("near") - 1, F.col("copies")[0] - 1).distinct().toDF("doc_id", "n_near", "n_near_copies")
    out = rows.join(counts, "doc_id", "left")
    fingerprint = F.lower(F.concat(F.lpad(F.hex("f1"), 16, "0"), F.lpad(F.hex("f2"), 16, "0")))
    return out.select("doc_id", "n_chars", "edited_sha256", fingerprint.alias("fingerprint"), "edited_fingerprint", "near_edited", "near_next", "n_near", "n_near_copies")
