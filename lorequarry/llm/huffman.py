"""Token ids in files of canonical length-limited Huffman codes.

A file row is an independent block of whole documents, in ascending doc_id order; each
document's code begins at a byte. A block holds a checkpoint (a bit offset) for each document
and for every INTERVAL ids within it, so that decoding can begin at any of them; the decoder
runs all checkpoints of a block side by side, one table look-up an id. The code book is a
table of (id, bits) beside the blocks, from which the canonical codes follow. Spark's Parquet
writer holds and commits the rows, so that lost tasks leave nothing half written.

A block, little-endian: "LQH1", documents u4, ids u8, checkpoints u4, then for each document
null flag u1, doc_id i8, ids u4, for each checkpoint bit offset u4 steps of a document's start
(u8), then the code bytes.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import checkpoint_folder, cut, lean, part_bounds, small_batches
from .tokens import END_ID, word_tokenizer

LIMIT, INTERVAL, BLOCK_IDS = 20, 256, 1 << 18
_MAGIC = b"LQH1"


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most `limit` bits by package-merge; 0 for unused ids."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        out[used] = 1
        return out
    if len(used) > 1 << limit:
        raise ValueError("more ids than codes")
    leaves = used[np.argsort(counts[used], kind="stable")]
    w = counts[leaves].astype(np.float64)
    merged, kinds = w, []
    for _ in range(limit):
        kinds.append(merged)
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(1)
        last, merged = merged, np.sort(np.concatenate([w, pairs]), kind="stable")
        kinds[-1] = (last, pairs)
    # walk back: of the first `take` entries of a level, some are leaves, the others packages
    take = 2 * len(w) - 2
    depth = np.zeros(len(w), np.int64)
    for level in range(limit - 1, -1, -1):
        below = kinds[level - 1][1] if level else np.zeros(0)
        both = np.concatenate([w, below])
        order = np.argsort(both, kind="stable")[:take]
        n = int((order < len(w)).sum())
        depth[:n] += 1
        take = 2 * (take - n)
    out[leaves] = depth
    return out


def canonical(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code of each id, and the ids in the order of their codes."""
    order = np.flatnonzero(lengths)
    order = order[np.argsort(lengths[order], kind="stable")]
    size = np.uint64(1) << (np.uint64(LIMIT) - lengths[order].astype(np.uint64))
    first = np.concatenate([[np.uint64(0)], np.cumsum(size)[:-1]]).astype(np.uint64)
    codes = np.zeros(len(lengths), np.uint64)
    codes[order] = first >> (np.uint64(LIMIT) - lengths[order].astype(np.uint64))
    return codes, order


def encode_documents(ids: np.ndarray, counts: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[list[bytes], list[np.ndarray]]:
    """The code bytes of each document and its checkpoints (bits from its start)."""
    bits = lengths[ids].astype(np.int64)
    at = np.concatenate([[0], np.cumsum(counts)])
    run = np.concatenate([[0], np.cumsum(bits)])
    size = -(-(run[at[1:]] - run[at[:-1]]) // 8)
    begin = np.concatenate([[0], np.cumsum(size)])
    within = run[:-1] - np.repeat(run[at[:-1]], counts)
    start = within + 8 * np.repeat(begin[:-1], counts)
    word, off = start >> 5, start & 31
    value = codes[ids] << (64 - off - bits).astype(np.uint64)
    words = np.bincount(word, (value >> np.uint64(32)).astype(np.float64), int(begin[-1]) // 4 + 3)
    words[: len(words)] += np.bincount(word + 1, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), len(words))
    stream = words.astype(">u4").tobytes()
    code = [stream[a:b] for a, b in zip(begin[:-1].tolist(), begin[1:].tolist())]
    return code, [within[a:b:INTERVAL] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def block_bytes(docs: list, counts: list[int], codes: list[bytes], marks: list[np.ndarray]) -> bytes:
    size = np.concatenate([[0], np.cumsum([len(c) for c in codes])])
    bits = np.concatenate([m + 8 * b for m, b in zip(marks, size[:-1])]).astype("<u8")
    head = _MAGIC + np.array([len(docs)], "<u4").tobytes() + np.array([sum(counts)], "<u8").tobytes() + np.array([len(bits)], "<u4").tobytes()
    nulls = np.array([d is None for d in docs], "u1").tobytes()
    return b"".join([head, nulls, np.array([d or 0 for d in docs], "<i8").tobytes(), np.array(counts, "<u4").tobytes(), bits.tobytes(), *codes])


class Decoder:
    """The look-up table of 2^LIMIT entries of a code book."""

    def __init__(self, lengths: np.ndarray):
        _, order = canonical(lengths)
        n = lengths[order].astype(np.int64)
        self.symbol, self.bits = (np.zeros(1 << LIMIT, d) for d in (np.uint32, np.uint8))
        spans = 1 << (LIMIT - n)
        self.symbol[: spans.sum()] = np.repeat(order, spans)
        self.bits[: spans.sum()] = np.repeat(n, spans)

    def block(self, raw: bytes) -> tuple[list, np.ndarray, np.ndarray]:
        """A block's doc_ids, their numbers of ids, and all ids."""
        if raw[:4] != _MAGIC:
            raise ValueError("not a block of this format")
        n_docs = int(np.frombuffer(raw, "<u4", 1, 4)[0])
        n_marks = int(np.frombuffer(raw, "<u4", 1, 16)[0])
        p = 20
        nulls = np.frombuffer(raw, "u1", n_docs, p)
        docs = np.frombuffer(raw, "<i8", n_docs, p + n_docs).tolist()
        counts = np.frombuffer(raw, "<u4", n_docs, p + 9 * n_docs).astype(np.int64)
        p += 13 * n_docs
        at = np.frombuffer(raw, "<u8", n_marks, p).astype(np.int64)
        code = np.frombuffer(raw + b"\0" * 8, "u1", offset=p + 8 * n_marks).astype(np.uint32)
        window = (code[:-3] << 24) | (code[1:-2] << 16) | (code[2:-1] << 8) | code[3:]
        lanes = -(-counts // INTERVAL)
        left = np.full(n_marks, INTERVAL)
        left[np.cumsum(lanes) - 1] = counts - (lanes - 1) * INTERVAL
        begin = np.concatenate([[0], np.cumsum(left)[:-1]])
        order = np.argsort(-left, kind="stable")
        at, begin, active = at[order], begin[order], np.searchsorted(-left[order], -np.arange(INTERVAL), side="left")
        out = np.zeros(int(counts.sum()), np.uint32)
        for step in range(INTERVAL):
            k = active[step]
            if not k:
                break
            pos = at[:k]
            entry = (window[pos >> 3] >> (32 - LIMIT - (pos & 7)).astype(np.uint32)) & np.uint32((1 << LIMIT) - 1)
            out[begin[:k] + step] = self.symbol[entry]
            at[:k] += self.bits[entry]
        return [None if z else d for d, z in zip(docs, nulls)], counts, out


def _staged(path: str, bounds: list):
    """Documents to compressed rows of many documents' ids, and a task's counts of ids as its last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = word_tokenizer(path)
        end = np.array([END_ID], tok.dtype).tobytes()
        pack = zstandard.ZstdCompressor(level=1)
        total, edges = np.zeros(tok.size, np.int64), np.array(bounds, np.int64)
        names = ["part", "docs", "size", "ids", "seen", "n"]

        def row(docs, ids):
            size = [len(x) // tok.dtype.itemsize for x in ids]
            body = b"".join(ids)
            np.add(total, np.bincount(np.frombuffer(body, tok.dtype), minlength=tok.size), out=total)
            body = np.frombuffer(body, "u1").reshape(-1, tok.dtype.itemsize).T.tobytes()
            part = np.searchsorted(edges, np.array([d or 0 for d in docs], np.int64), side="right").astype(np.int32)
            part[[d is None for d in docs]] = 0
            cells = (pa.array([part.tolist()], pa.list_(pa.int32())), pa.array([docs], pa.list_(pa.int64())), pa.array([size], pa.list_(pa.int32())), pa.array([pack.compress(body)], pa.binary()))
            return pa.RecordBatch.from_arrays([*cells, pa.nulls(1, pa.list_(pa.int64())), pa.nulls(1, pa.list_(pa.int64()))], names)

        docs, ids, held = [], [], 0
        for batch in batches:
            for d, t in zip(batch.column("doc_id").to_pylist(), tok.many(batch.column("text").to_pylist())):
                docs.append(d), ids.append(t + end)
                held += len(t)
                if held > 1 << 19:
                    yield row(docs, ids)
                    docs, ids, held = [], [], 0
        if docs:
            yield row(docs, ids)
        seen = np.flatnonzero(total)
        none = [pa.nulls(1, k) for k in (pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary())]
        yield pa.RecordBatch.from_arrays([*none, pa.array([seen.tolist()], pa.list_(pa.int64())), pa.array([total[seen].tolist()], pa.list_(pa.int64()))], names)

    return run


def _unpack(raw: bytes, dtype: np.dtype) -> np.ndarray:
    body = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), "u1").reshape(dtype.itemsize, -1)
    return np.ascontiguousarray(body.T).reshape(-1).view(dtype)


def _encoded(path: str, book):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, lengths = word_tokenizer(path), book.value
        codes, _ = canonical(lengths)
        for batch in batches:
            for part, docs, size, raw in zip(*(batch.column(c).to_pylist() for c in ("part", "docs", "size", "ids"))):
                code, marks = encode_documents(_unpack(raw, tok.dtype), np.array(size), lengths, codes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.int32()), pa.array(docs, pa.int64()), pa.array(size, pa.int64()), pa.array(code, pa.binary()), pa.array([m.astype("<u8").tobytes() for m in marks], pa.binary())],
                    ["part", "doc_id", "n", "code", "marks"],
                )

    return run


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents sorted by part and doc_id to blocks of whole documents."""
    held: list[tuple] = []
    part, begin, n = None, 0, 0

    def row():
        docs, sizes, codes, marks = zip(*held)
        raw = block_bytes(list(docs), list(sizes), list(codes), [np.frombuffer(m, "<u8").astype(np.int64) for m in marks])
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([begin], pa.int64()), pa.array([n], pa.int64()), pa.array([raw], pa.binary())], ["part", "begin", "n_ids", "block"])

    for batch in batches:
        for p, d, size, code, mark in zip(*(batch.column(c).to_pylist() for c in ("part", "doc_id", "n", "code", "marks"))):
            if held and (p != part or n >= BLOCK_IDS):
                yield row()
                held, begin, n = [], begin + n, 0
            if p != part:
                part, begin = p, 0
            held.append((d, size, code, mark))
            n += size
    if held:
        yield row()


def write_ids(docs: DataFrame, path: str, folder: str, parts: int | None = None) -> None:
    """Write the ids of `docs` (doc_id, text) to `folder`: blocks, code book.

    Null text has the end id alone. Rows of equal doc_id follow each other; a null doc_id
    comes first. An empty table gives an empty folder of both tables.
    """
    spark = small_batches(docs).sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = part_bounds(docs, "doc_id", parts)
    schema = "part array<int>, docs array<long>, size array<int>, ids binary, seen array<long>, n array<long>"
    staged = cut(docs.select("doc_id", "text").mapInArrow(lean(_staged(path, bounds)), schema))
    counted = staged.where("seen IS NOT NULL").select(F.explode(F.arrays_zip("seen", "n")).alias("c"))
    counted = counted.groupBy(F.col("c.seen").alias("id")).agg(F.sum("c.n").alias("n")).toArrow()
    counts = np.zeros(word_tokenizer(path).size, np.int64)  # bounded by the vocabulary
    counts[np.asarray(counted["id"])] = np.asarray(counted["n"])
    lengths = code_lengths(counts)
    book = spark.sparkContext.broadcast(lengths)
    used = np.flatnonzero(lengths)
    spark.createDataFrame(pa.table({"id": used.astype(np.int64), "bits": lengths[used].astype(np.int32)})).coalesce(1).write.parquet(f"{folder}/codebook")
    coded = staged.where("ids IS NOT NULL").select("part", "docs", "size", "ids").mapInArrow(lean(_encoded(path, book)), "part int, doc_id long, n long, code binary, marks binary")
    ordered = coded.repartitionById(max(parts, 1), F.col("part")).sortWithinPartitions("part", "doc_id", "n", "code")
    ordered.mapInArrow(lean(_blocks), "part int, begin long, n_ids long, block binary").write.option("compression", "uncompressed").parquet(f"{folder}/blocks")


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in `folder`, from its files."""
    book = spark.read.parquet(f"{folder}/codebook").toArrow()  # bounded by the vocabulary
    ids = np.asarray(book["id"])
    lengths = np.zeros(int(ids.max()) + 1 if len(ids) else 1, np.uint8)
    lengths[ids] = np.asarray(book["bits"])
    held = spark.sparkContext.broadcast(lengths)
    blocks = spark.read.parquet(f"{folder}/blocks")
    total, before = 0, {}
    for r in blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect():  # a row for each partition
        before[r["part"]] = total
        total += r["n"]
    offsets = spark.sparkContext.broadcast(before)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = None
        for batch in batches:
            decoder = decoder or Decoder(held.value)
            for part, begin, raw in zip(*(batch.column(c).to_pylist() for c in ("part", "begin", "block"))):
                docs, counts, found = decoder.block(raw)
                at = np.concatenate([[0], np.cumsum(counts)])
                found = found.astype("<u4")
                crc = [zlib.crc32(found[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(offsets.value[part] + begin + at[:-1]), pa.array(counts), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return blocks.select("part", "begin", "block").mapInArrow(lean(run), "doc_id long, start long, n_tokens long, ids_crc32 long")


def fresh_folder(spark: SparkSession) -> str:
    """A new folder among the shared ones; its files are the caller's to delete."""
    return f"{checkpoint_folder(spark)}/ids-{uuid.uuid4().hex}"
