"""What the training-data operators share: tables, lineage cuts, Arrow text access."""

from __future__ import annotations

import contextlib
import ctypes
import re
import tempfile
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder that the session names, in setCheckpointDir or spark.checkpoint.dir.

    Only a local session, whose driver runs all tasks, gets one made where none is named.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named and not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="lorequarry-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write `df` once to the cluster's shared checkpoint folder and go on from there."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a shared folder and what is in it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of `df` has, whatever its case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def lean(run: Callable) -> Callable:
    """A mapInArrow function that gives freed memory back to the machine when its task ends.

    Python workers outlive tasks, and both Arrow's pool and the C library keep what they freed.
    """

    @wraps(run)
    def leaner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # another C library
                ctypes.CDLL("libc.so.6").malloc_trim(0)

    return leaner


#: Rows and bytes of an Arrow batch that carries whole texts.
BATCH_ROWS, BATCH_BYTES = 1000, "8m"


def small_batches(df: DataFrame) -> DataFrame:
    """`df`, after its session's default Arrow batch size is lowered; a size set by hand stays.

    Spark's default of 10,000 rows of whole texts is held several times over, outside the
    heap, for each running task.
    """
    conf = df.sparkSession.conf
    for key, default, ours in (("maxRecordsPerBatch", "10000", str(BATCH_ROWS)), ("maxBytesPerBatch", "67108864b", BATCH_BYTES)):
        if conf.get(f"spark.sql.execution.arrow.{key}", default) == default:
            conf.set(f"spark.sql.execution.arrow.{key}", ours)
    return df


def part_bounds(ids: DataFrame, column: str, parts: int) -> list:
    """At most parts - 1 values of `column` that cut it into about equal ranges.

    One driver row per partition, as a range partitioner keeps; never one per document.
    """
    fractions = [i / parts for i in range(1, parts)]
    if not fractions:
        return []
    found = ids.agg(F.percentile_approx(column, fractions, 10_000).alias("q")).first()["q"]
    return sorted(set(found or []))


def part_of(column, bounds: list):
    """The range that a value falls in: how many bounds are at or below it (null: 0)."""
    if not bounds:
        return F.lit(0)
    kind = "array<bigint>"
    # a binary search by array_position would need equality; ranges are few, so count them
    edges = F.lit(bounds).cast(kind)
    return F.coalesce(F.size(F.filter(edges, lambda b: b <= column)), F.lit(0))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of an Arrow string column; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    o = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    b = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return b[o[0] : o[-1]], o - o[0]


def row_chunks(offsets: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about `limit` bytes, so that numpy's working arrays stay small.

    A longer row stands alone.
    """
    n, start = len(offsets) - 1, 0
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        end = min(n, max(end, start + 1))
        yield start, end
        start = end
