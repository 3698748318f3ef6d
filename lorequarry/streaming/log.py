"""The append-only log fed by a stream (an extension: batches are the main path)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..sources.writers import append_unseen


def append_stream(stream: DataFrame, path: str, keys: Sequence[str], checkpoint: str) -> StreamingQuery:
    """Append each new key of a stream once to the Parquet table at `path`, then stop.

    A batch that runs again after a failure adds nothing. `checkpoint` must be a shared folder.
    """
    sink = lambda batch, _: append_unseen(batch, path, keys)
    return stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
