"""A stream's rows held to unique keys: repeats are rejected to a table of their own, not dropped."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import BooleanType, StructField, StructType

from ..sources.writers import exists, locked

_EMPTY = "spark.sql.streaming.noDataMicroBatches.enabled"


def judged(stream: DataFrame, key: str, order: str, days: float = 7) -> DataFrame:
    """`stream` with `rejected`: true for each row but the first, by `order` in a batch, of its key.

    A key's state is one flag; it goes when the key has not been seen for `days`, so that state
    does not grow for ever. Null keys have no state and are all rejected.
    """
    schema = StructType([*stream.schema, StructField("rejected", BooleanType())])
    wait = int(days * 86_400_000)

    def judge(_: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        known, best = state.exists, None
        for rows in parts:
            if not known:  # the best row so far is held back, the others are repeats
                rows = rows if best is None else pd.concat([best, rows])
                rows = rows.sort_values(order, kind="stable", na_position="last")
                best, rows = rows.iloc[:1], rows.iloc[1:]
            yield rows.assign(rejected=True)
        if best is not None:
            yield best.assign(rejected=False)
        state.update((True,))
        state.setTimeoutDuration(wait)

    keyed = stream.where(F.col(key).isNotNull()).groupBy(key).applyInPandasWithState(judge, schema, "seen boolean", "append", GroupStateTimeout.ProcessingTimeTimeout)
    return keyed.unionByName(stream.where(F.col(key).isNull()).withColumn("rejected", F.lit(True)))


def log_stream(stream: DataFrame, path: str, key: str, order: str, checkpoint: str, mirror: Callable[[DataFrame], object] | None = None, days: float = 7) -> StreamingQuery:
    """Append a stream's rows to the log at `path`/log once for each key, then stop.

    Every batch writes three folders under its own number, which a batch that runs again replaces:
    `log`, `rejected` (repeats in the stream, and keys that the log has from others) and, where the
    mirror fails, `outbox`. Two streams may feed one log: a writer holds the log's lock while it
    compares its keys with those of the others and writes, so none enters twice. `checkpoint` must
    be a shared folder; its name sets a stream's batches apart.
    """
    spark = stream.sparkSession
    writer = checkpoint.rstrip("/").rpartition("/")[2]

    def sink(batch: DataFrame, number: int) -> None:
        own = f"writer={writer}/batch={number}"
        batch = batch.persist()
        try:
            with locked(spark, f"{path}/lock"):
                fresh, late = batch.where("NOT rejected").drop("rejected"), batch.where("rejected").drop("rejected")
                if exists(spark, f"{path}/log"):
                    known = spark.read.schema(StructType([batch.schema[key]]).add("writer", "string").add("batch", "long")).parquet(f"{path}/log")
                    known = known.where(~((F.col("writer") == writer) & (F.col("batch") == number))).select(key).distinct()
                    late = late.unionByName(fresh.join(known, key, "left_semi"))
                    fresh = fresh.join(known, key, "left_anti")
                fresh = fresh.persist()
                fresh.write.mode("overwrite").parquet(f"{path}/log/{own}")
                late.write.mode("overwrite").parquet(f"{path}/rejected/{own}")
            if mirror is not None:
                try:
                    mirror(fresh)
                except Exception as failure:
                    fresh.withColumns({"status": F.lit("pending"), "error": F.lit(str(failure))}).write.mode("overwrite").json(f"{path}/outbox/{own}")
        finally:
            batch.unpersist()

    query = judged(stream, key, order, days).writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    # batches without data, which timeouts ask for again and again, would keep it from stopping
    before = spark.conf.get(_EMPTY, "true")
    spark.conf.set(_EMPTY, "false")
    try:
        return query.start()
    finally:
        spark.conf.set(_EMPTY, before)
