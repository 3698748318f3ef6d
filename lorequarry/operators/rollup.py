"""Aggregations that the compiled views need."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def joined_set(column: str, sep: str = ",") -> Column:
    """The group's distinct values, sorted and joined."""
    return F.array_join(F.array_sort(F.collect_set(column)), sep)


def share(part: Column, total: Column) -> Column:
    """A percentage with one decimal; zero where the total is zero."""
    return F.when(total == 0, F.lit(0.0)).otherwise(F.round(100.0 * part / total, 1))


def row_hash(columns: Sequence[str]) -> Column:
    """sha256 of the values as text, a unit separator between them, nulls empty."""
    return F.sha2(F.concat_ws("\x1f", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)), 256)


def table_signature(df: DataFrame, columns: Sequence[str], buckets: int = 4096) -> DataFrame:
    """(n_rows, signature): independent of row order.

    Sorted row hashes are hashed by hash prefix first, then the buckets' hashes in order, so
    no task sorts or holds the whole table.
    """
    rows = df.select(row_hash(columns).alias("h"))
    width = 3 if buckets > 256 else 2
    part = rows.groupBy(F.substring("h", 1, width).alias("p")).agg(F.count(F.lit(1)).alias("n"), F.sha2(F.array_join(F.array_sort(F.collect_list("h")), ""), 256).alias("s"))
    total = part.agg(F.sum("n").alias("n_rows"), F.array_sort(F.collect_list(F.struct("p", "s"))).alias("all"))
    return total.select(F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.sha2(F.array_join(F.transform("all", lambda x: x["s"]), ""), 256).alias("signature"))


def manifest(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(manifest_hash, run_id, n): the signature of the entries, its first 16 digits, and the
    number of hash prefixes that it is nested by."""
    part = df.select(row_hash(columns).alias("h")).groupBy(F.substring("h", 1, 3).alias("p")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list("h")), ""), 256).alias("s"))
    whole = part.agg(F.array_sort(F.collect_list(F.struct("p", "s"))).alias("all"))
    digest = F.sha2(F.array_join(F.transform("all", lambda x: x["s"]), ""), 256)
    return whole.select(digest.alias("manifest_hash"), F.substring(digest, 1, 16).alias("run_id"), F.size("all").cast("long").alias("n"))


def zero_filled(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """(column, n) for every value of a closed list, zero where none occurs."""
    enum = df.sparkSession.createDataFrame([(v,) for v in values], f"{column} string")
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return enum.join(counts, column, "left").select(column, F.coalesce("n", F.lit(0)).alias("n"))


def stratified(df: DataFrame, group: str, key: str, seed: int) -> DataFrame:
    """A sixth of each group's rows, but two at least (or all): those with the least hashes of seed and key.

    Ranks are made of counts by hash prefix and ranks inside a prefix, so a group that holds a
    third of all rows is spread over 4096 sorts. Null is a group too; equal keys rank in no
    stated order, so keys should be unique.
    """
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    rows = df.withColumn("_h", h).withColumn("_p", F.substring("_h", 1, 3))
    parts = rows.groupBy(F.col(group).alias("_g"), F.col("_p").alias("_q")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_g").orderBy("_q")
    parts = parts.withColumn("_size", F.sum("_n").over(Window.partitionBy("_g"))).withColumn("_upto", F.sum("_n").over(before) - F.col("_n"))
    parts = parts.withColumn("_take", F.least("_size", F.greatest(F.lit(2), F.floor(F.col("_size") / 6))) - F.col("_upto")).where("_take > 0")
    hit = rows.join(parts, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_p") == F.col("_q")))
    rank = F.row_number().over(Window.partitionBy(group, "_p").orderBy("_h", key))
    return hit.withColumn("_r", rank).where("_r <= _take").select(df.columns)
