"""Differences of two large tables by a tree of digests kept beside each.

A table is stored in bucket folders by a hash of its keys. A bucket's digest is its number of rows
and two sums of row hashes, which do not depend on order, so appended rows add theirs. Nodes above
sum `fan` nodes each. Two trees are compared from the root down, only under nodes that differ; of
the tables only the buckets of leaves that differ are read.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import relate


class Shape(NamedTuple):
    """Nodes under a node, and levels under the root: fan ** depth buckets."""

    fan: int = 64
    depth: int = 2

    @property
    def buckets(self) -> int:
        return self.fan**self.depth


def _digests(rows: DataFrame, keys: Sequence[str], values: Sequence[str], shape: Shape) -> DataFrame:
    """(level, node, n, a, b) of all nodes above `rows`, which have their bucket."""
    all_ = [*keys, *values]
    # whether a value is null is hashed too, as a null leaves a hash as it was
    cells = [*all_, *(F.col(c).isNull() for c in all_)]
    at = rows.select("bucket", *(F.xxhash64(F.lit(seed), *cells).cast("decimal(38,0)").alias(x) for seed, x in ((1, "a"), (2, "b"))))
    leaf = at.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b"))
    levels = F.explode(F.array(*(F.struct(F.lit(k).alias("level"), F.floor(F.col("bucket") / shape.fan ** (shape.depth - k)).cast("int").alias("node")) for k in range(shape.depth + 1))))
    each = leaf.select("n", "a", "b", levels.alias("x")).select("x.level", "x.node", "n", "a", "b")
    return each.groupBy("level", "node").agg(F.sum("n").alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b"))


def _bucketed(df: DataFrame, keys: Sequence[str], shape: Shape) -> DataFrame:
    return df.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(shape.buckets)).cast("int"))


def save(df: DataFrame, path: str, keys: Sequence[str], values: Sequence[str], shape: Shape = Shape()) -> None:
    """Write `keys` and `values` under `path`, with their tree; what is there is replaced."""
    _write(df, path, keys, values, shape, "overwrite")


def append(df: DataFrame, path: str, keys: Sequence[str], values: Sequence[str], shape: Shape = Shape()) -> None:
    """Add rows: new files in their buckets, and their digests, which a reader adds up."""
    _write(df, path, keys, values, shape, "append")


def _write(df, path, keys, values, shape, mode) -> None:
    rows = _bucketed(df.select(*keys, *values), keys, shape)
    spark = df.sparkSession
    rows.repartition("bucket").write.mode(mode).partitionBy("bucket").parquet(f"{path}/rows")
    # digests are taken from what was written where nothing was there before, else from what is added
    source = spark.read.parquet(f"{path}/rows") if mode == "overwrite" else rows
    _digests(source, keys, values, shape).coalesce(1).write.mode(mode).partitionBy("level").parquet(f"{path}/tree")


def tree(spark: SparkSession, path: str) -> DataFrame:
    """(level, node, n, a, b) of a stored table."""
    return spark.read.parquet(f"{path}/tree").groupBy("level", "node").agg(F.sum("n").alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b"))


def changed_buckets(spark: SparkSession, left: str, right: str, shape: Shape = Shape()) -> list[int]:
    """The buckets whose digests differ, from the root down; each level reads its own partition of
    the trees, and only children of nodes that differ. At most all bucket numbers."""
    nodes, both = [0], (tree(spark, left), tree(spark, right))
    for level in range(shape.depth + 1):
        if level:
            nodes = [n * shape.fan + i for n in nodes for i in range(shape.fan)]
        if not nodes:
            return []
        part = [t.where((F.col("level") == level) & F.col("node").isin(nodes)).drop("level") for t in both] if len(nodes) < shape.buckets else [t.where(F.col("level") == level).drop("level") for t in both]
        nodes = sorted(r["node"] for r in relate.difference(*part, ["node"], ["n", "a", "b"]).where("status <> 'same'").collect())
    return nodes


def difference(spark: SparkSession, left: str, right: str, keys: Sequence[str], values: Sequence[str], shape: Shape = Shape()) -> DataFrame:
    """(keys, status): the keys that only one side has or whose values differ; nothing else.

    Both tables must have been saved with the same keys, values and shape. Buckets whose digests
    agree are not read: their rows are taken as equal, which two 64-bit sums and a count would
    hide for about one change in 10^38. Null values are equal to each other; keys are not null.
    """
    buckets = changed_buckets(spark, left, right, shape)
    rows = [spark.read.parquet(f"{path}/rows").where(F.col("bucket").isin(buckets)) for path in (left, right)]
    return relate.difference(*rows, keys, values).where("status <> 'same'")
