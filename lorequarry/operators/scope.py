"""Tenant-scoped filters, per-stage drop reasons and priority picks."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

log = logging.getLogger(__name__)
#: Rows that a caller gets unless it says otherwise.
MAX_ITEMS = 1000


def scoped(df: DataFrame, required: Mapping[str, Sequence], optional: Mapping[str, Sequence] | None = None) -> DataFrame:
    """Rows whose columns hold allowed values.

    A required column that `df` lacks, or one without an allowed value, is an error: the filter
    never opens. Optional filters on columns that `df` lacks are skipped. Null is not allowed.
    """
    for name, values in required.items():
        if name not in df.columns:
            raise ValueError(f"no column {name} to scope by")
        if not values:
            raise ValueError(f"no value of {name} is allowed")
        df = df.where(F.col(name).isin(*values))
    for name, values in (optional or {}).items():
        if name in df.columns:
            df = df.where(F.col(name).isin(*values))
    return df


def drop_reason(stages: Sequence[tuple[str, Column]]) -> Column:
    """The first stage whose condition does not hold (null counts as not); else `kept`."""
    out = None
    for name, keep in stages:
        failed = ~F.coalesce(keep, F.lit(False))
        out = F.when(failed, name) if out is None else out.when(failed, name)
    return out.otherwise("kept")


def first_per(df: DataFrame, keys: Sequence[str], order: Sequence, n: int = 1) -> DataFrame:
    """The first n rows of each key in a total order; Spark limits each group before the shuffle."""
    name = spare(df, "rank")
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(name, rank).where(F.col(name) <= n).drop(name)


def spare(df: DataFrame, name: str) -> str:
    """A name like this that no column of `df` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def head(df: DataFrame, order: Sequence, n: int, most: int | None = MAX_ITEMS) -> DataFrame:
    """The first n rows, at most `most` (None: no bound), of which a warning tells; n below one is
    an error."""
    if n < 1:
        raise ValueError("n must be positive")
    if most is not None and n > most:
        log.warning("%d rows were asked for, %d is the most", n, most)
        n = most
    return df.orderBy(*order).limit(n)


def exactly_one(asked: DataFrame, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key of `asked`: n rows of `df` and verdict found, ambiguous or not_found."""
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    out = asked.select(*keys).distinct().join(n, list(keys), "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return out.withColumn("verdict", F.when(F.col("n") == 1, "found").when(F.col("n") == 0, "not_found").otherwise("ambiguous"))


def overlays(df: DataFrame, layer: str, base: str, content_type: str, column: str = "target_content_type", layer_column: str = "brand_layer") -> DataFrame:
    """A layer's rows for a content type; an empty target fits every type. The base layer has none."""
    if layer == base:
        return df.where(F.lit(False))
    target = F.coalesce(F.col(column), F.lit(""))
    return df.where((F.col(layer_column) == layer) & ((target == "") | (target == content_type)))
