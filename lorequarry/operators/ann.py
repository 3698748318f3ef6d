"""Approximate vector search by inverted lists, filter first, for tables of queries.

Centers are fitted to a bounded sample; every row of the corpus goes to the list of its nearest
center. A query meets the lists nearest to it, as many as the sample showed to be needed for a
wanted recall at the number of rows that the filter leaves, and all rows there are scored exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from .lineage import cut
from .vectors import _best, _unit

#: Rows of a list, and queries on it, that one group scores against each other.
BLOCK = 2048
#: Queries of the sample that probes are chosen by.
_TRIED = 200


class Lists(NamedTuple):
    """Unit centers, and (rows, probes) by rising rows: how many lists a query of that many rows meets."""

    centers: np.ndarray
    probes: list[tuple[int, int]]

    def probes_for(self, rows: int) -> int:
        fit = [p for n, p in self.probes if n <= rows]
        return fit[-1] if fit else len(self.centers)


def _sound(vector: str) -> Column:
    size = F.aggregate(F.col(vector).cast("array<double>"), F.lit(0.0), lambda s, x: s + x * x)
    return F.coalesce((size > 0) & (size < float("inf")), F.lit(False))


def train(corpus: DataFrame, lists: int = 64, k: int = 8, recall: float = 0.95, sample: int = 20_000, rounds: int = 10, id_: str = "vec_id", vector: str = "embedding") -> Lists:
    """Centers and probes from the `sample` rows of least hash of their id, which come to the driver.

    Vectors of another length than the sample's most usual are left out. The probes of a number of
    rows are the fewest lists in which that many rows of the sample have, of the `k` nearest of
    some of them, a share of `recall`. An empty corpus has no center.
    """
    rows = corpus.where(_sound(vector)).select(F.col(vector).cast("array<double>").alias("v"), id_)
    found = [np.asarray(v) for v in rows.orderBy(F.xxhash64(id_), id_).limit(sample).select("v").toArrow()["v"].to_pylist()]
    if not found:
        return Lists(np.zeros((0, 0)), [])
    sizes, n = np.unique([len(v) for v in found], return_counts=True)
    x = _unit([v for v in found if len(v) == sizes[n.argmax()]])
    rng = np.random.default_rng(1)
    centers = x[rng.permutation(len(x))[: min(lists, len(x))]]
    for _ in range(rounds):
        own = (x @ centers.T).argmax(axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, own, x)
        length = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centers = np.where(length > 0, sums / np.where(length > 0, length, 1), centers)
    own, probes, m = (x @ centers.T).argmax(axis=1), [], len(x)
    while m >= 16 * k:
        some = x[:m]
        near = np.argsort(-(some[:_TRIED] @ some.T), axis=1)[:, :k]
        place = np.argsort(np.argsort(-(some[:_TRIED] @ centers.T), axis=1), axis=1)
        at = np.sort(np.take_along_axis(place, own[near], axis=1).ravel())
        probes.append((m, int(at[min(len(at) - 1, int(np.ceil(recall * len(at))))]) + 1))
        m //= 4
    return Lists(centers, probes[::-1])


def assign(corpus: DataFrame, lists: Lists, vector: str = "embedding") -> DataFrame:
    """`corpus` with its `list`; vectors that no center fits (null, empty, of no length, with null,
    NaN or infinite entries, or of another dimension) are left out."""
    centers = corpus.sparkSession.sparkContext.broadcast(lists.centers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = centers.value
            v = batch.column("_v").to_pylist()
            own = (np.array(v, np.float64).reshape(len(v), c.shape[1]) @ c.T).argmax(axis=1) if len(v) else np.zeros(0)
            yield batch.drop_columns(["_v"]).append_column("list", pa.array(own.astype(np.int32)))

    fits = _sound(vector) & (F.size(vector) == int(lists.centers.shape[1]))
    return corpus.where(fits).withColumn("_v", F.col(vector).cast("array<double>")).mapInArrow(run, StructType([*corpus.schema, StructField("list", IntegerType())])) if len(lists.centers) else corpus.where("false").withColumn("list", F.lit(0))


def save(assigned: DataFrame, lists: Lists, path: str) -> None:
    """The rows in a folder for each list, so that a probe reads its lists alone, and the centers."""
    assigned.repartition("list").write.mode("overwrite").partitionBy("list").parquet(f"{path}/rows")
    spark = assigned.sparkSession
    rows = [(i, c) for i, c in enumerate(lists.centers.tolist())]
    spark.createDataFrame(rows, "list int, center array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/centers")
    spark.createDataFrame(lists.probes, "n long, probes int").coalesce(1).write.mode("overwrite").parquet(f"{path}/probes")


def load(spark: SparkSession, path: str) -> tuple[DataFrame, Lists]:
    centers = [r["center"] for r in spark.read.parquet(f"{path}/centers").orderBy("list").collect()]
    probes = [(r["n"], r["probes"]) for r in spark.read.parquet(f"{path}/probes").orderBy("n").collect()]
    return spark.read.parquet(f"{path}/rows"), Lists(np.array(centers), probes)


def _probed(queries: DataFrame, lists: Lists, probes: int, there: list[int]) -> DataFrame:
    """(query_id, v, list): each query's nearest lists of those that have rows."""
    held = queries.sparkSession.sparkContext.broadcast((lists.centers[there], np.array(there, np.int32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centers, names = held.value
        for batch in batches:
            v = batch.column("v").to_pylist()
            if not v:
                continue
            near = names[np.argsort(-(np.array(v, np.float64) @ centers.T), axis=1, kind="stable")[:, :probes]]
            row = np.repeat(np.arange(len(v)), near.shape[1])
            yield pa.RecordBatch.from_arrays([batch.column("query_id").take(pa.array(row)), batch.column("v").take(pa.array(row)), pa.array(near.ravel())], ["query_id", "v", "list"])

    return queries.mapInArrow(run, "query_id long, v array<double>, list int")


def search(assigned: DataFrame, lists: Lists, queries: DataFrame, k: int, where: Column | None = None, id_: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, `id_`, score, rank): for each row of `queries` (`id_`, `vector`) the k nearest of
    its probed lists' rows that pass `where`, by cosine rounded to nine digits, ties by id.

    Rows and queries stay in Spark: a list's are met in groups of at most about BLOCK of each, so
    a list that holds much of the corpus, or that many queries probe, is dealt to many tasks. Only
    the number of rows in each list comes to the driver. Queries without id or a sound vector of
    the centers' length have no hits; repeated ones count once. Ids are longs.
    """
    rows = assigned.where(F.lit(True) if where is None else where).where(F.col(id_).isNotNull())
    rows = rows.select(F.col(id_).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("w"), "list")
    size = {r["list"]: r["n"] for r in rows.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()}
    out = f"query_id long, `{id_}` long, score double"
    spark = assigned.sparkSession
    if not size:
        return spark.createDataFrame([], out).withColumn("rank", F.lit(0))
    asked = queries.where(_sound(vector) & F.col(id_).isNotNull() & (F.size(vector) == int(lists.centers.shape[1])))
    asked = asked.select(F.col(id_).cast("long").alias("query_id"), F.col(vector).cast("array<double>").alias("v")).distinct()
    probed = cut(_probed(asked, lists, lists.probes_for(sum(size.values())), sorted(size)))
    on = {r["list"]: r["n"] for r in probed.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = spark.createDataFrame([(i, -(-n // BLOCK), -(-on[i] // BLOCK)) for i, n in size.items() if i in on] or [(-1, 1, 1)], "list int, r int, q int")
    deal = lambda df, own, other, key: df.join(F.broadcast(parts), "list").withColumn(own, F.pmod(F.xxhash64(key), F.col(own)).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))

    def score(corpus: pa.Table, asked: pa.Table) -> pa.Table:
        if not corpus.num_rows or not asked.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), id_: pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        ids = np.asarray(corpus["id"])
        order = np.argsort(ids, kind="stable")
        all_ = np.round(_unit(asked["v"].to_pylist()) @ _unit(corpus["w"].to_pylist())[order].T, 9)
        best, names = _best(all_, ids[order], k)
        return pa.table({"query_id": np.repeat(np.asarray(asked["query_id"]), best.shape[1]), id_: names.ravel(), "score": best.ravel()})

    by = ["list", "r", "q"]
    met = deal(rows, "r", "q", "id").groupBy(*by).cogroup(deal(probed, "q", "r", "query_id").groupBy(*by)).applyInArrow(score, out)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), id_))
    return met.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", id_, "score", "rank")
