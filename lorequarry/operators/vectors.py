"""Exact vector retrieval: filter, score, top k, for one vector or a table of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Queries and corpus rows scored at a time.
QUERY_BLOCK, ROW_BLOCK = 512, 2048


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Null where either vector has no length."""
    return dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))


def top_k(corpus: DataFrame, query: list[float], k: int, id_: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k nearest by cosine, ties by id; filter `corpus` first. One top-k per partition.

    Vectors of no length, and those with null, NaN or infinite entries, are no hits.
    """
    q = F.array(*(F.lit(float(x)) for x in query))
    scored = corpus.withColumn("score", cosine(F.col(vector), q)).where("score IS NOT NULL AND NOT isnan(score)")
    return scored.orderBy(F.desc("score"), id_).limit(k)


def _unit(vectors: list) -> np.ndarray:
    v = np.array(vectors, np.float64)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's k highest scores and their ids (of one row for all, or a row each), ties by id."""
    order = np.lexsort((np.broadcast_to(ids, score.shape), -score), axis=1)[:, :k]
    return np.take_along_axis(score, order, 1), np.take_along_axis(np.broadcast_to(ids, score.shape), order, 1)


def _nearest(score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """As _best for many columns with ids in ascending order: sorts only what reaches a row's k-th score."""
    if score.shape[1] <= k:
        return _best(score, ids, k)
    row, col = np.nonzero(score >= np.partition(score, -k, axis=1)[:, [-k]])
    order = np.lexsort((col, -score[row, col], row))
    row, col = row[order], col[order]
    first = np.searchsorted(row, np.arange(len(score)))[:, None] + np.arange(k)
    return np.take_along_axis(score, col[first], 1), ids[col[first]]


def top_k_each(corpus: DataFrame, queries: DataFrame, k: int, id_: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, `id_`, score, rank): for each row of `queries` the k nearest of all of `corpus`
    by cosine (rounded to nine digits), ties by id; `rank` from 1.

    Every pair is scored, in blocks; a task keeps k rows a query, and these are merged. The
    queries' vectors are held by the driver and each task. Rows without id or length, with null
    elements or of another dimension than a query's are no hits of it. Ids are longs.
    """
    size = F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    sound = lambda df: df.select(F.col(id_).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).where(F.col("id").isNotNull() & (size > 0) & (size < float("inf")))
    found = sound(queries).distinct().toArrow()
    by_size: dict[int, list] = {}
    for i, v in enumerate(found.column("v").to_numpy()):
        by_size.setdefault(len(v), []).append((i, v))
    asked = corpus.sparkSession.sparkContext.broadcast({n: (np.array([i for i, _ in rows]), _unit([v for _, v in rows])) for n, rows in by_size.items()})
    query_ids = np.asarray(found.column("id").combine_chunks())
    names = corpus.sparkSession.sparkContext.broadcast(query_ids)
    query_block, row_block = QUERY_BLOCK, ROW_BLOCK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, row_block):
                part = batch.slice(start, row_block)
                ids, rows = np.asarray(part.column("id")), part.column("v").to_numpy(zero_copy_only=False)
                order = np.argsort(ids, kind="stable")
                sizes = np.array([len(rows[i]) for i in order])
                for n in set(sizes.tolist()) & asked.value.keys():
                    at = order[sizes == n]
                    unit = _unit([rows[i] for i in at])
                    for lo in range(0, len(asked.value[n][0]), query_block):
                        new = _nearest(np.round(asked.value[n][1][lo : lo + query_block] @ unit.T, 9), ids[at], k)
                        old = kept.get((n, lo))
                        kept[n, lo] = _best(*(np.concatenate(x, axis=1) for x in zip(old, new)), k) if old else new
        for (n, lo), (score, ids) in kept.items():
            query = np.repeat(asked.value[n][0][lo : lo + query_block], score.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(names.value[query]), pa.array(ids.ravel()), pa.array(score.ravel())], ["query", "query_id", id_, "score"])

    best = sound(corpus).mapInArrow(run, f"query long, query_id long, `{id_}` long, score double")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), id_))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", id_, "score", "rank")
