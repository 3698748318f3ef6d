"""Line deduplication over levelled sorted runs of line hashes.

Documents arrive in batches of ascending doc_id. A run holds the keys (128-bit line hashes)
that some batches brought first, each with the document that holds it; runs are disjoint.
A batch merge-anti-joins its keys with the runs, keeps what is new, and adds it as a run of
level 0. Whenever `fanout` runs stand on a level they are compacted into one on the next.
Runs are bucketed tables, each bucket one file sorted by key, so that a merge reads them as they
stand: no run is shuffled or sorted again. They and the lines, partitioned by batch, lie in the
shared checkpoint folder until the dropped lines are found. Only DataFrame functions are used.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import checkpoint_folder, cut, part_bounds, part_of, remove, unused

_WHITE = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["h1", "h2"]


_ORDERED = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased."""
    bare = F.btrim(line, F.lit(_WHITE))
    # lower() folds ASCII alone where there is nothing else, and is much faster than translate()
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def hashed_lines(docs: DataFrame, min_length: int) -> DataFrame:
    """(doc_id, pos, h1, h2) of every line whose key has `min_length` code points or more."""
    lines = docs.select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("pos", "line"))
    lines = lines.select("doc_id", "pos", line_key(F.col("line")).alias("key")).where(F.char_length("key") >= min_length)
    # two hashes of different seeds: 128 bits together
    return lines.select("doc_id", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(71), "key").alias("h2"))


class Runs:
    """Levels of disjoint runs (h1, h2, first): bucketed tables under `folder`, sorted by key."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int, fanout: int):
        self.spark, self.folder, self.buckets, self.fanout = spark, folder, buckets, fanout
        self.levels: list[list[DataFrame]] = []
        self.names: list[str] = []
        # a bucket of one file keeps its order when read
        self.before = spark.conf.get(_ORDERED, None)
        spark.conf.set(_ORDERED, "true")

    def write(self, keys: DataFrame) -> DataFrame:
        name = f"lorequarry_run_{uuid.uuid4().hex}"
        self.names.append(name)
        # a task holds one bucket whole, so that each bucket is one file
        bucket = F.pmod(F.hash(*KEY), F.lit(self.buckets))
        dealt = keys.repartitionById(self.buckets, bucket).write.bucketBy(self.buckets, *KEY).sortBy(*KEY)
        dealt.option("path", f"{self.folder}/{name}").format("parquet").saveAsTable(name)
        return self.spark.table(name)

    def new(self, keys: DataFrame) -> DataFrame:
        """The keys that no run holds yet."""
        for level in self.levels:
            for run in level:
                keys = keys.join(run.hint("merge"), KEY, "left_anti")
        return keys

    def add(self, run: DataFrame, level: int = 0) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            merged, self.levels[level] = reduce(DataFrame.unionAll, self.levels[level]), []
            self.add(self.write(merged), level + 1)

    def drop(self) -> None:
        """Drop the tables and put the session's setting back."""
        if self.before is None:
            self.spark.conf.unset(_ORDERED)
        else:
            self.spark.conf.set(_ORDERED, self.before)
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def dropped_lines(docs: DataFrame, min_length: int = 10, batches: int = 4, fanout: int = 2) -> DataFrame:
    """(doc_id, pos): lines whose key an earlier document holds; pos counts from 0."""
    spark = docs.sparkSession
    docs = docs.where("doc_id IS NOT NULL")
    bounds = part_bounds(docs, "doc_id", batches)
    folder = f"{checkpoint_folder(spark)}/lines-{uuid.uuid4().hex}"
    runs, out = Runs(spark, folder, int(spark.conf.get("spark.sql.shuffle.partitions")), fanout), []
    try:
        hashed_lines(docs, min_length).withColumn("batch", part_of(F.col("doc_id"), bounds)).write.partitionBy("batch").parquet(f"{folder}/lines")
        lines = spark.read.schema("doc_id long, pos int, h1 long, h2 long, batch int").parquet(f"{folder}/lines")
        for i in range(len(bounds) + 1):
            batch = lines.where(F.col("batch") == i).drop("batch")
            run = runs.write(runs.new(batch.groupBy(*KEY).agg(F.min("doc_id").alias("first"))))
            # by key and document, so that a line of very many documents is spread over the tasks
            held = run.withColumnRenamed("first", "doc_id")
            out.append(batch.join(held, [*KEY, "doc_id"], "left_anti").select("doc_id", "pos"))
            if i < len(bounds):
                runs.add(run)
        return cut(reduce(DataFrame.unionAll, out))
    finally:
        runs.drop()
        remove(spark, folder)


def dedup_lines(docs: DataFrame, min_length: int = 10, batches: int = 4, fanout: int = 2) -> DataFrame:
    """`docs` with n_lines, n_dropped and kept_text added, one row per row.

    A key of at least `min_length` code points that several documents hold keeps its lines
    in the smallest doc_id only; within one document repeats stay. Null and empty texts are
    one empty line; kept_text is then empty. Rows with a null doc_id keep all lines and take
    none from others. Rows that repeat a doc_id count as one document whose lines at equal
    positions fall together. Other columns pass through; columns named n_lines, n_dropped or
    kept_text are replaced. An empty table gives an empty table.
    """
    drops = dropped_lines(docs.select("doc_id", "text"), min_length, batches, fanout)
    docs = docs.drop("n_lines", "n_dropped", "kept_text")
    id_, drop, lines, keep = unused(docs, "id", "drop", "lines", "keep")
    drops = drops.groupBy(F.col("doc_id").alias(id_)).agg(F.collect_set("pos").alias(drop))
    # the split text is a column of its own, so that a lambda does not split it for each line
    out = docs.join(drops, docs["doc_id"] == drops[id_], "left").withColumn(lines, F.split(F.coalesce("text", F.lit("")), "\n"))
    out = out.withColumn(keep, F.when(F.col(drop).isNotNull(), F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(drop))))
    kept = F.array_join(F.transform(keep, lambda i: F.get(F.col(lines), i)), "\n")
    return out.select(
        *docs.columns,
        F.size(lines).cast("long").alias("n_lines"),
        F.when(F.col(keep).isNull(), 0).otherwise(F.size(lines) - F.size(keep)).cast("long").alias("n_dropped"),
        F.coalesce(F.when(F.col(keep).isNotNull(), kept), "text", F.lit("")).alias("kept_text"),
    )
