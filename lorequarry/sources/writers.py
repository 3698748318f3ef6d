"""Sinks: idempotent appends, versioned publishing behind a pointer, logs with a mirror."""

from __future__ import annotations

import contextlib
import json
import os
import re
import time
from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import uuid5
from .readers import exists

#: Verbs that a read-only statement may begin with, and plain identifiers.
READS = ("select", "with", "show", "describe", "explain", "values")
NAME = re.compile(r"[a-z_][a-z0-9_]*")


@contextlib.contextmanager
def locked(spark: SparkSession, path: str, wait: float = 120, stale: float = 3600) -> Iterator[None]:
    """Hold the lock file `path`, which its file system creates for one caller alone.

    The local one does so by the operating system, others by creation without overwriting, which
    is atomic in HDFS but not in every object store. After `wait` seconds TimeoutError is raised; a lock older than `stale` seconds is taken as left
    behind by a driver that was lost, and removed.
    """
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    until, local = time.monotonic() + wait, system.getUri().getScheme() == "file"
    if local:
        os.makedirs(os.path.dirname(at.toUri().getPath()), exist_ok=True)
    while True:
        try:
            if local:
                os.close(os.open(at.toUri().getPath(), os.O_CREAT | os.O_EXCL))
            else:
                system.create(at, False).close()
            break
        except Exception as taken:
            if not system.exists(at):
                raise
            with contextlib.suppress(Exception):  # it may be gone by now
                if time.time() - system.getFileStatus(at).getModificationTime() / 1000 > stale:
                    system.delete(at, False)
            if time.monotonic() > until:
                raise TimeoutError(f"{path} is held") from taken
            time.sleep(0.1)
    try:
        yield
    finally:
        system.delete(at, False)


def append_unseen(rows: DataFrame, path: str, keys: Sequence[str], order: Sequence[str] = (), buckets: int = 64) -> None:
    """Append the rows whose key the Parquet table at `path` lacks; running again adds nothing.

    Of rows with one key the first by `order` (else by all columns) is kept. The table is
    partitioned by a hash of the key, and only partitions that new keys fall in are read.
    """
    spark = rows.sparkSession
    rows = rows.withColumn("key_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    rest = [c for c in rows.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*(order or rest))).alias("first")
    rows = rows.groupBy(*keys).agg(first).select(*keys, "first.*")
    if exists(spark, path):
        touched = [r[0] for r in rows.select("key_bucket").distinct().collect()]  # at most `buckets`
        known = spark.read.parquet(path).where(F.col("key_bucket").isin(touched))
        rows = rows.join(known.select(*keys), list(keys), "left_anti")
    rows.write.mode("append").partitionBy("key_bucket").parquet(path)


def publish(tables: Mapping[str, DataFrame], root: str, version: str) -> dict[str, int]:
    """Write each table under a new version, compare the rows read back with those written, and
    only then move the pointer: readers see all tables of a version or none."""
    if not version or not re.fullmatch(r"[A-Za-z0-9_.-]+", version):
        raise ValueError("a version is needed")
    counts = {}
    for name, df in tables.items():
        told = df.count()
        df.write.mode("errorifexists").parquet(f"{root}/{version}/{name}")
        counts[name] = df.sparkSession.read.parquet(f"{root}/{version}/{name}").count()
        if counts[name] != told:
            raise ValueError(f"{name}: {told} rows were to be written, {counts[name]} are there")
    point(next(iter(tables.values())).sparkSession, root, version)
    return counts


def point(spark: SparkSession, root: str, version: str) -> None:
    """Make `version` the current one: a file renamed in one step, so rolling back is a call too."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    if not exists(spark, f"{root}/{version}"):
        raise ValueError(f"no version {version}")
    fs = path(root).getFileSystem(conf)
    out = fs.create(path(f"{root}/NEXT"), True)
    out.write(bytearray(version.encode()))
    out.close()
    fs.delete(path(f"{root}/CURRENT"), False)
    if not fs.rename(path(f"{root}/NEXT"), path(f"{root}/CURRENT")):
        raise OSError("the pointer did not move")


def published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the current version; after a break between two pointers, of the one to come."""
    for pointer in ("CURRENT", "NEXT"):
        if exists(spark, f"{root}/{pointer}"):
            version = bytes(spark.read.format("binaryFile").load(f"{root}/{pointer}").first()["content"]).decode()
            return spark.read.parquet(f"{root}/{version}/{name}")
    raise ValueError("nothing is published")


def csv_sorted(df: DataFrame, path: str, columns: Sequence[str], keys: Sequence[str]) -> None:
    """CSV in key order with these columns: lists and structs as JSON, maps with sorted keys,
    booleans in lower case, nulls empty, LF. The parts follow each other in order."""
    kinds = dict(df.dtypes)

    def cell(c: str):
        if kinds[c].startswith("map"):
            return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(c)))).alias(c)
        if kinds[c].startswith(("array", "struct")):
            return F.to_json(c, {"ignoreNullFields": "false"}).alias(c)
        return F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)

    ordered = df.orderBy(*keys).select(*(cell(c) for c in columns))
    ordered.write.mode("overwrite").csv(path, header=True, escape='"', emptyValue="", lineSep="\n")


def write_if_changed(df: DataFrame, path: str, volatile: Sequence[str] = ()) -> bool:
    """Write unless the table at `path` holds the same rows, volatile columns aside."""
    spark = df.sparkSession
    mark = lambda d: d.agg(F.count(F.lit(1)), F.sum(F.xxhash64(F.to_json(F.struct(*sorted(d.columns)), {"ignoreNullFields": "false"})).cast("decimal(38,0)"))).first()
    if exists(spark, path) and mark(spark.read.parquet(path).drop(*volatile)) == mark(df.drop(*volatile)):
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def upsert(rows: DataFrame, path: str, version: str, key: str, namespace: str, order: str) -> DataFrame:
    """The rows under `path`/`version` after adding `rows`: an id from the key by name, the latest by
    `order` of each key. `path` holds versions, so readers of the old one are not disturbed."""
    spark = rows.sparkSession
    rows = rows.withColumn("point_id", uuid5(namespace, F.col(key)))
    old = [p for p in [f"{path}/latest"] if exists(spark, p)]
    if old:
        rows = rows.unionByName(spark.read.parquet(json.loads(spark.read.text(old[0]).first()[0])["at"]))
    rest = [c for c in rows.columns if c != key]
    rows.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("r")).select(key, "r.*").write.mode("errorifexists").parquet(f"{path}/{version}")
    spark.createDataFrame([(json.dumps({"at": f"{path}/{version}"}),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/latest")
    return spark.read.parquet(f"{path}/{version}")


def table_ddl(df: DataFrame, table: str, comment: str, schema: str = "serving", all_text: bool = False) -> str:
    """CREATE TABLE for the frame; names must be plain, the comment carries lineage."""
    for name in (schema, table, *df.columns):
        if not NAME.fullmatch(name):
            raise ValueError(f"{name!r} is no plain name")
    columns = ", ".join(f"{c} {'STRING' if all_text else t.upper()}" for c, t in df.dtypes)
    return f"CREATE TABLE IF NOT EXISTS {schema}.{table} ({columns}) USING PARQUET COMMENT '{comment.replace(chr(39), chr(39) * 2)}'"


def guard_read_only(sql: str) -> str:
    """The statement, if it only reads; several statements or another verb are an error."""
    bare = re.sub(r"'(?:[^']|'')*'|--[^\n]*|/\*.*?\*/", " ", sql, flags=re.S).strip().rstrip(";").strip()
    if ";" in bare or not bare or bare.split()[0].lower() not in READS or re.search(r"\b(insert|update|delete|merge|drop|alter|create|truncate|grant|revoke)\b", bare, re.I):
        raise ValueError("only reading statements are allowed")
    return sql


def guard_schema(sql: str, legacy: Sequence[str]) -> str:
    """The statement, if it names no table of a legacy schema."""
    if found := [s for s in legacy if re.search(rf"\b{re.escape(s)}\s*\.", sql, re.I)]:
        raise ValueError(f"{found} must not be written")
    return sql


def guard_path(path: str, canonical: str) -> str:
    """The path, if it is the one canonical sink."""
    if path.rstrip("/") != canonical.rstrip("/"):
        raise ValueError(f"{path} is not the log")
    return path


def ledger(spark: SparkSession, path: str, version: str, entry: Mapping[str, str]) -> None:
    """Append a deployment to the ledger; an entry without a version is refused."""
    if not version:
        raise ValueError("a version is needed")
    cells = {**entry, "version": version}
    spark.createDataFrame([tuple(cells.values())], ", ".join(f"{k} string" for k in cells)).coalesce(1).write.mode("append").json(path)


def log_rows(rows: DataFrame, path: str, key: str, mirror: Callable[[DataFrame], object] | None = None, outbox: str | None = None) -> str:
    """Append to the log at `path`, then mirror; returns logged, mirrored or pending.

    A null, repeated or known key raises ValueError before anything is written. The rows are
    made once, and a writer holds the log's lock from the check to the write, so that of two with
    one key the second is refused. If the mirror fails, the rows go to the outbox as JSON lines
    with status pending; without an outbox its error is raised.
    """
    spark = rows.sparkSession
    rows = rows.persist()
    try:
        bad = rows.groupBy(key).count().where((F.col("count") > 1) | F.col(key).isNull())
        if not bad.isEmpty():
            raise ValueError(f"{key} is null or repeated")
        with locked(spark, f"{path.rstrip('/')}.lock"):
            if exists(spark, path) and not rows.join(spark.read.parquet(path).select(key), key, "left_semi").isEmpty():
                raise ValueError(f"{key} is in the log already")
            rows.write.mode("append").parquet(path)
        if mirror is None:
            return "logged"
        try:
            mirror(rows)
            return "mirrored"
        except Exception as failure:
            if outbox is None:
                raise
            rows.withColumns({"status": F.lit("pending"), "error": F.lit(str(failure))}).write.mode("append").json(outbox)
            return "pending"
    finally:
        rows.unpersist()


def reconcile(log: DataFrame, mirror: DataFrame, key: str, send: Callable[[DataFrame], object], outbox: str | None = None) -> tuple[int, int]:
    """(replayed, extra): rows of the log that the mirror lacks are sent again; rows that only the
    mirror has are counted for an alarm and left alone. The outbox notes what was replayed."""
    missing = log.join(mirror.select(key), key, "left_anti").persist()
    try:
        n = missing.count()
        if n:
            send(missing)
            if outbox is not None:
                missing.select(key, F.lit("replayed").alias("status")).write.mode("append").json(outbox)
        return n, mirror.join(log.select(key), key, "left_anti").count()
    finally:
        missing.unpersist()
