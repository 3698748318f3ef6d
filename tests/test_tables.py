"""Digest trees, the document source, and streams of unique keys."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from lorequarry.operators import mirror
from lorequarry.sources import documents, writers
from lorequarry.streaming import unique

SHAPE = mirror.Shape(16, 2)


@pytest.fixture
def stored(spark, tmp_path):
    """A table of 5,000 rows stored twice."""
    df = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"), F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("w"))
    paths = [str(tmp_path / side) for side in "lr"]
    mirror.save(df, paths[0], ["k"], ["v", "w"], SHAPE)
    mirror.save(df.orderBy(F.desc("k")), paths[1], ["k"], ["v", "w"], SHAPE)
    return df, paths


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_equal_tables_are_not_read(spark, stored):
    _, paths = stored
    assert mirror.changed_buckets(spark, *paths, SHAPE) == []
    assert mirror.difference(spark, *paths, ["k"], ["v", "w"], SHAPE).count() == 0
    root = {tuple(r) for p in paths for r in mirror.tree(spark, p).where("level = 0").collect()}
    assert len(root) == 1 and root.pop()[2] == 5000


def test_changes_read_their_buckets_alone(spark, stored, tmp_path):
    df, (left, _) = stored
    right = str(tmp_path / "changed")
    changed = df.where("k <> 17").withColumn("w", F.when(F.col("k") == 30, "x").when(F.col("k") == 31, None).otherwise(F.col("w"))).unionByName(spark.createDataFrame([(9001, 1, "n")], "k long, v long, w string"))
    mirror.save(changed, right, ["k"], ["v", "w"], SHAPE)
    buckets = mirror.changed_buckets(spark, left, right, SHAPE)
    assert 0 < len(buckets) <= 4 < 0.02 * SHAPE.buckets
    out = mirror.difference(spark, left, right, ["k"], ["v", "w"], SHAPE)
    plan = _plan(out)
    assert {tuple(r) for r in out.collect()} == {(17, "only_left"), (30, "mismatch"), (31, "mismatch"), (9001, "only_right")}
    assert plan.count("PartitionFilters: [bucket") + plan.count("PartitionFilters: [isnotnull(bucket") == 2
    read = spark.read.parquet(f"{left}/rows").where(F.col("bucket").isin(buckets))
    assert 0 < len(read.inputFiles()) and read.count() < 0.05 * 5000


def test_appends_add_their_digests(spark, stored, tmp_path):
    df, (left, _) = stored
    parts = str(tmp_path / "parts")
    mirror.save(df.where("k < 2000"), parts, ["k"], ["v", "w"], SHAPE)
    mirror.append(df.where("k BETWEEN 2000 AND 3999"), parts, ["k"], ["v", "w"], SHAPE)
    assert {r["status"] for r in mirror.difference(spark, left, parts, ["k"], ["v", "w"], SHAPE).collect()} == {"only_left"}
    mirror.append(df.where("k >= 4000"), parts, ["k"], ["v", "w"], SHAPE)
    assert mirror.changed_buckets(spark, left, parts, SHAPE) == []


@pytest.fixture
def folder(spark, tmp_path):
    documents.register(spark)
    for path, text in {"a/x.md": "intro\n# One\nbody\n## Two\r\nmore", "a/y.txt": "y1\ny2\n", "b/x.md": "# B", "b/empty.txt": ""}.items():
        (tmp_path / path).parent.mkdir(exist_ok=True)
        (tmp_path / path).write_bytes(text.encode())
    return str(tmp_path)


def _load(spark, path, **options):
    return spark.read.format("lore_documents").options(**options).load(path)


def test_whole_documents_and_pushed_filters(spark, folder):
    df = _load(spark, folder)
    assert {(r["folder"], r["name"]): r["text"] for r in df.collect()} == {("a", "x.md"): "intro\n# One\nbody\n## Two\r\nmore", ("a", "y.txt"): "y1\ny2\n", ("b", "x.md"): "# B", ("b", "empty.txt"): ""}
    with open(os.path.join(folder, "b", "bad.bin"), "wb") as f:
        f.write(b"\xff")
    one = df.where("folder = 'a' AND name LIKE 'x%' AND text <> ''")  # the file that is not UTF-8 is never opened
    assert [r["name"] for r in one.collect()] == ["x.md"]
    left = _plan(one).partition("Filter (")[2].split("\n")[0]  # what Spark still has to see to
    assert "text" in left and "= a)" not in left and "StartsWith" not in left
    assert _load(spark, folder).where(F.col("name").isin("y.txt", "none")).count() == 1
    assert _load(spark, folder, pattern="*.md").count() == 2
    with pytest.raises(Exception, match="not UTF-8"):
        _load(spark, folder).collect()
    assert _load(spark, folder, mode="permissive").where("text IS NULL").count() == 1


def test_lines_are_split_by_bytes(spark, folder):
    lines = [f"line {i} é" * (i % 4) for i in range(3000)]
    with open(os.path.join(folder, "a", "big.log"), "wb") as f:
        f.write("\n".join(lines).encode())
    want, at = [], 0
    for line in lines:
        want.append((at, line))
        at += len(line.encode()) + 1
    for size in ("64000000", "1000", "7"):
        df = _load(spark, folder, record="line", splitBytes=size, pattern="big.log").select("offset", "text")
        got = sorted(tuple(r) for r in df.collect())
        assert got == (want if want[-1][1] else want[:-1])
        assert (df.rdd.getNumPartitions() > 1) == (size != "64000000")
        if size == "1000":
            break
    assert sorted(r["text"] for r in _load(spark, folder, record="line", pattern="y.txt").collect()) == ["y1", "y2"]


def test_sections(spark, folder):
    got = sorted((r["offset"], r["text"]) for r in _load(spark, folder, record="section").where("folder = 'a' AND name = 'x.md'").collect())
    assert got == [(0, "intro"), (6, "# One\nbody"), (17, "## Two\nmore")]


def _fed(spark, path, rows):
    spark.createDataFrame(rows, "k string, at long, who string").coalesce(1).write.mode("append").json(path)


def _stream(spark, source):
    return spark.readStream.schema("k string, at long, who string").json(source)


def test_repeats_are_rejected_not_dropped(spark, tmp_path):
    log, source, mark = (str(tmp_path / n) for n in ("log", "source", "mark_a"))
    sent = []
    _fed(spark, source, [("a", 2, "late"), ("a", 1, "first"), ("b", 1, "x"), (None, 1, "null")])
    unique.log_stream(_stream(spark, source), log, "k", "at", mark, lambda df: sent.append(df.count())).awaitTermination()
    _fed(spark, source, [("a", 0, "again"), ("c", 1, "y")])
    unique.log_stream(_stream(spark, source), log, "k", "at", mark, lambda df: 1 / 0).awaitTermination()
    read = lambda name: sorted((str(r["k"]), r["who"]) for r in spark.read.parquet(f"{log}/{name}").collect())
    assert read("log") == [("a", "first"), ("b", "x"), ("c", "y")]
    assert read("rejected") == [("None", "null"), ("a", "again"), ("a", "late")]
    assert sent == [2] and [r["k"] for r in spark.read.json(f"{log}/outbox").collect()] == ["c"]
    unique.log_stream(_stream(spark, source), log, "k", "at", mark).awaitTermination()  # nothing new
    assert len(read("log")) == 3


def test_replayed_batches_and_two_writers_add_nothing(spark, tmp_path):
    log, source = (str(tmp_path / n) for n in ("log", "source"))
    _fed(spark, source, [(str(i), i, "x") for i in range(50)])
    runs = [unique.log_stream(_stream(spark, source), log, "k", "at", str(tmp_path / f"mark_{n}")) for n in range(2)]
    for run in runs:
        run.awaitTermination()
    assert spark.read.parquet(f"{log}/log").count() == 50 and spark.read.parquet(f"{log}/rejected").count() == 50
    commits = tmp_path / "mark_0" / "commits"
    for f in os.listdir(commits):
        os.remove(commits / f)  # as if the driver was lost before the batch was noted
    unique.log_stream(_stream(spark, source), log, "k", "at", str(tmp_path / "mark_0")).awaitTermination()
    rows = spark.read.parquet(f"{log}/log")
    assert rows.count() == 50 == rows.select("k").distinct().count()


def test_one_of_two_writers_is_refused(spark, tmp_path):
    path, done = str(tmp_path / "log"), []

    def write(n):
        try:
            done.append(writers.log_rows(spark.createDataFrame([("same", n)], "k string, n int"), path, "k"))
        except ValueError as why:
            done.append(str(why))

    threads = [threading.Thread(target=write, args=(n,)) for n in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(done) == ["k is in the log already"] * 3 + ["logged"] and spark.read.parquet(path).count() == 1
    with writers.locked(spark, f"{path}.lock"), pytest.raises(TimeoutError):
        with writers.locked(spark, f"{path}.lock", wait=0.3):
            pass
    (tmp_path / "old.lock").write_text("")
    os.utime(tmp_path / "old.lock", (0, 0))
    with writers.locked(spark, str(tmp_path / "old.lock"), wait=5):
        pass
