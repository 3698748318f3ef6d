"""Scans of delimited, JSON, Markdown and whole-text files; each fails closed."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def csv_table(spark: SparkSession, path: str, schema: str, multiline: bool = True, missing_ok: bool = False) -> DataFrame:
    """A headed CSV; a ragged row, a bad value or another header stops the query.

    `multiline` allows quoted newlines and reads a file in one task; without it files are split.
    A missing file is an error, or with `missing_ok` an empty table.
    """
    if missing_ok and not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("enforceSchema", "false").csv(path, header=True, mode="FAILFAST", multiLine=multiline, escape='"')


def csv_positional(spark: SparkSession, path: str, multiline: bool = True) -> tuple[list[str], DataFrame]:
    """(header, rows) with all cells as texts, nulls empty, columns by place (_1, _2, ...)."""
    df = spark.read.csv(path, header=True, mode="FAILFAST", multiLine=multiline, escape='"', nullValue="\0")
    return df.columns, df.toDF(*(f"_{i}" for i in range(1, len(df.columns) + 1))).fillna("")


def stripped(df: DataFrame) -> DataFrame:
    """All text cells trimmed, nulls empty."""
    return df.select(*(F.trim(F.coalesce(F.col(f"`{c}`"), F.lit(""))).alias(c) if t == "string" else F.col(f"`{c}`") for c, t in df.dtypes))


def csv_repairable(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, ragged rows with what was read of them and the `raw` text)."""
    rows = spark.read.schema(f"{schema}, _bad string").csv(path, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_bad", escape='"')
    return rows.where("_bad IS NULL").drop("_bad"), rows.where("_bad IS NOT NULL").withColumnRenamed("_bad", "raw")


def joined_overflow(bad: DataFrame, n: int, at: int) -> DataFrame:
    """Ragged rows with one cell too many, unquoted, and their `cells` with the one `at` and the
    next joined by a comma again; other ragged rows are left out."""
    cells = F.split("raw", ",")
    whole = F.concat(F.slice(cells, 1, at), F.array(F.concat_ws(",", F.get(cells, F.lit(at)), F.get(cells, F.lit(at + 1)))), F.slice(cells, at + 3, n))
    return bad.where(F.size(cells) == n + 1).withColumn("cells", whole)


def header_faults(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """(path, errors) of files with a byte order mark, carriage returns or another header."""
    files = spark.read.format("binaryFile").load(path).select("path", F.col("content").cast("string").alias("t"), F.substring("content", 1, 3).alias("mark"))
    first = F.regexp_replace(F.substring_index("t", "\n", 1), "\r$", "")
    rules = [("bom", F.hex("mark") == "EFBBBF"), ("crlf", F.contains("t", F.lit("\r"))), ("header", F.ltrim(first, F.lit("﻿")) != ",".join(columns))]
    errors = F.array_compact(F.array(*(F.when(bad, F.lit(name)) for name, bad in rules)))
    return files.select("path", errors.alias("errors")).where(F.size("errors") > 0)


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One object a line; blank lines are skipped, bad JSON stops the query."""
    return spark.read.schema(schema).json(path, mode="FAILFAST")


def config(spark: SparkSession, path: str, required: Sequence[str] = (), parse: Callable[[str], object] = json.loads) -> dict:
    """A small document that the driver needs (manifest, schema, policy), with its required keys."""
    found = parse(spark.read.text(path, wholetext=True).first()[0])
    if not isinstance(found, dict):
        raise ValueError(f"{path} holds no mapping")
    if missing := [k for k in required if k not in found]:
        raise ValueError(f"{path} lacks {missing}")
    return found


def whole_texts(spark: SparkSession, path: str, pattern: str = "*", folders: Sequence[str] | None = None) -> DataFrame:
    """(path, folder, name, text) of all files below `path`; with `folders` only those
    subfolders' files are read at all."""
    paths = [path] if folders is None else [p for p in (f"{path}/{f}" for f in folders) if exists(spark, p)]
    if not paths:
        return spark.createDataFrame([], "path string, folder string, name string, text string")
    rows = spark.read.text(paths, wholetext=True, recursiveFileLookup=True, pathGlobFilter=pattern)
    where = F.col("_metadata.file_path")
    parts = F.split(where, "/")
    return rows.select(where.alias("path"), F.element_at(parts, -2).alias("folder"), F.col("_metadata.file_name").alias("name"), F.col("value").alias("text"))


def parsed(files: DataFrame, parse: Callable[[str], object]) -> DataFrame:
    """`files` with `doc`, the JSON of what the caller's parser (a YAML loader, say) makes of `text`;
    what is no mapping stops the query."""

    @F.pandas_udf("string")
    def to_json(texts: pd.Series) -> pd.Series:
        def one(text: str) -> str:
            found = parse(text)
            if not isinstance(found, dict):
                raise ValueError("a document is no mapping")
            return json.dumps(found, ensure_ascii=False, sort_keys=True, default=str)

        return texts.map(one)

    return files.withColumn("doc", to_json("text"))


def by_folder(files: DataFrame, asked: DataFrame, order: Sequence[str]) -> DataFrame:
    """For each asked `name` the file of the first folder in `order` that has it, else nulls."""
    place = F.array_position(F.array(*(F.lit(f) for f in order)), F.col("folder"))
    rest = [c for c in files.columns if c != "name"]
    best = files.where(place > 0).groupBy("name").agg(F.min_by(F.struct(*rest), F.struct(place, F.col("path"))).alias("best"))
    return asked.select("name").distinct().join(best, "name", "left").select("name", "best.*")


def sections(spark: SparkSession, path: str) -> DataFrame:
    """(path, title, level, body) of Markdown files' sections; text before a heading has level 0."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("path"), F.concat(F.lit("\n"), "value").alias("t"))
    parts = files.select("path", F.posexplode(F.split("t", r"\n(?=#{1,6} )")).alias("pos", "s"))
    first = F.substring_index("s", "\n", 1)
    head = F.regexp_extract(first, r"^(#{1,6}) +(.*)$", 1)
    is_head = head != ""
    body = F.when(is_head, F.substr("s", F.char_length(first) + 2)).otherwise(F.col("s"))
    return parts.select("path", "pos", F.when(is_head, F.btrim(F.regexp_extract(first, r"^(#{1,6}) +(.*)$", 2))).alias("title"), F.char_length(head).alias("level"), F.btrim(body, F.lit(" \n")).alias("body")).where("title IS NOT NULL OR body <> ''")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, at, line): files are small documents, a file a task."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return files.select("path", F.posexplode(F.split("value", "\r?\n")).alias("at", "line"))


def markdown_table(spark: SparkSession, path: str, columns: Sequence[str], pending: str | None = None) -> DataFrame:
    """(path, at, columns) of the rows of Markdown tables with that many cells; rules, headings
    that repeat the column names and rows with a cell `pending` are left out."""
    cells = F.transform(F.split(F.regexp_extract("line", r"^\s*\|(.*)\|\s*$", 1), r"\|"), lambda c: F.trim(c))
    rows = _lines(spark, path).where(F.col("line").rlike(r"^\s*\|.*\|\s*$")).select("path", "at", cells.alias("c")).where(F.size("c") == len(columns))
    rows = rows.where(~F.forall("c", lambda c: c.rlike("^:?-+:?$")) & (F.array_join("c", "|") != "|".join(columns)))
    if pending is not None:
        rows = rows.where(~F.array_contains("c", pending))
    return rows.select("path", "at", *(F.get("c", F.lit(i)).alias(name) for i, name in enumerate(columns)))


def first_field(spark: SparkSession, path: str, field: str) -> DataFrame:
    """(path, value) of the first line `field: value` of each file, without quotes; null if none."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    value = F.trim(F.regexp_extract("value", rf"(?m)^\s*{field}:[ \t]*(.*)$", 1))
    return files.select(F.col("_metadata.file_path").alias("path"), F.nullif(F.regexp_replace(value, "^[\"']|[\"']$", ""), F.lit("")).alias("value"))


def front_matter(spark: SparkSession, path: str) -> DataFrame:
    """(path, key, value, items) of the `key: value` lines between the first two `---` lines;
    `items` holds a list's texts, in brackets or as `- item` lines below the key."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("path"), F.regexp_extract("value", r"(?s)^---\r?\n(.*?)\r?\n---", 1).alias("m"))
    entries = files.select("path", F.explode(F.regexp_extract_all("m", F.lit(r"(?m)^([A-Za-z_][\w-]*:.*(?:\n[ \t]*- .*)*)$"), F.lit(1))).alias("e"))
    bare = lambda c: F.regexp_replace(F.trim(c), "^[\"']|[\"']$", "")
    first = F.substring_index("e", "\n", 1)
    value = F.trim(F.substr(first, F.instr(first, ":") + 1))
    inside = F.filter(F.transform(F.split(F.regexp_replace(value, r"^\[|\]$", ""), ","), bare), lambda x: x != "")
    below = F.transform(F.regexp_extract_all("e", F.lit(r"\n[ \t]*- (.*)"), F.lit(1)), bare)
    items = F.when(value.startswith("["), inside).when(value == "", below)
    return entries.select("path", F.split_part("e", F.lit(":"), F.lit(1)).alias("key"), bare(value).alias("value"), items.alias("items"))


def gate_statuses(spark: SparkSession, path: str) -> DataFrame:
    """(path, gate, status) of a governance report: `[S1 name]`, and the `status:` below it."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.explode(F.split("value", r"(?m)^(?=\[S\d+)")).alias("s"))
    gate, status = F.regexp_extract("s", r"^\[(S\d+)", 1), F.regexp_extract("s", r"(?m)^\s*status:\s*(\w+)", 1)
    return files.where(gate != "").select("path", gate.alias("gate"), F.nullif(status, F.lit("")).alias("status"))


def table_counts(spark: SparkSession, names: Sequence[str], database: str = "default") -> DataFrame:
    """(name, n) of tables of the catalog that are named plainly and asked for; n null if missing."""
    there = {t.name for t in spark.catalog.listTables(database) if not t.isTemporary}
    out = spark.createDataFrame([(n,) for n in names if n not in there], "name string").withColumn("n", F.lit(None).cast("long"))
    for name in names:
        if not name.replace("_", "").isalnum():
            raise ValueError(f"{name!r} is no table name")
        if name in there:
            out = out.unionByName(spark.table(f"{database}.{name}").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n"))
    return out


def as_markdown(df: DataFrame, column: str, name: str = "markdown") -> DataFrame:
    """`df` with a JSON cell as nested Markdown headings and lists."""

    def lines(found: object, depth: int) -> list[str]:
        if isinstance(found, dict):
            return [x for k, v in found.items() for x in (f"{'#' * min(depth, 6)} {k}", *lines(v, depth + 1))]
        if isinstance(found, list):
            return [f"- {x}" if not isinstance(x, (dict, list)) else "\n".join(lines(x, depth)) for x in found]
        return ["" if found is None else str(found)]

    @F.pandas_udf("string")
    def render(cells: pd.Series) -> pd.Series:
        return cells.map(lambda c: None if c is None else "\n".join(lines(json.loads(c), 1)))

    return df.withColumn(name, render(column))


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """(path, size, sha256) of every file; hidden files are skipped by Spark."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))
