"""Nested JSON documents as relations, by VARIANT values in the JVM."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .lineage import cut

#: Levels that one pass takes apart.
LEVELS = 16


def shape(text: Column) -> Column:
    """The brackets of a JSON text: escapes, then strings, then all else are taken out."""
    plain = F.when(F.contains(text, F.lit("\\")), F.regexp_replace(text, r"(?s)\\.", "")).otherwise(text)
    return F.regexp_replace(F.regexp_replace(plain, '"[^"]*+"', ""), r"[^\[\]{}]++", "")


def depth(brackets: Column) -> Column:
    """How deep brackets nest: 0 for none, 1 for an array or object of scalars; null for null."""
    # pairs are taken out from within, a level at a time; only what is deep or unpaired is counted bracket by bracket
    step = lambda b: F.when(b.isin("[", "{"), 1).when(b == "", 0).otherwise(-1)
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))
    counted = F.aggregate(F.split(brackets, ""), start, lambda at, b: F.struct((at["now"] + step(b)).alias("now"), F.greatest(at["most"], at["now"] + step(b)).alias("most")), lambda at: at["most"])
    rest, out = F.translate(brackets, "{}", "[]"), F.when(F.length(brackets) == 0, 0)
    for level in range(1, 9):
        rest = F.replace(rest, F.lit("[]"), F.lit(""))
        out = out.when(F.length(rest) == 0, level)
    return out.otherwise(counted)


def _levels(df: DataFrame, text: str) -> int:
    """How deep the deepest text of `df` nests."""
    return df.select(shape(F.col(text)).alias("b")).agg(F.max(depth(F.col("b")))).first()[0] or 0


def leaves(df: DataFrame, id_: str, text: str) -> DataFrame:
    """(`id_`, path, kind, value): every value of each document that holds no other, at any depth.

    Paths are `/name/0/name`; kinds string, number, boolean, null, object and array (the last two
    where they are empty); values are texts, null for null. Texts that are no JSON, and null ones,
    give one row of kind `unreadable`.

    A first pass over the texts finds how deep they nest; a second takes all levels apart, one
    after the other in the same task, so that nothing is stored or shuffled between them. A
    document that is deeper than the first pass found, as its text is not the same in both, fails.
    """
    spark = df.sparkSession
    levels = _levels(df, text)
    if levels > LEVELS:
        # brackets of what cannot be read do not count
        levels = _levels(df.where(F.try_parse_json(text).isNotNull()), text)
    at = df.select(id_, F.lit("").alias("path"), F.try_parse_json(text).alias("v"))
    for level in range(levels):
        if level and level % LEVELS == 0:
            at = cut(at)
        # what holds no other comes out as one row of nulls
        below = at.withColumnsRenamed({"path": "_path", "v": "_v"}).lateralJoin(spark.tvf.variant_explode_outer(F.col("_v").outer()))
        leaf = F.col("pos").isNull()
        name = F.coalesce("key", F.col("pos").cast("string"))
        at = below.select(id_, F.when(leaf, F.col("_path")).otherwise(F.concat("_path", F.lit("/"), name)).alias("path"), F.when(leaf, F.col("_v")).otherwise(F.col("value")).alias("v"))
    at = at.select(id_, "path", "v", F.schema_of_variant("v").alias("said"))
    empty = lambda name: F.when(F.to_json("v").isin("[]", "{}"), name).otherwise(F.raise_error(F.lit("a document nests deeper than it did when first read")))
    said = F.col("said")
    kind = F.when(F.col("v").isNull(), "unreadable").when(said == "STRING", "string").when(said == "BOOLEAN", "boolean").when(said == "VOID", "null").when(said.startswith("ARRAY"), empty("array")).when(said.startswith("OBJECT"), empty("object")).otherwise("number")
    value = F.when(~said.isin("VOID") & ~said.startswith("ARRAY") & ~said.startswith("OBJECT"), F.try_variant_get("v", "$", "string"))
    return at.select(id_, "path", kind.alias("kind"), value.alias("value"))


def parted(df: DataFrame, id_: str, text: str, wanted: Mapping[str, str]) -> DataFrame:
    """(relation, `id_`, place, fields): the elements of each path of `wanted` ($.path of an array of
    objects: fields with types) with their places, all relations in one frame and by one reading.

    Fields of the same name have the same type; a relation has nulls in those that are not its own.
    A path that is no array has no row, a field that is missing or of another kind is null.
    """
    own = {path: T.StructType.fromDDL(fields) for path, fields in wanted.items()}
    kinds: dict[str, T.DataType] = {}
    for f in (f for fields in own.values() for f in fields):
        if kinds.setdefault(f.name, f.dataType) != f.dataType:
            raise ValueError(f"{f.name} has two types")

    each = f"array<struct<{', '.join(f'`{n}`: {k.simpleString()}' for n, k in kinds.items())}>>"
    lists = [F.struct(F.lit(path).alias("relation"), F.try_variant_get("_v", path, each).alias("rows")) for path in wanted]
    read = df.select(id_, F.try_parse_json(text).alias("_v")).select(id_, F.explode(F.array(*lists)).alias("r"))
    rows = read.select(id_, "r.relation", F.posexplode("r.rows").alias("place", "x"))
    cell = lambda n: F.col("x")[n] if all(n in fields.names for fields in own.values()) else F.when(F.col("relation").isin([p for p in own if n in own[p].names]), F.col("x")[n])
    return rows.select("relation", id_, "place", *(cell(n).alias(n) for n in kinds))


def relations(df: DataFrame, id_: str, text: str, wanted: Mapping[str, str]) -> dict[str, DataFrame]:
    """A relation for each path of `wanted` ($.path of an array of objects: fields with types), with
    `id_` and the element's place, from one pass over the documents.

    The documents are read and taken apart once, as rows of (relation, place, element), which are
    stored and scanned by each relation; `parted` gives all relations together and stores nothing.
    A path that is no array has no row there, a field that is missing or of another kind is null.
    """
    lists = [F.struct(F.lit(path).alias("relation"), F.try_variant_get("_v", path, "array<variant>").alias("rows")) for path in wanted]
    each = df.select(id_, F.try_parse_json(text).alias("_v")).select(id_, F.explode(F.array(*lists)).alias("r")).select(id_, "r.relation", F.posexplode("r.rows").alias("place", "element"))
    each = cut(each)
    out = {}
    for path, fields in wanted.items():
        kinds = T.StructType.fromDDL(fields)
        cells = [F.try_variant_get("element", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in kinds]
        out[path] = each.where(F.col("relation") == path).select(id_, "place", *cells)
    return out
