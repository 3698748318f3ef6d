"""JSON-Schema documents compiled to column expressions, and a preflight of many tables.

A schema becomes one expression that gives a row's errors as `path: keyword`, so a table is
validated in one pass inside the JVM. Typed columns are checked as what they are; cells of JSON
become VARIANT values, which carry their types at any depth. A null column counts as absent, a
null inside JSON as null.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Keywords that say nothing about validity.
_NOTES = {"$schema", "$id", "$defs", "$comment", "title", "description", "default", "examples", "format", "deprecated", "readOnly", "writeOnly"}
#: More than this many errors are counted, not listed.
MOST_ERRORS = 50


def _no_errors() -> Column:
    return F.array().cast("array<string>")


def _all(parts: Iterable[Column | None]) -> Column | None:
    """All errors of rules, None where none of them can have one."""
    parts = [p for p in parts if p is not None]
    return F.concat(*parts) if len(parts) > 1 else parts[0] if parts else None


def _listed(errors: Column | None) -> Column:
    return _no_errors() if errors is None else errors


def _error(path: Column, word: str, bad: Column | bool) -> Column | None:
    """One error where `bad` is true; None if it never is."""
    if bad is False:
        return None
    return F.when(F.lit(True) if bad is True else bad, F.array(F.concat(F.when(path == "", "<root>").otherwise(path), F.lit(f": {word}")))).otherwise(_no_errors())


def _join(path: Column, name: Column) -> Column:
    return F.when(path == "", name).otherwise(F.concat(path, F.lit("/"), name))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value evaluated once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def variant_type(v: Column) -> Column:
    """The type of a VARIANT value: ARRAY, OBJECT or that of a scalar.

    `schema_of_variant` walks through all that a value holds, so only scalars are given to it.
    """
    return F.when(F.try_variant_get(v, "$", "array<variant>").isNotNull(), "ARRAY").when(F.try_variant_get(v, "$", "map<string,variant>").isNotNull(), "OBJECT").otherwise(F.schema_of_variant(v))


class _Value:
    """A value with a Spark type; null is absent, except in a VARIANT, which has a null of its own."""

    def __init__(self, column: Column, kind: T.DataType, said: Column | None = None):
        self.column, self.kind, self.said = column, kind, said
        self.loose = isinstance(kind, T.VariantType)

    def bound(self, body: Callable[[_Value], Column]) -> Column:
        """body(self), with a VARIANT and its type evaluated once."""
        if not self.loose or self.said is not None:
            return body(self)
        return let(self.column, lambda c: let(variant_type(c), lambda said: body(_Value(c, self.kind, said))))

    def is_(self, name: str) -> Column | bool:
        """Whether a present value has this JSON type; a bool where its Spark type says so."""
        c, k = self.column, self.kind
        if self.loose:
            said = self.said if self.said is not None else variant_type(c)
            number = said.isin("BIGINT", "DOUBLE", "FLOAT") | said.startswith("DECIMAL")
            return {
                "string": said == "STRING", "boolean": said == "BOOLEAN", "null": said == "VOID", "number": number, "array": said == "ARRAY", "object": said == "OBJECT",
                "integer": (said == "BIGINT") | (number & (F.try_variant_get(c, "$", "double") % 1 == 0)),
            }[name]
        whole = isinstance(k, T.IntegralType)
        static = {"string": isinstance(k, T.StringType), "boolean": isinstance(k, T.BooleanType), "null": False, "number": whole or isinstance(k, T.NumericType), "integer": whole, "array": isinstance(k, T.ArrayType), "object": isinstance(k, (T.StructType, T.MapType))}[name]
        if name == "integer" and not whole and isinstance(k, T.NumericType):
            return F.coalesce(c % 1 == 0, F.lit(False))
        return static

    def text(self) -> Column:
        """The string, null for other types."""
        if self.loose:
            return F.when(self.is_("string"), F.try_variant_get(self.column, "$", "string"))
        return self.column if isinstance(self.kind, T.StringType) else F.lit(None).cast("string")

    def number(self) -> Column:
        if self.loose:
            return F.when(self.is_("number"), F.try_variant_get(self.column, "$", "double"))
        return self.column if isinstance(self.kind, T.NumericType) else F.lit(None).cast("double")

    def items(self) -> tuple[Column, T.DataType] | None:
        """The elements and their type, null for other types."""
        if self.loose:
            return F.when(self.is_("array"), F.try_variant_get(self.column, "$", "array<variant>")), T.VariantType()
        return (self.column, self.kind.elementType) if isinstance(self.kind, T.ArrayType) else None

    def keys(self) -> Column:
        """Names of the members that are there, null for other types."""
        if self.loose:
            return F.when(self.is_("object"), F.map_keys(F.try_variant_get(self.column, "$", "map<string,variant>")))
        if isinstance(self.kind, T.MapType):
            return F.map_keys(self.column)
        if isinstance(self.kind, T.StructType):
            return F.when(self.column.isNotNull(), F.array_compact(F.array(*(F.when(self.column[f.name].isNotNull(), F.lit(f.name)) for f in self.kind))))
        return F.lit(None).cast("array<string>")

    def lacks(self, name: str) -> Column:
        """Whether an object is without this member, null or false for other types."""
        if self.loose:
            return self.is_("object") & self.member(name).column.isNull()
        if isinstance(self.kind, T.StructType):
            return self.column.isNotNull() & (self.column[name].isNull() if name in self.kind.names else F.lit(True))
        return ~F.array_contains(self.keys(), name)

    def member(self, name: str) -> _Value | None:
        if self.loose and re.fullmatch("[A-Za-z_][A-Za-z0-9_]*", name):
            return _Value(F.try_variant_get(self.column, f"$.{name}", "variant"), T.VariantType())
        if self.loose:
            members = F.when(self.is_("object"), F.try_variant_get(self.column, "$", "map<string,variant>"))
            return _Value(F.try_element_at(members, F.lit(name)), T.VariantType())
        if isinstance(self.kind, T.MapType):
            return _Value(F.try_element_at(self.column, F.lit(name)), self.kind.valueType)
        if isinstance(self.kind, T.StructType) and name in self.kind.names:
            return _Value(self.column[name], self.kind[name].dataType)
        return None

    def written(self) -> Column:
        """The value as JSON, to be compared."""
        if self.loose or isinstance(self.kind, (T.ArrayType, T.StructType, T.MapType)):
            return F.to_json(self.column)
        if isinstance(self.kind, T.StringType):
            return F.regexp_extract(F.to_json(F.struct(self.column.alias("v"))), r'^\{"v":(.*)\}$', 1)
        return self.column.cast("string")


class _Row(_Value):
    """A row of a table: an object whose members are its columns.

    A text cell whose property has another type is read as JSON; what is none stays a string.
    """

    def __init__(self, fields: T.StructType, cells: Mapping[str, Mapping]):
        self.fields, self.cells, self.loose = fields, cells, False

    def lacks(self, name: str) -> Column:
        return F.col(f"`{name}`").isNull() if name in self.fields.names else F.lit(True)

    def is_(self, name: str) -> bool:
        return name == "object"

    def text(self) -> Column:
        return F.lit(None).cast("string")

    def number(self) -> Column:
        return F.lit(None).cast("double")

    def items(self) -> None:
        return None

    def keys(self) -> Column:
        return F.array_compact(F.array(*(F.when(F.col(f"`{n}`").isNotNull(), F.lit(n)) for n in self.fields.names)))

    def member(self, name: str) -> _Value | None:
        if name not in self.fields.names:
            return None
        c, kind = F.col(f"`{name}`"), self.fields[name].dataType
        if isinstance(kind, T.StringType) and self.cells.get(name, {"string"}) & {"integer", "number", "boolean", "array", "object"}:
            return _Value(F.coalesce(F.try_parse_json(c), c.cast("variant")), T.VariantType())
        return _Value(c, kind)

    def written(self) -> Column:
        return F.to_json(F.struct(*(F.col(f"`{n}`") for n in self.fields.names)))


class Compiler:
    """Turns schema documents into error expressions; `$ref` leads into `document` alone.

    Known keywords: type, enum, const, pattern, minLength, maxLength, minimum, maximum,
    exclusiveMinimum, exclusiveMaximum, multipleOf, required, properties, additionalProperties,
    minProperties, items, minItems, maxItems, uniqueItems, contains, allOf, anyOf, oneOf, not,
    if/then/else and $ref. An unknown keyword and a reference that leads nowhere or to itself are
    errors when the schema is compiled: what cannot be checked is not passed.
    """

    def __init__(self, document: Mapping):
        self.document = document

    def resolve(self, ref: str) -> Mapping:
        at = self.document
        for name in ref.removeprefix("#").strip("/").split("/"):
            if not ref.startswith("#") or not isinstance(at, Mapping) or name not in at:
                raise ValueError(f"no such definition: {ref}")
            at = at[name]
        return at

    def flat(self, schema: Mapping, seen: tuple = ()) -> list[Mapping]:
        """A schema and those that its $ref and allOf add to it."""
        out = [schema]
        if (ref := schema.get("$ref")) is not None:
            if ref in seen:
                raise ValueError(f"{ref} refers to itself")
            out += self.flat(self.resolve(ref), (*seen, ref))
        for part in schema.get("allOf", ()):
            out += self.flat(part, seen)
        return out

    def cell_types(self, schema: Mapping) -> dict[str, set[str]]:
        """The JSON types that a row's schema names for each of its properties."""
        out: dict[str, set[str]] = {}
        for part in self.flat(schema):
            for name, sub in part.get("properties", {}).items():
                for s in self.flat(sub):
                    named = s.get("type", [])
                    out.setdefault(name, set()).update([named] if isinstance(named, str) else named)
        return {k: v - {"string"} if "string" not in v else {"string"} for k, v in out.items() if v}

    def row_errors(self, schema: Mapping, fields: T.StructType) -> Column:
        """Errors of a table's rows, sorted."""
        return F.sort_array(F.array_distinct(_listed(self.errors(_Row(fields, self.cell_types(schema)), schema, F.lit("")))))

    def json_errors(self, schema: Mapping, column: Column) -> Column:
        """Errors of a column of JSON texts; one that cannot be read has the error `<root>: json`."""
        found = lambda v: F.sort_array(F.array_distinct(_listed(self.errors(v, schema, F.lit("")))))
        read = _Value(F.try_parse_json(column), T.VariantType())
        return read.bound(lambda v: F.when(v.column.isNull(), F.array(F.lit("<root>: json"))).otherwise(found(v)))

    def errors(self, value: _Value, schema: Mapping | bool, path: Column, refs: tuple = ()) -> Column | None:
        """The errors of a value; None where it can have none."""
        if isinstance(schema, bool):
            return _error(path, "false", not schema)
        if not value.loose:
            return self._all_words(value, schema, path, refs)
        return value.bound(lambda v: _listed(self._all_words(v, schema, path, refs)))

    def _all_words(self, value: _Value, schema: Mapping, path: Column, refs: tuple) -> Column | None:
        parts = []
        for word, want in schema.items():
            if word in _NOTES or word in ("then", "else"):
                continue
            rule: Callable | None = getattr(self, f"_{word.lstrip('$')}", None)
            if rule is None:
                raise ValueError(f"cannot check {word}")
            if word == "$ref":
                if want in refs:
                    raise ValueError(f"{want} refers to itself")
                parts.append(self.errors(value, self.resolve(want), path, (*refs, want)))
            elif word in ("properties", "items", "contains", "additionalProperties", "allOf", "anyOf", "oneOf", "not", "if"):
                parts.append(rule(value, want, path, schema, refs))
            else:
                parts.append(rule(value, want, path))
        return _all(parts)

    def _fits(self, value, schema, path, refs) -> Column:
        return F.size(_listed(self.errors(value, schema, path, refs))) == 0

    def _ref(self):
        raise NotImplementedError

    def _type(self, v, want, path):
        names = [want] if isinstance(want, str) else want
        known = [v.is_(n) for n in names]
        if any(k is True for k in known):
            return None
        known = [k for k in known if k is not False]
        return _error(path, "type", ~reduce(Column.__or__, known) if known else True)

    def _enum(self, v, want, path):
        return _error(path, "enum", ~v.written().isin([json.dumps(x, ensure_ascii=False, separators=(",", ":"), sort_keys=True) for x in want]))

    def _const(self, v, want, path):
        return _error(path, "const", v.written() != json.dumps(want, ensure_ascii=False, separators=(",", ":"), sort_keys=True))

    def _pattern(self, v, want, path):
        return _error(path, "pattern", ~v.text().rlike(want))

    def _minLength(self, v, want, path):
        return _error(path, "minLength", F.char_length(v.text()) < want)

    def _maxLength(self, v, want, path):
        return _error(path, "maxLength", F.char_length(v.text()) > want)

    def _minimum(self, v, want, path):
        return _error(path, "minimum", v.number() < want)

    def _maximum(self, v, want, path):
        return _error(path, "maximum", v.number() > want)

    def _exclusiveMinimum(self, v, want, path):
        return _error(path, "exclusiveMinimum", v.number() <= want)

    def _exclusiveMaximum(self, v, want, path):
        return _error(path, "exclusiveMaximum", v.number() >= want)

    def _multipleOf(self, v, want, path):
        return _error(path, "multipleOf", v.number() % want != 0)

    def _required(self, v, want, path):
        return _all(_error(_join(path, F.lit(n)), "required", v.lacks(n)) for n in want)

    def _minProperties(self, v, want, path):
        return _error(path, "minProperties", F.size(v.keys()) < want)

    def _minItems(self, v, want, path):
        return _error(path, "minItems", F.size(v.items()[0]) < want) if v.items() else None

    def _maxItems(self, v, want, path):
        return _error(path, "maxItems", F.size(v.items()[0]) > want) if v.items() else None

    def _uniqueItems(self, v, want, path):
        if not want or not v.items():
            return None
        each, kind = v.items()
        texts = F.transform(each, lambda x: _Value(x, kind).written())
        return let(texts, lambda t: _error(path, "uniqueItems", F.size(F.array_distinct(t)) < F.size(t)))

    def _properties(self, v, want, path, schema, refs):
        parts = []
        for name, sub in want.items():
            member = v.member(name)
            if member is not None:
                at = _join(path, F.lit(name))
                if not member.loose:
                    found = self.errors(member, sub, at)
                    parts.append(None if found is None else F.when(member.column.isNotNull(), found).otherwise(_no_errors()))
                else:
                    parts.append(member.bound(lambda m, sub=sub, at=at: F.when(m.column.isNotNull(), _listed(self.errors(m, sub, at))).otherwise(_no_errors())))
        return _all(parts)

    def _additionalProperties(self, v, want, path, schema, refs):
        if want is True:
            return None
        if want is not False:
            raise ValueError("cannot check additionalProperties that have a schema")
        names = F.array(*(F.lit(n) for n in schema.get("properties", {}))).cast("array<string>")
        extra = F.array_except(v.keys(), names)
        listed = F.transform(extra, lambda n: F.concat(_join(path, n), F.lit(": additionalProperties")))
        return F.coalesce(listed, _no_errors())

    def _items(self, v, want, path, schema, refs):
        if not v.items():
            return None
        each, kind = v.items()
        one = lambda x, i: self.errors(_Value(x, kind), want, _join(path, i.cast("string")))
        if isinstance(kind, T.VariantType):
            found = F.transform(each, lambda x, i: _listed(one(x, i)))
            return F.coalesce(F.flatten(found), _no_errors())
        # a null element of a typed array is a null, which has no type but null's
        null = lambda i: _error(_join(path, i.cast("string")), "type", True)
        found = F.flatten(F.transform(each, lambda x, i: F.when(x.isNull(), null(i)).otherwise(_listed(one(x, i)))))
        if self.errors(_Value(F.lit(None), kind), want, path) is None:
            # only nulls can be wrong
            return F.when(F.exists(each, lambda x: x.isNull()), found).otherwise(_no_errors())
        return F.coalesce(found, _no_errors())

    def _contains(self, v, want, path, schema, refs):
        if not v.items():
            return None
        each, kind = v.items()
        return _error(path, "contains", ~F.exists(each, lambda x: self._fits(_Value(x, kind), want, path, ())))

    def _allOf(self, v, want, path, schema, refs):
        return _all(self.errors(v, s, path, refs) for s in want)

    def _anyOf(self, v, want, path, schema, refs):
        return _error(path, "anyOf", ~reduce(Column.__or__, [self._fits(v, s, path, refs) for s in want]))

    def _oneOf(self, v, want, path, schema, refs):
        return _error(path, "oneOf", sum((self._fits(v, s, path, refs).cast("int") for s in want), F.lit(0)) != 1)

    def _not(self, v, want, path, schema, refs):
        return _error(path, "not", self._fits(v, want, path, refs))

    def _if(self, v, want, path, schema, refs):
        return F.when(self._fits(v, want, path, refs), _listed(self.errors(v, schema.get("then", True), path, refs))).otherwise(_listed(self.errors(v, schema.get("else", True), path, refs)))


def row_errors(df: DataFrame, document: Mapping, definition: str | list[str]) -> Column:
    """The sorted errors of each row of `df` against all the named definitions."""
    names = [definition] if isinstance(definition, str) else definition
    return Compiler(document).row_errors({"allOf": [{"$ref": f"#/$defs/{n}"} for n in names]}, df.schema)


def violations(df: DataFrame, document: Mapping, definition: str | list[str], keys: list[str]) -> DataFrame:
    """(keys, error): a row for each error of each row of `df` against all the named definitions."""
    return df.select(*keys, F.explode(row_errors(df, document, definition)).alias("error"))


def preflight(tables: list[tuple[str, DataFrame | None, Mapping, str | list[str], list[str]]], most: int = MOST_ERRORS) -> DataFrame:
    """(name, status, checked_rows, n_violations, first, truncated) of each table (name, rows,
    schema document, definitions, keys); rows None: the table is missing, which fails, as does a
    definition that is missing or cannot be checked. `first` has the first `most` errors by key.
    """

    def one(name, df, document, definition, keys) -> DataFrame:
        if df is None:
            return _failed(spark, name, "the table is missing")
        try:
            bad, errors = violations(df, document, definition, keys), row_errors(df, document, definition)
        except ValueError as why:
            return _failed(spark, name, str(why))
        label = F.concat(F.array_join(F.array(*(F.col(k).cast("string") for k in keys)), ","), F.lit(" "), F.col("error"))
        # each task keeps the first few; the rest are only counted
        first = bad.orderBy(*keys, "error").limit(most).agg(F.sort_array(F.collect_list(F.struct(*keys, "error", label.alias("_e")))).alias("f"))
        counts = df.agg(F.count(F.lit(1)).alias("checked_rows"), F.coalesce(F.sum(F.size(errors)), F.lit(0).cast("long")).alias("n_violations"))
        # two tables of one row
        both = counts.crossJoin(F.broadcast(first))
        return both.select(F.lit(name).alias("name"), F.when(F.col("n_violations") > 0, "fail").otherwise("pass").alias("status"), "checked_rows", "n_violations", F.col("f._e").alias("first"), (F.col("n_violations") > most).alias("truncated"))

    spark = next((df.sparkSession for _, df, *_ in tables if df is not None), None) or SparkSession.active()
    return reduce(DataFrame.unionByName, [one(*t) for t in tables])


def _failed(spark: SparkSession, name: str, why: str) -> DataFrame:
    kinds = "name string, status string, checked_rows long, n_violations long, first array<string>, truncated boolean"
    return spark.createDataFrame([(name, "fail", 0, 1, [why], False)], kinds)
